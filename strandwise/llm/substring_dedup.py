"""Substring deduplication with a log-structured fingerprint index.

A window is `words` consecutive words ([^\\x20\\x09-\\x0D]+, unchanged) of one document. A word is removed if a window that covers
it also starts in a document of a lesser id; windows are judged on the input. Documents come in batches of rising ids.

1. A window's fingerprint is the least hash of the `gram`-word grams inside it (winnowing): equal windows have equal
   fingerprints and neighbours mostly share one. It names the bucket that owns the window, so neighbours travel together.
2. A task first looks at its own Arrow batch: a window that a lesser id of that batch has is repeated and stays at home. So a bucket
   gets a window once from each Arrow batch at most, however common it is.
3. A bucket sorts its windows and merge-joins them with the older runs: what is in a run, or has a lesser id in the batch, is
   repeated. All ids of older runs are less, so runs hold no ids and history is never read again.
4. The bucket's new windows become a run: an immutable table, one row a bucket with its sorted window hashes, bucketed so that
   later joins shuffle no run. When a batch comes, runs of one level are compacted two by two into one of the next, so their
   number stays logarithmic. The newest batch is no run yet unless it is flushed.
5. What was found is verified on the text of the row that loses words: the window at that place must have that hash.

A window is told by 64 bits, mixed of its fingerprint and 40 bits of an independent hash of all its words. Null and empty texts,
and texts of fewer words, lose nothing. Rows with a null id lose nothing and are no source. Rows that repeat an id are one
document as a source; each row is judged by its own text. Empty tables give empty results. The result has columns of its own
only; extra columns of docs, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _text
from ._bloom import among, bitmap, which
from ._runtime import modest, release, remove_path, shared_dir, stored

WORDS, GRAM, BATCHES = 13, 6, 4
#: Windows of one row at most, and bytes of text for a bucket, about: it is sorted in one task's memory.
RUN, BUCKET = 120, 8 << 20
#: Bits of a window's own hash.
KEY = np.uint64((1 << 40) - 1)


def prints(w: _text.Words, words: int, gram: int) -> np.ndarray:
    """The fingerprint of the window from each word on (void where none starts)."""
    g = _text.chain(w.hashes, gram)
    n = len(w.hashes) - words + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = g[:n].copy()
    for j in range(1, words - gram + 1):
        np.minimum(out, g[j : j + n], out=out)
    return out


def keys(w: _text.Words, words: int) -> np.ndarray:
    return _text.chain(w.hashes, words) & KEY


def windows(col: pa.Array, words: int, gram: int) -> tuple[np.ndarray, ...]:
    """Row, place, fingerprint and key of all windows of a column."""
    out = []
    for w in _text.slices(col):
        fp, key = prints(w, words, gram), keys(w, words)
        n = np.diff(w.of)
        row, at = np.repeat(np.arange(len(n)), n), np.arange(len(w.hashes))
        use = np.flatnonzero(w.of[1:][row] - at >= words)
        out.append((w.first + row[use], use - w.of[:-1][row[use]], fp[use], key[use]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (*[np.zeros(0, np.int64)] * 2, *[np.zeros(0, np.uint64)] * 2)


def names(fp: np.ndarray, key: np.ndarray) -> np.ndarray:
    return _text.mix(fp ^ _text.mix(key))


def later(name: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which windows have a copy of a lesser id."""
    order = np.lexsort((ids, name))
    x, i = name[order], ids[order]
    first = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))[: len(x)]
    least = np.repeat(i[first], np.diff(np.append(first, len(x))))
    out = np.empty(len(x), bool)
    out[order] = i > least
    return out


def stretches(row: np.ndarray, at: np.ndarray, same: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of the stretches of neighbouring windows (of equal `same`), of at most RUN."""
    if not len(row):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.concatenate(([True], (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)))
    if same is not None:
        cut[1:] |= same[1:] != same[:-1]
    first = np.flatnonzero(cut)
    since = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
    first = np.flatnonzero(since % RUN == 0)
    return first, np.diff(np.append(first, len(row)))


def planes(x: np.ndarray, size: int) -> bytes:
    """Numbers by their bytes, all lowest ones first: zeros and sorted numbers compress well then."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T.tobytes()


def unplanes(b: bytes, size: int) -> np.ndarray:
    x = np.frombuffer(b, np.uint8).reshape(size, -1)
    out = np.zeros((x.shape[1], 8), np.uint8)
    out[:, :size] = x.T
    return out.view("<u8").ravel()


ASKED = "p int, id binary, at binary, n binary, fp binary, key binary"
MARKS = "id long, pos long, n long, key long"
#: What a bucket answers: marks, or its run.
ANSWER = f"p int, {MARKS}, run binary"


def answer(p: int, marks: tuple[np.ndarray, ...], run: bytes | None) -> pa.Table:
    id_, pos, n, key = (np.asarray(c).astype(np.int64) for c in marks)
    more = 0 if run is None else 1
    cols = [pa.array(np.concatenate((c, np.zeros(more, np.int64)))) for c in (id_, pos, n, key)]
    last = pa.array([None] * len(id_) + [run] * more, pa.binary())
    return pa.Table.from_arrays([pa.array(np.full(len(id_) + more, p, np.int32)), *cols, last], ["p", "id", "pos", "n", "key", "run"])


class FingerprintIndex:
    """Runs of the windows of all batches so far."""

    def __init__(self, spark: SparkSession, words: int = WORDS, gram: int = GRAM, buckets: int | None = None):
        self.spark, self.words, self.gram = spark, words, gram
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs: list[tuple[int, str]] = []  # (level, table)
        self.tables: list[str] = []

    def _write(self, rows: DataFrame) -> str:
        name = f"strandwise_run_{uuid.uuid4().hex}"
        rows.write.format("parquet").bucketBy(self.buckets, "p").option("path", f"{shared_dir(self.spark)}/strandwise/{name}").saveAsTable(name)
        self.tables.append(name)
        return name

    def _drop(self, name: str) -> None:
        self.tables.remove(name)
        self.spark.sql(f"drop table {name}")
        remove_path(self.spark, f"{shared_dir(self.spark)}/strandwise/{name}")

    def drop(self) -> None:
        for name in list(self.tables):
            self._drop(name)
        self.runs = []

    def run(self, name: str) -> DataFrame:
        """(p, run): one row a bucket."""
        return self.spark.table(name).where("run is not null").select("p", "run")

    def compact(self) -> None:
        """Merge-join pairs of runs of one level into a run of the next."""

        @F.arrow_udf("binary")
        def merged(a: pa.Array, b: pa.Array) -> pa.Array:
            return pa.array([planes(np.union1d(unplanes(x, 8), unplanes(y, 8)), 8) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.binary())

        while len(self.runs) > 1 and self.runs[-1][0] == self.runs[-2][0]:
            (level, one), (_, two) = self.runs[-2], self.runs[-1]
            a, b = self.run(one), self.run(two).withColumnRenamed("run", "other")
            both = a.join(b, "p").select("p", merged("run", "other").alias("run"))
            self.runs[-2:] = [(level + 1, self._write(both))]

    def add(self, batch: DataFrame, flush: bool = True) -> DataFrame:
        """The repeated windows of a batch (id, text): stretches (id, pos, n) and the key of the first, stored. flush: the batch becomes a run."""
        self.compact()
        words, gram, buckets = self.words, self.gram, self.buckets

        def send(batches):
            for b in batches:
                row, at, fp, key = windows(b.column(1), words, gram)
                if not len(row):
                    continue
                ids = b.column(0).to_numpy(zero_copy_only=False)[row]
                known = later(names(fp, key), ids)
                use = np.flatnonzero(known)
                first, n = stretches(row[use], at[use])
                got = [(0, ids[use][first], at[use][first], n, None, key[use][first])] if len(first) else []
                use = np.flatnonzero(~known)
                row, at, fp, key, ids = row[use], at[use], fp[use], key[use], ids[use]
                first, n = stretches(row, at, fp)
                to = (_text.mix(fp[first]) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                cut = np.searchsorted(to[order], np.arange(buckets + 1))
                for p in np.flatnonzero(np.diff(cut)).tolist():
                    f = first[order[cut[p] : cut[p + 1]]]
                    m = n[order[cut[p] : cut[p + 1]]]
                    each = np.repeat(f - (np.cumsum(m) - m), m) + np.arange(m.sum())
                    got.append((p, ids[f], at[f], m, fp[f], key[each]))
                if got and got[0][4] is None:  # these are no question: any bucket passes them on
                    got[0] = (int(got[0][1][0]) % buckets, *got[0][1:])
                cols = [
                    pa.array([x[0] for x in got], pa.int32()), pa.array([planes(x[1], 8) for x in got], pa.binary()), pa.array([planes(x[2], 4) for x in got], pa.binary()),
                    pa.array([planes(x[3], 1) for x in got], pa.binary()), pa.array([None if x[4] is None else planes(x[4], 8) for x in got], pa.binary()), pa.array([planes(x[5], 5) for x in got], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(cols, ["p", "id", "at", "n", "fp", "key"])
            release()

        def bucket(key_of: tuple, asked: pa.Table, older: pa.Table) -> pa.Table:
            p = key_of[0].as_py()
            marks, got = [], []
            for r in asked.to_pylist():
                if r["id"] is None:
                    continue
                id_, at, n, key = unplanes(r["id"], 8).view(np.int64), unplanes(r["at"], 4).view(np.int64), unplanes(r["n"], 1).view(np.int64), unplanes(r["key"], 5)
                if r["fp"] is None:
                    marks.append((id_, at, n, key))
                else:
                    got.append((id_, at, n, unplanes(r["fp"], 8), key))
            name = np.zeros(0, np.uint64)
            if got:
                id_, at, n, fp, key = (np.concatenate(c) for c in zip(*got, strict=True))
                of = np.repeat(np.arange(len(n)), n)
                name = names(fp[of], key)
                again = later(name, id_[of])
                for c in older.column_names[1:]:
                    run = unplanes(older[c][0].as_py(), 8)
                    if len(run):
                        again |= run[np.minimum(np.searchsorted(run, name), len(run) - 1)] == name
                use = np.flatnonzero(again)
                place = at[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                first, m = stretches(of[use], place[use])
                f = use[first]
                marks.append((id_[of[f]], place[f], m, key[f]))
            marks = [np.concatenate(c) for c in zip(*marks, strict=True)] if marks else [np.zeros(0, np.int64)] * 4
            out = answer(p, tuple(marks), planes(np.unique(name), 8) if flush else None)
            release()
            return out

        every = self.spark.range(buckets).select(F.col("id").cast("int").alias("p"), *(F.lit(None).cast("binary").alias(c) for c in ("id", "at", "n", "fp", "key")))
        asked = batch.where("id is not null").select("id", "text").mapInArrow(send, ASKED).union(every).repartition(buckets, "p")
        older = None
        for i, (_, name) in enumerate(self.runs):
            one = self.run(name).withColumnRenamed("run", f"run{i}")
            older = one if older is None else older.join(one, "p")
        if older is None:
            found = asked.groupBy("p").applyInArrow(lambda key, rows: bucket(key, rows, pa.table({"p": []})), ANSWER)
        else:
            found = asked.groupBy("p").cogroup(older.groupBy("p")).applyInArrow(bucket, ANSWER)
        name = self._write(found)
        if flush:
            self.runs.append((0, name))
        return self.spark.table(name).where("run is null").drop("p", "run")


def _outcome(text: bytes, marks: list | None, key: np.ndarray, width: int) -> tuple[int, int, bytes]:
    """Words, removed words and the kept ones joined by a space. bytes.split() knows the same separators as the pattern."""
    words = text.split()
    n = len(words)
    if marks:
        diff = np.zeros(n + 1, np.int64)
        for m in marks:
            p = m["pos"]
            if p < len(key) and int(key[p]) == m["key"]:  # else it is for another text of the same id
                diff[p] += 1
                diff[p + m["n"] - 1 + width] -= 1
        words = list(compress(words, (np.cumsum(diff[:n]) == 0).tolist()))
    return n, n - len(words), b" ".join(words)


def substring_dedup(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, gram: int = GRAM, batches: int = BATCHES, texts: bool = False) -> DataFrame:
    """One row a row of docs: id, n_words, n_removed, kept_sha256 (kept words joined by a space) and, if asked, kept_text.

    The batches are a half, a quarter and so on of the documents, the least first.
    """
    spark = docs.sparkSession
    modest(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    cuts, size = rows.agg(F.percentile_approx("id", [2.0**-i for i in range(batches - 1, 0, -1)] or [1.0], 10_000), F.sum(F.octet_length("text"))).first()
    cuts = sorted(set(cuts or [])) if batches > 1 else []
    index, marks = FingerprintIndex(spark, words, gram, max(int(spark.conf.get("spark.sql.shuffle.partitions")), (size or 0) // BUCKET)), None
    for i in range(len(cuts) + 1):
        low = rows.where(F.col("id") > cuts[i - 1]) if i else rows
        got = index.add(low.where(F.col("id") <= cuts[i]) if i < len(cuts) else low, flush=i < len(cuts))
        marks = got if marks is None else marks.union(got)
    marks = stored(marks, "repeated")
    index.drop()
    kind = "struct<n_words: long, n_removed: long, kept_sha256: string" + (", kept_text: string>" if texts else ">")
    names_ = ["n_words", "n_removed", "kept_sha256", *(["kept_text"] if texts else [])]

    def result(col: pa.Array, given: pa.Array | None) -> pa.Array:
        own = repeat(np.zeros(0, np.uint64))
        if given is not None:
            own = (key[a : max(a, e - words + 1)] for w in _text.slices(col) for key in [keys(w, words)] for _, a, e in w.each())
        marked = given.to_pylist() if given is not None else repeat(None)
        got = [_outcome((t.as_py() or "").encode(), m, k, words) for t, m, k in zip(col, marked, own, strict=False)]
        cols = [pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64()), pa.array([hashlib.sha256(g[2]).hexdigest() for g in got], pa.string())]
        if texts:
            cols.append(pa.array([g[2].decode() for g in got], pa.string()))
        return pa.StructArray.from_arrays(cols, names_)

    bits = bitmap(marks, "id")
    cast = spark.sparkContext.broadcast(bits)

    def whole(batches):  # one Python step for the test and the result: a worker a task
        for b in batches:
            b = b.filter(pa.array(~which(cast.value, b.column(0))))
            yield pa.RecordBatch.from_arrays([b.column(0), result(b.column(1), None)], ["id", "r"])
        release()

    @F.arrow_udf(kind)
    def cut(col: pa.Array, given: pa.Array) -> pa.Array:
        return result(col, given)

    of = marks.groupBy(F.col("id").alias("_sw_id")).agg(F.collect_list(F.struct("pos", "n", "key")).alias("marks"))
    tested = rows.where(among(rows, "id", bits))
    marked = tested.join(of, tested["id"] == of["_sw_id"], "left").select("id", cut("text", "marks").alias("r"))
    same = rows.mapInArrow(whole, f"id long, r {kind}")  # most texts need no shuffle
    return same.union(marked).select("id", "r.*")
