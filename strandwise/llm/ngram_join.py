"""Near duplicates by an exact Jaccard join on word shingles, searched as a T-occurrence problem.

A document's set: its distinct k-word shingles (A-Z as a-z, words [^\\x20\\x09-\\x0D]+); with fewer words the whole sequence is
one element; without words, or with a null text, it is empty and linked with nothing. Two documents link when
100 * intersection >= percent * union, so a link has T = ceil(percent * n / 100) common elements at least. Equal sets are one
class, and classes are the nodes of all that follows.

1. Signatures. An element and its successor, by hash, make a pair. An element of one set only breaks two pairs of its own set
   and one of the other at most, so linked sets have most pairs in common (broken()). Each class sends its first pairs, by
   hash, to the owners of their slots and learns how many it shares with others; who shares too few is linked with nothing.
   Pairs are rare even where elements are common, so this thins the corpus out at any size.
2. Inverted lists. Of the classes that are left, each element's list length is counted exactly. Who has fewer than T
   elements with a list of two or more leaves. Lists are ordered by length: the T - 1 longest lists of a class may be
   skipped in looking for candidates, so a list is read by those for which it is among the shorter ones, apart for each pair
   of neighbouring length bands (linked sets differ in size by `percent` at most). A list's least class is its leader.
3. Those that share a leader meet in chunks of about CHUNK (fewer of large sets), the leader in each. DivideSkip searches a
   chunk's lists for a block of queries at a time: a query's short lists are merged, its long ones are probed, and who reaches
   T common elements is tested for a link. Pairs that are connected already need no comparison.
4. Chunks of one leader never met each other: whoever is not connected with the leader meets the other chunks too, more in
   each round, until it is or has met all. So no link between different components is lost. Of a group of near copies that
   are not linked with each other, all pairs are compared: the products of matrices keep a pair at a fraction of a microsecond.
5. Components come from the links in Spark.

Elements are 64-bit hashes; equal sets are told by size and two 64-bit sums. Rows are nodes by their set, so different texts
under one id are apart unless they link. Rows with a null id take no part (component null). Empty tables give empty results.
near_duplicates returns columns of its own only; extra columns of docs, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text
from ._bloom import among, bitmap, which
from ._runtime import join_small, modest, release, remove, stored
from .components import components, merged

WORDS, PERCENT = 5, 80
#: Hundredths of a set's pairs that are sent beyond those that a link may break.
EXTRA = 5
#: Classes that meet in one chunk, about, and elements of their sets; how many times more chunks each round of step 4 covers.
CHUNK, ELEMENTS, GROWTH = 512, 1 << 18, 8
#: DivideSkip's weight of a probe against a merge step.
MU = 0.0085
#: Bits of a slot.
SLOT = np.uint64((1 << 47) - 1)


def element_sets(w: _text.Words, k: int):
    """(text, sorted distinct elements) of each text."""
    all_of = w.shingles(k)
    for i, a, e in w.each():
        if e - a >= k:
            yield i, np.unique(all_of[a : e - k + 1])
        elif e > a:
            yield i, _text.chain(w.hashes[a:e], e - a)
        else:
            yield i, np.zeros(0, np.uint64)


def required(n: int, percent: int) -> int:
    """Common elements that a set of n must have with any it is linked to."""
    return (percent * n + 99) // 100


def paired(percent: int) -> bool:
    """Whether pairs of neighbours survive a link often enough to be a signature; else single elements are."""
    return percent >= 70


def broken(n: int, percent: int) -> int:
    """At most so many of a set's pairs (or elements) are not in a set that it is linked to.

    With x elements of its own only and y of the other only, x + y <= (100 - percent) / percent * (n - x); 2x + y is largest
    for the largest x, n - T.
    """
    lost = n - required(n, percent)
    return 2 * lost + 1 if paired(percent) else lost


def sent(n: int, percent: int) -> int:
    return broken(n, percent) + 1 + n * EXTRA // 100


@lru_cache(1 << 16)
def shared_at_least(n: int, percent: int) -> int:
    """Pairs that a set of n and any that it is linked to must both have sent; 0 or less: nothing is known."""
    if percent < 10:
        return 0
    pairs = lambda m: m - 1 if paired(percent) else m
    fewest = lambda m: min(1 + m * EXTRA // 100, pairs(m) - broken(m, percent))
    low, high = required(n, percent), 100 * n // percent
    if low > 1000:  # the first term is the lesser one from here on, and it grows
        return 1 + low * EXTRA // 100
    return min(fewest(m) for m in range(low, high + 1))


def sums(s: np.ndarray) -> tuple[int, int]:
    return int(_text.mix(s).sum(dtype=np.uint64)), int(_text.mix(~s).sum(dtype=np.uint64))


def signature(s: np.ndarray, percent: int) -> np.ndarray:
    """Slots of the pairs that a set sends, the first ones by hash."""
    g = _text.mix(s[:-1] * np.uint64(0xD6E8FEB86659FD93) + s[1:]) if paired(percent) else _text.mix(s)
    m = min(len(g), sent(len(s), percent))
    if m < len(g):
        g = np.partition(g, m - 1)[:m]
    return _text.mix(g) & SLOT  # mixed again: the first ones by hash are all small


def sets(docs: DataFrame, text: str, doc_id: str, k: int) -> DataFrame:
    """Stored: id, n, a, b (two sums that tell equal sets) of each row."""

    def make(batches):
        for b in batches:
            out = [(len(s), *sums(s)) for w in _text.slices(b.column(1), table=_text.LOWER) for _, s in element_sets(w, k)]
            c = np.array(out, np.uint64).reshape(-1, 3).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c[:, i]) for i in range(3))], ["id", "n", "a", "b"])
        release()

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    return stored(rows.mapInArrow(make, "id long, n long, a long, b long"), "shingle-sets")


def sharing(docs: DataFrame, text: str, doc_id: str, k: int, percent: int) -> DataFrame:
    """(a, c): how many of its sent pairs each class shares with others, or a little more; classes that share none are left out.

    A task first looks at its own batch: who shares a slot there is counted at once, and one of them speaks for all, so a slot's
    owner gets a row for each batch at most, however common the pair.
    """
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def send(batches):
        for b in batches:
            seen, slots = {}, []
            for w in _text.slices(b.column(0), table=_text.LOWER):
                for _, s in element_sets(w, k):
                    if len(s) > paired(percent):
                        a = sums(s)[0]
                        if a not in seen:
                            seen[a] = len(seen)
                            slots.append(signature(s, percent))
            if not slots:
                continue
            names = np.array(list(seen), np.uint64).view(np.int64)
            owner = np.repeat(np.arange(len(slots)), [len(x) for x in slots])
            slot = np.concatenate(slots)
            order = np.argsort(slot, kind="stable")
            slot, owner = slot[order], owner[order]
            first, many = runs(slot)
            c = np.bincount(owner[np.repeat(many > 1, many)], minlength=len(slots))
            at = np.flatnonzero(c)
            yield packed(np.array([int(names[0]) % parts]), np.array([-1]), [names[at].tobytes()], [c[at].astype(np.int64).tobytes()])
            slot, owner = slot[first], names[owner[first]]
            to = (slot % np.uint64(parts)).astype(np.int64)
            slot |= np.where(many > 1, ~SLOT, np.uint64(0))  # counted already
            order = np.argsort(to, kind="stable")
            cut = np.searchsorted(to[order], np.arange(parts + 1))
            use = np.flatnonzero(np.diff(cut))
            slot, owner = slot[order], owner[order]
            yield packed(use, use, [slot[cut[p] : cut[p + 1]].tobytes() for p in use], [owner[cut[p] : cut[p + 1]].tobytes() for p in use])
        release()

    def count(slot: np.ndarray, owner: np.ndarray):
        told, slot = slot > SLOT, slot & SLOT
        order = np.lexsort((owner, slot))
        told, slot, owner = told[order], slot[order], owner[order]
        first, many = runs(slot)
        other = np.concatenate(([False], owner[1:] != owner[:-1]))
        other[first] = False
        use = np.logical_or.reduceat(told | other, first)
        names, c = np.unique(owner[np.repeat(use, many) & ~told], return_counts=True)
        return names, c

    def blobs(batches):
        """(part, kind, one, two) of a stream sorted by part: all of a part together."""
        key, rows = None, []
        for b in batches:
            for part, *row in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if part != key and rows:
                    yield rows
                    rows = []
                key = part
                rows.append(row)
        if rows:
            yield rows

    def gather(batches):
        for rows in blobs(batches):
            got = [(np.frombuffer(one, np.int64), np.frombuffer(two, np.int64)) for kind, one, two in rows if kind < 0]
            ask = [(np.frombuffer(one, np.uint64), np.frombuffer(two, np.int64)) for kind, one, two in rows if kind >= 0]
            if ask:
                got.append(count(*(np.concatenate(x) for x in zip(*ask, strict=True))))
            name, c = (np.concatenate(x) for x in zip(*got, strict=True))
            to = name % parts
            order = np.argsort(to, kind="stable")
            name, c, cut = name[order], c[order], np.searchsorted(to[order], np.arange(parts + 1))
            use = np.flatnonzero(np.diff(cut))
            yield packed(use, use, [name[cut[p] : cut[p + 1]].tobytes() for p in use], [c[cut[p] : cut[p + 1]].tobytes() for p in use])
        release()

    def total(batches):
        for rows in blobs(batches):
            name, c = (np.concatenate([np.frombuffer(x[i], np.int64) for x in rows]) for i in (1, 2))
            names, of = np.unique(name, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.bincount(of, c).astype(np.int64))], ["a", "c"])

    rows = docs.where(F.col(doc_id).isNotNull()).select(F.col(text).alias("text"))
    kind = "part long, kind long, one binary, two binary"
    asked = rows.mapInArrow(send, kind).repartition(parts, "part").sortWithinPartitions("part", "kind")
    told = asked.mapInArrow(gather, kind).repartition(parts, "part").sortWithinPartitions("part", "kind")
    return told.mapInArrow(total, "a long, c long")


def packed(part, kind, one, two) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(kind, pa.int64()), pa.array(one, pa.binary()), pa.array(two, pa.binary())], ["part", "kind", "one", "two"])


def runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and length of each run of equal values in a sorted array."""
    if not len(x):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
    return first, np.diff(np.append(first, len(x)))


def lists(docs: DataFrame, node: DataFrame, text: str, doc_id: str, k: int, percent: int) -> DataFrame:
    """Stored: a, n and tokens of the classes that can be linked: their elements with a list of two or more, the shortest list first."""
    count = sharing(docs, text, doc_id, k, percent)
    some = node.join(count.withColumnRenamed("a", "_a"), node["a"] == F.col("_a"), "left").select("n", "a", "rep", F.coalesce("c", F.lit(0)).alias("c"))

    @F.arrow_udf("boolean")
    def enough(n: pa.Array, c: pa.Array) -> pa.Array:
        return pa.array([y >= shared_at_least(x, percent) for x, y in zip(n.to_pylist(), c.to_pylist(), strict=True)], pa.bool_())

    some = stored(some.where(enough("n", "c")).select(F.col("rep").alias("_rep"), F.col("a").alias("_a")), "sharing")
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    texts = texts.where(among(texts, "id", bitmap(some, "_rep"))).join(some, F.col("id") == F.col("_rep")).select("_a", "text")

    def make(batches):
        for b in batches:
            want, got, at = b.column(0).to_pylist(), [], []
            for w in _text.slices(b.column(1), table=_text.LOWER):
                for i, s in element_sets(w, k):
                    if len(s) and sums(s)[0] == want[i] % (1 << 64):
                        at.append(want[i])
                        got.append(s.view(np.int64))
            if at:
                cut = pa.array(np.concatenate(([0], np.cumsum([len(s) for s in got]))).astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array([len(s) for s in got], pa.int64()), pa.ListArray.from_arrays(cut, pa.array(np.concatenate(got)))], ["a", "n", "s"])
        release()

    whole = stored(texts.mapInArrow(make, "a long, n long, s array<long>"), "whole-sets")
    remove(some)
    posting = whole.select("a", "n", F.explode("s").alias("token"))
    length = posting.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1").withColumnRenamed("token", "_token")
    found = posting.join(length, F.col("token") == F.col("_token")).groupBy("a", "n").agg(F.sort_array(F.collect_set(F.struct("df", "token"))).alias("x"))
    found = found.where(F.size("x") * 100 >= F.col("n") * percent).select("a", "n", F.col("x.token").alias("tokens"))
    found = stored(found, "lists")
    remove(whole)
    return found


class Index:
    """Inverted lists over the sets of a chunk, and DivideSkip's search in them for a block of queries at a time.

    A list that is long for its chunk is a row of zeros and ones too (at most 16 bytes an element of the sets): a block of
    queries is merged with or probes such lists in one product of matrices. Lists of one document hold no link between the sets.
    """

    def __init__(self, found: list[np.ndarray], least: int = 2):
        self.sets = found
        sizes = [len(s) for s in found]
        values = np.concatenate(found)
        order = np.argsort(values, kind="stable")  # owners ascend within a list
        first, count = runs(values[order])
        owners = np.repeat(np.arange(len(found)), sizes)[order]
        use = count >= least
        self.owners = owners[np.repeat(use, count)]
        self.tokens, count = values[order][first[use]], count[use]
        self.at = np.concatenate(([0], np.cumsum(count)))
        dense = 4 * count >= len(found)
        self.row = np.where(dense, np.cumsum(dense) - 1, -1)
        self.bits = np.zeros((int(dense.sum()), len(found)), np.float32)
        of = np.repeat(self.row, count)
        self.bits[of[of >= 0], self.owners[of >= 0]] = 1

    def block(self) -> int:
        """Queries at a time, by the cells that they take."""
        return int(max(1, min(64, (1 << 21) // (self.bits.shape[0] + len(self.sets)))))

    def _counted(self, q: np.ndarray, at: np.ndarray, queries: int, columns: np.ndarray) -> np.ndarray:
        """How often each document of columns is in the lists (at) of each query."""
        row = self.row[at]
        dense = row >= 0
        asked = np.zeros((queries, len(self.bits)), np.float32)  # counts to 2^24 are exact
        asked[q[dense], row[dense]] = 1
        out = (asked @ self.bits[:, columns]).astype(np.int64) if dense.any() else np.zeros((queries, len(columns)), np.int64)
        q, at = q[~dense], at[~dense]
        if len(at):
            size = self.at[at + 1] - self.at[at]
            place = np.repeat(self.at[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            merged = np.bincount(np.repeat(q, size) * len(self.sets) + self.owners[place], minlength=queries * len(self.sets))
            out += merged.reshape(queries, -1)[:, columns]
        return out

    def search_block(self, asking: list[np.ndarray], need: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, document, intersection) of the wanted documents (a mask, a row a query) with need elements of a query or more."""
        none = np.zeros(0, np.int64)
        values = np.concatenate(asking)
        q = np.repeat(np.arange(len(asking)), [len(s) for s in asking])
        if not len(self.tokens):
            return none, none, none
        at = np.minimum(np.searchsorted(self.tokens, values), len(self.tokens) - 1)
        hit = self.tokens[at] == values
        q, at = q[hit], at[hit]
        enough = (np.bincount(q, minlength=len(asking)) >= need)[q]
        q, at = q[enough], at[enough]
        if not len(q):
            return none, none, none
        length = self.at[at + 1] - self.at[at]
        order = np.lexsort((-length, q))
        q, at, length = q[order], at[order], length[order]
        first, many = runs(q)
        longest = np.ones(len(asking))
        longest[q[first]] = length[first]
        skip = np.minimum(need - 1, (need / (MU * np.log2(longest) + 1)).astype(np.int64))
        long = np.arange(len(q)) - np.repeat(first, many) < skip[q]
        few = self._counted(q[~long], at[~long], len(asking), np.arange(len(self.sets)))  # the short lists are merged
        maybe = wanted & (few >= (need - skip)[:, None])
        columns = np.flatnonzero(maybe.any(0))
        if not len(columns):
            return none, none, none
        n = few[:, columns] + self._counted(q[long], at[long], len(asking), columns)  # the long ones are probed
        i, j = np.nonzero(maybe[:, columns] & (n >= need[:, None]))
        return i, columns[j], n[i, j]

    def search(self, q: int, t: int, wanted: np.ndarray) -> list[tuple[int, int]]:
        """(document, intersection) of all wanted documents (a mask) with t elements of q or more."""
        _, d, n = self.search_block([self.sets[q]], np.array([t]), wanted[None])
        return list(zip(d.tolist(), n.tolist(), strict=True))


def chunk_links(found: list[np.ndarray], sizes: list[int], percent: int, known: list[int], asks: list[bool]) -> list[tuple[int, int]]:
    """Links (two places) that connect what is linked in a chunk. known: labels of what is connected already; asks: who searches.

    Who does not ask lives in the chunk, and guests who ask search among those only: they meet each other where one of them lives.
    """
    _, group = np.unique(np.array(known), return_inverse=True)  # who is connected already
    left = len(set(group.tolist()))
    if left == 1:
        return []
    size, asking = np.array(sizes), np.array(asks)
    home = np.arange(len(found)) if asking.all() else np.flatnonzero(~asking)
    index = Index([found[d] for d in home], 2 if len(home) == len(found) else 1)
    searching, step, out = np.flatnonzero(asking), index.block(), []
    for start in range(0, len(searching), step):
        q = searching[start : start + step]
        wanted = (group[q][:, None] != group[home]) & (100 * np.minimum(size[q][:, None], size[home]) >= percent * np.maximum(size[q][:, None], size[home]))
        live = wanted.any(1)
        if not live.any():
            continue
        q = q[live]
        i, j, n = index.search_block([found[x] for x in q], (percent * size[q] + 99) // 100, wanted[live])
        i, j = q[i], home[j]
        link = 100 * n >= percent * (size[i] + size[j] - n)
        i, j = i[link], j[link]
        while len(i):
            a, b = int(i[0]), int(j[0])
            if group[a] != group[b]:
                group[group == group[b]] = group[a]
                left -= 1
                out.append((a, b))
            apart = group[i] != group[j]
            i, j = i[apart], j[apart]
        if left == 1:
            break
    return out


def meet(rows: DataFrame, found: DataFrame, percent: int, name: str) -> DataFrame:
    """Stored links (a, b) of rows (leader, chunk, x, label, asks), whose sets are in found."""
    full = rows.join(found, rows["x"] == found["a"]).select("leader", "chunk", "x", "label", "asks", "n", "tokens")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a number: few bytes can be much work
    full = full.repartition(parts, "leader", "chunk").sortWithinPartitions("leader", "chunk", "x")

    def stream(batches):
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("leader", "chunk", "x", "label", "asks", "n")]
            t = b.column("tokens")
            flat, at = t.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(t.value_lengths().to_numpy(zero_copy_only=False))).tolist()
            for i, (leader, chunk, *row) in enumerate(zip(*cols, strict=True)):
                yield (leader, chunk), (*row, np.sort(flat[at[i] : at[i + 1]]))

    def find(batches) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for _, rows in groupby(stream(batches), key=lambda x: x[0]):
            got = list({r[1][0]: r[1] for r in rows}.values())
            if len(got) > 1:
                x, label, asks, n, s = zip(*got, strict=True)
                out += [(x[i], x[j]) for i, j in chunk_links(s, n, percent, label, asks)]
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in range(2)], ["a", "b"])
                out = []
        yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in range(2)], ["a", "b"])
        release()

    return stored(full.mapInArrow(find, "a long, b long"), name)


def prefix_lists(found: DataFrame, percent: int) -> DataFrame:
    """(a, token, band): the lists that each class must read, once for each of its two pairs of neighbouring bands."""
    t = F.ceil(F.col("n") * percent / 100)
    prefix = F.slice("tokens", 1, (F.size("tokens") - t + 1).cast("int"))
    width = math.log(100 / percent) * 1.01 if percent < 100 else 1.0  # a little more, against rounding
    band = F.floor(F.log("n") / width).cast("int")
    rows = found.select("a", "n", band.alias("band"), F.explode(prefix).alias("token"))
    return rows.select("a", "n", "token", F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("band"))


def linked(found: DataFrame, percent: int) -> DataFrame:
    """(id, label) of all classes that are linked with another one: label is the least class reachable."""
    posting = prefix_lists(found, percent)
    leaders = posting.groupBy("token", "band").agg(F.min("a").alias("leader"), F.max("a").alias("last")).where("leader < last").drop("last")
    pairs = posting.join(leaders, ["token", "band"]).where("a <> leader").select(F.col("a").alias("x"), "n", "leader").distinct()
    pairs = stored(pairs, "meetings")
    size = pairs.count()
    many = F.count(F.lit(1))
    hot = pairs.groupBy("leader").agg(F.least(many, F.ceil(F.greatest(many / CHUNK, F.sum("n") / ELEMENTS))).cast("int").alias("chunks")).where("chunks > 1")
    hot = stored(hot, "hot-leaders", size)
    split = join_small(pairs, hot, "leader")
    home = F.when(F.col("chunks").isNull(), 0).otherwise(F.pmod(F.xxhash64("x"), F.col("chunks"))).cast("int")
    rows = stored(split.select("x", "leader", home.alias("chunk"), F.coalesce("chunks", F.lit(1)).alias("chunks")), "members", size)
    heads = rows.select("leader", "chunk").distinct().select(F.col("leader").alias("x"), "leader", "chunk")
    first = rows.select("x", "leader", "chunk").union(heads).select("leader", "chunk", "x", F.col("x").alias("label"), F.lit(True).alias("asks"))
    links = meet(first, found, percent, "links")
    label = components(links)
    members = rows.where("chunks > 1")
    met, step = 1, GROWTH
    while True:
        # who is not connected with its leader goes on to the chunks met .. met + step - 1 after its own
        now = members.join(label.withColumnRenamed("id", "x"), "x", "left").select("x", "leader", "chunk", "chunks", F.coalesce("label", "x").alias("label"))
        top = label.select(F.col("id").alias("leader"), F.col("label").alias("main"))
        main = members.select("leader").distinct().join(top, "leader", "left").select("leader", F.coalesce("main", "leader").alias("main"))
        now = stored(join_small(now, stored(main, "mains", size), "leader", "inner"), "members-now", size)
        more = now.where((F.col("label") != F.col("main")) & (F.col("chunks") > met))
        to = F.sequence(F.col("chunk") + met, F.col("chunk") + F.least(F.lit(met + step), F.col("chunks")) - 1)
        asks = more.select("leader", F.explode(to).alias("to"), "chunks", "x", "label").select("leader", F.pmod("to", "chunks").alias("chunk"), "x", "label", F.lit(True).alias("asks"))
        asks = stored(asks, "asking")
        if not asks.limit(1).count():
            remove(asks)
            remove(now)
            break
        asked = asks.select(F.col("leader").alias("_l"), F.col("chunk").alias("_c")).distinct()
        there = now.join(asked, (F.col("leader") == F.col("_l")) & (F.col("chunk") == F.col("_c")), "left_semi").select("leader", "chunk", "x", "label", F.lit(False).alias("asks"))
        label = merged(label, meet(asks.union(there), found, percent, "more-links"))
        remove(asks)
        remove(now)
        met, step = met + step, step * GROWTH
    remove(pairs)
    remove(rows)
    return label


def near_duplicates(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row a row of docs: id, n_shingles, component (least id reachable by links, itself included; null for a null id)."""
    return classified(docs, text, doc_id, words, percent).select("id", F.col("n").alias("n_shingles"), "component")


def classified(docs: DataFrame, text: str, doc_id: str, k: int, percent: int) -> DataFrame:
    """id, n, a, b (the class) and component of each row, and keeper: the component's least id, in its class of that id only."""
    modest(docs.sparkSession)
    rows = sets(docs, text, doc_id, k)
    node = stored(rows.where("n > 0 and id is not null").groupBy("n", "a", "b").agg(F.min("id").alias("rep")), "classes")
    found = lists(docs, node, text, doc_id, k, percent)
    label = linked(found, percent)
    remove(found)
    part = stored(node.join(label, node["a"] == label["id"]).select("n", "a", "b", "rep", "label"), "linked-classes")
    least = part.groupBy("label").agg(F.min(F.struct("rep", "n", "a", "b")).alias("least"))
    part = part.join(least, "label").select(*(F.col(c).alias("_" + c) for c in "nab"), "least")
    same = (F.col("n") == F.col("_n")) & (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b"))
    top = node.join(part, same, "left")
    own = F.struct("rep", "n", "a", "b")
    keeper = F.when(F.coalesce(F.col("least") == own, F.lit(True)), F.col("rep"))
    top = stored(top.select(*(F.col(c).alias("_" + c) for c in "nab"), F.coalesce("least.rep", "rep").alias("component"), keeper.alias("keeper")), "components")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return rows.join(top, same, "left").select("id", "n", "a", "b", component.alias("component"), "keeper")


def linked_pairs(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """The join itself: membership (id, rep) of all nonempty documents, and every link (rep1 < rep2, common) between representatives of equal sets.

    Each pair with a common element among the lists that both must read is verified once on the whole sets. The rows grow with
    the number of such pairs, so a group of m near copies costs up to m(m-1)/2; near_duplicates is for components. Ids must be unique.
    """
    modest(docs.sparkSession)
    full = sets(docs, text, doc_id, words).where("n > 0 and id is not null")
    node = stored(full.groupBy("n", "a", "b").agg(F.min("id").alias("rep")), "classes")
    member = full.select("id", "n", "a", "b").join(node, ["n", "a", "b"]).select("id", "rep").distinct()
    found = lists(docs, node, text, doc_id, words, percent)
    named = found.join(node.select(F.col("a").alias("_a"), "rep"), F.col("a") == F.col("_a")).select("rep", "n", "tokens", "a")
    posting = stored(prefix_lists(found, percent).select("a", "token", "band").join(named.select("a", "rep"), "a").select("rep", "token", "band"), "pair-postings")
    p, q = (posting.select("token", "band", F.col("rep").alias(f"rep{i}")) for i in "12")
    pairs = p.join(q, ["token", "band"]).where("rep1 < rep2").select("rep1", "rep2").distinct()
    one, two = (named.select(F.col("rep").alias(f"rep{i}"), F.col("n").alias(f"n{i}"), F.col("tokens").alias(f"s{i}")) for i in "12")
    common = F.size(F.array_intersect("s1", "s2")).cast("long")
    links = pairs.join(one, "rep1").join(two, "rep2").select("rep1", "rep2", (F.col("n1") + F.col("n2")).alias("n"), common.alias("common"))
    return member, stored(links.where(F.col("common") * 100 >= (F.col("n") - F.col("common")) * percent).select("rep1", "rep2", "common"), "linked-pairs")


def deduplicated(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """docs with one document of each component, that of the least id.

    Rows with a null id and rows without words stay. Rows are judged by id and text together: different texts under one id both
    stay unless they link. Of rows that repeat a kept id and its set of shingles the one of the least text stays.
    """
    found = stored(classified(docs, text, doc_id, words, percent).where("n > 0 and id is not null"), "near-duplicates")
    stays = F.col("id").eqNullSafe(F.col("keeper"))
    key = ["id", "n", "a", "b"]
    gone = stored(found.where(~stays).select(*(F.col(c).alias("_sw_" + c) for c in key)).distinct(), "duplicates")
    twice = found.where(stays).groupBy(*key).count().where("count > 1").select(*(F.col(c).alias("_sw_" + c) for c in key))
    twice = stored(twice, "repeated-rows")

    bits = bitmap(gone.union(twice), "_sw_id")
    cast = docs.sparkSession.sparkContext.broadcast(bits)

    @F.arrow_udf("struct<n: long, a: long, b: long>")
    def of(own: pa.Array, col: pa.Array) -> pa.Array:  # null: not in the set; one Python step for both, a worker a task
        maybe = which(cast.value, own)
        out = [(len(s), *sums(s)) for w in _text.slices(col.filter(pa.array(maybe)), table=_text.LOWER) for _, s in element_sets(w, words)]
        c = np.zeros((len(col), 3), np.int64)
        c[maybe] = np.array(out, np.uint64).reshape(-1, 3).view(np.int64)
        return pa.StructArray.from_arrays([pa.array(c[:, i]) for i in range(3)], ["n", "a", "b"], mask=pa.array(~maybe))

    # columns of docs may have any names: they travel in one struct
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_sw_row"))
    own = F.col("_sw_row")[doc_id].cast("long")
    rows = rows.withColumn("_sw_own", own)
    maybe = among(rows, "_sw_own", bits)
    some = rows.withColumn("_sw_k", of.asNondeterministic()("_sw_own", F.col("_sw_row")[text])).where("_sw_k is not null")
    same = (F.col("_sw_own") == F.col("_sw_id")) & (F.col("_sw_k.n") == F.col("_sw_n")) & (F.col("_sw_k.a") == F.col("_sw_a")) & (F.col("_sw_k.b") == F.col("_sw_b"))
    rest = some.join(gone, same, "left_anti")
    if twice.limit(1).count():
        once = rest.join(twice, same, "left_semi").groupBy("_sw_own", "_sw_k")
        once = once.agg(F.min_by("_sw_row", F.struct(F.col("_sw_row")[text], F.to_json("_sw_row"))).alias("_sw_row"))
        rest = rest.join(twice, same, "left_anti").select("_sw_row").union(once.select("_sw_row"))
    out = rows.where(~maybe).select("_sw_row").union(rest.select("_sw_row"))  # most rows need no shuffle
    return out.select(*(F.col("_sw_row")[c].alias(c) for c in docs.columns))
