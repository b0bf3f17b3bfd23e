"""Toxicity by maximum-scoring segments.

Tokens (runs of ASCII letters, digits, apostrophes and non-ASCII bytes; A-Z as a-z) are hashed to BUCKETS. Log-odds of
toxic against clean texts, with a Dirichlet prior proportional to the pooled counts, give each bucket a score: the
log-odds moved towards 0 by CONFIDENCE standard deviations, less DRIFT, so that ordinary tokens lower a passage. A linear
scan (Ruzzo and Tompa) finds every maximal-scoring passage. A passage of score s in n tokens is expected by chance
E = K n exp(-lambda s) times; lambda solves sum(p exp(lambda s)) = 1 over clean tokens and K is fitted to the largest
passages of clean texts. A text's evidence is the sum of -ln E over its passages with E < SIGNIFICANT, and a logistic curve
fitted on the training texts makes it a probability.

Nulls and empty texts have no tokens: no evidence, the curve's value at 0. Rows with a null id are scored, never learned
from. Repeated rows get equal scores. Other columns pass through. An empty table or no labels: a score of PRIOR for all. Whole texts are scanned.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _text
from ._runtime import modest, release, remove, stored

BUCKET_BITS = 18
#: At most this many labelled rows are learned from, those with the least hash of the id (a documented bound).
TRAIN_ROWS = 20_000
PRIOR_WEIGHT, CONFIDENCE, DRIFT, SIGNIFICANT, PRIOR = 0.05, 2.0, 0.15, 0.05, 0.05

_TOKEN = np.zeros(256, bool)
_TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123), 39, *range(128, 256)]] = True
SEP = ~_TOKEN


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


@dataclass
class Model:
    """Scores of buckets (float32, 2**BUCKET_BITS: a fixed size), and what turns passages into a probability."""

    scores: np.ndarray
    lam: float
    k: float
    slope: float
    base: float

    def passages(self, s: np.ndarray) -> list[tuple[int, int, float, float]]:
        """(first token, end, score, E) of each significant passage."""
        found = []
        for a, b, score in segments(s):
            e = self.k * len(s) * float(np.exp(-self.lam * score))
            if e < SIGNIFICANT:
                found.append((a, b, score, e))
        return found

    def evidence(self, s: np.ndarray) -> tuple[float, list]:
        found = self.passages(s)
        return float(sum(-np.log(max(p[3], 1e-300)) for p in found)), found

    def probability(self, evidence: float) -> float:
        return float(1 / (1 + np.exp(-(self.base + self.slope * np.log1p(evidence)))))


def segments(s: np.ndarray) -> list[tuple[int, int, float]]:
    """Every maximal-scoring segment (start, end, score), in linear time; only positive tokens take a step in Python."""
    at = np.flatnonzero(s > 0)
    if not len(at):
        return []
    total = np.concatenate(([0.0], np.cumsum(s, dtype=np.float64)))
    # candidates: (start, end, sum before, sum after), as a list; link[i]: the nearest earlier one with a smaller sum before
    stack: list[tuple[int, int, float, float]] = []
    link: list[int] = []
    for i, before, after in zip(at.tolist(), total[at].tolist(), total[at + 1].tolist(), strict=True):
        a, b, lo, hi = i, i + 1, before, after
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= lo:
                j = link[j]
            if j < 0 or stack[j][3] >= hi:
                stack.append((a, b, lo, hi))
                link.append(j)
                break
            a, lo = stack[j][0], stack[j][2]
            del stack[j:], link[j:]
    return [(a, b, hi - lo) for a, b, lo, hi in stack]


def log_odds(toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """Scores of buckets from their counts in toxic and clean texts."""
    both = toxic + clean
    prior = PRIOR_WEIGHT * (both + 0.01)
    nt, nc, a0 = toxic.sum(), clean.sum(), prior.sum()
    t, c = toxic + prior, clean + prior
    delta = np.log(t / (nt + a0 - t)) - np.log(c / (nc + a0 - c))
    sd = np.sqrt(1 / t + 1 / c)
    return np.where(both > 0, np.sign(delta) * np.maximum(0, np.abs(delta) - CONFIDENCE * sd), 0.0) - DRIFT


def extreme_value(scores: np.ndarray, clean: np.ndarray) -> float:
    """lambda > 0 with sum(p exp(lambda s)) = 1."""
    use = clean > 0
    p, s = clean[use] / clean.sum(), scores[use]
    if not (s > 0).any() or (p * s).sum() >= 0:
        return 1.0
    f = lambda x: float((p * np.exp(np.minimum(x * s, 700))).sum()) - 1
    lo, hi = 1e-6, 1.0
    while f(hi) < 0 and hi < 64:
        hi *= 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < 0 else (lo, mid)
    return (lo + hi) / 2


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope >= 0 and base of a logistic curve with a small ridge, by Newton's steps."""
    w, f = np.zeros(2), np.stack([x, np.ones_like(x)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(f @ w, -30, 30)))
        h = (f * (p * (1 - p))[:, None]).T @ f + np.diag([1e-2, 1e-6])
        step = np.linalg.solve(h, f.T @ (y - p) - np.array([1e-2, 1e-6]) * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(0.0, float(w[0])), float(w[1])


def training(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str, learn: Column | None) -> DataFrame:
    """(text, y) of at most TRAIN_ROWS labelled rows, stored."""
    rows = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    if learn is not None:
        rows = rows.where(learn)
    rows = rows.groupBy(F.col(doc_id).alias("_sw_id")).agg(F.max(label).cast("double").alias("_sw_y"))
    rows = rows.orderBy(F.xxhash64("_sw_id"), "_sw_id").limit(TRAIN_ROWS)  # the proof of the broadcast's size
    some = docs.select(F.col(doc_id).alias("_sw_doc"), F.col(text).alias("_sw_text"))
    some = some.join(F.broadcast(rows), some["_sw_doc"] == rows["_sw_id"]).select("_sw_text", "_sw_y")
    return stored(some, "toxic-train")


def fit(docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", learn: Column | None = None) -> Model:
    """A model learned from the rows of labels that `learn` keeps."""
    modest(docs.sparkSession)
    train = training(docs, labels, text, doc_id, label, learn)
    size = 1 << BUCKET_BITS

    def count(batches):
        n = np.zeros(2 * size, np.int64)
        for b in batches:
            y = b.column(1).to_numpy(zero_copy_only=False) > 0
            for w in _text.slices(b.column(0), SEP, _text.LOWER):
                of = np.repeat(y[w.first : w.first + len(w)], np.diff(w.of))
                n += np.bincount(buckets(w.hashes) + size * of, minlength=2 * size)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["bucket", "n"])

    counts = train.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    n = np.zeros(2 * size)
    got = counts.toArrow()  # at most 2 * 2**BUCKET_BITS rows
    n[got["bucket"].to_numpy()] = got["n"].to_numpy()
    clean, toxic = n[:size], n[size:]
    if not clean.sum() or not toxic.sum():
        remove(train)
        return Model(np.zeros(size, np.float32), 1.0, 1.0, 0.0, float(np.log(PRIOR / (1 - PRIOR))))
    scores = log_odds(toxic, clean).astype(np.float32)
    model = Model(scores, extreme_value(scores.astype(np.float64), clean), 1.0, 0.0, 0.0)
    cast = train.sparkSession.sparkContext.broadcast(model)

    def largest(batches):
        for b in batches:
            out = [(int(e - a), max((x[2] for x in segments(s[a:e])), default=0.0)) for w in _text.slices(b.column(0), SEP, _text.LOWER) for s in [cast.value.scores[buckets(w.hashes)]] for _, a, e in w.each()]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.float64())], ["y", "n", "best"])

    top = np.array(train.mapInArrow(largest, "y double, n long, best double").collect(), float).reshape(-1, 3)  # at most TRAIN_ROWS rows
    # K so that the chance passages of clean texts are as many as seen; without the top tenth, against wrong labels
    y, length, best = top.T
    some = (y == 0) & (length > 0)
    cut = np.quantile(best[some], 0.9) if some.any() else 0.0
    use = some & (best <= max(cut, 1e-9))
    model.k = float(np.clip(use.sum() / max(1e-9, (length[use] * np.exp(-model.lam * best[use])).sum()), 1e-6, 1.0))
    cast.unpersist()
    cast = train.sparkSession.sparkContext.broadcast(model)

    def evidence(batches):
        for b in batches:
            out = [cast.value.evidence(s[a:e])[0] for w in _text.slices(b.column(0), SEP, _text.LOWER) for s in [cast.value.scores[buckets(w.hashes)]] for _, a, e in w.each()]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(out, pa.float64())], ["y", "x"])

    seen = np.array(train.mapInArrow(evidence, "y double, x double").collect(), float).reshape(-1, 2)
    model.slope, model.base = logistic(np.log1p(seen[:, 1]), (seen[:, 0] > 0).astype(float))
    cast.unpersist()
    remove(train)
    return model


RESULT = T.StructType([
    T.StructField("score", T.DoubleType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_passages", T.LongType()),
    T.StructField("first_start", T.LongType()), T.StructField("first_end", T.LongType()), T.StructField("least_e", T.DoubleType()),
])


def scored(model: Model, text: Column) -> Column:
    """A struct: score, number of tokens and of significant passages, bytes of the best passage (start, end, counted from the first token), its E."""
    modest(SparkSession.active())
    cast = SparkSession.active().sparkContext.broadcast(model)

    @F.arrow_udf(RESULT)
    def score(col: pa.Array) -> pa.Array:
        m, rows = cast.value, []
        for w in _text.slices(col, SEP, _text.LOWER):
            s = m.scores[buckets(w.hashes)]
            hot = np.concatenate(([0], np.cumsum(s > 0)))
            starts, ends = w.starts, w.ends
            for _, a, e in w.each():
                if hot[e] == hot[a]:
                    rows.append((m.probability(0.0), e - a, 0, None, None, None))
                    continue
                x, found = m.evidence(s[a:e])
                if not found:
                    rows.append((m.probability(x), e - a, 0, None, None, None))
                    continue
                p = min(found, key=lambda f: f[3])
                zero = int(starts[a])  # counted from the text's first token
                rows.append((m.probability(x), e - a, len(found), int(starts[a + p[0]]) - zero, int(ends[a + p[1] - 1]) - zero, p[3]))
        kinds = (pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
        columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
        out = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [f.name for f in RESULT])
        release()
        return out

    return score(text)


def toxicity(docs: DataFrame, model: Model, *, text: str = "text", out: str = "toxicity") -> DataFrame:
    """docs with a struct column `out` (see scored()); a column of docs of that name is replaced."""
    return docs.withColumn(out, scored(model, F.col(text)))
