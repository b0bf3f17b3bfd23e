"""Quality classifier from weak labels.

Overlapping heuristic labellers vote 1 (good), 0 (poor) or abstain on each whole text. Expectation-maximisation over the counts of
vote patterns (few rows, whatever the corpus) estimates each labeller's accuracy and how common good texts are. Posterior
labels of a bounded sample then train a linear scorer over hashed features of the text (words, word pairs and shapes of words),
weighted by how sure the posterior is; the scorer, which sees no votes, gives every text a score.

Null and empty texts have no features and get the scorer's base value. Null ids are scored like others but not sampled.
Repeated rows get equal scores. An empty table, or votes of one kind only, give the prior to all. Texts are read whole. No table
of labels is used: labels serve to measure the result only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _text
from ._runtime import modest, release

#: Features: 2**BITS hashed counts. At most TRAIN_ROWS rows, those of the least hash of the id, train the scorer.
BITS, TRAIN_ROWS, PASSES, RATE = 16, 6000, 12, 0.5
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>{}[]\\^~=+@")] = True
#: Bytes that are no part of a letter.
ODD = np.ones(256, np.int64)
ODD[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 0
STOPS = frozenset("the of and to in a is that it for was on be as with der die und den das von zu la le de les et que en un el los las es por".split())


def _shares(w: _text.Words, a: int, e: int) -> tuple[int, float, float, float, float, float, float]:
    """Words, mean length in bytes, share of symbol bytes, of distinct words, of common words, lines' distinct share, "!" a word."""
    n = e - a
    if not n:
        return 0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0
    lo, hi = int(w.starts[a]), int(w.ends[e - 1])
    raw = w.buf[lo:hi]
    lengths = w.ends[a:e] - w.starts[a:e]
    lines = bytes(raw).split(b"\n")
    full = [x for x in lines if x.strip()]
    common = sum(1 for x in bytes(raw).lower().split() if x.strip(b".,").decode("utf-8", "replace") in STOPS)
    return n, float(lengths.mean()), float(SYMBOLS[raw].sum()) / max(1, int(lengths.sum())), len(np.unique(w.hashes[a:e])) / n, common / n, len(set(full)) / max(1, len(full)), float((raw == 33).sum()) / n


def votes(s: tuple) -> tuple[int, ...]:
    """1 good, 0 poor, -1 abstains; one a labeller."""
    n, length, symbols, distinct, common, lines, bangs = s
    return (
        0 if n < 20 else 1 if n >= 50 else -1,
        0 if symbols > 0.08 else 1 if symbols < 0.01 else -1,
        0 if length < 2.5 or length > 11 else 1 if 3.2 < length < 8.5 else -1,
        0 if common < 0.05 else 1 if common > 0.15 else -1,
        0 if lines < 0.7 else 1 if lines > 0.95 else -1,
        0 if bangs > 0.2 else 1 if bangs < 0.02 else -1,
        0 if n >= 100 and distinct < 0.25 else 1 if n >= 50 and distinct > 0.35 else -1,
    )


LABELLERS = 7


@dataclass
class Accuracies:
    """How common good texts are, and for each labeller the chance of each vote (0, 1, abstain) given poor and good."""

    good: float
    chance: np.ndarray  # [labeller, class, vote]

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """Probability of good for rows of votes."""
        at = np.where(v < 0, 2, v)
        log = np.tile(np.log([1 - self.good, self.good]), (len(v), 1))
        for j in range(v.shape[1]):
            log += np.log(self.chance[j][:, at[:, j]]).T
        log -= log.max(1, keepdims=True)
        p = np.exp(log)
        return p[:, 1] / p.sum(1)


def estimate(patterns: np.ndarray, counts: np.ndarray, steps: int = 100) -> Accuracies:
    """Expectation-maximisation over counted vote patterns, from the majority's opinion."""
    m = patterns.shape[1]
    ones, zeros = (patterns == 1).sum(1), (patterns == 0).sum(1)
    p = np.clip((ones + 2.0) / (ones + 3.0 * zeros + 2.5), 0.02, 0.98)
    at = np.where(patterns < 0, 2, patterns)
    model = Accuracies(0.8, np.full((m, 2, 3), 1 / 3))
    for _ in range(steps):
        good = float((counts * p).sum() / counts.sum())
        chance = np.ones((m, 2, 3))
        for j in range(m):
            for v in range(3):
                use = at[:, j] == v
                chance[j, 1, v] += (counts * p)[use].sum()
                chance[j, 0, v] += (counts * (1 - p))[use].sum()
        chance /= chance.sum(2, keepdims=True)
        model = Accuracies(float(np.clip(good, 1e-3, 1 - 1e-3)), chance)
        new = model.posterior(patterns)
        if np.abs(new - p).max() < 1e-6:
            break
        p = new
    return model


def odd_bytes(w: _text.Words) -> np.ndarray:
    """Bytes that are no letters of each word."""
    total = np.concatenate(([0], np.cumsum(ODD[w.buf])))
    return total[w.ends] - total[w.starts]


def features(w: _text.Words, a: int, e: int, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words, pairs, shapes and sizes with the root of their counts, of length 1 together.

    A word's shape is its number of bytes and of bytes that are no letters; a text's sizes are the steps of its number of words
    and of the share of its words that differ.
    """
    h = w.hashes[a:e]
    n = w.ends[a:e] - w.starts[a:e]
    shape = _text.mix((np.minimum(n, 20) * 32 + np.minimum(odd[a:e], 20)).astype(np.uint64) + np.uint64(1))
    steps = [int(4 * np.log2(e - a + 1)), 100 + int(10 * len(np.unique(h)) / max(1, e - a))]
    sizes = _text.mix(np.array(steps, np.uint64) + np.uint64(1 << 20))
    at = np.concatenate([h, _text.chain(h, 2), shape, np.repeat(sizes, max(1, e - a))]) >> np.uint64(64 - BITS)
    f, n = np.unique(at.astype(np.int64), return_counts=True)
    v = np.sqrt(n)
    return f, v / max(1e-9, np.sqrt((v**2).sum()))


@dataclass
class Scorer:
    """A linear scorer of fixed size over hashed features."""

    weights: np.ndarray
    base: float

    def score(self, f: np.ndarray, v: np.ndarray) -> float:
        x = self.base + float((self.weights[f] * v).sum())
        return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


def train(rows: list[tuple[np.ndarray, np.ndarray, float]], good: float) -> Scorer:
    """Adaptive gradient steps on the posterior as a soft label, in a fixed order."""
    s = Scorer(np.zeros(1 << BITS, np.float32), float(np.log(good / (1 - good))))
    g, gb = np.full(1 << BITS, 1e-3), 1e-3
    rng = np.random.default_rng(3)
    for _ in range(PASSES):
        for i in rng.permutation(len(rows)).tolist():
            f, v, p = rows[i]
            d = (s.score(f, v) - p) * (abs(2 * p - 1) + 0.05)
            step = d * v
            g[f] += step * step
            s.weights[f] -= (RATE * step / np.sqrt(g[f])).astype(np.float32) * 0.2
            gb += d * d
            s.base -= RATE * d / np.sqrt(gb) * 0.1
    return s


def fit(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> tuple[Accuracies | None, Scorer]:
    """The labellers' accuracies over the whole table and a scorer trained on a bounded sample."""
    modest(docs.sparkSession)
    nothing = Scorer(np.zeros(1 << BITS, np.float32), 0.0)
    names = [f"v{j}" for j in range(LABELLERS)]

    def pattern(batches):
        for b in batches:
            out = [votes(_shares(w, a, e)) for w in _text.slices(b.column(0)) for _, a, e in w.each()]
            got = np.array(out, np.int32).reshape(-1, LABELLERS)
            yield pa.RecordBatch.from_arrays([pa.array(got[:, j]) for j in range(LABELLERS)], names)

    found = docs.select(text).mapInArrow(pattern, ", ".join(f"{n} int" for n in names)).groupBy(*names).count().collect()  # at most 3**LABELLERS rows
    if not found:
        return None, nothing
    table = np.array([tuple(r) for r in sorted(found)], np.int64)
    model = estimate(table[:, :LABELLERS], table[:, LABELLERS].astype(float))

    ids = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("_sw_id")).distinct()
    ids = ids.orderBy(F.xxhash64("_sw_id"), "_sw_id").limit(TRAIN_ROWS)  # the proof of the broadcast's size
    some = docs.select(F.col(doc_id).alias("_sw_doc"), F.col(text).alias("_sw_text"))
    some = some.join(F.broadcast(ids), F.col("_sw_doc") == F.col("_sw_id"), "left_semi")

    def sample(batches):
        for b in batches:
            f, v, c = [], [], []
            for w in _text.slices(b.column(1), table=_text.LOWER):
                odd = odd_bytes(w)
                for _, a, e in w.each():
                    x, y = features(w, a, e, odd)
                    f.append(x.astype(np.int32))
                    v.append(y.astype(np.float32))
                    c.append(votes(_shares(w, a, e)))
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), pa.array([x.tobytes() for x in f], pa.binary()), pa.array([x.tobytes() for x in v], pa.binary()), pa.array(c, pa.list_(pa.int32()))], ["id", "f", "v", "c"])

    got = some.mapInArrow(sample, "id string, f binary, v binary, c array<int>")
    rows = sorted(((r["id"], np.frombuffer(r["f"], np.int32), np.frombuffer(r["v"], np.float32), tuple(r["c"])) for r in got.toLocalIterator()), key=lambda r: r[0])
    if not rows:
        return model, nothing
    p = model.posterior(np.array([r[3] for r in rows]))
    return model, train([(f, v, float(y)) for (_, f, v, _), y in zip(rows, p, strict=True)], model.good)


def quality_scores(docs: DataFrame, scorer: Scorer, *, text: str = "text", out: str = "quality_score") -> DataFrame:
    """docs with a score from 0 to 1 (higher: good likelier)."""
    modest(SparkSession.active())
    cast = SparkSession.active().sparkContext.broadcast(scorer)

    @F.arrow_udf("double")
    def score(col: pa.Array) -> pa.Array:
        got = []
        for w in _text.slices(col, table=_text.LOWER):
            odd = odd_bytes(w)
            got += [cast.value.score(*features(w, a, e, odd)) for _, a, e in w.each()]
        release()
        return pa.array(got, pa.float64())

    return docs.withColumn(out, score(F.col(text)))
