"""Quality rules as learned decision lists, in DataFrame functions only.

statistics() measures whole texts. learn() takes the statistics of labelled rows and grows rules for low quality one after
another (sequential covering): a rule is a conjunction of thresholds added by greatest information gain on two thirds of the
rows and pruned from its end on the other third; it stands if its precision there is at least MIN_PRECISION, and the rows it
covers are taken out. The list becomes one ordered CASE expression. At most TRAIN_ROWS labelled rows, those of the
least hash of the id, are learned from (a documented bound); everything else covers all rows.

Null texts have no words: all counts 0. Ratios over 0 count as 0. Rows with null labels or ids are not learned from.
Repeated rows get equal results. Without labels of both kinds the list is empty and keeps all. Equal 3-word windows are told
by a 64-bit hash within one text.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._runtime import guarded, stored

WORD = r"[^\x20\x09-\x0D]+"
SPACES, SYMBOLS = " \t\n\x0b\f\r", "#*$%&|<>"
TRAIN_ROWS = 20_000
MAX_RULES, MAX_CONDITIONS, CUTS, MIN_PRECISION, MIN_COVER = 8, 3, 24, 0.7, 5
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def statistics(docs: DataFrame, *, text: str = "text", out: str = "stats") -> DataFrame:
    """docs with a struct `out` of COUNTS (long). Words and windows stay inside the row: no shuffle."""
    docs, back = guarded(docs)
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_extract_all(t, F.lit(WORD), F.lit(0))
    df = docs.withColumn("_sw_words", words)
    n = F.size("_sw_words")
    w = F.col("_sw_words")
    gram = lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p"))
    df = df.withColumn("_sw_grams", F.when(n >= 4, F.sort_array(F.transform(F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))), gram))))
    g = F.col("_sw_grams")
    twice = F.filter(g, lambda x, i: (x["h"] == F.get(g, i + 1)["h"]) | ((i > 0) & (x["h"] == F.get(g, i - 1)["h"])))
    df = df.withColumn("_sw_at", F.transform(twice, lambda x: x["p"]))
    covered = F.size(F.array_distinct(F.flatten(F.transform("_sw_at", lambda p: F.array(p, p + 1, p + 2)))))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    df = df.withColumn("_sw_lines", lines)
    stats = F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_sw_lines") - F.size(F.array_distinct("_sw_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("_sw_at").isNull(), F.lit(0)).otherwise(covered).cast("long").alias("n_repeat_words"),
    )
    return df.withColumn(out, stats).drop("_sw_words", "_sw_grams", "_sw_at", "_sw_lines").withColumnsRenamed(back)


def features(stats: str) -> dict[str, Column]:
    """What rules may test, by name."""
    c = lambda x: F.col(f"{stats}.{x}" if stats else x).cast("double")
    over = lambda a, b: F.coalesce(F.try_divide(c(a), c(b)), F.lit(0.0))
    return {
        "n_words": c("n_words"), "word_length": over("word_chars", "n_words"), "symbol_share": over("n_symbols", "word_chars"),
        "dup_lines": c("n_dup_lines"), "dup_lines_per_word": over("n_dup_lines", "n_words"), "repeat_share": over("n_repeat_words", "n_words"),
    }


@dataclass(frozen=True)
class Rule:
    """Conditions (feature, ">" or "<=", threshold), all to be met; precision on the rows it was pruned with."""

    conditions: tuple[tuple[str, str, float], ...]
    precision: float

    def meets(self, x: dict[str, float]) -> bool:
        return all(x[f] > v if op == ">" else x[f] <= v for f, op, v in self.conditions)

    def column(self, feature: dict[str, Column]) -> Column:
        out = F.lit(True)
        for f, op, v in self.conditions:
            out = out & (feature[f] > F.lit(v) if op == ">" else feature[f] <= F.lit(v))
        return out


def verdict(rules: list[Rule], feature: dict[str, Column]) -> Column:
    """The number (from 1) of the first rule that a row meets, else 0: one ordered CASE expression."""
    if not rules:
        return F.lit(0)
    out = None
    for i, r in enumerate(rules, 1):
        out = F.when(r.column(feature), F.lit(i)) if out is None else out.when(r.column(feature), F.lit(i))
    return out.otherwise(F.lit(0))


def _cuts(values: list[float]) -> list[float]:
    v = sorted(set(values))
    return v[:-1] if len(v) <= CUTS + 1 else [sorted(values)[len(values) * i // (CUTS + 1)] for i in range(1, CUTS + 1)]


def _grow(rows: list[tuple[dict, int]], names: list[str]) -> list[tuple[str, str, float]]:
    """Conditions by greatest FOIL gain for low quality (label 0)."""
    found: list[tuple[str, str, float]] = []
    while len(found) < MAX_CONDITIONS:
        p, n = sum(1 for _, y in rows if not y), sum(1 for _, y in rows if y)
        if not p or not n:
            break
        best = (1e-9, None)
        for f in names:
            cuts = sorted(set(_cuts([x[f] for x, _ in rows])))
            for op in (">", "<="):
                for v in cuts:
                    a = b = 0
                    for x, y in rows:
                        if (x[f] > v) == (op == ">"):
                            a, b = (a, b + 1) if y else (a + 1, b)
                    if a >= MIN_COVER:
                        gain = a * (math.log2(a / (a + b)) - math.log2(p / (p + n)))
                        if gain > best[0]:
                            best = (gain, (f, op, v))
        if best[1] is None:
            break
        found.append(best[1])
        rows = [r for r in rows if Rule((best[1],), 0).meets(r[0])]
    return found


def covering(rows: list[tuple[dict, int]]) -> list[Rule]:
    """An ordered decision list from (features, label) rows; label 0 is low quality. The order of rows decides the split."""
    rules: list[Rule] = []
    names = list(rows[0][0]) if rows else []
    while len(rules) < MAX_RULES:
        grow, prune = [r for i, r in enumerate(rows) if i % 3], rows[::3]
        conditions = _grow(grow, names)
        if not conditions:
            break
        best = None
        for k in range(len(conditions), 0, -1):
            met = [y for x, y in prune if Rule(tuple(conditions[:k]), 0).meets(x)]
            p, n = met.count(0), len(met) - met.count(0)
            worth = (p - n) / (p + n) if met else -1.0
            if best is None or worth >= best[0]:
                best = (worth, k, p, p + n)
        _, k, p, n = best
        if n < MIN_COVER or p / n < MIN_PRECISION:
            break
        rules.append(Rule(tuple(conditions[:k]), p / n))
        rows = [r for r in rows if not rules[-1].meets(r[0])]
    return rules


def learn(stats: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", label: str = "quality", column: str = "stats", where: Column | None = None) -> list[Rule]:
    """Rules from the labelled rows of a table with statistics (and, if given, `where` true)."""
    y = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_sw_id")).agg(F.max(label).alias("_sw_y"))
    y = y.orderBy(F.xxhash64("_sw_id"), "_sw_id").limit(TRAIN_ROWS)  # the proof of the broadcast's size
    feature = features(column)
    rows = stats.where(where) if where is not None else stats
    rows = rows.select(F.col(doc_id).alias("_sw_doc"), *(c.alias(f) for f, c in feature.items()))
    rows = rows.join(F.broadcast(y), rows["_sw_doc"] == y["_sw_id"])
    rows = rows.groupBy("_sw_doc", "_sw_y").agg(F.min(F.struct(*feature)).alias("x")).select("_sw_doc", "_sw_y", "x.*")  # of rows that repeat an id, the least
    got = sorted(rows.collect(), key=lambda r: zlib.crc32(str(r["_sw_doc"]).encode()))
    return covering([({f: r[f] for f in feature}, int(r["_sw_y"] > 0)) for r in got])


def base_failed(stats: str) -> Column:
    """Fewer than 50 words, or more than half of them in repeated 3-word windows."""
    c = lambda x: F.col(f"{stats}.{x}" if stats else x)
    return (c("n_words") < 50) | (100 * c("n_repeat_words") > 50 * c("n_words"))


def quality_rules(docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id", label: str = "quality", where: Column | None = None) -> tuple[DataFrame, list[Rule]]:
    """docs without its text, with COUNTS, base_failed, rule (0: none) and kept; and the rules. Texts are read once."""
    docs, back = guarded(docs)
    base = statistics(docs, text=text, out="_sw_stats").drop(text).withColumn("_sw_failed", base_failed("_sw_stats"))
    base = stored(base, "quality-statistics")
    rules = learn(base, labels, doc_id=doc_id, label=label, column="_sw_stats", where=~F.col("_sw_failed") if where is None else ~F.col("_sw_failed") & where)
    out = base.drop(*(c for c in [*COUNTS, "base_failed", "rule", "kept"] if c in base.columns))
    number = verdict(rules, features("_sw_stats"))
    out = out.select(*out.columns, *(F.col(f"_sw_stats.{c}").alias(c) for c in COUNTS), F.col("_sw_failed").alias("base_failed"), F.when(F.col("_sw_failed"), F.lit(0)).otherwise(number).cast("int").alias("rule"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)).drop("_sw_stats", "_sw_failed").withColumnsRenamed(back), rules
