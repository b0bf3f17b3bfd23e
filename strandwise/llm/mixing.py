"""Mixing sources to target weights, in DataFrame functions only.

A document's size is its number of words [^\\x20\\x09-\\x0D]+ (null text: 0). Sources, in code point order with null last,
weigh WEIGHTS, repeating, and share `share` hundredths of all sizes; a target stops at `cap` times its source's size and the
excess is shared again by weight. In closed form: by rising size / weight the sources are capped until the rest's even
share no longer exceeds the cap. A document is emitted floor(target / source size) times, and once more if a hash of seed
and id, uniform in [0, 1), is below the fraction; reruns and lost tasks therefore decide alike.

Sources of size 0 get target 0 and their documents no copy. Null ids are decided by their text's hash. Repeated rows are
separate documents with the same decision. An empty table gives an empty result. Other columns pass through. Totals are
64-bit integers (up to about 10**14 words; beyond, arithmetic raises).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._runtime import guarded, join_small, stored

WEIGHTS = (3, 1, 2)
WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix-1"


def source_targets(docs: DataFrame, *, source: str = "source", text: str = "text", weights: tuple[int, ...] = WEIGHTS, share: int = 150, cap: int = 2) -> DataFrame:
    """One row a source: _sw_source, source_size, target. Few rows: a window over all of them is one small task."""
    sized = docs.select(F.col(source).alias("_sw_source"), F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("s"))
    t = sized.groupBy("_sw_source").agg(F.sum("s").alias("source_size"))
    t = t.withColumn("_i", F.row_number().over(W.orderBy(F.col("_sw_source").asc_nulls_last())) - 1)
    t = t.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), (F.col("_i") % len(weights) + 1).cast("int")).cast("long"))
    order = W.orderBy((F.col("source_size") / F.col("_w")).asc(), "_i")
    before, every = order.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    t = t.withColumn("_c", F.coalesce(F.sum(F.lit(cap) * F.col("source_size")).over(before), F.lit(0)))
    t = t.withColumn("_left", F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0)))
    t = t.withColumn("_all", F.sum("source_size").over(every))
    over = (F.lit(share) * F.col("_all") - F.lit(100) * F.col("_c")) * F.col("_w") > F.lit(100 * cap) * F.col("source_size") * F.col("_left")
    t = t.withColumn("_over", over)
    taken = F.sum(F.when(F.col("_over"), F.lit(cap) * F.col("source_size")).otherwise(0)).over(every)
    rest = F.sum(F.when(F.col("_over"), F.lit(0)).otherwise(F.col("_w"))).over(every)
    even = F.col("_w") * (F.lit(share) * F.col("_all") - F.lit(100) * taken)
    full = F.lit(cap) * F.col("source_size")
    target = F.when(F.col("_over") | (F.col("source_size") == 0), full.cast("double")).otherwise(even.cast("double") / (F.lit(100) * rest).cast("double"))
    return t.select("_sw_source", "source_size", target.alias("target"))


def mixing_plan(docs: DataFrame, *, source: str = "source", text: str = "text", doc_id: str = "doc_id", seed: str = SEED, **how) -> DataFrame:
    """docs with size, source_size, target, copies and taken (size times copies); clashing columns are replaced."""
    targets = stored(source_targets(docs, source=source, text=text, **how), "mix-targets")
    docs, back = guarded(docs)
    out = docs.withColumn("size", F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long"))
    out = out.drop(*(c for c in ("source_size", "target", "copies", "taken") if c in docs.columns))
    out = join_small(out.withColumn("_sw_source", F.col(source)), targets, "_sw_source").drop("_sw_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    key = F.concat(F.lit(seed + ":"), F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("t"), F.md5(F.coalesce(F.col(text), F.lit(""))))))
    chance = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)
    copies = F.floor(rate) + (chance < rate - F.floor(rate)).cast("long")
    out = out.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).cast("long"))
    return out.withColumn("taken", F.col("size") * F.col("copies")).withColumnsRenamed(back)


def mixing(docs: DataFrame, **how) -> DataFrame:
    """The mixed documents: each row of docs as often as the mix takes it, with the columns of docs."""
    own = docs.select(F.struct(*docs.columns).alias("_sw_row"))
    used = [how.get("source", "source"), how.get("text", "text"), how.get("doc_id", "doc_id")]
    plan = mixing_plan(own.select("_sw_row", *(F.col(f"_sw_row.{c}").alias(c) for c in used)), **how)
    some = plan.where(F.col("copies") > 0)
    return some.withColumn("_sw_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("_sw_row.*")
