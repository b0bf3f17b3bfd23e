"""The sample matrix: two ratios a pairing, prevalence filters, and the wide form.

Kept long, one row a key, sample, pairing and metric. espf is edited sites of XY over qualified X; espr is reads of XY over all
reads at X. A ratio whose denominator is below min_cov is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bases import BASES, EDITS, PAIRINGS

KEY = ["seqid", "parent_ids", "id", "mtype", "ptype", "type", "ctype", "mode", "start", "end", "strand"]
#: The sixteen-wide vectors as an older reader indexed them, with a pairing's place among the twelve edits.
LEGACY = {p: PAIRINGS[i] for i, p in enumerate(EDITS)}


def ratios(rows: DataFrame, sample: list[str], key: list[str], min_cov: int = 1, decimals: int | None = 4, legacy_pair_index: bool = False, pairings: tuple[str, ...] = EDITS) -> DataFrame:
    """rows with wide counters as long rows: sample, key, pairing, metric, num, den, value."""
    each: list[Column] = []
    for p in pairings:
        x, source = p[0], LEGACY[p] if legacy_pair_index else p
        reads = sum((F.col(f"read_{x}{b}") for b in BASES[1:]), F.col(f"read_{x}A"))
        for metric, num, den in (("espf", f"site_{source}", F.col(f"qual_{x}")), ("espr", f"read_{source}", reads)):
            each.append(F.struct(F.lit(p).alias("pairing"), F.lit(metric).alias("metric"), F.col(num).alias("num"), den.cast("bigint").alias("den")))
    long = rows.select(*sample, *key, F.explode(F.array(*each)).alias("r")).select(*sample, *key, "r.*")
    ratio = F.try_divide("num", "den")
    value = F.when(F.col("den") >= max(1, min_cov), ratio if decimals is None else F.bround(ratio, decimals))
    return long.withColumn("value", value.cast("double"))


def has_value(value: str = "value") -> Column:
    return F.col(value).isNotNull() & (F.col(value) != 0)


def prevalent(long: DataFrame, samples: DataFrame, key: list[str], min_samples_pct: float | None = None, min_group_pct: float | None = None, group: str = "grp") -> DataFrame:
    """Keys (with pairing and metric) that stay. Without limits: any sample has a value. With limits: the share of all samples,
    or of the samples of any group, reaches its limit. samples has one row a sample."""
    keys = [*key, "pairing", "metric"]
    per = long.where(has_value()).groupBy(*keys, group).agg(F.count(F.lit(1)).alias("_n"))
    if min_samples_pct is None and min_group_pct is None:
        return per.select(*keys).distinct()
    sizes = samples.groupBy(group).agg(F.count(F.lit(1)).alias("_size"))
    total = samples.agg(F.count(F.lit(1)).alias("_all"))
    per = per.join(sizes, group).crossJoin(F.broadcast(total))  # total is one row
    keep = F.lit(False)
    if min_samples_pct is not None:
        keep = keep | (F.sum("_n") / F.max("_all") >= min_samples_pct / 100)
    if min_group_pct is not None:
        keep = keep | F.max(F.col("_n") / F.col("_size") >= min_group_pct / 100)
    return per.groupBy(*keys).agg(keep.alias("_keep")).where("_keep").select(*keys)


def kept(long: DataFrame, keys: DataFrame, key: list[str]) -> DataFrame:
    """Rows of long whose key is in keys; nulls in keys match."""
    names = [*key, "pairing", "metric"]
    k = keys.select(*(F.col(c).alias(f"_k_{c}") for c in names))
    on = F.lit(True)
    for c in names:
        on = on & long[c].eqNullSafe(k[f"_k_{c}"])
    return long.join(k, on, "left_semi")


def sample_column(group: str = "grp", sample: str = "sample", rep: str = "rep", metric: str = "metric", file: str | None = None) -> Column:
    return F.concat_ws("::", group, sample, rep, *([file] if file else []), metric)


def wide(long: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """One row a key and one column a sample, null where it has no value: a group-by is an outer merge. A key that comes twice in a sample raises."""
    one = long.groupBy(*key, sample_column().alias("_col")).agg(F.count(F.lit(1)).alias("_n"), F.first("value").alias("_v"))
    twice = F.raise_error(F.concat(F.lit("a key comes twice in "), F.col("_col"))).cast("double")
    return one.withColumn("_v", F.when(F.col("_n") > 1, twice).otherwise(F.col("_v"))).groupBy(*key).pivot("_col", columns).agg(F.first("_v"))


def deduplicated_samples(samples: DataFrame, order: str) -> DataFrame:
    """samples with a second and later equal (grp, sample, rep) told apart by a suffix of its replicate."""
    from pyspark.sql import Window as W

    n = F.row_number().over(W.partitionBy("grp", "sample", "rep").orderBy(order))
    return samples.withColumn("_n", n).withColumn("rep", F.when(F.col("_n") > 1, F.concat_ws("_", "rep", F.col("_n").cast("string"))).otherwise(F.col("rep"))).drop("_n")


def in_matrix_order(rows: DataFrame) -> DataFrame:
    """Sequences by name with the genome last, then parents and mode."""
    return rows.orderBy(F.col("seqid").isNull(), "seqid", "parent_ids", "mode")
