"""Counters of bases and pairings, kept long: one row a key and genome base.

A long counter has `ref` (0 to 4), observed, qualified, and for each read base b reads_b (qualified reads after the edit
threshold) and sites_b (sites with any). All are sums, so counters merge by summing, partially before a shuffle.
wide() turns them into the columns of a report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bases import BASES, FREQS, PAIRINGS, vector

SUMS = ["observed", "qualified", *(f"reads_{b}" for b in BASES), *(f"sites_{b}" for b in BASES)]
VECTORS = ["observed_bases", "qualified_bases", "site_pairings", "read_pairings"]


def qualified_reads(index: int, cov: int, edit: int) -> Column:
    """Reads of a base that count: at a site of enough coverage, and at least `edit` of them unless it is the genome's base."""
    f = F.col(FREQS[index])
    enough = F.when((F.col("ref") == index) | (f >= edit), f).otherwise(0)
    return F.when(F.col("coverage") >= cov, enough).otherwise(0).cast("bigint")


def qualify(sites: DataFrame, cov: int = 1, edit: int = 1) -> DataFrame:
    """sites with what each adds to a counter."""
    out = sites.withColumns({f"reads_{b}": qualified_reads(i, cov, edit) for i, b in enumerate(BASES)})
    return out.withColumns(
        {"observed": F.lit(1).cast("bigint"), "qualified": (F.col("coverage") >= cov).cast("bigint")} | {f"sites_{b}": (F.col(f"reads_{b}") > 0).cast("bigint") for b in BASES}
    )


def summed(rows: DataFrame, *keys: str) -> DataFrame:
    """Counters merged by keys (and genome base)."""
    return rows.groupBy(*keys, "ref").agg(*(F.sum(c).cast("bigint").alias(c) for c in SUMS))


def wide(rows: DataFrame, *keys: str) -> DataFrame:
    """One row a key: obs_X, qual_X (X also N), site_XY and read_XY. A key has at most five rows, one a genome base."""
    pick = lambda c, i: F.sum(F.when(F.col("ref") == i, F.col(c)).otherwise(0)).cast("bigint")
    cols = [pick("observed", i).alias(f"obs_{b}") for i, b in enumerate([*BASES, "N"])]
    cols += [pick("qualified", i).alias(f"qual_{b}") for i, b in enumerate([*BASES, "N"])]
    cols += [pick(f"sites_{p[1]}", BASES.index(p[0])).alias(f"site_{p}") for p in PAIRINGS]
    cols += [pick(f"reads_{p[1]}", BASES.index(p[0])).alias(f"read_{p}") for p in PAIRINGS]
    return rows.groupBy(*keys).agg(*cols)


def zeros(rows: DataFrame) -> DataFrame:
    """Null counters as 0, after an outer join."""
    names = [c for c in rows.columns if c.startswith(("obs_", "qual_", "site_", "read_"))]
    return rows.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in names})


def qualified_total() -> Column:
    """Qualified bases of any kind, N too: rows without any are not reported."""
    return sum((F.col(f"qual_{b}") for b in [*BASES, "N"][1:]), F.col("qual_A"))


def packed(rows: DataFrame) -> DataFrame:
    """Wide counters as the four comma vectors of a report (N is left out)."""
    vectors = {
        "observed_bases": vector(*(F.col(f"obs_{b}") for b in BASES)),
        "qualified_bases": vector(*(F.col(f"qual_{b}") for b in BASES)),
        "site_pairings": vector(*(F.col(f"site_{p}") for p in PAIRINGS)),
        "read_pairings": vector(*(F.col(f"read_{p}") for p in PAIRINGS)),
    }
    keep = [c for c in rows.columns if not c.startswith(("obs_", "qual_", "site_", "read_"))]
    return rows.select(*keep, *(v.alias(k) for k, v in vectors.items()))
