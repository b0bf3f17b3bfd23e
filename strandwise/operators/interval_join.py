"""Point-in-interval join of sites with the parts of features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Positions a bin. A site has one bin, so no pair comes twice; a part is repeated for each bin it touches.
BIN = 4096


def strand_fits(part: Column, site: Column) -> Column:
    """A stranded part takes sites of its strand; an unstranded one takes all."""
    return (part == site) | (part == 0)


def sites_in_parts(sites: DataFrame, parts: DataFrame, keep: list[str], bin_size: int = BIN) -> DataFrame:
    """Each site with each part it falls in (start0 <= pos < end0): the sites' columns and `keep` of parts.

    An equi-join on sequence and bin with the exact range as a residual, so a long sequence spreads over many keys; Spark
    broadcasts the parts only while their size is under its threshold and splits skewed bins otherwise.
    """
    binned = parts.where(F.col("end0") > F.col("start0")).select(
        F.col("seqid").alias("_seqid"), F.col("start0").alias("_start"), F.col("end0").alias("_end"), F.col("strand").alias("_strand"),
        *(F.col(c).alias(f"_keep_{c}") for c in keep),
        F.explode(F.sequence(F.floor(F.col("start0") / bin_size), F.floor((F.col("end0") - 1) / bin_size))).alias("_bin"),
    )
    s = sites.withColumn("_at", F.floor(F.col("pos") / bin_size))
    on = (s["seqid"] == binned["_seqid"]) & (s["_at"] == binned["_bin"]) & (s["pos"] >= binned["_start"]) & (s["pos"] < binned["_end"]) & strand_fits(binned["_strand"], s["strand"])
    return s.join(binned, on).select(*sites.columns, *(F.col(f"_keep_{c}").alias(c) for c in keep))


def sites_in_parts_plain(sites: DataFrame, parts: DataFrame, keep: list[str]) -> DataFrame:
    """The same without bins: for few or short sequences."""
    p = parts.select(F.col("seqid").alias("_seqid"), F.col("start0").alias("_start"), F.col("end0").alias("_end"), F.col("strand").alias("_strand"), *(F.col(c).alias(f"_keep_{c}") for c in keep))
    on = (sites["seqid"] == p["_seqid"]) & (sites["pos"] >= p["_start"]) & (sites["pos"] < p["_end"]) & strand_fits(p["_strand"], sites["strand"])
    return sites.join(p, on).select(*sites.columns, *(F.col(f"_keep_{c}").alias(c) for c in keep))
