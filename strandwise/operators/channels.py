"""Joins of runs by their uid: sheets with alignments, library types, hyper-edited reads, and tables by edit type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_sheet(alignments: DataFrame, sheet: DataFrame) -> DataFrame:
    """Alignments (uid, path) with their row of the sheet; those without one, and rows without an alignment, fall out."""
    return alignments.join(sheet, "uid")


def with_library(runs: DataFrame, libraries: DataFrame) -> DataFrame:
    """runs with the strandedness that was found for their uid (uid, library), else their own; all runs stay."""
    found = libraries.groupBy("uid").agg(F.min("library").alias("_found"))
    out = runs.join(found, "uid", "left")
    return out.withColumn("strandedness", F.coalesce("_found", "strandedness")).drop("_found")


def mixed(*sources: DataFrame) -> DataFrame:
    """All runs of several sources; columns that a source lacks are null."""
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def with_hyper_edited(mapped: DataFrame, mapped_again: DataFrame) -> DataFrame:
    """Reads of the runs that have both: mapped at once and mapped again after a transformation, with `again` to tell them."""
    both = mapped.select("uid").distinct().join(mapped_again.select("uid").distinct(), "uid")
    rows = mapped.withColumn("again", F.lit(False)).unionByName(mapped_again.withColumn("again", F.lit(True)), allowMissingColumns=True)
    return rows.join(both, "uid", "left_semi")


def by_edit_type(aggregates: DataFrame, features: DataFrame, pairing: str = "pairing") -> DataFrame:
    """Rows of aggregates and features together, for the edit types that both have."""
    both = aggregates.select(pairing).distinct().join(features.select(pairing).distinct(), pairing)
    return mixed(aggregates, features).join(F.broadcast(both), pairing, "left_semi")  # at most twelve edit types
