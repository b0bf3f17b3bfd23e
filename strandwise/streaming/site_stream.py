"""Counters of arriving site files.

Counters are sums, so a running total is exact: each micro-batch is counted like a finite input, and its long counters are merged by
summing. A state table under `path` holds one folder a batch id, so a batch that is run again replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import counters, rollup


def count_stream(sites: DataFrame, parts: DataFrame, path: str, checkpoint: str, by: list[str] | None = None, cov: int = 1, edit: int = 1, **trigger) -> StreamingQuery:
    """Start counting a stream of sites (seqid, pos, strand, ref, coverage, fa to ft and by) into path."""
    keys = by or []

    def merge(batch: DataFrame, number: int) -> None:
        rows = rollup.part_counts(batch, parts, keys, cov, edit)
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return sites.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def counted(spark, path: str, by: list[str] | None = None) -> DataFrame:
    """The counters of all batches so far."""
    return counters.summed(spark.read.parquet(path).drop("batch"), *(by or []), "seqid", "feature_id")


def live_totals(sites: DataFrame, by: list[str] | None = None, cov: int = 1, edit: int = 1) -> DataFrame:
    """Running counters a sequence of a stream, for output mode complete or update; the state is one row a sequence and base."""
    rows = counters.qualify(sites, cov, edit)
    return rows.groupBy(*(by or []), "seqid", "ref").agg(*(F.sum(c).alias(c) for c in counters.SUMS))
