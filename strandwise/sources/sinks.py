"""Writers: report and matrix files with dots and NA, statistics by section, a manifest."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names
from ..operators import counters, matrix
from .tables import DATA, ENGINE, META


def report_text(rows: DataFrame) -> DataFrame:
    """Report rows under the file's column names, all text, null as a dot."""
    p = counters.packed(rows)
    meta = [names.dotted(F.col(e)).alias(m) for m, e in zip(META, ENGINE, strict=True)]
    data = [names.dotted(F.col("total_sites")).alias(DATA[0]), *(F.col(c).alias(d) for c, d in zip(counters.VECTORS, DATA[1:], strict=True))]
    by = [c for c in rows.columns if c not in (*ENGINE, "total_sites") and not c.startswith(("obs_", "qual_", "site_", "read_"))]
    return p.select(*by, *meta, *data)


def write_report(rows: DataFrame, path: str, by: list[str] | None = None, single: bool = False) -> None:
    """A tab-separated report, a folder for each run; sequences in natural order within a file."""
    out = report_text(rows)
    out = out.repartition(1) if single else out
    out = out.sortWithinPartitions(F.col("SeqID") == names.MISSING, *names.natural_key(F.col("SeqID")), "ParentIDs", "Mode")
    w = out.write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "")
    (w.partitionBy(*by) if by else w).csv(path)


def write_by_mode(rows: DataFrame, path: str, column: str = "Mode") -> None:
    """A report split by mode (or type): a folder a value."""
    report_text(rows).write.mode("overwrite").option("sep", "\t").option("header", True).partitionBy(column).csv(path)


def split_levels(rows: DataFrame) -> dict[str, DataFrame]:
    """The genome's rows, those of whole sequences, and the rest."""
    genome = F.col("seqid").isNull()
    sequence = ~genome & (F.col("parent_ids") == names.MISSING) & (F.col("type") == "sequence")
    return {"total": rows.where(genome), "sequences": rows.where(sequence), "rest": rows.where(~genome & ~sequence)}


def write_matrix(long: DataFrame, columns: list[str], path: str, key: list[str] | None = None) -> None:
    """One wide table a metric and pairing (folders), NA for null, sequences by name with the genome last."""
    key = key or matrix.KEY
    out = matrix.wide(long, [*key, "metric", "pairing"], columns)
    out = out.select(*(names.dotted(F.col(e)).alias(m) for m, e in zip(META, ENGINE, strict=True) if e in key), "metric", "pairing", *(F.col(f"`{c}`") for c in columns))
    order = [c for c in ("SeqID", "ParentIDs", "Mode") if c in out.columns]
    out = out.sortWithinPartitions("metric", "pairing", F.col("SeqID") == names.MISSING, *order)
    out.write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", "NA").partitionBy("metric", "pairing").csv(path)


def write_statistics(tables: dict[str, DataFrame], path: str, section: str = "section") -> None:
    """Each statistic as CSV, a folder a section."""
    for name, t in tables.items():
        w = t.write.mode("overwrite").option("header", True)
        (w.partitionBy(section) if section in t.columns else w).csv(f"{path}/{name}")


def write_manifest(spark, path: str, facts: dict) -> None:
    """A small JSON file by Spark's file system, so that any store will do."""
    spark.createDataFrame([(json.dumps(facts, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def preview(table: DataFrame, rows: int = 500) -> DataFrame:
    """The first rows of a table, for a page."""
    return table.limit(rows)
