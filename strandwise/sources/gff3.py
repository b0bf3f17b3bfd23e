"""GFF3 annotation as parts of features (see operators.hierarchy). Plain, gzip or block-gzip files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _attribute(name: str):
    found = F.regexp_extract("_attributes", f"(?:^|;)\\s*{name}=([^;]*)", 1)
    return F.when(found != "", F.coalesce(F.try_url_decode(F.regexp_replace(found, r"\+", "%2B")), found))


def read_gff3(spark: SparkSession, path, types: list[str] | None = None) -> DataFrame:
    """seqid, feature_id, parent_id, type, start0, end0, strand (. is 0), file_order. A feature of several parents has a row for each.

    Only lines of nine columns count, so comments, directives and an appended FASTA part fall out. types keeps these feature
    types only, before any hierarchy is built. A feature without an id is named by its type and place.
    """
    lines = spark.read.text(path).where(~F.col("value").startswith("#") & ~F.col("value").startswith(">"))
    c = F.split("value", "\t")
    rows = lines.where(F.size(c) == 9).select(*(F.get(c, F.lit(i)).alias(n) for i, n in enumerate(["seqid", "_source", "type", "_start", "_end", "_score", "_strand", "_phase", "_attributes"])), F.monotonically_increasing_id().alias("file_order"))
    if types:
        rows = rows.where(F.col("type").isin(types))
    rows = rows.withColumn("start0", F.col("_start").cast("int") - 1).withColumn("end0", F.col("_end").cast("int"))
    name = F.coalesce(_attribute("ID"), F.concat_ws("-", "type", "seqid", "_start", "_end"))
    rows = rows.withColumn("feature_id", name).withColumn("_parent", _attribute("Parent"))
    rows = rows.withColumn("parent_id", F.explode_outer(F.split("_parent", ",")))
    strand = F.when(F.col("_strand") == "+", 1).when(F.col("_strand") == "-", -1).otherwise(0).cast("int")
    return rows.select("seqid", "feature_id", "parent_id", "type", "start0", "end0", strand.alias("strand"), "file_order")


def cached_by_sequence(parts: DataFrame, path: str) -> DataFrame:
    """parts written once as Parquet, a folder a sequence, and read again: a filter on seqid then reads that sequence's files only."""
    parts.repartition("seqid").write.partitionBy("seqid").parquet(path)
    schema = T.StructType([f for f in parts.schema if f.name != "seqid"] + [parts.schema["seqid"]])
    return parts.sparkSession.read.schema(schema).parquet(path).select(*parts.columns)


def sequence_ids(spark: SparkSession, path) -> DataFrame:
    """The sequences that an annotation names: a scan of lines that are no comments."""
    lines = spark.read.text(path).where(~F.col("value").startswith("#"))
    c = F.split("value", "\t")
    return lines.where(F.size(c) >= 2).select(F.get(c, F.lit(0)).alias("seqid")).distinct()
