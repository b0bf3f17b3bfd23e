"""Readers of per-position base counts; all give the same columns.

seqid string, pos int (from 0), strand (-1, 0, 1), ref (0 to 4), coverage, mean_q, fa, fc, fg, ft, score. Files may be compressed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.bases import FREQS, base_code, int_list, strand_code

# The header names of the callers' formats and their strand codes.
REDITOOLS2 = ["Region", "Position", "Reference", "Strand", "Coverage-q30", "MeanQ", "BaseCount[A,C,G,T]", "AllSubs", "Frequency", "gCoverage-q30", "gMeanQ", "gBaseCount[A,C,G,T]", "gAllSubs", "gFrequency"]
REDITOOLS3 = ["Region", "Position", "Reference", "Strand", "Coverage", "MeanQ", "BaseCount[A,C,G,T]", "AllSubs", "Frequency", "gCoverage", "gMeanQ", "gBaseCount[A,C,G,T]", "gAllSubs", "gFrequency"]
JACUSA2 = ["#contig", "start", "end", "name", "score", "strand", "bases11", "info", "filter", "ref"]
STRANDS2 = {"2": 1, "1": -1, "0": 0}
STRANDS3 = {"+": 1, "-": -1, "*": 0}
STRANDS_BED = {"+": 1, "-": -1, ".": 0}


def _reditools(spark: SparkSession, path, header: list[str], strands: dict[str, int]) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in header])
    raw = spark.read.csv(path, sep="\t", header=True, schema=schema, enforceSchema=False, quote="", mode="FAILFAST")
    c = [F.col(f"`{n}`") for n in header]
    freq = int_list(c[6])
    return raw.select(
        c[0].alias("seqid"), (c[1].cast("int") - 1).alias("pos"), strand_code(c[3], strands).alias("strand"), base_code(c[2]).alias("ref"), c[4].cast("int").alias("coverage"),
        c[5].cast("double").alias("mean_q"), *(F.get(freq, F.lit(i)).alias(f) for i, f in enumerate(FREQS)), F.lit(0.0).alias("score"),
    )


def reditools2(spark: SparkSession, path) -> DataFrame:
    """Tab-separated, 14 columns with a strict header; a base that is not A, C, G or T is N."""
    return _reditools(spark, path, REDITOOLS2, STRANDS2)


def reditools3(spark: SparkSession, path) -> DataFrame:
    return _reditools(spark, path, REDITOOLS3, STRANDS3)


def jacusa2(spark: SparkSession, path) -> DataFrame:
    """Extended BED: lines with ## are skipped, the header is checked; the start counts from 0, coverage is the sum of bases."""
    lines = spark.read.text(path).where(~F.col("value").startswith("##") & (F.col("value") != ""))
    bad = F.raise_error(F.concat(F.lit("unexpected header "), F.col("value"))).cast("boolean")
    body = lines.where(F.when(F.col("value") == "\t".join(JACUSA2), F.lit(False)).when(F.col("value").startswith("#"), bad).otherwise(F.lit(True)))
    part = F.split("value", "\t")
    c = [F.get(part, F.lit(i)) for i in range(len(JACUSA2))]
    freq = int_list(c[6])
    return body.select(
        c[0].alias("seqid"), c[1].cast("int").alias("pos"), strand_code(c[5], STRANDS_BED).alias("strand"), base_code(c[9]).alias("ref"),
        F.aggregate(freq, F.lit(0), lambda a, x: a + x).alias("coverage"), F.lit(None).cast("double").alias("mean_q"), *(F.get(freq, F.lit(i)).alias(f) for i, f in enumerate(FREQS)), c[4].try_cast("double").alias("score"),
    )


def unsupported(spark: SparkSession, path) -> DataFrame:
    raise NotImplementedError("Unimplemented format")


#: Readers by format name; add one to support another caller.
FORMATS = {"reditools2": reditools2, "reditools3": reditools3, "jacusa2": jacusa2, "sapin": unsupported}


def read_sites(spark: SparkSession, path, format: str) -> DataFrame:
    return FORMATS[format](spark, path)


def synthetic(spark: SparkSession, seqid: str, n: int, ref: int, read: int, strand: int = 1) -> DataFrame:
    """One read of a base at each of n positions of one genome base: for tests."""
    return spark.range(n).select(
        F.lit(seqid).alias("seqid"), F.col("id").cast("int").alias("pos"), F.lit(strand).cast("tinyint").alias("strand"), F.lit(ref).cast("tinyint").alias("ref"), F.lit(1).alias("coverage"),
        F.lit(30.0).alias("mean_q"), *(F.lit(int(i == read)).alias(f) for i, f in enumerate(FREQS)), F.lit(0.0).alias("score"),
    )
