"""Where reads come from: a sheet, a list, a folder, a pattern, a file or an address."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names

# What counts as reads or alignments by its name, and how mates in a folder are named.
ALIGNMENT = r"(?i)\.bam$"
READS = r"(?i)\.(fastq|fq)(\.gz)?$"
MATES = r"_(R?1|R?2)(_.*)?\.(fastq|fq)(\.gz)?$"
KINDS = {"alignment": ALIGNMENT, "reads": READS}


def is_list(text: str) -> bool:
    return "," in text


def discover(spark: SparkSession, text: str, kind: str) -> DataFrame:
    """(path, is_url, uid) of the inputs of a kind, `alignment` or `reads`, that text names.

    A list, parted by commas and blanks, keeps its entries of that kind as they are, found or not. An address is kept as it is. A
    file, a pattern or a folder is looked up by Spark's file system; in a folder reads must be named as mates. Only
    names are read. Nothing found is an empty table.
    """
    pattern = KINDS[kind]
    if is_list(text) or re.match(names.URL, text):
        found = [(x,) for x in re.split(r"[,\s]+", text) if re.search(pattern, x)]
        rows = spark.createDataFrame(found, "path string")
    else:
        rows = files(spark, text).where(F.col("path").rlike(pattern))
        if kind == "reads" and not re.search(pattern, text):
            rows = rows.where(F.col("path").rlike(MATES))
    return rows.select("path", names.is_url(F.col("path")).alias("is_url"), names.file_id(F.col("path")).alias("uid"))


def files(spark: SparkSession, text: str) -> DataFrame:
    """(path) of a file, of a pattern's files, or of the files right in a folder; empty if there are none."""
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(text)
    system = path.getFileSystem(hadoop)
    found = []
    for s in system.globStatus(path) or []:
        inside = system.listStatus(s.getPath()) if s.isDirectory() else [s]
        found += [(x.getPath().toString(),) for x in inside if not x.isDirectory()]
    return spark.createDataFrame(sorted(found), "path string")
