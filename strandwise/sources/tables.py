"""Readers of report and matrix files, sample sheets and sequence files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import names
from ..functions.bases import BASES, PAIRINGS, a_to_g, vector_item

# The column names of the report files.
META = ["SeqID", "ParentIDs", "ID", "Mtype", "Ptype", "Type", "Ctype", "Mode", "Start", "End", "Strand"]
DATA = ["TotalSites", "ObservedBases", "QualifiedBases", "SiteBasePairingsQualified", "ReadBasePairingsQualified"]
ENGINE = ["seqid", "parent_ids", "id", "mtype", "ptype", "type", "ctype", "mode", "start", "end", "strand"]


def _strings(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_report(spark: SparkSession, path) -> DataFrame:
    """A feature or aggregate file as the engine's rows with wide counters (dots become null; N is not in the file)."""
    raw = spark.read.csv(path, sep="\t", header=True, schema=_strings([*META, *DATA]), enforceSchema=False, quote="", mode="FAILFAST")
    keep = {"parent_ids"}
    meta = [(F.col(m) if e in keep else names.undotted(F.col(m))).alias(e) for m, e in zip(META, ENGINE, strict=True)]
    meta = [c.cast("bigint").alias(e) if e in ("start", "end") else c.cast("int").alias(e) if e == "strand" else c for c, e in zip(meta, ENGINE, strict=True)]
    cols = [vector_item(F.col("ObservedBases"), i).alias(f"obs_{b}") for i, b in enumerate(BASES)]
    cols += [vector_item(F.col("QualifiedBases"), i).alias(f"qual_{b}") for i, b in enumerate(BASES)]
    cols += [vector_item(F.col("SiteBasePairingsQualified"), i).alias(f"site_{p}") for i, p in enumerate(PAIRINGS)]
    cols += [vector_item(F.col("ReadBasePairingsQualified"), i).alias(f"read_{p}") for i, p in enumerate(PAIRINGS)]
    return raw.select(*meta, names.undotted(F.col("TotalSites")).cast("bigint").alias("total_sites"), *cols)


def read_matrix(spark: SparkSession, path, sep: str = "\t") -> tuple[DataFrame, list[str]]:
    """A wide matrix file as long rows (key, grp, sample, rep, metric, value) and its sample columns: those of four parts.

    `..` in a column's name, as R writes it, counts as `::`. NA and anything that is no number is null.
    """
    head = spark.read.csv(path, sep=sep, header=True, inferSchema=False, quote="").columns
    fixed = [c.replace("..", "::") for c in head]
    raw = spark.read.csv(path, sep=sep, header=True, schema=_strings(head), quote="").toDF(*fixed)
    samples = [c for c in fixed if len(c.split("::")) == 4 and all(c.split("::"))]
    key = [names.undotted(F.col(m)).alias(e) if m != "ParentIDs" else F.col(m).alias(e) for m, e in zip(META, ENGINE, strict=True) if m in fixed]
    each = F.explode(F.array(*(F.struct(*(F.lit(p).alias(n) for n, p in zip(("grp", "sample", "rep", "metric"), c.split("::"), strict=True)), F.expr(f"try_cast(`{c}` as double)").alias("value")) for c in samples)))
    return raw.select(*key, each.alias("_v")).select(*[e for m, e in zip(META, ENGINE, strict=True) if m in fixed], "_v.*"), samples


SHEET = ["group", "input_1", "input_2", "strandedness", "read_type", "sample", "replicate"]
# The kinds of reads.
READ_TYPES = ("short_paired", "short_single", "pacbio", "ont")


def read_sample_sheet(spark: SparkSession, path, **how) -> DataFrame:
    return checked_sheet(spark.read.csv(path, header=True), **how)


def checked_sheet(raw: DataFrame, strandedness: str | None = None, read_type: str | None = None, base: str | None = None) -> DataFrame:
    """A sample sheet with a problem column (null: none), input_type, is_url, paired and uid.

    group and input_1 are needed, and strandedness and read_type unless given for all. Two files are a pair only for
    short_paired; other read types do without the second. sample is the uid where neither it nor replicate is there; a
    replicate without a sample is a problem. base makes paths absolute.
    """
    for c in SHEET:
        if c not in raw.columns:
            raw = raw.withColumn(c, F.lit(None).cast("string"))
    t = raw.select(*(F.when(F.trim(c) != "", F.trim(c)).alias(c) for c in SHEET))
    if base:
        t = t.withColumns({c: names.absolute(F.col(c), base) for c in ("input_1", "input_2")})
    if strandedness:
        t = t.withColumn("strandedness", F.coalesce("strandedness", F.lit(strandedness)))
    t = t.withColumn("read_type", F.lit(read_type) if read_type else F.lower("read_type"))
    t = t.withColumn("input_type", F.when(names.is_fastq(F.col("input_1")), "fastq").when(F.col("input_1").rlike(r"(?i)\.(bam|cram|sam)$"), "alignment"))
    pairs = F.col("read_type") == "short_paired"
    problem = (
        F.when(F.col("group").isNull(), "group is missing").when(F.col("input_1").isNull(), "input_1 is missing")
        .when(F.col("input_type").isNull(), "input_1 is neither reads nor an alignment")
        .when((F.col("input_type") == "alignment") & F.col("input_2").isNotNull(), "an alignment has no input_2")
        .when(F.col("strandedness").isNull(), "strandedness is missing").when(F.col("read_type").isNull(), "read_type is missing")
        .when(~F.col("read_type").isin(*READ_TYPES), "read_type is unknown")
        .when(F.col("input_2").isNotNull() & ~names.is_fastq(F.col("input_2")), "input_2 holds no reads")
        .when(pairs & (F.col("input_type") == "fastq") & F.col("input_2").isNull(), "short_paired needs input_2")
        .when(F.col("sample").isNull() & F.col("replicate").isNotNull(), "a replicate needs a sample")
    )
    t = t.withColumn("problem", problem).withColumn("paired", F.coalesce(pairs & F.col("input_2").isNotNull(), F.lit(False)))
    t = t.withColumn("is_url", names.is_url(F.col("input_1"))).withColumn("uid", names.run_uid(F.col("input_1"), F.col("paired")))
    return t.withColumn("sample", F.coalesce("sample", "uid")).withColumn("replicate", F.coalesce("replicate", F.lit("rep1")))


def fastq_a_to_g(spark: SparkSession, path) -> DataFrame:
    """Four-line records of FASTQ files: name, sequence with A as G, plus, quality.

    A line's place in its file is the number of lines in the file's earlier pieces, summed over a row a piece, and its place in its
    own piece; so a file is cut at will and no task holds all of it.
    """
    own = F.struct(F.input_file_name().alias("file"), F.input_file_block_start().alias("piece"), F.monotonically_increasing_id().alias("n"))
    lines = spark.read.text(path).select("value", own.alias("at")).select("value", "at.*")
    pieces = lines.groupBy("file", "piece").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("lines"))
    before = F.sum("lines").over(W.partitionBy("file").orderBy("piece")) - F.col("lines")  # a row a piece
    pieces = pieces.select("file", "piece", "least", before.alias("before"))
    place = F.col("before") + F.col("n") - F.col("least")
    lines = lines.join(pieces, ["file", "piece"]).select("file", "value", F.floor(place / 4).alias("record"), (place % 4).alias("line"))
    rows = lines.groupBy("file", "record").pivot("line", [0, 1, 2, 3]).agg(F.first("value"))
    return rows.select(F.col("file").alias("_file"), "record", F.col("0").alias("name"), a_to_g(F.col("1")).alias("sequence"), F.col("2").alias("plus"), F.col("3").alias("quality"))


def fasta_a_to_g(spark: SparkSession, path) -> DataFrame:
    """Lines of a FASTA file, with A as G in sequence lines."""
    return spark.read.text(path).select(F.when(F.col("value").startswith(">"), F.col("value")).otherwise(a_to_g(F.col("value"))).alias("value"))


def library_type(json_text):
    """The expected library format out of a quantifier's JSON report."""
    return F.get_json_object(json_text, "$.expected_format")


def restored_reads(aligned: DataFrame, original: DataFrame, name: str = "name") -> DataFrame:
    """Aligned reads with the sequence and quality of the original reads of their name (the first of a name); others fall out."""
    o = original.groupBy(F.col(name).alias("_n")).agg(F.min_by(F.struct("sequence", "quality"), "n").alias("_o"))
    rest = aligned.drop("sequence", "quality", "md")
    return rest.join(o, rest[name] == o["_n"]).select(*rest.columns, "_o.sequence", "_o.quality")
