"""Identifiers: paths, unique ids, safe names, file and sample names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What stands for a missing value in the tab-separated files.
MISSING = "."


def dotted(value: Column) -> Column:
    """A value as text, null as the missing sign."""
    return F.coalesce(value.cast("string"), F.lit(MISSING))


def undotted(value: Column) -> Column:
    return F.when(value != MISSING, value)


def said(value: Column) -> Column:
    """What a column adds to a unique id: nothing if it is null or has dots and blanks only, and no root sign in front of a path."""
    text = F.trim(F.coalesce(value, F.lit("")))
    for sign in (".", ","):
        text = F.when(text.startswith(sign), F.substring(text, 2, 1 << 30)).otherwise(text)
    return F.when(F.trim(F.translate(text, MISSING, "")) == "", F.lit("")).otherwise(text)


def uid(mtype: Column, type_: Column, seqid: Column, ptype: Column, parent_ids: Column, id_: Column, ctype: Column, mode: Column) -> Column:
    """agg or feat, then the parts that are there, joined by single dashes; sequence and global rows go without their id."""
    m = F.lower(F.trim(mtype))
    prefix = F.when(m == "aggregate", "agg").when(m == "feature", "feat").otherwise("")
    own = F.when(~F.lower(F.trim(type_)).isin("global", "sequence"), id_)
    joined = F.concat_ws("-", prefix, *(said(c) for c in (type_, seqid, ptype, parent_ids, own, ctype, mode)))
    return F.regexp_replace(F.regexp_replace(joined, "-+", "-"), "^-|-$", "")


def row_type(id_: Column, seqid: Column) -> Column:
    """feature, sequence or global."""
    return F.when(id_.isNotNull() & ~id_.isin(MISSING, ""), "feature").when(seqid.isNotNull() & (seqid != MISSING), "sequence").otherwise("global")


def aggregate_id(seqid: Column, ptype: Column, ctype: Column, mode: Column) -> Column:
    """The id of a row without one: its type, the sequence if it has one, then parent type, child type and mode."""
    kind = F.when(seqid.isNotNull(), "sequence").otherwise("global")
    return F.concat_ws("_", kind, seqid, ptype, ctype, mode)


def safe_seqid(seqid: Column) -> Column:
    """A file name for a sequence."""
    v = F.regexp_replace(seqid, "[^A-Za-z0-9._-]", "_")
    return F.when(v == "", "EMPTY").otherwise(v)


def section_name(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(name, r"\.", "all"), "-", "_")


def safe_feature(name: Column) -> Column:
    return F.regexp_replace(name, "[:/]", "_")


def file_id(path: Column) -> Column:
    """The file's stem without its last part after an underscore."""
    stem = F.regexp_replace(F.regexp_replace(path, "^.*/", ""), r"\.[^.]*$", "")
    return F.regexp_replace(stem, "_[^_]*$", "")


def clean_prefix(path: Column) -> Column:
    """The file's name without the endings of read and alignment files."""
    return F.regexp_replace(F.regexp_replace(path, "^.*/", ""), r"(\.(fastq|fq|bam|cram|sam|gz|bz2))+$", "")


# What an address begins with.
URL = "^(https?|ftp|s3|gs|az)://"


def is_url(path: Column) -> Column:
    return path.rlike(URL)


def absolute(path: Column, base: str) -> Column:
    """A path from the folder base; addresses and paths from the root stay."""
    return F.when(is_url(path) | path.startswith("/") | path.rlike("^[a-z0-9]+:/"), path).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), path))


def run_uid(path: Column, paired: Column) -> Column:
    """The uid of a run: of two mates what their names share, else the file's name without endings."""
    return F.when(paired, file_id(path)).otherwise(clean_prefix(path))


def is_fastq(path: Column) -> Column:
    return path.rlike(r"(?i)\.(fastq|fq)(\.gz)?$")


def sample_part(column: Column, index: int) -> Column:
    """Part 0 to 3 (group, sample, replicate, value type) of a sample column's name of exactly four parts."""
    parts = F.split(column, "::")
    return F.when(F.size(parts) == 4, F.get(parts, F.lit(index)))


def natural_key(name: Column) -> list[Column]:
    """Sort keys that put chr2 before chr10."""
    digits = F.regexp_extract(name, r"(\d+)", 1)
    return [F.regexp_extract(name, r"^(\D*)", 1), F.when(digits != "", digits.cast("decimal(38,0)")), name]
