"""The forest of features: levels, paths, isoforms, and the union of intervals under a root.

Features come as parts (seqid, feature_id, parent_id, type, start0, end0, strand, file_order); a feature in several parts has
several rows. A feature of several parents has rows for each of them. Coordinates are half-open from 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

def features(parts: DataFrame) -> DataFrame:
    """One row a feature and parent: extent, summed length of parts, first place in the file."""
    return parts.groupBy("seqid", "feature_id", "parent_id").agg(
        F.min_by("type", "file_order").alias("type"), F.min("start0").alias("start0"), F.max("end0").alias("end0"),
        F.min_by("strand", "file_order").alias("strand"), F.sum(F.col("end0") - F.col("start0")).cast("bigint").alias("length"), F.min("file_order").alias("file_order"),
    )


def paths(parts: DataFrame, keep=None) -> DataFrame:
    """features with level (from 1), path (ids of the ancestors, root first), root_id, root_type, iso_id (the level-2 one, or null).

    Chains of any depth: three look-ups in a table of ids cover four levels, and while a small job finds chains that go on, known
    stretches are joined end to end, so each further step doubles them. A parent that is not there makes a feature a root; a
    feature that is its own ancestor raises. keep(table, name), such as plans.store.kept, stores the ids and the stretches.
    """
    up = parts.select(F.col("seqid").alias("_s"), F.col("feature_id").alias("_f")).distinct()
    link = parts.select("seqid", "feature_id", "parent_id").distinct()
    # own: the parent of a row; top: the next ancestor that is not in the path yet, null if there is none
    link = link.join(up, (link["seqid"] == up["_s"]) & (link["parent_id"] == up["_f"]), "left").select("seqid", "feature_id", F.col("parent_id").alias("own"), F.col("_f").alias("top"))
    link = keep(link, "links") if keep else link
    state = link.withColumn("path", F.array().cast("array<string>"))

    def longer(state: DataFrame, by: DataFrame) -> DataFrame:
        on = by.select(F.col("seqid").alias("_s"), F.col("feature_id").alias("_f"), F.col("path").alias("_p"), F.col("top").alias("_t"))
        out = state.join(on, (state["seqid"] == on["_s"]) & (state["top"] == on["_f"]), "left")
        return out.select("seqid", "feature_id", "own", F.when(F.col("_f").isNull(), F.col("path")).otherwise(F.concat("_p", F.array("_f"), "path")).alias("path"), F.col("_t").alias("top"))

    single = state
    for _ in range(3):
        state = longer(state, single)
    while True:
        left = state.where("top is not null").agg(F.count(F.lit(1)).alias("n"), F.max(F.array_contains("path", F.col("feature_id"))).alias("round")).first()
        if left["round"]:
            raise ValueError("a feature is its own ancestor")
        if not left["n"]:
            break
        state = keep(state, "stretches") if keep else state
        state = longer(state, state)
    f = features(parts)
    state = state.select(F.col("seqid").alias("_s"), F.col("feature_id").alias("_f"), F.col("own").alias("_o"), "path").distinct()
    out = f.join(state, (f["seqid"] == state["_s"]) & (f["feature_id"] == state["_f"]) & f["parent_id"].eqNullSafe(state["_o"])).drop("_s", "_f", "_o")
    out = out.withColumn("level", (F.size("path") + 1).cast("int"))
    out = out.withColumn("root_id", F.coalesce(F.get("path", F.lit(0)), F.col("feature_id")))
    out = out.withColumn("iso_id", F.when(F.col("level") == 2, F.col("feature_id")).otherwise(F.get("path", F.lit(1))))
    root = parts.groupBy(F.col("seqid").alias("_s"), F.col("feature_id").alias("_r")).agg(F.min_by("type", "file_order").alias("root_type"), F.min_by("strand", "file_order").alias("root_strand"))
    return out.join(root, (out["seqid"] == root["_s"]) & (out["root_id"] == root["_r"])).drop("_s", "_r")


def parent_ids(path: str = "path"):
    """The path as it is written: the root sign, then the ancestors."""
    return F.concat_ws(",", F.lit("."), F.array_join(path, ","))


def parent_path():
    return F.when(F.size("path") == 0, F.lit(".")).otherwise(parent_ids())


def ancestors(tree: DataFrame) -> DataFrame:
    """One row a feature and ancestor: ancestor_id, ancestor_level with the feature's columns."""
    return tree.select("*", F.posexplode("path").alias("_i", "ancestor_id")).withColumn("ancestor_level", F.col("_i") + 1).drop("_i")


def longest_isoforms(tree: DataFrame) -> DataFrame:
    """seqid, root_id, iso_id, kind (CDS or exon), length: the isoform that stands for each root.

    Isoforms with CDS come before those with exons only, then the longest, then the first in the file.
    """
    size = lambda t: F.coalesce(F.sum(F.when((F.col("level") == 3) & (F.col("type") == t), F.col("length"))), F.lit(0)).cast("bigint")
    each = tree.where("level in (2, 3)").groupBy("seqid", "root_id", "iso_id").agg(size("CDS").alias("cds"), size("exon").alias("exon"), F.min(F.when(F.col("level") == 2, F.col("file_order"))).alias("place"))
    kind = F.when(F.col("cds") > 0, "CDS").otherwise("exon")
    length = F.when(F.col("cds") > 0, F.col("cds")).otherwise(F.col("exon"))
    first = F.min(F.struct(kind.alias("kind"), (-length).alias("less"), "place", "iso_id")).alias("first")
    best = each.where("cds > 0 or exon > 0").groupBy("seqid", "root_id").agg(first)
    return best.select("seqid", "root_id", "first.iso_id", "first.kind", (-F.col("first.less")).alias("length"))


def chimaera_parts(tree: DataFrame, parts: DataFrame) -> DataFrame:
    """The union of the level-3 parts under each root, one row an interval: a feature of its own for each type.

    Touching intervals merge. Columns of parts, with parent_id the root.
    """
    third = tree.where("level = 3").select("seqid", "feature_id", "parent_id", "root_id", "root_type", "root_strand")
    own = parts.select("seqid", "feature_id", "parent_id", "type", "start0", "end0")
    rows = own.join(third, ["seqid", "feature_id", "parent_id"]).select("seqid", "root_id", "root_type", "root_strand", "type", "start0", "end0").distinct()
    by = W.partitionBy("seqid", "root_id", "type").orderBy("start0", "end0")
    before = F.max("end0").over(by.rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("_new", F.when(before.isNull() | (F.col("start0") > before), 1).otherwise(0))
    rows = rows.withColumn("_island", F.sum("_new").over(by))
    out = rows.groupBy("seqid", "root_id", "root_type", "root_strand", "type", "_island").agg(F.min("start0").alias("start0"), F.max("end0").alias("end0"))
    return out.select("seqid", F.concat_ws("-", "root_id", "type", F.lit("chimaera")).alias("feature_id"), F.col("root_id").alias("parent_id"), "root_type", "type", "start0", "end0", F.col("root_strand").alias("strand"))
