"""Roll-ups of feature counters by isoform policy, sequence and genome.

Counters stay long (see counters) and are aggregated once at the finest grain, (feature, genome base); each roll-up is a join
with the small feature tables and a sum. `by` names the columns that tell runs apart (samples); it may be empty.

Rows of a report have: by, seqid, parent_ids, id, mtype, ptype, type, ctype, mode, start, end, strand, total_sites and the wide
counters. Null stands for a missing value; sinks write it as a dot. start is 1-based, end inclusive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names
from . import counters, hierarchy
from .interval_join import sites_in_parts

META = ["seqid", "parent_ids", "id", "mtype", "ptype", "type", "ctype", "mode", "start", "end", "strand", "total_sites"]


def part_counts(sites: DataFrame, parts: DataFrame, by: list[str], cov: int = 1, edit: int = 1) -> DataFrame:
    """Long counters of each feature id in parts: by, seqid, feature_id, ref. A site counts once a feature."""
    where = parts.select("seqid", "feature_id", "start0", "end0", "strand").distinct()
    narrow = sites.select(*by, "seqid", "pos", "strand", "ref", "coverage", "fa", "fc", "fg", "ft")
    hits = sites_in_parts(narrow, where, ["feature_id"])
    return counters.summed(counters.qualify(hits, cov, edit), *by, "seqid", "feature_id")


def _n(text: str | None):
    return F.lit(text).cast("string")


def _report(rows: DataFrame, by: list[str], report_all: bool) -> DataFrame:
    data = [c for c in rows.columns if c.startswith(("obs_", "qual_", "site_", "read_"))]
    out = rows.select(*by, *META, *data)
    return out if report_all else out.where(counters.qualified_total() > 0)


def feature_rows(counts: DataFrame, tree: DataFrame, parts: DataFrame, by: list[str], report_all: bool = False, runs: DataFrame | None = None) -> DataFrame:
    """One row a feature; with report_all also those without counts (for each row of runs, if given)."""
    wide = counters.wide(counts, *by, "seqid", "feature_id")
    if report_all:
        base = tree.crossJoin(runs.select(*by).distinct()) if by and runs is not None else tree
        rows = counters.zeros(base.join(wide, [*by, "seqid", "feature_id"], "left"))
    else:
        rows = tree.join(wide, ["seqid", "feature_id"])
    rows = rows.select(
        *by, "seqid", hierarchy.parent_path().alias("parent_ids"), F.col("feature_id").alias("id"), _n("feature").alias("mtype"), _n(None).alias("ptype"), "type",
        _n(None).alias("ctype"), _n(None).alias("mode"), (F.col("start0") + 1).cast("bigint").alias("start"), F.col("end0").cast("bigint").alias("end"), F.col("strand").cast("int").alias("strand"),
        F.col("length").cast("bigint").alias("total_sites"), *[c for c in rows.columns if c.startswith(("obs_", "qual_", "site_", "read_"))],
    )
    return _report(rows, by, report_all)


def _under(tree: DataFrame, mode: str) -> DataFrame:
    """Members of a mode: seqid, feature_id, group_id with its id, parent_ids, ptype, strand, and the member's extent."""
    if mode == "feature":
        a = hierarchy.ancestors(tree).where("ancestor_level >= 2")
        top = tree.where("level >= 2").select(F.col("seqid").alias("_s"), F.col("feature_id").alias("_f"), hierarchy.parent_path().alias("parent_ids"), F.col("strand").alias("group_strand"), F.element_at("path", -1).alias("_p"))
        types = hierarchy.features(tree.select("seqid", "feature_id", "parent_id", "type", "start0", "end0", "strand", "file_order")).select(F.col("seqid").alias("_s2"), F.col("feature_id").alias("_f2"), F.col("type").alias("ptype")).distinct()
        top = top.join(types, (F.col("_s") == F.col("_s2")) & (F.col("_p") == F.col("_f2"))).drop("_s2", "_f2", "_p")
        m = a.join(top, (a["seqid"] == top["_s"]) & (a["ancestor_id"] == top["_f"]))
        return m.select("seqid", "feature_id", F.col("ancestor_id").alias("group_id"), F.col("ancestor_id").alias("id"), "parent_ids", "ptype", F.col("type").alias("ctype"), "group_strand", "start0", "end0")
    m = tree.where("level >= 3")
    if mode == "longest_isoform":
        best = hierarchy.longest_isoforms(tree).select("seqid", "root_id", "iso_id")
        m = m.join(best, ["seqid", "root_id", "iso_id"])
        name = F.col("iso_id")
    else:
        name = F.col("root_id")
    return m.select(
        "seqid", "feature_id", F.col("root_id").alias("group_id"), F.concat_ws("-", name, F.lit(mode)).alias("id"), F.concat_ws(",", F.lit("."), "root_id").alias("parent_ids"),
        F.col("root_type").alias("ptype"), F.col("type").alias("ctype"), F.col("root_strand").alias("group_strand"), "start0", "end0",
    )


def mode_counts(counts: DataFrame, tree: DataFrame, mode: str, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Long counters of a mode's groups (by, seqid, group_id, ctype, ref) and the groups with their extents."""
    m = _under(tree, mode)
    groups = m.groupBy("seqid", "group_id", "ctype").agg(
        F.first("id").alias("id"), F.first("parent_ids").alias("parent_ids"), F.first("ptype").alias("ptype"), F.first("group_strand").alias("strand"), F.min("start0").alias("start0"), F.max("end0").alias("end0"),
    )
    member = m.select("seqid", "feature_id", "group_id", "ctype")
    return counters.summed(counts.join(member, ["seqid", "feature_id"]), *by, "seqid", "group_id", "ctype"), groups


def _group_rows(long: DataFrame, groups: DataFrame, mode: str, by: list[str], total=None) -> DataFrame:
    wide = counters.wide(long, *by, "seqid", "group_id", "ctype")
    rows = wide.join(groups, ["seqid", "group_id", "ctype"])
    data = [c for c in wide.columns if c.startswith(("obs_", "qual_", "site_", "read_"))]
    return rows.select(
        *by, "seqid", "parent_ids", "id", _n("aggregate").alias("mtype"), "ptype", _n("feature").alias("type"), "ctype", _n(mode).alias("mode"),
        (F.col("start0") + 1).cast("bigint").alias("start"), F.col("end0").cast("bigint").alias("end"), F.col("strand").cast("int").alias("strand"),
        (F.col("total") if total else F.col("end0") - F.col("start0")).cast("bigint").alias("total_sites"), *data,
    )


def mode_rows(counts: DataFrame, tree: DataFrame, mode: str, by: list[str], report_all: bool = False) -> DataFrame:
    """Aggregate rows of feature, all_isoforms or longest_isoform."""
    long, groups = mode_counts(counts, tree, mode, by)
    return _report(_group_rows(long, groups, mode, by), by, report_all)


def chimaera_counts(sites: DataFrame, tree: DataFrame, parts: DataFrame, by: list[str], cov: int = 1, edit: int = 1) -> tuple[DataFrame, DataFrame]:
    """Long counters of the interval unions (by, seqid, group_id, ctype, ref) and the unions with their extents."""
    union = hierarchy.chimaera_parts(tree, parts)
    groups = union.groupBy("seqid", "feature_id").agg(
        F.first("type").alias("ctype"), F.first("parent_id").alias("root_id"), F.first("root_type").alias("ptype"), F.first("strand").alias("strand"),
        F.min("start0").alias("start0"), F.max("end0").alias("end0"), F.sum(F.col("end0") - F.col("start0")).alias("total"),
    )
    groups = groups.select("seqid", F.col("feature_id").alias("group_id"), "ctype", F.col("feature_id").alias("id"), F.concat_ws(",", F.lit("."), "root_id").alias("parent_ids"), "ptype", "strand", "start0", "end0", "total")
    long = part_counts(sites, union, by, cov, edit).withColumnRenamed("feature_id", "group_id")
    return long.join(groups.select("seqid", "group_id", "ctype"), ["seqid", "group_id"]), groups


def chimaera_rows(sites: DataFrame, tree: DataFrame, parts: DataFrame, by: list[str], cov: int = 1, edit: int = 1, report_all: bool = False) -> DataFrame:
    long, groups = chimaera_counts(sites, tree, parts, by, cov, edit)
    return _report(_group_rows(long, groups, "chimaera", by, total=True), by, report_all)


def tagged(modes: dict[str, tuple[DataFrame, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """Long counters and groups of several modes as one table each, with a column mode."""
    group = ["seqid", "group_id", "ctype", "ptype", "start0", "end0"]
    long = [x.withColumn("mode", F.lit(m)) for m, (x, _) in modes.items()]
    groups = [g.select(*group, F.lit(m).alias("mode")) for m, (_, g) in modes.items()]
    return reduce(DataFrame.unionByName, long), reduce(DataFrame.unionByName, groups)


def level_rows(long: DataFrame, groups: DataFrame, by: list[str], report_all: bool = False) -> DataFrame:
    """Rows of sequences and of the genome, by child type and by parent and child type, of all modes at once (see tagged()).

    Counters are aggregated at the finest grain once and the four levels are grouping sets of that. Extents, of all
    groups for isoform modes and of counted ones for unions, go by child type alone, as the total_sites of both kinds of row.
    """
    fine = long.join(groups.select("mode", "seqid", "group_id", "ctype", "ptype"), ["mode", "seqid", "group_id", "ctype"])
    sums = [F.sum(c).cast("bigint").alias(c) for c in counters.SUMS]
    fine = fine.groupBy(*by, "mode", "seqid", "ptype", "ctype", "ref").agg(*sums)
    names_ = [*by, "mode", "seqid", "ptype", "ctype", "ref"]
    fixed = [F.col(c) for c in (*by, "mode", "ctype", "ref")]
    sets = [[*fixed, F.col("seqid")], [*fixed, F.col("seqid"), F.col("ptype")], fixed, [*fixed, F.col("ptype")]]
    rolled = fine.groupingSets(sets, *names_).agg(F.grouping("seqid").alias("_gs"), F.grouping("ptype").alias("_gp"), *sums)
    wide = counters.wide(rolled, *by, "mode", "seqid", "ptype", "ctype", "_gs", "_gp").drop("_gs", "_gp")
    seen = long.where("mode = 'chimaera'").select(*by, "mode", "seqid", "group_id", "ctype").distinct().join(groups, ["mode", "seqid", "group_id", "ctype"])
    rows = wide
    for name, table, keys in (("all", groups.where("mode <> 'chimaera'"), ["mode"]), ("seen", seen, [*by, "mode"])):
        per = table.groupBy(*keys, "seqid", "ctype").agg(F.min("start0").alias("lo"), F.max("end0").alias("hi"))
        every = per.groupBy(*keys, "ctype").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).withColumn("seqid", F.lit(None).cast("string"))
        extent = per.unionByName(every).select(*(F.col(c).alias(f"_x_{c}") for c in [*keys, "seqid", "ctype"]), (F.col("hi") - F.col("lo")).alias(f"_{name}"))
        on = [rows["seqid"].eqNullSafe(extent["_x_seqid"]), rows["ctype"] == extent["_x_ctype"], *(rows[c] == extent[f"_x_{c}"] for c in keys)]
        rows = rows.join(extent, reduce(lambda a, b: a & b, on), "left").drop(*(c for c in extent.columns if c.startswith("_x_")))
    data = [c for c in wide.columns if c.startswith(("obs_", "qual_", "site_", "read_"))]
    rows = rows.select(
        *by, "seqid", _n(".").alias("parent_ids"), names.aggregate_id(F.col("seqid"), F.col("ptype"), F.col("ctype"), F.col("mode")).alias("id"), _n("aggregate").alias("mtype"), "ptype",
        F.when(F.col("seqid").isNull(), "global").otherwise("sequence").alias("type"), "ctype", "mode",
        F.lit(None).cast("bigint").alias("start"), F.lit(None).cast("bigint").alias("end"), F.lit(None).cast("int").alias("strand"), F.coalesce("_all", "_seen").cast("bigint").alias("total_sites"), *data,
    )
    return _report(rows, by, report_all)


def all_sites_rows(sites: DataFrame, seqids: DataFrame, by: list[str], cov: int = 1, edit: int = 1, report_all: bool = False) -> DataFrame:
    """Every site of the annotated sequences, whatever the features and strands: by sequence and over the genome."""
    known = sites.join(seqids.select("seqid").distinct(), "seqid", "left_semi")
    fine = counters.summed(counters.qualify(known, cov, edit), *by, "seqid")
    sums = [F.sum(c).cast("bigint").alias(c) for c in counters.SUMS]
    fixed = [F.col(c) for c in (*by, "ref")]
    rolled = fine.groupingSets([[*fixed, F.col("seqid")], fixed], *by, "seqid", "ref").agg(*sums)
    wide = counters.wide(rolled, *by, "seqid")
    data = [c for c in wide.columns if c.startswith(("obs_", "qual_", "site_", "read_"))]
    mode = "all_sites"
    rows = wide.select(
        *by, "seqid", _n(".").alias("parent_ids"), names.aggregate_id(F.col("seqid"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(mode)).alias("id"), _n("aggregate").alias("mtype"), _n(None).alias("ptype"),
        F.when(F.col("seqid").isNull(), "global").otherwise("sequence").alias("type"), _n(None).alias("ctype"), _n(mode).alias("mode"),
        F.lit(None).cast("bigint").alias("start"), F.lit(None).cast("bigint").alias("end"), F.lit(None).cast("int").alias("strand"), F.lit(None).cast("bigint").alias("total_sites"), *data,
    )
    return _report(rows, by, report_all)


def report(sites: DataFrame, parts: DataFrame, by: list[str], cov: int = 1, edit: int = 1, report_all: bool = False, runs: DataFrame | None = None, keep=None) -> tuple[DataFrame, DataFrame]:
    """All feature rows and all aggregate rows of a set of samples. keep(table, name), such as plans.store.kept, stores what is used several times."""
    keep = keep or (lambda df, name: df)
    tree = keep(hierarchy.paths(parts, keep), "tree")
    counts = keep(part_counts(sites, parts, by, cov, edit), "counts")
    out = [mode_rows(counts, tree, "feature", by, report_all), all_sites_rows(sites, parts, by, cov, edit, report_all)]
    modes = {}
    for mode in ("longest_isoform", "all_isoforms", "chimaera"):
        long, groups = chimaera_counts(sites, tree, parts, by, cov, edit) if mode == "chimaera" else mode_counts(counts, tree, mode, by)
        modes[mode] = keep(long, mode), keep(groups, mode)
        out.append(_report(_group_rows(*modes[mode], mode, by, total=mode == "chimaera"), by, report_all))
    out.append(level_rows(*tagged(modes), by, report_all))
    return feature_rows(counts, tree, parts, by, report_all, runs), reduce(DataFrame.unionByName, out)


def quick_totals(sites: DataFrame, by: list[str]) -> DataFrame:
    """Reads of G at genome A and of T at genome C, a sequence, without thresholds."""
    reads = lambda ref, f: F.coalesce(F.sum(F.when(F.col("ref") == ref, F.col(f))), F.lit(0)).cast("bigint")
    return sites.groupBy(*by, "seqid").agg(reads(0, "fg").alias("a_to_g"), reads(1, "ft").alias("c_to_t"))
