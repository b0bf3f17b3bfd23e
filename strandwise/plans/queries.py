"""One query an operator of the engine, over the fixture views; oracles holds the same in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bases, names, pvalues
from ..operators import channels, counters, hierarchy, interval_join, matrix, multivariate, rollup, sections, stats
from ..sources import gff3, sinks, site_tables, tables
from . import fixtures
from .store import kept, path_for

COV, EDIT = 10, 2
BY = ["sample_idx"]
Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Rounded as the SQL rounds: x times ten to the digits to a whole number, halves away from 0. F.round goes by the shortest decimal, where 0.0640625 is a tie; times 10^6 it is below one."""
    scale = 10.0**digits
    return df.withColumns({c: F.round(F.col(c) * scale) / scale + 0.0 for c in columns})


def tree(spark, d) -> DataFrame:
    """Stored, as every roll-up joins it several times."""
    return kept(hierarchy.paths(fixtures.features(spark, d).drop("level"), kept), "tree")


def counts(spark, d) -> DataFrame:
    """The long counters that all roll-ups share, stored after one pass over the sites."""
    return kept(rollup.part_counts(fixtures.sites(spark, d), fixtures.features(spark, d).drop("level"), BY, COV, EDIT), "counts")


def vectors(df: DataFrame) -> DataFrame:
    return counters.packed(df)


# -- sites and features --------------------------------------------------------------------------------------------------


def site_scan_normalised(spark, d):
    s = fixtures.sites(spark, d)
    return s.select("sample_idx", "seqid", (F.col("pos") + 1).cast("int").alias("position"), F.col("strand").cast("int").alias("strand"), F.element_at(F.array(*map(F.lit, "ACGTN")), F.col("ref") + 1).alias("base"), bases.vector(*(F.col(f) for f in bases.FREQS)).alias("freqs"), "coverage")


def site_qualified_long(spark, d):
    q = counters.qualify(fixtures.sites(spark, d), COV, EDIT)
    each = F.explode(F.array(*(F.struct(F.lit(b).alias("base"), F.col(f"reads_{b}").alias("reads"), F.col(f"sites_{b}").alias("sites")) for b in bases.BASES)))
    return q.select("sample_idx", "seqid", "pos", F.col("ref").cast("int").alias("ref"), "qualified", F.col("strand").cast("int").alias("strand"), each.alias("e")).select("sample_idx", "seqid", "pos", "strand", "ref", "qualified", "e.*").where("reads > 0")


def site_all_sites_by_seq_genome(spark, d):
    return vectors(rollup.all_sites_rows(fixtures.sites(spark, d), fixtures.features(spark, d), BY, COV, EDIT)).select("sample_idx", "seqid", "id", "type", *counters.VECTORS)


def quick_ag_ct_by_seq(spark, d):
    return rollup.quick_totals(fixtures.sites(spark, d), BY)


def feature_counts(spark, d):
    return vectors(rollup.feature_rows(counts(spark, d), tree(spark, d), fixtures.features(spark, d), BY)).select("sample_idx", "seqid", "parent_ids", "id", "type", "start", "end", "strand", "total_sites", *counters.VECTORS)


def feature_counts_report_all(spark, d):
    r = rollup.feature_rows(counts(spark, d), tree(spark, d), fixtures.features(spark, d), BY, report_all=True, runs=fixtures.samples(spark))
    return vectors(r).select("sample_idx", "seqid", "id", "total_sites", *counters.VECTORS)


def feature_counts_binned(spark, d):
    """Sites and coverage of every feature of every level, in every sample."""
    hits = interval_join.sites_in_parts(fixtures.sites(spark, d), fixtures.features(spark, d), ["feature_id"])
    return hits.groupBy("sample_idx", "seqid", "feature_id").agg(F.count(F.lit(1)).alias("sites"), F.sum("coverage").cast("bigint").alias("coverage"))


def feature_type_pushdown(spark, d):
    p = fixtures.features(spark, d).where(F.col("type").isin("gene", "mRNA", "CDS")).drop("level")
    return hierarchy.paths(p).groupBy("type", "level").agg(F.count(F.lit(1)).alias("n"), F.sum("length").cast("bigint").alias("length"))


def feature_hierarchy_paths(spark, d):
    t = tree(spark, d)
    return t.select("seqid", "feature_id", "level", hierarchy.parent_path().alias("parent_ids"), "root_id", "root_type", "iso_id")


def feature_hierarchy_deep(spark, d):
    """Chains of seven features: no depth is left out."""
    t = hierarchy.paths(fixtures.deep(spark, d), kept)
    return t.select("seqid", "feature_id", "level", hierarchy.parent_path().alias("parent_ids"), "root_id", "root_type", "iso_id")


def feature_ancestors(spark, d):
    return hierarchy.ancestors(tree(spark, d)).select("seqid", "feature_id", "ancestor_id", "ancestor_level")


def longest_isoform_choice(spark, d):
    return hierarchy.longest_isoforms(hierarchy.paths(fixtures.features(spark, d).drop("level"), kept))


def chimaera_intervals(spark, d):
    p = fixtures.features(spark, d).drop("level")
    return hierarchy.chimaera_parts(hierarchy.paths(p), p).select("seqid", "feature_id", "type", "start0", "end0", F.col("strand").cast("int").alias("strand"))


# -- files: written from the fixture views, and read again --------------------------------------------------------------------


def _lines(df: DataFrame, name: str, head: str | None = None) -> str:
    """A folder of text files of one string column, each file with the header line."""
    path = path_for(df.sparkSession, name)
    if head is None or head.startswith("#"):
        (df if head is None else df.union(df.sparkSession.createDataFrame([(head,)], "value string"))).write.text(path)
    else:
        df.toDF(head).write.option("sep", "\x01").option("header", True).option("quote", "").csv(path)
    return path


def _site_lines(spark, d, strands: dict[int, str], bed: bool = False):
    s = fixtures.sites(spark, d)
    strand = F.element_at(F.create_map(*(F.lit(x) for kv in strands.items() for x in kv)), F.col("strand").cast("int"))
    base = F.element_at(F.array(*map(F.lit, "ACGTN")), F.col("ref") + 1)
    list_ = F.concat_ws("," if bed else ", ", *(F.col(f).cast("string") for f in bases.FREQS))
    name = F.concat_ws("_", "seqid", F.col("sample_idx").cast("string"))  # a run is told by its sequence's name
    if bed:
        return s.select(F.concat_ws("\t", name, "pos", F.col("pos") + 1, F.lit("variant"), F.lit("1.5"), strand, list_, F.lit("*"), F.lit("*"), base))
    blank = [F.lit("-")] * 7
    return s.select(F.concat_ws("\t", name, F.col("pos") + 1, base, strand, "coverage", F.lit("30.5"), F.concat(F.lit("["), list_, F.lit("]")), *blank))


def _site_scan(format: str) -> Query:
    strands = {"reditools2": {1: "2", -1: "1", 0: "0"}, "reditools3": {1: "+", -1: "-", 0: "*"}, "jacusa2": {1: "+", -1: "-", 0: "."}}[format]
    head = "\t".join({"reditools2": site_tables.REDITOOLS2, "reditools3": site_tables.REDITOOLS3, "jacusa2": site_tables.JACUSA2}[format])

    def query(spark, d):
        path = _lines(_site_lines(spark, d, strands, format == "jacusa2"), format, head)
        r = site_tables.read_sites(spark, path, format)
        return r.select("seqid", "pos", F.col("strand").cast("int").alias("strand"), F.col("ref").cast("int").alias("ref"), F.col("coverage").cast("bigint").alias("coverage"), *(F.col(f).cast("bigint").alias(f) for f in bases.FREQS), "mean_q", "score")

    return query


def gff3_scan(spark, d):
    f = fixtures.features(spark, d)
    strand = F.when(F.col("strand") > 0, "+").when(F.col("strand") < 0, "-").otherwise(".")
    given = F.concat_ws(";", F.concat(F.lit("ID="), "feature_id"), F.concat(F.lit("Parent="), "parent_id"))
    path = _lines(f.select(F.concat_ws("\t", "seqid", F.lit("x"), "type", F.col("start0") + 1, "end0", F.lit("."), strand, F.lit("."), given)), "gff3")
    return gff3.cached_by_sequence(gff3.read_gff3(spark, path), path_for(spark, "gff3-cache")).drop("file_order")


def report_round_trip(spark, d):
    """feature_counts by way of the report file."""
    rows = rollup.feature_rows(counts(spark, d), tree(spark, d), fixtures.features(spark, d), BY)
    path = path_for(spark, "report")
    sinks.write_report(rows.withColumn("id", F.concat_ws("@", "id", F.col("sample_idx").cast("string"))).drop("sample_idx"), path)
    r = tables.read_report(spark, path)
    part = F.split("id", "@")
    r = r.withColumn("sample_idx", part[1].cast("int")).withColumn("id", part[0])
    return vectors(r).select("sample_idx", "seqid", "parent_ids", "id", "type", "start", "end", "strand", "total_sites", *counters.VECTORS)


def matrix_round_trip(spark, d):
    """matrix_wide_ag by way of the matrix file, long again."""
    m = long_matrix(spark, d, decimals=None).where("metric = 'espf' and pairing = 'AG'")
    m = matrix.kept(m, matrix.prevalent(m, fixtures.samples(spark), KEY), KEY)
    path = path_for(spark, "matrix")
    sinks.write_matrix(m, COLUMNS, path, KEY)
    long, _ = tables.read_matrix(spark, f"{path}/metric=espf/pairing=AG")
    return rounded(long.select("seqid", "id", "type", "grp", "sample", "rep", "value"), "value", digits=9)


def sheet_check(spark, d):
    t = tables.checked_sheet(fixtures.sheet(spark, d).drop("n"), base="/work")
    return t.select(F.col("group").alias("grp"), "input_1", "read_type", "paired", "uid", "sample", "replicate", "problem")


def channel_joins(spark, d):
    """Runs of the sheet with an alignment, with the library type found for them, and the other alignments."""
    n = spark.read.parquet(f"{d}/supplier.parquet").select(F.col("s_suppkey").alias("n"), F.concat(F.lit("r"), F.col("s_suppkey").cast("string")).alias("uid"))
    runs = channels.with_sheet(n.where("n % 2 = 0").select("uid", F.concat("uid", F.lit(".bam")).alias("path")), n.where("n % 3 = 0").select("uid", F.lit("ISR").alias("strandedness")))
    runs = channels.with_library(runs, n.where("n % 4 = 0").select("uid", F.lit("U").alias("library")))
    return channels.mixed(runs, n.where("n % 5 = 0").select("uid", F.concat("uid", F.lit(".own.bam")).alias("path"))).select("uid", "path", "strandedness")


def hyper_editing_merge(spark, d):
    n = spark.read.parquet(f"{d}/orders.parquet").select(F.concat(F.lit("r"), (F.col("o_orderkey") % 40).cast("string")).alias("uid"), F.col("o_orderkey").alias("read"), (F.col("o_orderkey") % 40).alias("k"))
    both = channels.with_hyper_edited(n.where("k % 2 = 0 and read % 3 = 0").drop("k"), n.where("k % 5 < 3 and read % 3 = 1").drop("k"))
    return both.groupBy("uid", "again").agg(F.count(F.lit(1)).alias("reads"), F.sum("read").cast("bigint").alias("sum"))


def value_selectors(spark, d):
    f = sections.chosen(fixtures.features(spark, d), "type", ["gene", "mRNA", "exon"])
    return f.groupBy("seqid", "type").agg(F.count(F.lit(1)).alias("n"))


def heatmap_labels(spark, d):
    r = fixtures.features(spark, d).where("level >= 2")
    null = F.lit(None).cast("string")
    r = r.select(
        F.when(F.col("level") == 2, "one").otherwise("many").alias("section"), F.col("feature_id").alias("uid"), F.when(F.col("level") == 3, F.col("seqid")).otherwise("c").alias("seqid"),
        F.when((F.col("level") == 3) & (F.col("file_order") % 3 > 0), F.col("type")).alias("ptype"), F.when(F.col("file_order") % 2 == 0, F.col("type")).otherwise(null).alias("ctype"),
        F.when(F.col("level") == 2, "chimaera").when(F.col("file_order") % 5 == 0, "all_sites").otherwise("chimaera").alias("mode"),
    )
    return sections.labels(r).select("section", "uid", "label", "priority")


REPORT = ["sample_idx", "seqid", "parent_ids", "id", "ptype", "type", "ctype", "mode", "start", "end", "strand", "total_sites", *counters.VECTORS]


def chimaera_counts(spark, d):
    return vectors(rollup.chimaera_rows(fixtures.sites(spark, d), tree(spark, d), fixtures.features(spark, d).drop("level"), BY, COV, EDIT)).select(*REPORT)


def _mode(mode: str) -> Query:
    def query(spark, d):
        return vectors(rollup.mode_rows(counts(spark, d), tree(spark, d), mode, BY)).select(*REPORT)

    return query


def _levels(spark, d) -> DataFrame:
    c, t, p = counts(spark, d), tree(spark, d), fixtures.features(spark, d).drop("level")
    modes = {m: rollup.mode_counts(c, t, m, BY) for m in ("all_isoforms", "longest_isoform")} | {"chimaera": rollup.chimaera_counts(fixtures.sites(spark, d), t, p, BY, COV, EDIT)}
    long, groups = rollup.tagged(modes)
    return rollup.level_rows(kept(long, "long"), kept(groups, "groups"), BY)


LEVEL = ["sample_idx", "seqid", "id", "ptype", "ctype", "mode", "total_sites", *counters.VECTORS]


def rollup_sequence(spark, d):
    return vectors(_levels(spark, d).where("seqid is not null")).select(*LEVEL)


def rollup_genome(spark, d):
    return vectors(_levels(spark, d).where("seqid is null")).select(*[c for c in LEVEL if c != "seqid"])


def aggregate_ids(spark, d):
    t = tree(spark, d).where("level >= 3").select("seqid", F.col("root_type").alias("ptype"), F.col("type").alias("ctype")).distinct()
    modes = F.explode(F.array(*map(F.lit, sections.MODES)))
    t = t.select("*", modes.alias("mode"))
    null = F.lit(None).cast("string")
    return t.select("seqid", "ptype", "ctype", "mode", names.aggregate_id(F.col("seqid"), F.col("ptype"), F.col("ctype"), F.col("mode")).alias("sequence_id"), names.aggregate_id(null, null, F.col("ctype"), F.col("mode")).alias("global_id"), names.row_type(F.lit("."), F.col("seqid")).alias("type"))


# -- matrix --------------------------------------------------------------------------------------------------------------

KEY = ["seqid", "id", "type"]
SAMPLE = ["sample_idx", "grp", "sample", "rep"]


def long_matrix(spark, d, **how) -> DataFrame:
    rows = rollup.feature_rows(counts(spark, d), tree(spark, d), fixtures.features(spark, d), BY)
    rows = rows.join(F.broadcast(fixtures.samples(spark)), BY)  # a dozen rows by construction
    return matrix.ratios(rows, SAMPLE, KEY, **how)


def _cells(metric: str) -> Query:
    """Every cell of the matrix rows that stay: 0 is covered and not edited, null not observed (null counts: no row of the sample)."""

    def query(spark, d):
        s = fixtures.samples(spark)
        m = kept(long_matrix(spark, d, decimals=None).where(F.col("metric") == metric), "cells")
        grid = matrix.prevalent(m, s, KEY).crossJoin(F.broadcast(s.select("sample_idx")))  # a dozen samples by construction
        m = m.select(*(F.col(c).alias(f"_{c}") for c in ("sample_idx", *KEY, "pairing")), "num", "den", "value")
        on = grid["sample_idx"] == m["_sample_idx"]
        for c in (*KEY, "pairing"):
            on = on & grid[c].eqNullSafe(m[f"_{c}"])
        return grid.join(m, on, "left").select("sample_idx", "seqid", "id", "pairing", "num", "den", "value")

    return query


def matrix_legacy_index(spark, d):
    m = long_matrix(spark, d, legacy_pair_index=True).where("metric = 'espr'")
    return m.groupBy("pairing").agg(F.sum("num").cast("bigint").alias("num"), F.sum("den").cast("bigint").alias("den"))


COLUMNS = [f"{('ctrl', 'low', 'high')[i % 3]}::s{i % 2 + 1}::rep{1 if i < 6 else 2}::espf" for i in range(12)]


def matrix_wide_ag(spark, d):
    m = long_matrix(spark, d, decimals=None).where("metric = 'espf' and pairing = 'AG'")
    m = matrix.kept(m, matrix.prevalent(m, fixtures.samples(spark), KEY), KEY)
    return matrix.wide(m, KEY, COLUMNS)


def _prevalence(samples_pct, group_pct) -> Query:
    def query(spark, d):
        m = long_matrix(spark, d, decimals=None)
        return matrix.prevalent(m, fixtures.samples(spark), KEY, samples_pct, group_pct)

    return query


# -- names ---------------------------------------------------------------------------------------------------------------


def uid_build(spark, d):
    t = tree(spark, d)
    agg = t.where("level = 1").select("seqid", F.lit(".").alias("parent_ids"), F.col("feature_id").alias("id"), F.lit("aggregate").alias("mtype"), F.lit(".").alias("ptype"), F.when(F.col("strand") == 0, "sequence").otherwise("feature").alias("type"), F.lit("exon").alias("ctype"), F.lit("chimaera").alias("mode"))
    feat = t.select("seqid", hierarchy.parent_path().alias("parent_ids"), F.col("feature_id").alias("id"), F.lit("feature").alias("mtype"), F.lit(".").alias("ptype"), "type", F.lit(".").alias("ctype"), F.lit(".").alias("mode"))
    c = F.col
    return agg.union(feat).select(names.uid(c("mtype"), c("type"), c("seqid"), c("ptype"), c("parent_ids"), c("id"), c("ctype"), c("mode")).alias("uid"))


def safe_names(spark, d):
    p = spark.read.parquet(f"{d}/pages.parquet").select("page_id", "url")
    c = F.col("url")
    return p.select("page_id", names.safe_seqid(c).alias("safe"), names.section_name(c).alias("section"), names.safe_feature(c).alias("feature"), names.file_id(c).alias("file_id"), names.is_url(c).alias("is_url"))


def sample_column_parse(spark, d):
    s = fixtures.samples(spark).withColumn("col", F.concat_ws("::", "grp", "sample", "rep", F.lit("espr")))
    s = s.select("sample_idx", "col").union(s.select("sample_idx", F.concat_ws("::", "col", F.lit("x"))))
    return s.select("sample_idx", "col", *(names.sample_part(F.col("col"), i).alias(n) for i, n in enumerate(("grp", "sample", "rep", "value_type"))))


def sample_duplicates(spark, d):
    s = fixtures.samples(spark).withColumn("rep", F.lit("rep1"))
    return matrix.deduplicated_samples(s, "sample_idx").select("sample_idx", "grp", "sample", "rep")


def file_uid(spark, d):
    p = spark.read.parquet(f"{d}/part.parquet")
    path = F.concat(F.lit("/data/"), F.regexp_replace("p_name", " ", "_"), F.when(F.col("p_partkey") % 2 == 0, "_R1.fastq.gz").otherwise(".bam"))
    return p.select("p_partkey", names.clean_prefix(path).alias("prefix"), names.file_id(path).alias("file_id"), names.is_fastq(path).alias("is_fastq"))


def atog_transform(spark, d):
    return spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", bases.a_to_g(F.col("c_name")).alias("sequence"))


# -- statistics ----------------------------------------------------------------------------------------------------------

SEC, UID = ["section"], "uid"
B = [*SEC, UID]


def values(spark, d) -> DataFrame:
    """Every level, pairing and metric as section, uid, grp, sample, rep, value; a row for each sample, null where it has none. A section is one type of one matrix, as AG_espr_exon."""
    f = fixtures.features(spark, d).select("type", F.col("feature_id").alias("uid"))
    grid = f.crossJoin(F.broadcast(fixtures.samples(spark)))  # a dozen samples by construction
    rows = rollup.feature_rows(counts(spark, d), tree(spark, d), fixtures.features(spark, d), BY)
    rows = rows.select(F.col("id").alias("uid"), *BY, *(c for c in rows.columns if c.startswith(("qual_", "site_", "read_"))))
    m = matrix.ratios(grid.join(rows, ["uid", *BY], "left"), SAMPLE, ["type", "uid"], decimals=None)  # counters meet samples before a row becomes one for each matrix
    return kept(m.select(F.concat_ws("_", "pairing", "metric", "type").alias("section"), "uid", "grp", "sample", "rep", "value"), "values")


def qc_missing(spark, d, v=values):
    return stats.missing(v(spark, d), ["section", "grp", "sample", "rep"])


def qc_describe(spark, d, v=values):
    """A mean that is a tie at the sixth place must not fall by the order of its sum, so thirteen places are rounded first."""
    s = rounded(stats.describe(v(spark, d), ["section", "grp", "sample", "rep"]), "mean", digits=13)
    return rounded(s, "mean", "std", "min", "q25", "q50", "q75", "max")


def group_statistics(spark, d, v=values):
    return rounded(stats.group_statistics(v(spark, d), ["section", "grp"]), "mean", "median", "std", "min", "max", "q25", "q75")


def bmk_mean_by_group(spark, d, v=values):
    return rounded(stats.group_means(v(spark, d), B), "mean")


def variance_filter_topk(spark, d, v=values):
    return rounded(stats.top_variance(v(spark, d), SEC, UID, 50).where("variance > 1e-10").select("section", "uid", "variance"), "variance", digits=9)


def coefficient_variation(spark, d, v=values):
    return rounded(stats.coefficient_of_variation(v(spark, d), B), "cv")


def varied(spark, d, v=values) -> DataFrame:
    return kept(sections.filtered(v(spark, d), SEC, UID), "varied")


def kruskal_h(spark, d, v=values):
    return rounded(stats.kruskal(varied(spark, d, v), B), "h")


def anova_f(spark, d, v=values):
    return rounded(stats.anova(varied(spark, d, v), B), "f")


def bartlett_stat(spark, d, v=values):
    return rounded(stats.bartlett(varied(spark, d, v), B), "bartlett")


def student_t(spark, d, v=values):
    return rounded(stats.student(stats.pairs(varied(spark, d, v), B), B), "t")


def welch_t(spark, d, v=values):
    return rounded(stats.welch(stats.pairs(varied(spark, d, v), B), B), "t", "df", digits=5)


def mannwhitney_u(spark, d, v=values):
    return rounded(stats.mann_whitney(varied(spark, d, v), B), "effect_size")


def effect_size_log2fc(spark, d, v=values):
    return rounded(stats.fold_changes(stats.pairs(varied(spark, d, v), B), B), "diff", "log2fc")


def group_pairs(spark, d, v=values):
    p = stats.pairs(v(spark, d), B)
    return p.groupBy("section", "grp1", "grp2").agg(F.count(F.lit(1)).alias("uids"), F.sum(F.col("n1") + F.col("n2")).cast("bigint").alias("values"))


def pvalues_kruskal(spark, d, v=values):
    k = stats.kruskal(varied(spark, d, v), B).where("df = 2 and h is not null")
    return rounded(k.select("section", "uid", pvalues.chi2_p("h", F.col("df").cast("double")).alias("pval")), "pval")


def pvalues_anova(spark, d, v=values):
    a = stats.anova(varied(spark, d, v), B)
    return rounded(a.select("section", "uid", pvalues.f_p("f", F.col("df1").cast("double"), F.col("df2").cast("double")).alias("pval")), "pval")


def pvalues_student(spark, d, v=values):
    s = stats.student(stats.pairs(varied(spark, d, v), B), B)
    return rounded(s.select("section", "uid", "grp1", "grp2", pvalues.t_p("t", "df").alias("pval")), "pval")


def pvalues_global(spark, d, v=values):
    return stats.global_tests(varied(spark, d, v), B, SEC)


def pvalues_pairwise(spark, d, v=values):
    return stats.pairwise_tests(varied(spark, d, v), B, SEC)


def tests_auto(spark, d, v=values):
    return stats.global_tests(varied(spark, d, v), B, SEC, "auto")


def assumption_tests(spark, d, v=values):
    return stats.assumptions(varied(spark, d, v), B)


def bh_fdr(spark, d):
    return rounded(stats.benjamini_hochberg(fixtures.tests(spark, d), ["section", "test"]).select("section", "uid", "test", "comparison", "pval", F.col("padj")), "padj", digits=9)


def significant_any(spark, d):
    return stats.significant(fixtures.tests(spark, d), ["section", "uid"])


def global_ranking(spark, d):
    return stats.global_ranking(fixtures.tests(spark, d)).select("section", "uid", "comparison", "padj", "n_sections_total", "n_sections_significant")


def sig_unique_common(spark, d):
    return stats.unique_and_common(fixtures.tests(spark, d), ["section", "uid"], "comparison")


def sig_common_pairs(spark, d):
    return stats.common_pairs(fixtures.tests(spark, d), ["section", "uid"], "comparison")


def test_ranking(spark, d):
    return stats.ranking(fixtures.tests(spark, d), ["section"], "anova", ("uid", "comparison")).select("section", "uid", "comparison", "padj", "rank")


def edit_type_join(spark, d):
    """Long matrix rows of features and of aggregates, of the edit types that both have."""
    m = long_matrix(spark, d, decimals=None).where("metric = 'espr' and num > 0").select("pairing", "id", "sample_idx")
    a, f = m.where("id like '%t%' and pairing < 'CT'"), m.where("id not like '%t%' and pairing > 'AC'")
    return channels.by_edit_type(a, f).groupBy("pairing").agg(F.count(F.lit(1)).alias("n"))


def sig_levels(spark, d):
    t = fixtures.tests(spark, d)
    return rounded(t.select("section", "uid", "test", "comparison", stats.significance_level(F.col("padj")).alias("level"), bases.score10(F.col("padj")).alias("score")), "score")


def replicate_pearson(spark, d, v=values):
    return rounded(stats.replicate_pearson(v(spark, d), SEC, UID).drop("pval"), "pearson_r")


def sample_correlation(spark, d, v=values):
    return rounded(stats.sample_correlation(v(spark, d), SEC, UID), "r")


def bmk_correlation_top50(spark, d, v=values):
    return rounded(stats.biomarker_correlation(v(spark, d), SEC, UID, 50).where("n >= 6 and r is not null"), "r")


def section_membership(spark, d):
    r = rollup.feature_rows(counts(spark, d), tree(spark, d), fixtures.features(spark, d), BY).select("seqid", "parent_ids", "id", "mtype", "ptype", "type", "ctype", "mode").distinct()
    return sections.memberships(r, ["id"]).groupBy("section").agg(F.count(F.lit(1)).alias("rows"))


def pca_variance(spark, d, v=values):
    return multivariate.explained_by_section(v(spark, d))


def primary(rows: DataFrame) -> DataFrame:
    """Adjusted p-values of rows' biomarkers over all groups, by which learning selects."""
    return kept(stats.primary_tests(kept(sections.filtered(rows, SEC, UID), "varied"), B, SEC), "primary")


def rf_importance(spark, d, v=values):
    rows = v(spark, d)
    return multivariate.importance_by_section(rows, primary(rows), keep=kept)


def cv_accuracy(spark, d, v=values):
    rows = v(spark, d)
    return multivariate.cross_validated_by_section(rows, primary(rows))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        site_scan_normalised, site_qualified_long, site_all_sites_by_seq_genome, quick_ag_ct_by_seq, feature_counts, feature_counts_report_all, feature_counts_binned,
        feature_type_pushdown, feature_hierarchy_paths, feature_hierarchy_deep, feature_ancestors, longest_isoform_choice, chimaera_intervals, chimaera_counts, rollup_sequence, rollup_genome,
        aggregate_ids, matrix_legacy_index, matrix_wide_ag, uid_build, safe_names, sample_column_parse, sample_duplicates, file_uid, atog_transform, qc_missing, qc_describe, group_statistics,
        bmk_mean_by_group, variance_filter_topk, coefficient_variation, kruskal_h, anova_f, bartlett_stat, student_t, welch_t, mannwhitney_u, effect_size_log2fc, group_pairs,
        pvalues_kruskal, pvalues_anova, pvalues_student, pvalues_global, pvalues_pairwise, tests_auto, assumption_tests, bh_fdr, significant_any, global_ranking, sig_unique_common, sig_levels, replicate_pearson,
        sample_correlation, bmk_correlation_top50, section_membership, pca_variance, rf_importance, cv_accuracy,
        gff3_scan, report_round_trip, matrix_round_trip, sheet_check, channel_joins, hyper_editing_merge, value_selectors, heatmap_labels, sig_common_pairs, test_ranking, edit_type_join,
    )
} | {
    "reditools2_scan": _site_scan("reditools2"), "reditools3_scan": _site_scan("reditools3"), "jacusa2_scan": _site_scan("jacusa2"),
    "rollup_feature_mode": _mode("feature"), "rollup_all_isoforms": _mode("all_isoforms"), "rollup_longest_isoform": _mode("longest_isoform"),
    "matrix_espf": _cells("espf"), "matrix_espr": _cells("espr"), "prevalence_any": _prevalence(None, None), "prevalence_samples_pct": _prevalence(50, None),
    "prevalence_group_pct": _prevalence(90, 75),
}
