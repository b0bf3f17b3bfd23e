"""Worked cases, edge cases of a hand-made genome, invariants, and readers and writers on small files."""

import math

import pytest
from pyspark.sql import functions as F

from strandwise.functions import bases, names, pvalues
from strandwise.plans.store import kept
from strandwise.operators import counters, hierarchy, interval_join, matrix, rollup, sections, stats
from strandwise.sources import gff3, site_tables, sinks, tables

SITE = "seqid string, pos int, strand int, ref int, coverage int, fa int, fc int, fg int, ft int"
PART = "seqid string, feature_id string, parent_id string, type string, start0 int, end0 int, strand int, file_order long"


def sites(spark, rows):
    return spark.createDataFrame(rows, SITE)


def parts(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], PART)


def wide(spark, rows, cov, edit):
    return counters.wide(counters.qualify(sites(spark, rows), cov, edit), "seqid").first()


def test_thresholds(spark):
    # of four sites one is not covered enough, and of the rare reads those of G at 7 stay under the edit threshold
    r = wide(spark, [("k", 3, -1, 2, 40, 7, 1, 32, 0), ("k", 7, -1, 1, 21, 0, 17, 2, 2), ("k", 8, -1, 1, 8, 0, 8, 0, 0), ("k", 9, -1, 0, 33, 30, 0, 3, 0)], 20, 3)
    assert (r.obs_A, r.obs_C, r.obs_G, r.obs_T, r.obs_N) == (1, 2, 1, 0, 0)
    assert (r.qual_A, r.qual_C, r.qual_G) == (1, 1, 1)
    assert (r.site_GA, r.site_GC, r.site_GG, r.site_CG, r.site_CT, r.site_CC, r.site_AG) == (1, 0, 1, 0, 0, 1, 1)
    assert (r.read_GA, r.read_GC, r.read_GG, r.read_CC, r.read_AA, r.read_AG) == (7, 0, 32, 17, 30, 3)


def test_threshold_spares_the_genome_base(spark):
    r = wide(spark, [("c", 0, 1, 0, 6, 1, 0, 5, 0)], 5, 2)
    assert (r.read_AA, r.read_AG, r.site_AA, r.site_AG) == (1, 5, 1, 1)


def test_fully_edited_site_and_unknown_base(spark):
    r = wide(spark, [("c", 0, 1, 0, 6, 0, 0, 6, 0), ("c", 1, 1, 4, 6, 0, 0, 6, 0)], 5, 1)
    assert (r.site_AA, r.site_AG, r.obs_N, r.qual_N) == (0, 1, 1, 1)


GENOME = [
    ("c", "g1", None, "gene", 0, 100, 1),
    ("c", "t1", "g1", "mRNA", 0, 100, 1),
    ("c", "t2", "g1", "mRNA", 10, 90, 1),
    ("c", "e1", "t1", "exon", 0, 20, 1),
    ("c", "e2", "t1", "exon", 20, 40, 1),
    ("c", "e2", "t2", "exon", 20, 40, 1),
    ("c", "e3", "t2", "exon", 50, 51, 1),
    ("c", "c1", "t2", "CDS", 25, 30, 1),
    ("c", "g2", None, "gene", 200, 210, 0),
]


def test_hierarchy_and_longest(spark):
    p = parts(spark, GENOME)
    t = hierarchy.paths(p)
    got = {(r.feature_id, tuple(r.path)): (r.level, r.root_id, r.iso_id) for r in t.collect()}
    assert got[("e2", ("g1", "t1"))] == (3, "g1", "t1") and got[("e2", ("g1", "t2"))] == (3, "g1", "t2")
    assert got[("g2", ())] == (1, "g2", None)
    best = hierarchy.longest_isoforms(t).collect()
    assert [(r.root_id, r.iso_id, r.kind, r.length) for r in best] == [("g1", "t2", "CDS", 5)]  # CDS first, though its exons are shorter


def test_any_depth_and_no_rounds(spark):
    chain = [("c", f"f{i}", f"f{i - 1}" if i > 1 else None, "x", i, i + 1, 1) for i in range(1, 24)]
    t = {r.feature_id: r for r in hierarchy.paths(parts(spark, chain), kept).collect()}
    assert all(t[f"f{i}"].level == i and t[f"f{i}"].root_id == "f1" and list(t[f"f{i}"].path) == [f"f{j}" for j in range(1, i)] for i in range(1, 24))
    with pytest.raises(ValueError, match="own ancestor"):
        hierarchy.paths(parts(spark, [("c", "a", "b", "x", 0, 1, 1), ("c", "b", "a", "x", 0, 1, 1)]))


def test_longest_tie_goes_to_the_first(spark):
    p = parts(spark, [("c", "g", None, "gene", 0, 9, 1), ("c", "b", "g", "mRNA", 0, 9, 1), ("c", "a", "g", "mRNA", 0, 9, 1), ("c", "x", "b", "exon", 0, 5, 1), ("c", "y", "a", "exon", 4, 9, 1)])
    assert hierarchy.longest_isoforms(hierarchy.paths(p)).first().iso_id == "b"


def test_chimaera_merges_touching_parts(spark):
    p = parts(spark, GENOME)
    got = sorted((r.feature_id, r.start0, r.end0) for r in hierarchy.chimaera_parts(hierarchy.paths(p), p).collect())
    assert got == [("g1-CDS-chimaera", 25, 30), ("g1-exon-chimaera", 0, 40), ("g1-exon-chimaera", 50, 51)]


def test_interval_bounds_and_strands(spark):
    s = sites(spark, [("c", x, st, 0, 9, 9, 0, 0, 0) for x, st in ((0, 1), (39, 1), (40, 1), (50, 1), (51, 1), (25, -1), (26, 0), (205, -1), (206, 0))] + [("z", 5, 1, 0, 9, 9, 0, 0, 0)])
    p = parts(spark, GENOME)
    for bin_size in (7, 4096):
        hits = interval_join.sites_in_parts(s, p.where("feature_id in ('e1', 'e3', 'g2') or parent_id = 't1'"), ["feature_id"], bin_size)
        got = sorted((r.feature_id, r.pos) for r in hits.collect())
        assert got == [("e1", 0), ("e2", 39), ("e3", 50), ("g2", 205), ("g2", 206)]


def test_report(spark):
    s = sites(spark, [("c", x, 1, 0, 9, 9, 0, 0, 0) for x in (5, 22, 27, 50)] + [("c", 60, 0, 0, 9, 9, 0, 0, 0), ("z", 5, 1, 0, 9, 9, 0, 0, 0)])
    feats, aggs = rollup.report(s, parts(spark, GENOME), [], 1, 1, keep=kept)
    n = {(r.id, r.parent_ids): r.obs_A for r in feats.collect()}
    assert n[("g1", ".")] == 4 and n[("e2", ".,g1,t1")] == 2 and n[("e2", ".,g1,t2")] == 2 and ("g2", ".") not in n
    a = {(r.id, r.ctype): r for r in aggs.collect()}
    assert a[("g1-all_isoforms", "exon")].obs_A == 1 + 2 + 2 + 1  # shared exons count for each isoform
    assert a[("t2-longest_isoform", "exon")].obs_A == 3 and a[("g1-exon-chimaera", "exon")].obs_A == 4
    assert a[("g1-exon-chimaera", "exon")].total_sites == 41 and a[("g1-all_isoforms", "exon")].total_sites == 51
    assert a[("sequence_c_all_sites", None)].obs_A == 5 and a[("global_all_sites", None)].obs_A == 5  # sequence z is not annotated
    assert a[("sequence_c_gene_exon_all_isoforms", "exon")].obs_A == a[("global_exon_all_isoforms", "exon")].obs_A == 6


def test_feature_mode_sums_to_all_isoforms(spark):
    s = sites(spark, [("c", x, 1, x % 4, 9, 3, 2, 2, 2) for x in range(100)])
    _, aggs = rollup.report(s, parts(spark, GENOME), [], 1, 1, keep=kept)
    rows = aggs.where("type = 'feature' and ctype = 'exon'").collect()
    of = lambda mode: sum(r.read_AG for r in rows if r["mode"] == mode)
    assert of("feature") == of("all_isoforms") >= of("longest_isoform") and of("chimaera") <= of("all_isoforms")


def test_report_all_has_zero_rows(spark):
    feats, _ = rollup.report(sites(spark, [("c", 5, 1, 0, 9, 9, 0, 0, 0)]), parts(spark, GENOME), [], 1, 1, report_all=True, keep=kept)
    assert feats.count() == len(GENOME) and feats.where("id = 'g2' and obs_A = 0").count() == 1


def test_ratios_and_prevalence(spark):
    s = sites(spark, [("c", 5, 1, 0, 10, 6, 0, 4, 0), ("c", 6, 1, 0, 10, 10, 0, 0, 0)])
    feats, _ = rollup.report(s, parts(spark, GENOME[:1]), [], 1, 1)
    rows = feats.withColumns({"grp": F.lit("a"), "sample": F.lit("s"), "rep": F.lit("r")})
    m = {(r.pairing, r.metric): r.value for r in matrix.ratios(rows, ["grp", "sample", "rep"], ["id"]).collect()}
    assert m[("AG", "espf")] == 0.5 and m[("AG", "espr")] == 0.2 and m[("CT", "espf")] is None
    long = spark.createDataFrame([("x", "AG", "m", g, float(v)) for g, v in (("a", 1), ("a", 0), ("b", 0), ("b", 0))], "id string, pairing string, metric string, grp string, value double")
    samples = spark.createDataFrame([("a",), ("a",), ("b",), ("b",)], "grp string")
    assert matrix.prevalent(long, samples, ["id"]).count() == 1
    assert matrix.prevalent(long, samples, ["id"], 50).count() == 0 and matrix.prevalent(long, samples, ["id"], 50, 50).count() == 1


def test_uid_and_names(spark):
    one = spark.range(1)
    v = lambda c: one.select(c.alias("x")).first().x
    lit = F.lit
    assert v(names.uid(lit("aggregate"), lit("sequence"), lit("chr1"), lit("."), lit("."), lit("zz"), lit("exon"), lit("chimaera"))) == "agg-sequence-chr1-exon-chimaera"
    assert v(names.uid(lit("feature"), lit("exon"), lit("chr1"), lit("."), lit(".,g1,t1"), lit("e1"), lit("."), lit("."))) == "feat-exon-chr1-g1,t1-e1"
    assert v(names.safe_seqid(lit(""))) == "EMPTY" and v(names.file_id(lit("/a/b_c_d.tsv"))) == "b_c"
    assert v(names.sample_part(lit("g::s::r::espf::x"), 0)) is None
    assert v(bases.base_code(lit(""))) == 4 and v(bases.base_code(lit("T"))) == 3


def test_special_functions():
    assert abs(pvalues.chi2_sf(3.0, 2) - math.exp(-1.5)) < 1e-12
    assert abs(pvalues.t_two_sided(1.0, 1) - 0.5) < 1e-12
    assert abs(pvalues.f_sf(3.0, 2, 10) - (1 + 2 * 3 / 10) ** -5) < 1e-12
    assert abs(pvalues.u_exact(0, 3, 3) - 0.1) < 1e-12
    w, p = pvalues.shapiro([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236])
    assert abs(w - 0.79) < 0.01 and 0.003 < p < 0.012


def test_benjamini_hochberg(spark):
    p = [0.01, 0.02, 0.03, 0.5, None]
    got = {r.i: r.padj for r in stats.benjamini_hochberg(spark.createDataFrame([(i, "t", x) for i, x in enumerate(p)], "i int, test string, pval double"), ["test"]).collect()}
    assert [round(got[i], 6) for i in range(4)] == [0.04, 0.04, 0.04, 0.5] and got[4] is None


def test_global_and_pairwise_tests(spark):
    rows = [("s", "u", g, "x", str(i), float(v)) for g, vs in (("a", (1, 2, 3, 4)), ("b", (5, 6, 7, 9)), ("c", (2, 8, 1, 5))) for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "section string, uid string, grp string, sample string, rep string, value double")
    g = {r.test: r for r in stats.global_tests(df, ["section", "uid"], ["section"], "auto").collect()}
    assert set(g) == {"kruskal", "anova", "welch", "primary"} and g["welch"].stat == g["kruskal"].stat
    pw = {(r.grp1, r.grp2, r.test): r for r in stats.pairwise_tests(df, ["section", "uid"], ["section"]).collect()}
    assert pw[("a", "b", "mwu")].stat == 0.0 and abs(pw[("a", "b", "mwu")].pval - 2 / 70) < 1e-12
    assert abs(pw[("a", "b", "student")].stat - (2.5 - 6.75) / math.sqrt((5 / 3 + 2.9166666667) / 2 * 0.5)) < 1e-6


def test_sections(spark):
    r = spark.createDataFrame([("c", ".", "x", "aggregate", None, "sequence", "exon", "chimaera")], "seqid string, parent_ids string, id string, mtype string, ptype string, type string, ctype string, mode string")
    got = {x.section for x in sections.memberships(r, ["id"]).collect()}
    assert got == {"sequence_c_ctype_exon_chimaera", "sequences_ctype_exon_chimaera"}


RED3 = "\t".join(site_tables.REDITOOLS3)


def test_readers(spark, tmp_path):
    f = tmp_path / "r3.tsv"
    f.write_text(RED3 + "\nchr1\t11\tA\t+\t9\t30.5\t[5, 0, 4, 0]\t-\t0\t-\t-\t-\t-\t-\nchr1\t12\tR\t*\t3\t30\t[1,1,1,0]\t-\t0\t-\t-\t-\t-\t-\n")
    r = site_tables.read_sites(spark, str(f), "reditools3").orderBy("pos").collect()
    assert (r[0].pos, r[0].ref, r[0].strand, r[0].coverage, r[0].fa, r[0].fg) == (10, 0, 1, 9, 5, 4) and (r[1].ref, r[1].strand) == (4, 0)
    f.write_text(RED3.replace("MeanQ", "Mean") + "\n" + "\t".join("x" * 14) + "\n")
    with pytest.raises(Exception):
        site_tables.reditools3(spark, str(f)).collect()
    j = tmp_path / "j.bed"
    j.write_text("## a comment\n" + "\t".join(site_tables.JACUSA2) + "\nchr1\t7\t8\tvariant\t1.5\t-\t1,2,3,4\t*\t*\tN\n")
    r = site_tables.jacusa2(spark, str(j)).first()
    assert (r.pos, r.strand, r.ref, r.coverage, r.ft, r.score) == (7, -1, 4, 10, 4, 1.5)
    with pytest.raises(NotImplementedError):
        site_tables.read_sites(spark, str(j), "sapin")


def test_gff(spark, tmp_path):
    f = tmp_path / "a.gff3"
    f.write_text("##gff-version 3\nc\tx\tgene\t1\t100\t.\t+\t.\tID=g1\nc\tx\tmRNA\t1\t100\t.\t+\t.\tID=t1;Parent=g1\nc\tx\texon\t1\t10\t.\t.\t.\tID=e%2C1;Parent=t1,t2\n##FASTA\n>c\nACGT\n")
    p = gff3.read_gff3(spark, str(f))
    got = sorted((r.feature_id, r.parent_id or "", r.start0, r.end0, r.strand) for r in p.collect())
    assert got == [("e,1", "t1", 0, 10, 0), ("e,1", "t2", 0, 10, 0), ("g1", "", 0, 100, 1), ("t1", "g1", 0, 100, 1)]
    assert gff3.read_gff3(spark, str(f), ["gene"]).count() == 1 and gff3.sequence_ids(spark, str(f)).collect()[0][0] == "c"


def test_report_round_trip(spark, tmp_path):
    s = sites(spark, [("c", x, 1, 0, 9, 5, 0, 4, 0) for x in (5, 22)])
    feats, aggs = rollup.report(s, parts(spark, GENOME), [], 1, 1, keep=kept)
    feats, aggs = kept(feats, "f"), kept(aggs, "a")
    sinks.write_report(aggs, str(tmp_path / "a"))
    back = tables.read_report(spark, str(tmp_path / "a"))
    cols = ["seqid", "id", "ctype", "start", "total_sites", "read_AG"]
    assert sorted(map(tuple, back.select(cols).collect()), key=str) == sorted(map(tuple, aggs.select(cols).collect()), key=str)
    levels = sinks.split_levels(aggs)
    assert sum(t.count() for t in levels.values()) == aggs.count() and levels["total"].count() > 0
    rows = feats.withColumns({"grp": F.lit("a"), "sample": F.lit("s"), "rep": F.lit("r")})
    long = matrix.ratios(rows, ["grp", "sample", "rep"], matrix.KEY)
    sinks.write_matrix(long.where("metric = 'espf' and pairing = 'AG'"), ["a::s::r::espf"], str(tmp_path / "m"))
    got, cols = tables.read_matrix(spark, str(tmp_path / "m" / "metric=espf" / "pairing=AG"))
    assert cols == ["a::s::r::espf"] and got.where("value = 1.0").count() == feats.count()


def test_sample_sheet_and_sequences(spark, tmp_path):
    f = tmp_path / "s.csv"
    f.write_text("group,input_1,input_2,strandedness,read_type\na,/x/r_1.fastq.gz,/x/r_2.fastq.gz,ISR,Short_Paired\n,/x/q.bam,,,\nb,/x/q.bam,/x/r.fastq,,\nc,y.fq,,ISR,short_paired\nd,/x/y.fq,,,ont\ne,/x/y.fq,,ISR,\n")
    sheet = lambda **how: [r.problem for r in tables.read_sample_sheet(spark, str(f), **how).orderBy(F.col("group").asc_nulls_last()).collect()]
    assert sheet() == [None, "an alignment has no input_2", "short_paired needs input_2", "strandedness is missing", "read_type is missing", "group is missing"]
    assert sheet(strandedness="ISF", read_type="ont") == [None, "an alignment has no input_2", None, None, None, "group is missing"]
    first, *_, third = tables.read_sample_sheet(spark, str(f), base="/b").where("group in ('a', 'c')").orderBy("group").collect()
    assert (first.uid, first.paired, first["sample"], first.replicate) == ("r", True, "r", "rep1") and third.input_1 == "/b/y.fq"
    q = tmp_path / "q.fastq"
    q.write_text("@A1\nAaCG\n+\nAAAA\n@A2\nTT\n+\nII\n")
    got = tables.fastq_a_to_g(spark, str(q)).orderBy("record").collect()
    assert [(r["name"], r["sequence"], r["quality"]) for r in got] == [("@A1", "GgCG", "AAAA"), ("@A2", "TT", "II")]
    many = [(f"@r{i}", "ACGT" * (i % 5 + 1), "I" * (i % 5 + 1) * 4) for i in range(400)]
    q.write_text("".join(f"{n}\n{s}\n+\n{x}\n" for n, s, x in many))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")  # the file is cut within records
    got = tables.fastq_a_to_g(spark, str(q)).collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert sorted((r["name"], r["sequence"], r["quality"]) for r in got) == sorted((n, s.replace("A", "G"), x) for n, s, x in many)
    fa = tmp_path / "g.fa"
    fa.write_text(">chrA\nACGTa\n")
    assert [r.value for r in tables.fasta_a_to_g(spark, str(fa)).collect()] == [">chrA", "GCGTg"]


def test_stream_counts_equal_batch(spark, tmp_path):
    from strandwise.streaming import site_stream

    s = sites(spark, [("c", x, 1, 0, 9, 5, 0, 4, 0) for x in range(0, 60, 3)]).repartition(3)
    p = parts(spark, GENOME)
    s.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(s.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    site_stream.count_stream(stream, p, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = sorted(map(tuple, site_stream.counted(spark, str(tmp_path / "out")).collect()))
    assert got == sorted(map(tuple, rollup.part_counts(s, p, []).collect())) and got
