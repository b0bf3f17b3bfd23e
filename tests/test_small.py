"""Small pieces: names and orders, writers, reads by name, duplicate keys."""

import json
import os

import pytest
from pyspark.sql import functions as F

from strandwise.functions import names, pvalues
from strandwise.operators import interval_join, matrix, multivariate, stats
from strandwise.plans import queries, store
from strandwise.sources import gff3, sinks, site_tables, tables


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v")).alias("r")).first().r


def test_natural_order(spark):
    df = spark.createDataFrame([(x,) for x in ("chr10", "chr2", "X", "chr1", "chr2b", "contig")], "s string")
    assert [r.s for r in df.orderBy(*names.natural_key(F.col("s"))).collect()] == ["X", "chr1", "chr2", "chr2b", "chr10", "contig"]


def test_matrix_order(spark):
    df = spark.createDataFrame([(None, ".", "a"), ("b", ".", "z"), ("b", ".", "a"), ("a", "q", "a")], "seqid string, parent_ids string, mode string")
    assert [tuple(r) for r in matrix.in_matrix_order(df).collect()] == [("a", "q", "a"), ("b", ".", "a"), ("b", ".", "z"), (None, ".", "a")]


@pytest.mark.parametrize(("given", "want"), [(" .,g1,t1 ", "g1,t1"), (".", ""), (". . ", ""), ("...", ""), (None, ""), (",x", "x"), (".x", "x"), ("a.b", "a.b"), ("..x", ".x")])
def test_parts_of_a_unique_id(spark, given, want):
    assert one(spark, names.said, given) == want


def test_paths_and_run_ids(spark):
    for given, want in (("d/x.bam", "/w/d/x.bam"), ("/d/x.bam", "/d/x.bam"), ("s3://b/x.bam", "s3://b/x.bam"), ("hdfs:/x", "hdfs:/x")):
        assert one(spark, lambda c: names.absolute(c, "/w/"), given) == want
    assert one(spark, lambda c: names.run_uid(c, F.lit(True)), "/d/run_7_R1.fastq") == "run_7" and one(spark, lambda c: names.run_uid(c, F.lit(False)), "/d/run_7.fastq.gz") == "run_7"


def test_reads_get_their_sequence_back(spark):
    a = spark.createDataFrame([("q1", "GG", "xx", "1"), ("q9", "GT", "yy", "2")], "name string, sequence string, quality string, md string")
    o = spark.createDataFrame([(5, "q1", "TT", "JJ"), (3, "q1", "AG", "II"), (4, "q2", "CC", "KK")], "n int, name string, sequence string, quality string")
    assert [tuple(r) for r in tables.restored_reads(a, o).collect()] == [("q1", "AG", "II")]
    assert one(spark, tables.library_type, json.dumps({"expected_format": "ISR"})) == "ISR"


def test_synthetic_sites(spark):
    r = site_tables.synthetic(spark, "c", 9, 0, 2).collect()
    assert [x.pos for x in sorted(r)] == list(range(9)) and all((x.ref, x.fg, x.fa, x.coverage) == (0, 1, 0, 1) for x in r)


def test_a_key_that_comes_twice(spark):
    s = "id string, grp string, sample string, rep string, metric string, value double"
    df = spark.createDataFrame([("x", "a", "s", "r", "m", 1.0), ("x", "a", "s", "q", "m", None)], s)
    assert matrix.wide(df, ["id"], ["a::s::r::m", "a::s::q::m"]).first()["a::s::r::m"] == 1.0
    with pytest.raises(Exception, match="twice"):
        matrix.wide(df.union(df), ["id"], ["a::s::r::m"]).collect()


def test_missing_list_and_products(spark):
    rows = [(f"u{i % 3}", f"s{i // 3}", None if i % 3 < i // 3 else float(i)) for i in range(12)]
    df = spark.createDataFrame([("k", *r) for r in rows], "section string, uid string, s string, value double")
    assert [(r.uid, r.missing) for r in stats.most_missing(df, ["section"], "uid", 2).orderBy("rank").collect()] == [("u0", 3), ("u1", 2)]
    v = df.withColumn("v", F.coalesce("value", F.lit(0.0)))
    got = {(r.s1, r.s2): (r.n, r.x, r.yy, r.xy) for r in stats.sample_products(v, ["section"], "uid").collect()}
    of = lambda s: [v or 0.0 for u, x, v in sorted(rows) if x == s]
    for (a, b), (n, x, yy, xy) in got.items():
        p, q = of(a), of(b)
        assert (n, x, yy, xy) == (3, sum(p), sum(y * y for y in q), sum(y * z for y, z in zip(p, q, strict=True)))
    assert len(got) == 10


def test_manifest_and_split_files(spark, tmp_path):
    sinks.write_manifest(spark, str(tmp_path / "m"), {"b": 1, "a": [2]})
    assert json.loads(spark.read.text(str(tmp_path / "m")).first().value) == {"a": [2], "b": 1}
    assert sinks.preview(spark.range(9), 4).count() == 4


def test_annotation_is_read_by_sequence(spark, tmp_path):
    f = tmp_path / "a.gff3"
    f.write_text("a\tx\tgene\t1\t9\t.\t+\t.\tID=g1\nb\tx\tgene\t1\t9\t.\t+\t.\tID=g2\n")
    got = gff3.cached_by_sequence(gff3.read_gff3(spark, str(f)), str(tmp_path / "cache")).where("seqid = 'b'")
    assert [r.feature_id for r in got.collect()] == ["g2"]
    assert "PartitionFilters: [isnotnull(seqid" in got._jdf.queryExecution().simpleString()


def test_stored_tables_are_swept(spark):
    t = store.kept(spark.range(3), "t")
    path = t.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    store.sweep(spark)
    assert not os.path.exists(path)


def test_ward_merges_the_nearest_first():
    import numpy as np

    got = multivariate.ward_order({"a": np.array([0.0]), "b": np.array([1.0]), "c": np.array([9.0])})
    assert [m[:2] for m in got] == [("a", "b"), ("a", "c")] and got[0][2] == pytest.approx(1.0)


def test_empty_parts_hold_no_site(spark):
    s = spark.createDataFrame([("c", 5, 1)], "seqid string, pos int, strand int")
    p = spark.createDataFrame([("c", "z", 5, 5, 1), ("c", "y", 5, 6, 0)], "seqid string, feature_id string, start0 int, end0 int, strand int")
    assert [r.feature_id for r in interval_join.sites_in_parts(s, p, ["feature_id"]).collect()] == ["y"]


def test_statistics_a_little_below_zero_have_p_of_one(spark):
    assert pvalues.f_sf(-1e-16, 2, 9) == pvalues.chi2_sf(-1e-16, 2) == 1.0
    assert pvalues.f_sf(0.0, 2, 9) == pvalues.chi2_sf(0.0, 2) == 1.0
    df = spark.createDataFrame([(-1e-16,), (float("nan"),), (None,)], "f double")
    p = pvalues.f_p("f", F.lit(2.0), F.lit(9.0))
    assert [r.p for r in df.select(p.alias("p")).collect()] == [1.0, None, None]


def test_mean_at_a_tie_does_not_fall_by_the_order_of_its_sum(spark):
    rows = spark.createDataFrame([("x", "g", str(i), "r", v) for i, v in enumerate((0.20781249999999998, 0.2078125, 0.2078124999))], "section string, grp string, sample string, rep string, value double")
    got = queries.qc_describe(spark, "", lambda *_: rows)
    assert [r["mean"] for r in got.orderBy("sample").collect()] == [0.207813, 0.207813, 0.207812]


def test_plain_words_are_one_pre_token_without_the_pattern():
    from strandwise.llm import tokens

    c = tokens.Coder(tokens.default_path())
    words = ["word", "café", "ßx", "Ǿ", "don't", "'s", "1a", "a1", "×", "ª", "x_y", "中", "A" * 300]
    assert [c.spaced(w) for w in words] == [e.ids for e in c.library.encode_batch([" " + w for w in words], add_special_tokens=False)]
    assert [tokens.packed(list(range(n))) for n in (0, 8, 9)] == [b"".join(i.to_bytes(4, "little") for i in range(n)) for n in (0, 8, 9)]
    asked = []
    c.chunk = asked.append
    assert [c.spaced(w) for w in words[:4]] and not asked


def test_rounding_is_that_of_the_sql(spark):
    import duckdb

    from strandwise.plans import queries

    ties = [s * (2 * k + 1) / 2e6 for k in range(0, 400_000, 7) for s in (1, -1)] + [0.0640625, 12.7734375, 1e12 / 3, 0.0]
    got = [r[0] for r in queries.rounded(spark.createDataFrame([(i, x) for i, x in enumerate(ties)], "i long, x double").coalesce(1), "x").orderBy("i").select("x").collect()]
    want = [r[0] for r in duckdb.sql(f"select round(x, 6) from (select unnest({ties}::double[]) as x)").fetchall()]
    assert got == want and got[-4] == 0.064062


def test_p_values_at_ties_are_those_of_the_closed_forms():
    from strandwise.functions import pvalues

    for df in (1, 2, 3, 4, 5, 6):
        for t in (0.0, 0.3, 1.0, 2.7, 40.0, 5e4, 3e7):
            want = pvalues._beta(df / 2, 0.5, df / (df + t * t))
            assert abs(pvalues.t_two_sided(-t, df) - want) <= 1e-9 * want
            assert abs(pvalues.f_sf(t * t, 1, df) - want) <= 1e-9 * want
            both = pvalues._beta(df / 2, 1, df / (df + 2 * t))
            assert abs(pvalues.f_sf(t, 2, df) - both) <= 1e-9 * both
    assert pvalues.f_sf(3.0, 2, 2) == 0.25 and pvalues.f_sf(3.0, 2, 6) == 0.125  # exactly, as in the SQL
    assert pvalues.t_two_sided(1.0, 1) == 0.5
