"""Inputs, selectors, labels, channels and the run over all steps."""

import random

import pytest
from pyspark.sql import functions as F

from strandwise.operators import analysis, channels, sections, stats
from strandwise.plans.store import kept
from strandwise.sources import inputs, sinks


def names(df):
    return sorted(r.path.rsplit("/", 1)[-1] for r in df.collect())


def test_inputs_are_found(spark, tmp_path):
    for n in ("a.bam", "b.bam", "c.txt", "r_R1.fastq.gz", "r_R2.fastq.gz", "plain.fastq"):
        (tmp_path / n).write_text("")
    (tmp_path / "empty").mkdir()
    assert names(inputs.discover(spark, str(tmp_path), "alignment")) == ["a.bam", "b.bam"]
    assert names(inputs.discover(spark, str(tmp_path), "reads")) == ["r_R1.fastq.gz", "r_R2.fastq.gz"]  # mates only in a folder
    assert names(inputs.discover(spark, f"{tmp_path}/[ac]*", "alignment")) == ["a.bam"]
    assert names(inputs.discover(spark, f"{tmp_path}/plain.fastq", "reads")) == ["plain.fastq"]
    assert inputs.discover(spark, f"{tmp_path}/empty", "alignment").count() == inputs.discover(spark, f"{tmp_path}/none", "reads").count() == 0
    got = inputs.discover(spark, "https://x.org/q_1.bam, /no/such.bam,z.txt", "alignment").collect()
    assert [(r.path, r.is_url, r.uid) for r in got] == [("https://x.org/q_1.bam", True, "q"), ("/no/such.bam", False, "such")]
    assert inputs.discover(spark, "s3://b/k.bam", "alignment").count() == 1


def test_selectors_warn(spark):
    df = spark.createDataFrame([("espf",), ("espr",)], "metric string")
    assert sections.chosen(df, "metric", None).count() == 2
    with pytest.warns(UserWarning, match="odd"):
        assert sections.chosen(df, "metric", ["espf", "odd"]).count() == 1
    with pytest.raises(ValueError, match="odd"):
        sections.chosen(df, "metric", ["odd"])


def test_channels(spark):
    frame = lambda rows, s: spark.createDataFrame(rows, s)
    runs = channels.with_sheet(frame([("a", "1"), ("b", "2")], "uid string, path string"), frame([("a", "X"), ("c", "Y")], "uid string, strandedness string"))
    assert [tuple(r) for r in channels.with_library(runs, frame([("z", "U")], "uid string, library string")).collect()] == [("a", "1", "X")]
    both = channels.with_hyper_edited(frame([("a", 1), ("b", 2)], "uid string, read int"), frame([("a", 3)], "uid string, read int"))
    assert sorted((r.uid, r.read, r.again) for r in both.collect()) == [("a", 1, False), ("a", 3, True)]


def values(spark):
    rng, rows = random.Random(4), []
    for s in ("one", "two"):
        for u in range(14):
            for g, shift in (("ctrl", 0), ("high", 0.3 if u < 12 else 0), ("low", 0.1)):
                for k in range(4):
                    v = 0.5 if u == 13 else round(shift + rng.random() / (8 if u < 9 else 2), 4)
                    rows.append((s, f"u{u}", g, f"s{k // 2}", f"rep{k % 2}", None if rng.random() < 0.04 else v))
    return spark.createDataFrame(rows, "section string, uid string, grp string, sample string, rep string, value double")


def test_all_steps_over_all_sections(spark, tmp_path):
    out = analysis.analysed(values(spark), [s for s in analysis.STEPS if s not in ("ranking", "classification")], keep=kept)
    assert set(out) == {
        "data", "missing", "describe", "batch", "group_statistics", "group_means", "coefficient_of_variation", "components", "explained", "clusters", "global_tests", "pairwise_tests", "fold_changes",
        "significant", "unique_common", "common_pairs", "sample_correlation", "biomarker_correlation", "stability", "heatmap",
    }
    assert all({r.section for r in t.select("section").distinct().collect()} == {"one", "two"} for n, t in out.items() if n not in ("unique_common", "common_pairs", "significant"))
    assert out["data"].where("uid = 'u13'").count() == 0 and out["batch"].where("component > 3").count() == 0
    sinks.write_statistics({n: out[n] for n in ("missing", "batch", "clusters")}, str(tmp_path / "t"))
    assert spark.read.option("header", True).csv(str(tmp_path / "t/missing")).count() == 24
    with pytest.warns(UserWarning, match="nothing"):
        assert set(analysis.analysed(values(spark), ["qc", "nothing"])) == {"data", "missing", "describe"}


def test_selection_reads_the_tests(spark):
    rows = values(spark).where("section = 'one'").drop("section")
    tests = kept(stats.global_tests(values(spark), ["section", "uid"], ["section"]), "t").where("section = 'one'")
    from strandwise.operators import multivariate

    best = {r.uid for r in tests.where("test = 'primary' and padj < 0.05").collect()}
    got = [r.uid for r in multivariate.selected(rows, tests, filters=("primary", "anova"), max_uids=len(best)).collect()]
    assert set(got) == best and 2 <= len(best) < 14
    assert {r.uid for r in multivariate.selected(rows, tests.where(F.lit(False))).collect()} == {f"u{i}" for i in range(14)}  # nothing significant: by variance


def test_varying_biomarkers_are_not_capped(spark):
    rows = spark.range(20_100).select(F.lit("x").alias("section"), (F.col("id") / 2).cast("int").cast("string").alias("uid"), F.lit("g").alias("grp"), F.lit("s").alias("sample"), (F.col("id") % 2).cast("string").alias("rep"), F.col("id").cast("double").alias("value"))
    assert sections.filtered(rows, ["section"], "uid").count() == 20_100
    assert sections.filtered(rows, ["section"], "uid", most=10_000).count() == 20_000  # a step that is asked for


def test_components_of_all_sections_in_one_pass(spark):
    from strandwise.operators import multivariate

    rows = [(sec, f"u{i}", "g", f"s{j}", "r", None if (i + j) % 5 == 0 else float((i * 7 + j * j * 3) % 11)) for sec, n in (("x", 4), ("y", 3), ("one", 1)) for i in range(9) for j in range(n)]
    df = spark.createDataFrame([*rows, ("none", "u", "g", "s1", "r", None), ("none", "u", "g", "s2", "r", None)], "section string, uid string, grp string, sample string, rep string, value double")
    got = {(r.section, r.component): (r.explained, r.cumulative) for r in multivariate.explained_by_section(df).collect()}
    want = {(s, r.component): (r.explained, r.cumulative) for s in ("x", "y", "one", "none") for r in multivariate.principal_components(df.where(F.col("section") == s))[1].collect()}
    assert got.keys() == want.keys() == {("x", i) for i in (1, 2, 3, 4)} | {("y", i) for i in (1, 2, 3)} | {("none", 1), ("none", 2)}
    assert all(got[k] == pytest.approx(want[k]) for k in want)
