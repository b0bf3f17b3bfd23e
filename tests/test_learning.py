"""Forests, boosted trees and discriminants of all sections in one plan, and the trees themselves."""

import time

import numpy as np
from pyspark.sql import functions as F

from strandwise.operators import multivariate, stats, trees

SECTIONS = 24


def _rows(spark, groups=3):
    """Twelve samples of groups; u0 to u7 tell them apart in every section, the other biomarkers do not."""
    n = spark.range(SECTIONS * 12 * 20).selectExpr("id div 240 as k", "id div 20 % 12 as s", "id % 20 as u")
    g = F.col("s") % groups
    noise = F.pmod(F.xxhash64("k", "s", "u"), F.lit(1009)) / 1009
    return n.select(F.format_string("sec%02d", "k").alias("section"), F.concat(F.lit("u"), "u").alias("uid"), F.concat(F.lit("g"), g).alias("grp"), F.concat(F.lit("s"), "s").alias("sample"), F.lit("r").alias("rep"), F.when(F.col("u") < 8, g * 5 + noise).otherwise(noise).alias("value"))


def test_learning_takes_no_jobs_a_section(spark):
    rows = _rows(spark).cache()
    rows.count()
    start = time.time()
    imp = multivariate.importance_by_section(rows).collect()
    acc = multivariate.cross_validated_by_section(rows).collect()
    assert time.time() - start < 60  # fits by Spark jobs took some 20 s a section
    assert len(imp) == SECTIONS * 20 and len(acc) == SECTIONS * 2
    for k in {r.section for r in imp}:
        of = {r.uid: r.importance for r in imp if r.section == k}
        assert sum(of[f"u{i}"] for i in range(8)) > 0.6 and abs(sum(of.values()) - 1) < 1e-9
    assert {(r.model, r.folds) for r in acc} == {("random_forest", 4), ("linear_discriminant", 4)}
    assert all(0 <= r.accuracy <= 1 for r in acc) and np.mean([r.accuracy for r in acc if r.model == "random_forest"]) > 0.9
    one = rows.where("section = 'sec07'")
    assert sorted((r.uid, r.importance) for r in imp if r.section == "sec07") == sorted(map(tuple, multivariate.importance(one).collect()))
    assert sorted(tuple(r)[1:] for r in acc if r.section == "sec07") == sorted(map(tuple, multivariate.cross_validated(one).collect()))


def test_two_groups_are_boosted_and_small_sections_are_left_out(spark):
    rows = _rows(spark, 2).where("section < 'sec02'")
    got = {(r.section, r.model): r.accuracy for r in multivariate.cross_validated_by_section(rows).collect()}
    assert {m for _, m in got} == {"random_forest", "gradient_boosting", "linear_discriminant"}
    assert got["sec00", "gradient_boosting"] == got["sec01", "gradient_boosting"] == 1
    for few in ("sample in ('s0', 's1', 's2')", "uid = 'u0'", "grp = 'g1'"):
        assert multivariate.cross_validated_by_section(rows.where(few)).count() == multivariate.importance_by_section(rows.where(few)).count() == 0


def test_selection_of_all_sections_is_that_of_each(spark):
    rows = _rows(spark).where("section < 'sec03'")
    tests = rows.select("section", "uid").distinct().select("*", F.lit("primary").alias("test"), (F.pmod(F.xxhash64("uid", "section"), F.lit(100)) / F.when(F.col("section") == "sec01", 300).otherwise(1000)).alias("padj")).withColumn("pval", F.col("padj"))
    tests = tests.where("section > 'sec00' or uid < 'u13'")
    every = multivariate.selected_by_section(rows, tests, max_uids=15).collect()
    for k in ("sec00", "sec01", "sec02"):
        mine = F.col("section") == k
        assert [r.uid for r in sorted((r for r in every if r.section == k), key=lambda r: r.place)] == [r.uid for r in multivariate.selected(rows.where(mine), tests.where(mine), max_uids=15).collect()]


def test_primary_tests_are_those_of_the_global_tests(spark):
    rows = _rows(spark).where("section < 'sec04'").withColumn("value", F.round("value", 1))
    by = ["section", "uid"]
    want = stats.global_tests(rows, by, ["section"]).where("test = 'primary'")
    got = stats.primary_tests(rows, by, ["section"]).select(want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 80


def test_trees_find_the_best_cut():
    rng = np.random.default_rng(5)
    x, y = rng.integers(0, 6, (15, 4)).astype(float), rng.integers(0, 3, 15)
    one = np.eye(3)[y]

    def impurity(part):
        return len(part) * (1 - ((np.bincount(part, minlength=3) / len(part)) ** 2).sum())

    t = trees.Tree(x, one, np.arange(15), 1, 4, rng)
    best = max(impurity(y) - impurity(y[x[:, f] <= c]) - impurity(y[x[:, f] > c]) for f in range(4) for c in set(x[:, f]) - {x[:, f].max()})
    assert abs(t.gains.sum() - best) < 1e-9 and len(t.feature) == 3
    deep = trees.Tree(x, one, np.arange(15), 99, 4, rng)
    same = {tuple(r) for r in x}
    assert len(same) < 15 or (deep.value[deep.leaves(x)].argmax(1) == y).all()
    flat = trees.forest(np.ones((8, 3)), np.arange(8) % 2, 2, 5, 10, 1)
    assert trees.importances(flat).sum() == 0  # nothing to split by


def test_discriminant_is_that_of_the_inverse_covariance():
    rng = np.random.default_rng(2)
    for n, d in ((9, 40), (30, 5)):
        x, y, q = rng.normal(size=(n, d)), np.arange(n) % 3, rng.normal(size=(50, d))
        x += y[:, None]
        means = np.stack([x[y == c].mean(0) for c in range(3)])
        centred = x - means[y]
        cov = centred.T @ centred / (n - 3)
        inverse = np.linalg.pinv(cov + 1e-6 * np.trace(cov) / d * np.eye(d))
        score = q @ inverse @ means.T - 0.5 * np.einsum("ij,jk,ik->i", means, inverse, means) + np.log(1 / 3)
        assert (multivariate._discriminant(x, y, q) == score.argmax(1)).all()


def test_importance_covers_all_chosen_biomarkers(spark):
    n = spark.range(2 * 12 * 700).selectExpr("id div 8400 as k", "id div 700 % 12 as s", "id % 700 as u")
    value = F.pmod(F.xxhash64("k", "s", "u"), F.lit(1009)) / 1009 + F.when(F.col("u") == 650, F.col("s") % 3 * 5).otherwise(0)
    rows = n.select(F.concat(F.lit("sec"), "k").alias("section"), F.concat(F.lit("u"), "u").alias("uid"), F.concat(F.lit("g"), F.col("s") % 3).alias("grp"), F.concat(F.lit("s"), "s").alias("sample"), F.lit("r").alias("rep"), value.alias("value"))
    tests = rows.select("section", "uid").distinct().select("*", F.lit("primary").alias("test"), F.lit(0.01).alias("pval"), (F.substring("uid", 2, 9).cast("int") / 20000).alias("padj"))
    for given in (None, tests):  # chosen by variance, or by tests in the order of u
        got = multivariate.importance_by_section(rows, given).collect()
        assert len({(r.section, r.uid) for r in got}) == len(got) == 1400  # no cut at 500
        for k in ("sec0", "sec1"):
            of = {r.uid: r.importance for r in got if r.section == k}
            assert abs(sum(of.values()) - 1) < 1e-9 and of["u650"] > 3 / 700
    few = multivariate.importance_by_section(rows, tests, max_uids=500).collect()
    assert len(few) == 1000 and "u650" not in {r.uid for r in few}
