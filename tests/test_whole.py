"""Queries over the whole job: nothing of the samples, features, cells, matrices or sections is left out."""

from pyspark.sql import functions as F

from strandwise.operators import interval_join
from strandwise.plans import fixtures, queries

SMALL = "/root/testdata/sf0.001"


def test_plain_join_equals_binned(spark):
    s = fixtures.sites(spark, SMALL).where("pos < 400")
    p = fixtures.features(spark, SMALL).where("start0 < 400")
    got = [sorted(map(tuple, f(s, p, ["feature_id"]).collect())) for f in (interval_join.sites_in_parts, interval_join.sites_in_parts_plain)]
    assert got[0] == got[1] and got[0]
    assert len({r[0] for r in got[0]}) == 12


def test_binned_counts_cover_all_levels_and_samples(spark):
    got = queries.QUERIES["feature_counts_binned"](spark, SMALL)
    f = fixtures.features(spark, SMALL).select("seqid", "feature_id", "level")
    by = {r["level"]: (r["n"], r["s"]) for r in got.join(f, ["seqid", "feature_id"]).groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("sample_idx").alias("s")).collect()}
    assert set(by) == {1, 2, 3} and all(s == 12 for _, s in by.values())
    whole = queries.QUERIES["feature_counts"](spark, SMALL).select("sample_idx", "seqid", F.col("id").alias("feature_id"))
    assert whole.join(got, ["sample_idx", "seqid", "feature_id"], "left_anti").count() == 0  # all that qualify are there


def test_cells_tell_zero_from_unobserved(spark):
    for metric in ("espf", "espr"):
        got = queries.QUERIES[f"matrix_{metric}"](spark, SMALL).cache()
        n = got.agg(F.count(F.lit(1)).alias("all"), F.expr("count_if(value = 0)").alias("zero"), F.expr("count_if(value is null)").alias("none"), F.countDistinct("seqid", "id", "pairing").alias("keys")).first()
        assert n["all"] == 12 * n["keys"] and n["zero"] > 0 and n["none"] > 0
        assert got.groupBy("seqid", "id", "pairing").agg(F.max("value").alias("v")).where("v is null or v = 0").count() == 0


def test_statistics_cover_all_types_and_matrices(spark):
    got = queries.QUERIES["qc_missing"](spark, SMALL).groupBy("section").agg(F.count(F.lit(1)).alias("samples"), F.max("total").alias("uids")).collect()
    types = {r["type"]: r["count"] for r in fixtures.features(spark, SMALL).groupBy("type").count().collect()}
    assert {r["section"] for r in got} == {f"{x}{y}_{m}_{t}" for x in "ACGT" for y in "ACGT" if x != y for m in ("espf", "espr") for t in types}
    assert all(r["samples"] == 12 and r["uids"] == types[r["section"].split("_", 2)[2]] for r in got)


def test_multivariate_steps_cover_sections_groups_and_biomarkers(spark):
    def two(spark, d):
        s = fixtures.samples(spark)
        n = spark.range(40).select(F.concat(F.lit("u"), "id").alias("uid"), "id")
        rows = n.crossJoin(s).crossJoin(spark.createDataFrame([("x",), ("y",)], "section string"))
        value = F.pmod(F.xxhash64("uid", "section", "sample_idx"), F.lit(97)) / 97 + F.when(F.col("grp") == "low", F.col("id")).otherwise(0)
        return rows.select("section", "uid", "grp", "sample", "rep", value.cast("double").alias("value"))

    imp = queries.rf_importance(spark, SMALL, two).collect()
    assert {r["section"] for r in imp} == {"x", "y"} and len({r["uid"] for r in imp}) > 30  # no cut at 20 or 30
    assert {r["section"] for r in queries.pca_variance(spark, SMALL, two).collect()} == {"x", "y"}


def test_cross_validation_has_the_production_settings():
    import inspect

    from strandwise.operators import multivariate

    p = inspect.signature(multivariate.cross_validated).parameters
    assert [p[n].default for n in ("trees", "depth", "rounds", "max_uids")] == [50, 10, 50, 500]
