"""Biomarker statistics on a long table (section, uid, grp, sample, rep, value): one grouped query a statistic.

Statistics are sums and windows in Spark; only p-values leave the JVM, in Arrow batches of one row a test. Null values do not
take part. `by` names the columns of a biomarker, such as section and uid.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import pvalues
from ..functions.bases import log2_ratio


#: Sums of squares up to this are rounding, not spread.
TINY = 1e-12


def valued(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("value").isNotNull() & ~F.isnan("value"))


# -- quality control and description -------------------------------------------------------------------------------------


def missing(rows: DataFrame, by: list[str]) -> DataFrame:
    """Missing values a sample, with their share in hundredths (2 places)."""
    n = F.sum(F.when(F.col("value").isNull(), 1).otherwise(0))
    return rows.groupBy(*by).agg(n.cast("bigint").alias("missing"), F.count(F.lit(1)).alias("total"), F.round(100 * n / F.count(F.lit(1)), 2).alias("missing_pct"))


def most_missing(rows: DataFrame, section: list[str], uid: str, k: int = 20) -> DataFrame:
    """The k biomarkers of a section with the most missing values, ties by name."""
    n = missing(rows, [*section, uid]).where("missing > 0")
    return n.withColumn("rank", F.row_number().over(W.partitionBy(*section).orderBy(F.col("missing").desc(), uid))).where(F.col("rank") <= k)


def _quantiles(at: dict[str, float]) -> list[Column]:
    return [F.percentile("value", F.lit(q)).alias(name) for name, q in at.items()]


def describe(rows: DataFrame, by: list[str]) -> DataFrame:
    """count, mean, std, min, quartiles, max."""
    return valued(rows).groupBy(*by).agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        *_quantiles({"q25": 0.25, "q50": 0.5, "q75": 0.75}), F.max("value").alias("max"),
    )


def group_statistics(rows: DataFrame, by: list[str]) -> DataFrame:
    """n, mean, median, std (0 for one value), min, max and quartiles of a group's pooled values."""
    return valued(rows).groupBy(*by).agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.percentile("value", F.lit(0.5)).alias("median"), F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"), *_quantiles({"q25": 0.25, "q75": 0.75}),
    )


def group_means(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by, "grp").agg(F.avg("value").alias("mean"), F.count("value").alias("n"))


def variances(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.var_samp("value").alias("variance"), F.count("value").alias("n"))


def variable(rows: DataFrame, by: list[str], least: float = 1e-10) -> DataFrame:
    """Biomarkers whose sample variance is above `least`; one value has none and goes."""
    return variances(rows, by).where(F.col("variance") > least)


def top_variance(rows: DataFrame, section: list[str], uid: str, k: int) -> DataFrame:
    """The k most variable biomarkers of a section, ties (to twelve places, as sums have no fixed order) by name."""
    v = variable(rows, [*section, uid], -1.0)
    order = W.partitionBy(*section) if section else W.partitionBy(F.lit(0))
    return v.withColumn("rank", F.row_number().over(order.orderBy(F.round("variance", 12).desc(), uid))).where(F.col("rank") <= k)


def coefficient_of_variation(rows: DataFrame, by: list[str]) -> DataFrame:
    """std / mean, null where the mean is 0."""
    m = F.avg("value")
    return rows.groupBy(*by).agg(F.when(m != 0, F.stddev_samp("value") / m).alias("cv"))


# -- tests ---------------------------------------------------------------------------------------------------------------


def ranks(rows: DataFrame, by: list[str]) -> DataFrame:
    """Average ranks within `by`, and the number of equal values (ties)."""
    w = W.partitionBy(*by).orderBy("value")
    ties = F.count(F.lit(1)).over(W.partitionBy(*by, "value"))
    return valued(rows).withColumn("ties", ties).withColumn("rnk", F.rank().over(w) + (F.col("ties") - 1) / 2)


def kruskal(rows: DataFrame, by: list[str]) -> DataFrame:
    """Kruskal and Wallis's H with tie correction, its degrees of freedom and p; null with fewer than two groups or all equal."""
    r = ranks(rows, by)
    per = r.groupBy(*by, "grp").agg(F.sum("rnk").alias("rs"), F.count(F.lit(1)).alias("n"), F.sum((F.col("ties") * F.col("ties") - 1).cast("double")).alias("tie"))
    s = per.groupBy(*by).agg(F.sum(F.col("rs") * F.col("rs") / F.col("n")).alias("q"), F.sum("n").alias("n"), F.sum("tie").alias("tie"), F.count(F.lit(1)).alias("groups"))
    n = F.col("n").cast("double")
    right = 1 - F.try_divide(F.col("tie"), n * n * n - n)
    h = F.try_divide(12 / (n * (n + 1)) * F.col("q") - 3 * (n + 1), right)
    out = s.withColumn("h", F.when((F.col("groups") >= 2) & (right > 0), h)).withColumn("df", (F.col("groups") - 1).cast("int"))
    return out.select(*by, "h", "df")


def _moments(rows: DataFrame, by: list[str]) -> DataFrame:
    return valued(rows).groupBy(*by, "grp").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.var_samp("value").alias("var"))


def anova(rows: DataFrame, by: list[str]) -> DataFrame:
    """One-way F over groups of two values or more, with its degrees of freedom; null with fewer than two such groups."""
    m = _moments(rows, by).where("n >= 2")
    s = m.groupBy(*by).agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("mean")).alias("t"), F.sum(F.col("n") * F.col("mean") * F.col("mean")).alias("b"), F.sum((F.col("n") - 1) * F.col("var")).alias("w"),
    )
    between = F.col("b") - F.col("t") * F.col("t") / F.col("n")
    d1, d2 = F.col("k") - 1, F.col("n") - F.col("k")
    f = F.when((F.col("k") >= 2) & (F.col("w") > TINY), (between / d1) / (F.col("w") / d2))
    return s.select(*by, f.alias("f"), d1.cast("int").alias("df1"), d2.cast("int").alias("df2"))


def bartlett(rows: DataFrame, by: list[str]) -> DataFrame:
    """Bartlett's statistic of equal variances over groups of two values or more; null unless all variances are above 0."""
    m = _moments(rows, by).where("n >= 2")
    s = m.groupBy(*by).agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum((F.col("n") - 1) * F.col("var")).alias("w"), F.min("var").alias("least"),
        F.sum(F.when(F.col("var") > 0, (F.col("n") - 1) * F.ln("var"))).alias("l"), F.sum(1 / (F.col("n") - 1)).alias("r"),
    )
    free = F.col("n") - F.col("k")
    scale = 1 + (F.col("r") - 1 / free) / (3 * (F.col("k") - 1))
    stat = F.when((F.col("k") >= 2) & (F.col("least") > TINY), (free * F.ln(F.col("w") / free) - F.col("l")) / scale)
    return s.select(*by, stat.alias("bartlett"), (F.col("k") - 1).cast("int").alias("df"))


def pairs(rows: DataFrame, by: list[str]) -> DataFrame:
    """Moments of each two groups of a biomarker, in name order: grp1, grp2, n1, n2, mean1, mean2, var1, var2."""
    m = _moments(rows, by)
    a = m.select(*by, F.col("grp").alias("grp1"), F.col("n").alias("n1"), F.col("mean").alias("mean1"), F.col("var").alias("var1"))
    b = m.select(*by, F.col("grp").alias("grp2"), F.col("n").alias("n2"), F.col("mean").alias("mean2"), F.col("var").alias("var2"))
    return a.join(b, by).where("grp1 < grp2")


def student(p: DataFrame, by: list[str]) -> DataFrame:
    """Student's t of pairs (equal variances), with its degrees of freedom."""
    df = F.col("n1") + F.col("n2") - 2
    pooled = ((F.col("n1") - 1) * F.col("var1") + (F.col("n2") - 1) * F.col("var2")) / df
    t = F.try_divide(F.col("mean1") - F.col("mean2"), F.sqrt(pooled * (1 / F.col("n1") + 1 / F.col("n2"))))
    ok = (F.col("n1") >= 2) & (F.col("n2") >= 2) & (pooled > TINY)
    return p.select(*by, "grp1", "grp2", F.when(ok, t).alias("t"), F.when(ok, df.cast("double")).alias("df"))


def welch(p: DataFrame, by: list[str]) -> DataFrame:
    """Welch's t of pairs (unequal variances), with its degrees of freedom."""
    a, b = F.col("var1") / F.col("n1"), F.col("var2") / F.col("n2")
    ok = (F.col("n1") >= 2) & (F.col("n2") >= 2) & (a + b > TINY)
    t = F.try_divide(F.col("mean1") - F.col("mean2"), F.sqrt(a + b))
    df = F.try_divide((a + b) * (a + b), F.try_divide(a * a, F.col("n1") - 1) + F.try_divide(b * b, F.col("n2") - 1))
    return p.select(*by, "grp1", "grp2", F.when(ok, t).alias("t"), F.when(ok, df).alias("df"))


def mann_whitney(rows: DataFrame, by: list[str]) -> DataFrame:
    """Mann and Whitney's U of the first group of each pair, with n1, n2, tie term (sum of t^3 - t) and rank-biserial effect."""
    a, b = valued(rows).select(*by, F.col("grp").alias("grp1"), "value"), valued(rows).select(*by, F.col("grp").alias("grp2"), "value")
    g = valued(rows).select(*by, "grp").distinct()
    two = g.select(*by, F.col("grp").alias("grp1")).join(g.select(*by, F.col("grp").alias("grp2")), by).where("grp1 < grp2")
    both = two.join(a, [*by, "grp1"]).withColumn("_one", F.lit(1)).unionByName(two.join(b, [*by, "grp2"]).withColumn("_one", F.lit(0)))
    r = ranks(both, [*by, "grp1", "grp2"])
    s = r.groupBy(*by, "grp1", "grp2").agg(
        F.sum(F.col("rnk") * F.col("_one")).alias("r1"), F.sum("_one").alias("n1"), F.sum(1 - F.col("_one")).alias("n2"), F.sum((F.col("ties") * F.col("ties") - 1).cast("double")).alias("tie"),
    )
    u = F.col("r1") - F.col("n1") * (F.col("n1") + 1) / 2
    return s.select(*by, "grp1", "grp2", u.alias("u"), F.col("n1").cast("bigint").alias("n1"), F.col("n2").cast("bigint").alias("n2"), "tie", (1 - 2 * u / (F.col("n1") * F.col("n2"))).alias("effect_size"))


def fold_changes(p: DataFrame, by: list[str]) -> DataFrame:
    """Difference and log2 ratio of the means of pairs."""
    return p.select(*by, "grp1", "grp2", (F.col("mean1") - F.col("mean2")).alias("diff"), log2_ratio(F.col("mean1"), F.col("mean2")).alias("log2fc"))


def _steps(p: Column) -> Column:
    """p's step on a scale of some thousand, which rises with p."""
    return F.when(p >= 0.001, F.floor(p * 1000)).when(p > 0, -F.floor(-10 * F.log10(p))).otherwise(-10_000).cast("int")


def benjamini_hochberg(rows: DataFrame, by: list[str], p: str = "pval") -> DataFrame:
    """rows with padj: p times count over rank, least from the largest p down, at most 1; null p stays out.

    Equal p have equal padj, so ranks are counted on distinct p. A family is dealt out by steps of p: rows of a step are counted
    together, and only the steps, some thousand a family, meet in one task.
    """
    key = [F.col(c).alias(f"_{c}") for c in by]
    own = [f"_{c}" for c in by]
    d = rows.where(F.col(p).isNotNull()).groupBy(*key, F.col(p).alias("_p")).agg(F.count(F.lit(1)).alias("_n")).withColumn("_step", _steps(F.col("_p")))
    step, family = W.partitionBy(*own, "_step"), W.partitionBy(*own)
    s = d.groupBy(*own, "_step").agg(F.sum("_n").alias("_k"))
    s = s.withColumn("_m", F.sum("_k").over(family)).withColumn("_before", F.sum("_k").over(family.orderBy("_step")) - F.col("_k")).drop("_k")
    q = F.col("_p") * F.col("_m") / (F.col("_before") + F.sum("_n").over(step.orderBy("_p")))
    d = d.join(s, [*own, "_step"]).withColumn("_q", q)
    d = d.withColumn("_low", F.min("_q").over(step.orderBy(F.col("_p").desc())))
    least = d.groupBy(*own, "_step").agg(F.min("_q").alias("_least"))
    least = least.withColumn("_later", F.min("_least").over(family.orderBy(F.col("_step").desc()).rowsBetween(W.unboundedPreceding, -1))).drop("_least")
    d = d.join(least, [*own, "_step"]).select(*own, "_p", F.least(F.lit(1.0), "_low", "_later").alias("padj"))
    on = F.col(p) == F.col("_p")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return rows.drop("padj").join(d, on, "left").drop("_p", *own)


#: The pairwise test that goes with each choice, and the global one.
CHOICES = {"nonparametric": ("kruskal", "mwu"), "kruskal": ("kruskal", "mwu"), "parametric": ("anova", "student"), "welch": ("welch", "welch")}


def assumptions(rows: DataFrame, by: list[str]) -> DataFrame:
    """The choice for each biomarker: groups normal (Shapiro and Wilk, p > 0.05, groups of 3 values that vary) and of equal variance (Bartlett, p > 0.05)."""
    g = valued(rows).groupBy(*by, "grp").agg(F.array_sort(F.collect_list("value")).alias("v"), F.stddev_samp("value").alias("sd"), F.count("value").alias("n"))
    g = g.withColumn("p", F.when((F.col("n") >= 3) & (F.col("sd") >= 1e-10), pvalues.shapiro_p("v")))
    s = g.groupBy(*by).agg((F.count("p") > 0).alias("_some"), F.coalesce(F.min("p") > 0.05, F.lit(False)).alias("normal"), (F.min("sd") > 1e-10).alias("_vary"))
    b = bartlett(rows, by).withColumn("bartlett_pval", pvalues.chi2_p("bartlett", F.col("df").cast("double")))
    out = s.join(b, by, "left").withColumn("equal", F.coalesce(F.col("_vary") & (F.col("bartlett_pval") > 0.05), F.lit(False)))
    choice = F.when(F.col("normal") & F.col("_some") & F.col("equal"), "parametric").when(F.col("normal") & F.col("_some"), "welch").otherwise("nonparametric")
    return out.select(*by, "normal", "equal", "bartlett", "bartlett_pval", choice.alias("choice"))


def _kruskal_test(rows: DataFrame, by: list[str]) -> DataFrame:
    return kruskal(rows, by).select(*by, F.lit("kruskal").alias("test"), F.col("h").alias("stat"), pvalues.chi2_p("h", F.col("df").cast("double")).alias("pval"))


def primary_tests(rows: DataFrame, by: list[str], family: list[str]) -> DataFrame:
    """The rows of test `primary` of global_tests (rank test), without the work of the other tests."""
    return benjamini_hochberg(_kruskal_test(rows, by).withColumn("test", F.lit("primary")), [*family, "test"])


def global_tests(rows: DataFrame, by: list[str], family: list[str], choice: str = "nonparametric") -> DataFrame:
    """Long rows by, test, stat, pval, padj over all groups; test `primary` repeats the chosen one. family: where padj belongs together."""
    groups = valued(rows).select(*family, "grp").distinct().groupBy(*family).agg(F.count(F.lit(1)).alias("_groups"))
    k = _kruskal_test(rows, by)
    a = anova(rows, by).select(*by, F.lit("anova").alias("test"), F.col("f").alias("stat"), pvalues.f_p("f", F.col("df1").cast("double"), F.col("df2").cast("double")).alias("pval"))
    w = welch(pairs(rows, by), by).join(groups, family).where("_groups = 2")
    w = w.select(*by, F.lit("welch").alias("test"), F.col("t").alias("stat"), pvalues.t_p("t", "df").alias("pval"))
    many = k.join(groups, family).where("_groups > 2").select(*by, F.lit("welch").alias("test"), "stat", "pval")  # with three groups or more the rank test stands for it
    tests = reduce(DataFrame.unionByName, [k, a, w, many])
    if choice == "auto":
        chosen = assumptions(rows, by).select(*by, F.when(F.col("choice") == "parametric", "anova").when(F.col("choice") == "welch", "welch").otherwise("kruskal").alias("test"))
        primary = tests.join(chosen, [*by, "test"])
    else:
        primary = tests.where(F.col("test") == CHOICES[choice][0])
    tests = tests.unionByName(primary.withColumn("test", F.lit("primary")))
    return benjamini_hochberg(tests, [*family, "test"])


def pairwise_tests(rows: DataFrame, by: list[str], family: list[str], choice: str = "nonparametric") -> DataFrame:
    """Long rows by, grp1, grp2, test, stat, pval, padj of each two groups; test `primary` repeats the chosen one."""
    p = pairs(rows, by)
    key = [*by, "grp1", "grp2"]
    m = mann_whitney(rows, by).select(*key, F.lit("mwu").alias("test"), F.col("u").alias("stat"), pvalues.u_p("u", F.col("n1").cast("double"), F.col("n2").cast("double"), "tie").alias("pval"))
    s = student(p, by).select(*key, F.lit("student").alias("test"), F.col("t").alias("stat"), pvalues.t_p("t", "df").alias("pval"))
    w = welch(p, by).select(*key, F.lit("welch").alias("test"), F.col("t").alias("stat"), pvalues.t_p("t", "df").alias("pval"))
    tests = m.unionByName(s).unionByName(w)
    if choice == "auto":
        chosen = assumptions(rows, by).select(*by, F.when(F.col("choice") == "parametric", "student").when(F.col("choice") == "welch", "welch").otherwise("mwu").alias("test"))
        primary = tests.join(chosen, [*by, "test"]).select(*tests.columns)
    else:
        primary = tests.where(F.col("test") == CHOICES[choice][1])
    tests = tests.unionByName(primary.withColumn("test", F.lit("primary")))
    return benjamini_hochberg(tests, [*family, "grp1", "grp2", "test"])


# -- rankings ------------------------------------------------------------------------------------------------------------

ALPHA = 0.05


def significant(tests: DataFrame, by: list[str], alpha: float = ALPHA) -> DataFrame:
    """Biomarkers with any adjusted p below alpha: number of such tests and the least."""
    return tests.groupBy(*by).agg(F.sum((F.col("padj") < alpha).cast("bigint")).alias("n_significant_tests"), F.min("padj").alias("min_padj")).where("n_significant_tests > 0")


def global_ranking(tests: DataFrame, section: str = "section", uid: str = "uid", alpha: float = ALPHA) -> DataFrame:
    """Primary rows by adjusted p, with the number of sections a uid is in and is significant in (by any test)."""
    flags = tests.groupBy(section, uid).agg(F.max((F.col("padj") < alpha).cast("int")).alias("_sig"))
    per = flags.groupBy(uid).agg(F.count(F.lit(1)).alias("n_sections_total"), F.coalesce(F.sum("_sig"), F.lit(0)).cast("bigint").alias("n_sections_significant"))
    primary = tests.where((F.col("test") == "primary") & F.col("padj").isNotNull())
    return primary.join(per, uid)


def significance_level(padj: Column) -> Column:
    """2 below 0.05, 1 below 0.1, else 0."""
    return F.when(padj < 0.05, 2).when(padj < 0.1, 1).otherwise(0)


def unique_and_common(tests: DataFrame, by: list[str], comparison: str, alpha: float = ALPHA) -> DataFrame:
    """Significant biomarkers of comparisons: `unique` to one, or `common` with another."""
    s = tests.where(F.col("padj") < alpha).select(*by, comparison).distinct()
    n = F.count(F.lit(1)).over(W.partitionBy(*by))
    return s.withColumn("kind", F.when(n == 1, "unique").otherwise("common"))


def common_pairs(tests: DataFrame, by: list[str], comparison: str, alpha: float = ALPHA) -> DataFrame:
    """Significant biomarkers that a comparison shares with each other one: by, comparison, other."""
    s = tests.where(F.col("padj") < alpha).select(*by, comparison).distinct()
    return s.join(s.withColumnRenamed(comparison, "other"), by).where(F.col(comparison) != F.col("other"))


def ranking(tests: DataFrame, section: list[str], test: str = "kruskal", tie: tuple[str, ...] = ("uid",)) -> DataFrame:
    """A test's biomarkers with an adjusted p, the least first, with their rank in the section."""
    rows = tests.where((F.col("test") == test) & F.col("padj").isNotNull())
    return rows.withColumn("rank", F.row_number().over(W.partitionBy(*section).orderBy("padj", *tie)))


def variance_ranking(rows: DataFrame, section: list[str], uid: str) -> DataFrame:
    """All biomarkers with a variance, the largest first; at most the biomarkers of a section, a number each, in one task."""
    v = variances(rows, [*section, uid]).where("variance is not null")
    return v.withColumn("rank", F.row_number().over(W.partitionBy(*section).orderBy(F.round("variance", 12).desc(), uid)))


def pearson(x: str, y: str) -> Column:
    """Pearson's r, null where either side does not vary."""
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    return F.when((F.var_pop(x) > 1e-18) & (F.var_pop(y) > 1e-18), r)


# -- correlations --------------------------------------------------------------------------------------------------------


def replicate_pearson(rows: DataFrame, section: list[str], uid: str) -> DataFrame:
    """Pearson's r of each two replicates of a sample over biomarkers with both values, three or more."""
    a = valued(rows).select(*section, uid, "grp", "sample", F.col("rep").alias("rep1"), F.col("value").alias("x"))
    b = valued(rows).select(*section, uid, "grp", "sample", F.col("rep").alias("rep2"), F.col("value").alias("y"))
    key = [*section, "grp", "sample"]
    two = a.join(b, [*key, uid]).where("rep1 < rep2")
    out = two.groupBy(*key, "rep1", "rep2").agg(F.count(F.lit(1)).alias("n"), pearson("x", "y").alias("pearson_r")).where("n >= 3")
    df = (F.col("n") - 2).cast("double")
    r = F.col("pearson_r")
    t = F.try_divide(r * F.sqrt(df), F.sqrt(F.greatest(F.lit(0.0), 1 - r * r)))
    return out.withColumn("pval", F.when(F.abs(r) >= 1, F.lit(0.0)).otherwise(pvalues.t_p(t, df)))


def sample_products(rows: DataFrame, section: list[str], uid: str, value: str = "v", sample: str = "s") -> DataFrame:
    """(section, s1, s2, n, x, y, xx, yy, xy): sums over biomarkers of each two samples' values and products, s1 <= s2.

    A biomarker is one row with its samples' values. A task adds up whole matrices of products, a section after another, so what is
    shuffled is a number of samples squared for each task and section, not for each biomarker. A biomarker without a row of a
    sample counts for the other samples only.
    """
    vectors = rows.groupBy(*section, uid).agg(F.sort_array(F.collect_list(F.struct(F.col(sample).alias("s"), F.col(value).cast("double").alias("v")))).alias("_x"))
    vectors = vectors.select(*section, F.col("_x.s").alias("s"), F.col("_x.v").alias("v")).sortWithinPartitions(*section, "s")
    width = len(section)

    def sums(batches):
        key, held = None, []

        def done():
            x = np.array(held)
            a = x.T @ x
            i, j = np.triu_indices(x.shape[1])
            total, square = x.sum(0), np.diag(a)
            names = key[-1]
            cols = [pa.array([k] * len(i), pa.string()) for k in key[:-1]]
            cols += [pa.array([names[q] for q in o], pa.string()) for o in (i, j)]
            cols += [pa.array(np.full(len(i), float(len(x)))), *(pa.array(c) for c in (total[i], total[j], square[i], square[j], a[i, j]))]
            return pa.RecordBatch.from_arrays(cols, [*section, *PRODUCTS])

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                now = (*row[:width], tuple(row[width]))
                if now != key or len(held) >= 4096:
                    if held:
                        yield done()
                    key, held = now, []
                held.append(row[width + 1])
        if held:
            yield done()

    kinds = ", ".join([*(f"{c} string" for c in section), "s1 string, s2 string", *(f"{c} double" for c in PRODUCTS[2:])])
    return vectors.mapInArrow(sums, kinds).groupBy(*section, "s1", "s2").agg(*(F.sum(c).alias(c) for c in PRODUCTS[2:]))


PRODUCTS = ["s1", "s2", "n", "x", "y", "xx", "yy", "xy"]


def sample_correlation(rows: DataFrame, section: list[str], uid: str) -> DataFrame:
    """Pearson's r of each two samples, nulls as 0, over biomarkers with any value; null where a sample does not vary."""
    live = rows.groupBy(*section, uid).agg(F.count("value").alias("_n")).where("_n > 0").select(*section, uid)
    v = rows.join(live, [*section, uid], "left_semi").select(*section, uid, F.concat_ws("::", "grp", "sample", "rep").alias("s"), F.coalesce("value", F.lit(0.0)).alias("v"))
    p = sample_products(v, section, uid).where("s1 < s2")
    vx, vy = (F.col(c * 2) / F.col("n") - (F.col(c) / F.col("n")) * (F.col(c) / F.col("n")) for c in "xy")
    r = (F.col("xy") / F.col("n") - F.col("x") / F.col("n") * (F.col("y") / F.col("n"))) / F.sqrt(vx * vy)
    return p.select(*section, F.col("s1").alias("sample1"), F.col("s2").alias("sample2"), F.when((vx > 1e-15) & (vy > 1e-15), r).alias("r"))


def biomarker_correlation(rows: DataFrame, section: list[str], uid: str, k: int = 50) -> DataFrame:
    """Pearson's r of each two of a section's k most variable biomarkers, over samples with both values."""
    top = top_variance(rows, section, uid, k).select(*section, uid)
    v = valued(rows).join(top, [*section, uid]).select(*section, uid, "grp", "sample", "rep", "value")
    key = [*section, "grp", "sample", "rep"]
    a = v.select(*key, F.col(uid).alias("uid1"), F.col("value").alias("x"))
    b = v.select(*key, F.col(uid).alias("uid2"), F.col("value").alias("y"))
    return a.join(b, key).where("uid1 < uid2").groupBy(*section, "uid1", "uid2").agg(F.count(F.lit(1)).alias("n"), pearson("x", "y").alias("r"))
