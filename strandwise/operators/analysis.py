"""All statistics of all sections in one go: a table a statistic, whatever the number of sections."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import multivariate, sections, stats

#: The steps, in order; filter1 takes out what does not vary, filter2 keeps the most variable of a section.
STEPS = ("filter1", "filter2", "qc", "batch", "descriptive", "multivariate", "differential", "correlation", "ranking", "classification", "stability", "heatmap")
MOST = 10_000


def analysed(rows: DataFrame, enabled: list[str] | None = None, choice: str = "nonparametric", max_uids: int | None = None, filters: tuple[str, ...] = ("primary", "kruskal", "welch", "anova"), keep=None) -> dict[str, DataFrame]:
    """Tables by name of a long table (section, uid, grp, sample, rep, value). enabled: the steps to run (None: all); unknown ones are warned of.

    choice: how the primary test is chosen. max_uids: the most that learning selects in a section (None: all for importance,
    MAX_UIDS for classification). filters: tests by which it selects, in order. keep(table, name), such as
    plans.store.kept, stores what several steps read. Sections whose biomarkers all go have no rows in any table.
    """
    unknown = [s for s in enabled or [] if s not in STEPS]
    if unknown:
        warnings.warn(f"unknown steps: {', '.join(unknown)}", stacklevel=2)
    on = set(enabled or STEPS)
    keep = keep or (lambda df, name: df)
    section, uid, by, sample = ["section"], "uid", ["section", "uid"], ["section", "grp", "sample", "rep"]
    out: dict[str, DataFrame] = {}
    if on & {"filter1", "filter2"}:
        rows = sections.filtered(rows, section, uid, 1e-10 if "filter1" in on else -1.0, MOST if "filter2" in on else None)
    rows = keep(rows, "analysed")
    out["data"] = rows
    tests = None
    if "qc" in on:
        out |= {"missing": stats.missing(rows, sample), "describe": stats.describe(rows, sample)}
    if "batch" in on:
        out["batch"] = multivariate.by_section(rows, lambda r, _: multivariate.batch_components(r))
    if "descriptive" in on:
        out |= {"group_statistics": stats.group_statistics(rows, ["section", "grp"]), "group_means": stats.group_means(rows, by), "coefficient_of_variation": stats.coefficient_of_variation(rows, by)}
    if "multivariate" in on:
        out["components"] = multivariate.by_section(rows, lambda r, _: multivariate.principal_components(r)[0])
        out["explained"] = multivariate.explained_by_section(rows)
        out["clusters"] = multivariate.by_section(rows, lambda r, _: multivariate.sample_clusters(r))
    if "differential" in on:
        tests = keep(stats.global_tests(rows, by, section, choice), "global-tests")
        pairs = keep(stats.pairwise_tests(rows, by, section, choice), "pairwise-tests")
        compared = pairs.withColumn("comparison", F.concat_ws("_vs_", "grp1", "grp2"))
        primary = compared.where("test = 'primary'")
        out |= {
            "global_tests": tests, "pairwise_tests": pairs, "fold_changes": stats.fold_changes(stats.pairs(rows, by), by), "significant": stats.significant(tests, by),
            "unique_common": stats.unique_and_common(primary, by, "comparison"), "common_pairs": stats.common_pairs(primary, by, "comparison"),
        }
    if "correlation" in on:
        out |= {"sample_correlation": stats.sample_correlation(rows, section, uid), "biomarker_correlation": stats.biomarker_correlation(rows, section, uid)}
    if "ranking" in on:
        out["importance"] = multivariate.importance_by_section(rows, tests, max_uids=max_uids, filters=filters, keep=keep)
        out["variance_ranking"] = stats.variance_ranking(rows, section, uid)
        if tests is not None:
            out["kruskal_ranking"] = stats.ranking(tests, section)
    if "classification" in on:
        out["classification"] = multivariate.cross_validated_by_section(rows, tests, max_uids=multivariate.MAX_UIDS if max_uids is None else max_uids, filters=filters)
    if "stability" in on:
        out["stability"] = stats.replicate_pearson(rows, section, uid)
    if "heatmap" in on:
        out["heatmap"] = stats.top_variance(rows, section, uid, 50)
    return out
