"""Multivariate steps: principal components of samples, importance and cross-validated classification.

Samples are few and biomarkers many, so what reaches the driver is a samples-by-samples matrix; a section's samples by its
chosen biomarkers (for importance all that its tiers choose) are one task's.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from . import stats
from .trees import boosted, forest, importances, voted

MAX_UIDS, MAX_SAMPLES, SEED = 500, 2000, 42
#: Sections that run at a time.
AT_ONCE = 4


def by_section(rows: DataFrame, step, tests: DataFrame | None = None, section: str = "section") -> DataFrame:
    """step(rows, tests) of each section, its results (a few hundred rows at most) under the section's name. A few sections run at a time."""
    names = [r[0] for r in rows.select(section).distinct().orderBy(section).collect()]

    def one(name: str):
        got = step(rows.where(F.col(section) == name), None if tests is None else tests.where(F.col(section) == name))
        return got.schema, [(name, *r) for r in got.collect()]

    with ThreadPoolExecutor(AT_ONCE) as pool:
        done = list(pool.map(one, names))
    if not done:
        return step(rows, tests).select(F.lit(None).cast("string").alias(section), "*").limit(0)
    schema = StructType([StructField(section, StringType()), *done[0][0].fields])
    return rows.sparkSession.createDataFrame([r for _, rs in done for r in rs], schema)


def _sample():
    return F.concat_ws("::", "grp", "sample", "rep")


def gram(rows: DataFrame, uid: str = "uid", section: tuple[str, ...] = ()) -> DataFrame:
    """Inner products of a section's samples over biomarkers, nulls as 0, each biomarker standardised (population deviation; without one, 0)."""
    by = [*section, uid]
    live = rows.groupBy(*by).agg(F.count("value").alias("_n"), F.avg(F.coalesce("value", F.lit(0.0))).alias("_m"), F.stddev_pop(F.coalesce("value", F.lit(0.0))).alias("_s")).where("_n > 0")
    z = rows.join(live, by).select(*by, _sample().alias("s"), F.when(F.col("_s") > 0, (F.coalesce("value", F.lit(0.0)) - F.col("_m")) / F.col("_s")).otherwise(0.0).alias("v"))
    return stats.sample_products(z, [*section], uid).select(*section, "s1", "s2", F.col("xy").alias("g"))


def _components(names: list[str], products: list[tuple[str, str, float]], most: int, shown: int) -> tuple[list[tuple], list[tuple]]:
    """(sample, component, value) and (component, explained, cumulative) of samples' inner products."""
    if len(names) < 2:
        return [], []
    k = min(most, len(names))
    at = {n: i for i, n in enumerate(names)}
    g = np.zeros((len(names), len(names)))
    for s1, s2, v in products:
        g[at[s1], at[s2]] = g[at[s2], at[s1]] = v
    value, vector = np.linalg.eigh(g)
    order = np.argsort(-value)[:k]
    value, vector = np.maximum(value[order], 0), vector[:, order]
    vector = vector * np.sign(vector[np.abs(vector).argmax(0), np.arange(k)])
    share = value / max(1e-300, np.trace(g))
    coords = [(n, j + 1, float(vector[i, j] * np.sqrt(value[j]))) for i, n in enumerate(names) for j in range(min(shown, k))]
    return coords, [(j + 1, float(share[j]), float(share[: j + 1].sum())) for j in range(k)]


def principal_components(rows: DataFrame, uid: str = "uid", most: int = 10, shown: int = 5) -> tuple[DataFrame, DataFrame]:
    """Coordinates of samples on the first components, and each component's share of variance with its running sum."""
    spark = rows.sparkSession
    names = [r[0] for r in rows.select(_sample().alias("s")).distinct().orderBy("s").limit(MAX_SAMPLES + 1).collect()]
    if len(names) > MAX_SAMPLES:
        raise ValueError(f"more than {MAX_SAMPLES} samples")
    products = [tuple(r) for r in gram(rows, uid).collect()] if len(names) > 1 else []  # at most MAX_SAMPLES squared numbers
    coords, parts = _components(names, products, most, shown)
    return spark.createDataFrame(coords, "sample string, component int, value double"), spark.createDataFrame(parts, "component int, explained double, cumulative double")


def explained_by_section(rows: DataFrame, uid: str = "uid", most: int = 10, section: str = "section") -> DataFrame:
    """Each section's components with their shares of variance: one pass over the rows for all sections, and their matrices of samples in tasks of their own."""
    sizes = rows.select(section, _sample().alias("s")).distinct().groupBy(section).agg(F.sort_array(F.collect_list("s")).alias("names"))
    products = gram(rows, uid, (section,)).groupBy(section).agg(F.collect_list(F.struct("s1", "s2", "g")).alias("g"))

    def solve(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                if len(r["names"]) > MAX_SAMPLES:
                    raise ValueError(f"more than {MAX_SAMPLES} samples")
                found = _components(r["names"], [(x["s1"], x["s2"], x["g"]) for x in r["g"] or []], most, 0)[1]
                out += [(r["section"], *x) for x in found]
            cols = list(zip(*out, strict=True)) or [(), (), (), ()]
            types = (pa.string(), pa.int32(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], [section, "component", "explained", "cumulative"])

    both = sizes.join(products, section, "left").select(F.col(section).alias("section"), "names", "g")
    return both.mapInArrow(solve, f"{section} string, component int, explained double, cumulative double")


def batch_components(rows: DataFrame, uid: str = "uid") -> DataFrame:
    """Samples on the first three components with their group and sample, to see whether batches part them: grp, sample, rep, component, value.

    Empty with fewer than three samples or two biomarkers.
    """
    schema = "grp string, sample string, rep string, component int, value double"
    few = rows.agg(F.countDistinct(_sample()).alias("s"), F.countDistinct(uid).alias("u")).first()
    if few["s"] < 3 or few["u"] < 2:
        return rows.sparkSession.createDataFrame([], schema)
    coords, _ = principal_components(rows, uid, most=3, shown=3)
    part = F.split("sample", "::")
    return coords.select(part[0].alias("grp"), part[1].alias("sample"), part[2].alias("rep"), "component", "value")


def sample_clusters(rows: DataFrame, uid: str = "uid") -> DataFrame:
    """Merges of samples by Ward clustering on their first components: first, second, height."""
    coords, _ = principal_components(rows, uid)
    points: dict[str, dict[int, float]] = {}
    for r in coords.collect():  # at most MAX_SAMPLES samples of five numbers
        points.setdefault(r["sample"], {})[r["component"]] = r["value"]
    merges = ward_order({s: np.array([v[c] for c in sorted(v)]) for s, v in points.items()}) if len(points) > 1 else []
    return rows.sparkSession.createDataFrame(merges, "first string, second string, height double")


def selected_by_section(rows: DataFrame, tests: DataFrame | None, uid: str = "uid", filters: tuple[str, ...] = ("primary",), max_uids: int | None = None, raw: bool = True, section: str = "section") -> DataFrame:
    """Biomarkers of each section for learning, with their place from 1, by tiers: adjusted p below 0.05 in the filters' order, then (raw) plain p, then, with fewer than ten, variance.

    max_uids: the first so many of a section only; None: all of them.
    """
    by = [section, uid]
    found = []
    for i, f in enumerate(filters if tests is not None else ()):
        mine = tests.where(F.col("test") == f)
        found.append(mine.where("padj < 0.05").select(*by, F.lit(i).alias("tier"), F.col("padj").alias("worth")))
        if raw:
            found.append(mine.where("pval < 0.05").select(*by, F.lit(100 + i).alias("tier"), F.col("pval").alias("worth")))
    tiers = reduce(DataFrame.unionByName, found) if found else None
    if tiers is not None:
        enough = tiers.groupBy(section).agg(F.countDistinct(uid).alias("_n")).where("_n >= 10").select(section)
        rows = rows.join(F.broadcast(enough), section, "left_anti")  # a name a section
    by_variance = stats.variances(rows, by).where("variance is not null").select(*by, F.lit(1000).alias("tier"), (-F.col("variance")).alias("worth"))
    tiers = by_variance if tiers is None else tiers.unionByName(by_variance)
    best = tiers.groupBy(*by).agg(F.min(F.struct("tier", "worth")).alias("b"))
    place = F.row_number().over(W.partitionBy(section).orderBy("b.tier", "b.worth", uid))
    best = best.withColumn("place", place).select(*by, "place")
    return best if max_uids is None else best.where(F.col("place") <= max_uids)


def selected(rows: DataFrame, tests: DataFrame | None, uid: str = "uid", filters: tuple[str, ...] = ("primary",), max_uids: int | None = None, raw: bool = True) -> DataFrame:
    """The same of one section's rows."""
    one = F.lit("").alias("_section")
    found = selected_by_section(rows.select("*", one), None if tests is None else tests.select("*", one), uid, filters, max_uids, raw, "_section")
    return found.orderBy("place").select(uid)


def _learned(rows: DataFrame, chosen: DataFrame, learn, schema: str, uid: str, section: str) -> DataFrame:
    """learn(uids, x, y) -> rows of each section: x has a row a sample and a column a chosen biomarker (null as 0), y is the group's number.

    Sections of under 2 biomarkers, 4 samples or 2 groups have no rows. A section is one task's, of its chosen biomarkers times MAX_SAMPLES numbers at most.
    """
    cells = rows.where("grp is not null").join(chosen, [section, uid]).select(F.col(section).alias("section"), F.col(uid).alias("uid"), "place", _sample().alias("s"), "grp", F.col("value").cast("double").alias("value"))
    columns = [(section, "string"), *(tuple(c.split()) for c in schema.split(", "))]
    kinds = pa.schema([(n, {"string": pa.string(), "int": pa.int32(), "double": pa.float64()}[k]) for n, k in columns])

    def coded(column: pa.ChunkedArray) -> tuple[list, np.ndarray]:
        """Distinct values, and the place of each row's among them."""
        c = column.combine_chunks().dictionary_encode()
        return c.dictionary.to_pylist(), c.indices.to_numpy(zero_copy_only=False).astype(np.int64)

    def one(table: pa.Table) -> pa.Table:
        (samples, s), (of, g) = coded(table.column("s")), coded(table.column("grp"))
        _, first, j = np.unique(table.column("place").to_numpy(), return_index=True, return_inverse=True)
        pairs, i = np.unique(s * len(of) + g, return_inverse=True)
        names = [(samples[p // len(of)], of[p % len(of)]) for p in pairs.tolist()]
        order = sorted(range(len(names)), key=names.__getitem__)
        groups = sorted({g for _, g in names})
        found = []
        if len(first) >= 2 and len(names) >= 4 and len(groups) >= 2:
            if len(names) > MAX_SAMPLES:
                raise ValueError(f"more than {MAX_SAMPLES} samples")
            i = np.argsort(order)[i]
            if len(np.unique(i * len(first) + j)) < len(i):
                raise ValueError("a sample has several values of a biomarker")
            x = np.zeros((len(names), len(first)))
            x[i, j] = np.nan_to_num(table.column("value").to_numpy(), nan=0.0, posinf=np.inf, neginf=-np.inf)
            found = learn(table.column("uid").take(pa.array(first)).to_pylist(), x, np.array([groups.index(names[n][1]) for n in order]))
        found = list(zip(*found, strict=True)) or [()] * (len(kinds) - 1)
        name = table.column("section")[0].as_py()
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip([[name] * len(found[0]), *found], kinds.types, strict=True)], schema=kinds)

    return cells.groupBy("section").applyInArrow(one, ", ".join(f"{n} {k}" for n, k in columns))


def _alone(step, rows: DataFrame, tests: DataFrame | None, **how) -> DataFrame:
    """A step by sections on the rows of one."""
    one = F.lit("").alias("_section")
    return step(rows.select("*", one), None if tests is None else tests.select("*", one), section="_section", **how).drop("_section")


def importance_by_section(rows: DataFrame, tests: DataFrame | None = None, uid: str = "uid", trees: int = 100, depth: int = 10, max_uids: int | None = None, filters: tuple[str, ...] = ("primary",), section: str = "section", keep=None) -> DataFrame:
    """Random forest importance of each section's chosen biomarkers, all of them unless max_uids is given; none with under 4 samples, 2 biomarkers or 2 groups. A section's forest grows in one task.

    keep(table, name), such as plans.store.kept, stores the choice, so that Spark knows whether it is small enough to broadcast.
    """

    def learn(uids, x, y):
        grown = forest(x, y, y.max() + 1, trees, depth, SEED)
        return [(u, float(v)) for u, v in zip(uids, importances(grown), strict=True)]

    chosen = selected_by_section(rows, tests, uid, filters, max_uids, section=section)
    return _learned(rows, chosen if keep is None else keep(chosen, "chosen"), learn, f"{uid} string, importance double", uid, section)


def importance(rows: DataFrame, tests: DataFrame | None = None, uid: str = "uid", trees: int = 100, depth: int = 10, max_uids: int | None = None, filters: tuple[str, ...] = ("primary",)) -> DataFrame:
    """The same of one section's rows."""
    return _alone(importance_by_section, rows, tests, uid=uid, trees=trees, depth=depth, max_uids=max_uids, filters=filters)


def _discriminant(x: np.ndarray, y: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Linear discriminant analysis with a pooled covariance (a little ridge), for few samples: its inverse by the samples' singular vectors, not as a matrix of biomarkers."""
    classes = np.unique(y)
    means = np.stack([x[y == c].mean(0) for c in classes])
    centred = (x - means[np.searchsorted(classes, y)]) / np.sqrt(max(1, len(x) - len(classes)))
    prior = np.log([np.mean(y == c) for c in classes])
    ridge = 1e-6 * (centred * centred).sum() / x.shape[1]
    if ridge == 0:  # nothing varies within a group
        return classes[np.broadcast_to(prior, (len(q), len(classes))).argmax(1)]
    _, s, v = np.linalg.svd(centred, full_matrices=False)
    inside = means @ v.T
    solved = (means - inside @ v) / ridge + inside / (s * s + ridge) @ v
    return classes[(q @ solved.T - 0.5 * (means * solved).sum(1) + prior).argmax(1)]


def folds(labels: list[float], k: int, seed: int = SEED) -> list[int]:
    """A fold for each sample: each alone with fewer than ten, else stratified."""
    if len(labels) < 10:
        return list(range(len(labels)))
    rng, out = np.random.default_rng(seed), [0] * len(labels)
    for c in sorted(set(labels)):
        for i, s in enumerate(rng.permutation([j for j, y in enumerate(labels) if y == c])):
            out[s] = i % k
    return out


def cross_validated_by_section(rows: DataFrame, tests: DataFrame | None = None, uid: str = "uid", trees: int = 50, depth: int = 10, rounds: int = 50, max_uids: int = MAX_UIDS, filters: tuple[str, ...] = ("primary",), section: str = "section") -> DataFrame:
    """Accuracy (mean, deviation) in each section of a random forest, of boosted trees (two groups) and of a linear discriminant over folds. A section is one task's."""

    def learn(uids, x, y):
        classes = int(y.max()) + 1
        fold = np.array(folds(y.tolist(), max(2, min(5, int(np.bincount(y).min())))))
        hits: dict[str, list[float]] = {}
        for f in sorted(set(fold.tolist())):
            inside = fold != f
            given, known, asked = x[inside], y[inside], x[~inside]
            if len(set(known.tolist())) < 2:
                continue
            said = {"random_forest": voted(forest(given, known, classes, trees, depth, SEED), asked)}
            if classes == 2:
                said["gradient_boosting"] = boosted(given, known, asked, rounds)
            if len(x) > classes:
                said["linear_discriminant"] = _discriminant(given, known, asked)
            for name, s in said.items():
                hits.setdefault(name, []).append(float((s == y[~inside]).mean()))
        return [(n, len(v), float(np.mean(v)), float(np.std(v))) for n, v in hits.items()]

    chosen = F.broadcast(selected_by_section(rows, tests, uid, filters, max_uids, False, section))  # at most max_uids a section
    return _learned(rows, chosen, learn, "model string, folds int, accuracy double, std double", uid, section)


def cross_validated(rows: DataFrame, tests: DataFrame | None = None, uid: str = "uid", trees: int = 50, depth: int = 10, rounds: int = 50, max_uids: int = MAX_UIDS, filters: tuple[str, ...] = ("primary",)) -> DataFrame:
    """The same of one section's rows."""
    return _alone(cross_validated_by_section, rows, tests, uid=uid, trees=trees, depth=depth, rounds=rounds, max_uids=max_uids, filters=filters)


def ward_order(points: dict[str, np.ndarray]) -> list[tuple[str, str, float]]:
    """Merges (least names of the two clusters, height) of Ward clustering of few samples."""
    clusters = {n: (1, p) for n, p in points.items()}
    out = []
    while len(clusters) > 1:
        names = sorted(clusters)
        best = min(((np.sqrt(2 * clusters[a][0] * clusters[b][0] / (clusters[a][0] + clusters[b][0])) * np.linalg.norm(clusters[a][1] - clusters[b][1]), a, b) for i, a in enumerate(names) for b in names[i + 1 :]))
        d, a, b = best
        (na, pa), (nb, pb) = clusters.pop(a), clusters.pop(b)
        clusters[min(a, b)] = (na + nb, (na * pa + nb * pb) / (na + nb))
        out.append((a, b, float(d)))
    return out
