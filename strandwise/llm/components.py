"""Connected components of a link table, wholly in Spark: least labels, hooking and shortcutting, a stored table a step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._runtime import remove, stored


def components(links: DataFrame) -> DataFrame:
    """(id, label) of every id in links (a, b): label is the least id reachable. Links of an id with itself are allowed.

    Each step sends labels along links, hooks roots to lesser labels and halves the paths, so the number of steps grows with
    the logarithm of a component's diameter. Sums are made before the shuffle and both sides of each join are stored tables, so
    that Spark can split a hub's rows. Tables are written in as many files as their rows need.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    rows = both.count()
    label = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("label")), "labels", rows)
    while True:
        seen = both.join(label.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        now = stored(label.join(seen, "id").select("id", "label", F.least("label", "near").alias("near")), "near", rows)
        sent = now.select("id", F.col("near").alias("label")).union(now.where("near < label").select(F.col("label").alias("id"), F.col("near").alias("label")))
        hooked = stored(sent.groupBy("id").agg(F.min("label").alias("label")), "hooked", rows)
        up = hooked.select(F.col("id").alias("label"), F.col("label").alias("upper"))
        short = stored(hooked.join(up, "label", "left").select("id", F.least("label", "upper").alias("label")), "labels", rows)
        changed = now.where("near < label").limit(1).count() or hooked.join(short.withColumnRenamed("label", "s"), "id").where("s < label").limit(1).count()
        remove(now)
        remove(hooked)
        remove(label)
        label = short
        if not changed:
            remove(both)
            return label


def merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """label after more links (a, b) are known: only what they join is computed anew."""
    named = label.select(F.col("id").alias("_id"), F.col("label").alias("_l"))
    for c in "ab":
        links = links.join(named.withColumnRenamed("_id", f"_{c}").withColumnRenamed("_l", f"_l{c}"), F.col(c) == F.col(f"_{c}"), "left")
    links = links.select("a", "b", F.coalesce("_la", "a").alias("la"), F.coalesce("_lb", "b").alias("lb"))
    links = stored(links, "new-links")
    top = components(links.select(F.col("la").alias("a"), F.col("lb").alias("b")))
    old = label.union(links.select("a", "la")).union(links.select("b", "lb")).distinct()
    out = old.join(top.select(F.col("id").alias("_t"), F.col("label").alias("_top")), F.col("label") == F.col("_t"), "left")
    out = stored(out.select("id", F.coalesce("_top", "label").alias("label")), "labels", label.count())
    remove(links)
    remove(top)
    return out
