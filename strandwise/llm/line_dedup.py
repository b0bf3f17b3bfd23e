"""Line deduplication by site-relative frequency, in DataFrame functions only.

A line counts by its text without spaces and tabs around it; blank lines never count and always stay. A host's total is its
number of rows. A line that stands in at least `min_pages` rows of a host and in more than `ratio` of the host's rows is
boilerplate there and is dropped from each row of that host, all its occurrences; other hosts keep it.

A null text stays null and counts as a row of its host. A null host is a host of its own. Null or repeated ids are allowed:
rows are joined null-safely, and what is dropped depends on host and line alone. A row can be left with an empty text; no
row is dropped. Lines are compared by two independent hashes (96 bits). Empty tables give empty results; all other columns
pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._runtime import guarded, join_small, stored

RATIO, MIN_PAGES = 0.1, 4
BLANKS = " \t\r"


def _key(line: Column) -> Column:
    line = F.btrim(line, F.lit(BLANKS))
    return F.struct(F.xxhash64(line).alias("a"), F.hash(line).alias("b"))


def _full(line: Column) -> Column:
    return F.length(F.btrim(line, F.lit(BLANKS))) > 0


def line_dedup(docs: DataFrame, *, host: str, text: str = "text", doc_id: str = "doc_id", ratio: float = RATIO, min_pages: int = MIN_PAGES, counts: bool = False) -> DataFrame:
    """docs with boilerplate lines taken out of `text`; with counts also n_lines (not blank) and n_dropped, which replace columns of these names."""
    docs, back = guarded(docs)
    lines = docs.select(
        F.col(doc_id).alias("_sw_id"), F.col(host).alias("_sw_host"),
        F.explode(F.array_distinct(F.transform(F.filter(F.split(F.col(text), "\n", -1), _full), _key))).alias("_sw_line"),
    )
    totals = stored(docs.groupBy(F.col(host).alias("_sw_host")).agg(F.count(F.lit(1)).alias("_sw_total")), "host-totals")
    found = lines.groupBy("_sw_host", "_sw_line").agg(F.count(F.lit(1)).alias("_sw_n")).where(F.col("_sw_n") >= min_pages)
    bad = join_small(found, totals, "_sw_host").where(F.col("_sw_n") > F.lit(float(ratio)) * F.col("_sw_total"))
    bad = stored(bad.select(F.col("_sw_host").alias("_sw_h"), F.col("_sw_line").alias("_sw_l")), "boilerplate")
    hits = lines.join(bad, lines["_sw_host"].eqNullSafe(bad["_sw_h"]) & (lines["_sw_line"] == bad["_sw_l"]))
    hits = hits.groupBy("_sw_id", "_sw_host").agg(F.collect_set("_sw_line").alias("_sw_bad"))
    out = docs.join(hits, docs[doc_id].eqNullSafe(hits["_sw_id"]) & docs[host].eqNullSafe(hits["_sw_host"]), "left").drop("_sw_id", "_sw_host")
    split = F.split(F.col(text), "\n", -1)
    kept = F.filter(split, lambda x: ~F.array_contains(F.col("_sw_bad"), _key(x)) | ~_full(x))
    if counts:
        full = F.coalesce(F.size(F.filter(split, _full)), F.lit(0))
        out = out.withColumn("n_lines", full.cast("long"))
        out = out.withColumn("n_dropped", F.when(F.col("_sw_bad").isNull() | F.col(text).isNull(), F.lit(0)).otherwise(F.size(split) - F.size(kept)).cast("long"))
    return out.withColumn(text, F.when(F.col("_sw_bad").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))).drop("_sw_bad").withColumnsRenamed(back)


HOST = "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
#: What of a page is no text, and what ends a line in it.
NO_TEXT = "(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
LINE_END = "(?i)<(br|/?p|/?div|/?li|/?ul|/?h[1-6]|/?article|/?nav|/?title|/?tr|/?table|/?section|/?body|/?head)( [^>]*)?>"


def page_lines(pages: DataFrame, *, url: str = "url", html: str = "html") -> DataFrame:
    """pages with `host` (lower case; null without one) and `text`, one line a block."""
    text = F.regexp_replace(F.regexp_replace(F.col(html), NO_TEXT, ""), LINE_END, "\n")
    text = F.regexp_replace(F.regexp_replace(text, "<[^>]*>", ""), "\n[ \t\r\n]*\n", "\n")
    host = F.lower(F.regexp_extract(F.col(url), HOST, 1))
    return pages.withColumn("host", F.when(host != "", host)).withColumn("text", text)
