"""One query an operator, with production parameters over its whole table, and SQL where it can express the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import graph_search, line_dedup, mixing, ngram_join, packing, quality_model, quality_rules, substring_dedup, tokens, toxicity
from ._runtime import stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn=~held_out())
    out = toxicity.toxicity(docs, model, out="t")
    score = F.col("t.score")
    return out.select("doc_id", held_out().alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), F.col("t.n_passages").alias("n_passages"), F.col("t.least_e").alias("least_e"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = ngram_join.near_duplicates(docs, words=3, percent=90)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mixing_plan(docs).select("doc_id", "size", "source_size", "target", "taken")


OP3 = r"""
with d as (select doc_id, source, text, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size from documents),
s as (select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source asc nulls last) - 1 as i from d group by source),
w as (select *, case i % 3 when 0 then 3 when 1 then 1 else 2 end as w from s),
c as (select *, coalesce(sum(2 * source_size) over o, 0) as c, sum(w) over () - coalesce(sum(w) over o, 0) as l, sum(source_size) over () as a from w
  window o as (order by source_size / w, i rows between unbounded preceding and 1 preceding)),
f as (select *, (150 * a - 100 * c) * w > 200 * source_size * l as over from c),
t as (select source, source_size, case when over or source_size = 0 then cast(2 * source_size as double)
  else cast(w * (150 * a - 100 * sum(case when over then 2 * source_size else 0 end) over ()) as double)
    / cast(100 * sum(case when over then 0 else w end) over () as double) end as target from f),
r as (select d.doc_id, d.size, t.source_size, t.target, case when t.source_size > 0 then t.target / t.source_size else 0.0 end as rate,
  cast('0x' || substr(md5('mix-1:' || coalesce(cast(d.doc_id as varchar), 't' || md5(coalesce(d.text, '')))), 1, 8) as bigint) / 4294967296.0 as u
  from d join t on d.source is not distinct from t.source)
select doc_id, size, source_size, target, cast(size * (floor(rate) + case when u < rate - floor(rate) then 1 else 0 end) as bigint) as taken from r
"""


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.substring_dedup(docs).withColumnRenamed("id", "doc_id")


def op5_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    _, scorer = quality_model.fit(docs)
    out = quality_model.quality_scores(docs, scorer, out="score")
    return out.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = tokens.token_counts(docs)
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return out.select("doc_id", n_bytes.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out, _ = quality_rules.quality_rules(docs, table(spark, sf_dir, "labels"))
    return out.select("doc_id", *quality_rules.COUNTS, "base_failed", "rule", "kept")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = line_dedup.page_lines(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "host", "text")
    pages = stored(pages, "page-lines")  # three scans need the text, the patterns run once
    out = line_dedup.line_dedup(pages, host="host", doc_id="page_id", counts=True)
    return out.select("page_id", "host", "n_lines", "n_dropped", F.md5("text").alias("kept_md5"))


OP8 = r"""
with p as (select page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '') as host,
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', '', 'g'),
    '(?i)<(br|/?p|/?div|/?li|/?ul|/?h[1-6]|/?article|/?nav|/?title|/?tr|/?table|/?section|/?body|/?head)( [^>]*)?>', chr(10), 'g'),
    '<[^>]*>', '', 'g'), '\n[ \t\r\n]*\n', chr(10), 'g') as text from pages),
l as (select page_id, host, unnest(string_split(text, chr(10))) as line from p),
k as (select page_id, host, trim(line, ' ' || chr(9) || chr(13)) as line from l),
n as (select host, count(*) as total from p group by host),
b as (select k.host, line from (select host, line, count(distinct page_id) as c from k where line <> '' group by host, line) k
  join n on n.host is not distinct from k.host where c >= 4 and c > 0.1 * total),
g as (select host, list(line) as bad from b group by host),
r as (select p.page_id, p.host, string_split(p.text, chr(10)) as lines, coalesce(g.bad, []) as bad from p left join g on p.host is not distinct from g.host),
s as (select page_id, host, lines, list_filter(lines, lambda x: trim(x, ' ' || chr(9) || chr(13)) = '' or not list_contains(bad, trim(x, ' ' || chr(9) || chr(13)))) as kept from r)
select page_id, host, cast(len(list_filter(lines, lambda x: trim(x, ' ' || chr(9) || chr(13)) <> '')) as bigint) as n_lines,
  cast(len(lines) - len(kept) as bigint) as n_dropped, md5(array_to_string(kept, chr(10))) as kept_md5 from s
"""


def op9_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return graph_search.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.packing(docs)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_ngram_join, op3_mixing, op4_substring_dedup, op5_quality_model,
        op6_token_counts, op7_quality_rules, op8_line_dedup, op9_graph_search, op10_packing,
    )
}
ORACLES: dict[str, str] = {"op3_mixing": OP3, "op8_line_dedup": OP8}
