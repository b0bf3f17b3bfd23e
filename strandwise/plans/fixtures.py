"""Deterministic views over the test tables that play the roles of sites, features and samples; the SQL runs in Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SITES = """
with raw as (
  select cast(l_orderkey % 12 as int) as sample_idx,
         concat('chr', cast(l_linenumber % 3 + 1 as varchar(4))) as seqid,
         cast(l_partkey * 5 + l_suppkey % 5 as int) as pos,
         case l_returnflag when 'A' then 1 when 'N' then -1 else 0 end as strand,
         cast(l_quantity as int) as q, cast(l_orderkey % 5 as int) as e, cast(l_suppkey % 3 as int) as k
  from lineitem),
r2 as (select *, case when pos % 97 = 0 then 4 else pos % 4 end as ref, (pos % 4 + 1 + k) % 4 as alt from raw)
select sample_idx, seqid, pos, strand, ref,
  cast(sum((case when ref = 0 then q else 0 end) + (case when alt = 0 then e else 0 end)) as bigint) as fa,
  cast(sum((case when ref = 1 then q else 0 end) + (case when alt = 1 then e else 0 end)) as bigint) as fc,
  cast(sum((case when ref = 2 then q else 0 end) + (case when alt = 2 then e else 0 end)) as bigint) as fg,
  cast(sum((case when ref = 3 then q else 0 end) + (case when alt = 3 then e else 0 end)) as bigint) as ft,
  cast(sum(q + e) as bigint) as coverage
from r2 group by sample_idx, seqid, pos, strand, ref
"""

FEATURES = """
with g as (
  select cast(s_suppkey as int) as gid, concat('chr', cast(s_suppkey % 3 + 1 as varchar(4))) as seqid,
         cast(s_suppkey * 90 as int) as st,
         case when s_suppkey % 11 = 0 then 0 when s_nationkey % 2 = 0 then 1 else -1 end as strand,
         case s_suppkey % 3 when 0 then 'gene' when 1 then 'ncRNA_gene' else 'pseudogene' end as gtype
  from supplier),
t as (
  select g.*, x.k as k, concat('g', cast(gid as varchar(10))) as g_id,
         concat('g', cast(gid as varchar(10)), 't', cast(x.k as varchar(4))) as t_id,
         st + 20 * x.k as t_st, st + 400 - 10 * x.k as t_en
  from g cross join (values (0), (1), (2)) as x(k)),
e as (
  select t.*, y.j as j, t_st + 90 * y.j as e_st, t_st + 90 * y.j + 40 + 7 * ((gid + k + y.j) % 5) as e_en
  from t cross join (values (0), (1), (2), (3)) as y(j))
select seqid, concat('g', cast(gid as varchar(10))) as feature_id, cast(null as varchar(40)) as parent_id, gtype as type, 1 as level,
       st as start0, st + 400 as end0, strand, gid * 1000 as file_order from g
union all
select seqid, t_id, g_id, case when gtype = 'gene' then 'mRNA' else 'lnc_RNA' end, 2, t_st, t_en, strand, gid * 1000 + k * 100 + 1 from t
union all
select seqid, concat(t_id, 'e', cast(j as varchar(4))), t_id, 'exon', 3, e_st, e_en, strand, gid * 1000 + k * 100 + 10 + j from e
union all
select seqid, concat(t_id, 'c', cast(j as varchar(4))), t_id, 'CDS', 3, e_st + 10, e_en - 5, strand, gid * 1000 + k * 100 + 50 + j
from e where gtype = 'gene' and k < 2 and j between 1 and 2
"""

SAMPLES = """
select x.i as sample_idx, case x.i % 3 when 0 then 'ctrl' when 1 then 'low' else 'high' end as grp,
  concat('s', cast(x.i % 2 + 1 as varchar(4))) as sample, case when x.i < 6 then 'rep1' else 'rep2' end as rep
from (values (0),(1),(2),(3),(4),(5),(6),(7),(8),(9),(10),(11)) as x(i)
"""

#: Chains of seven features, one under the other, and a place for each.
DEEP = """
select cast(p_partkey + 1 as bigint) as n from part
"""

#: A sheet of runs with all kinds of faults.
SHEET = """
select cast(s_suppkey as bigint) as n,
  case when s_suppkey % 11 = 0 then null else concat('grp', cast(s_suppkey % 3 as varchar(4))) end as "group",
  case s_suppkey % 7 when 0 then null when 1 then concat('data/run', cast(s_suppkey as varchar(10)), '.bam') when 2 then concat('https://x.org/run', cast(s_suppkey as varchar(10)), '_R1.fastq.gz')
    when 3 then '/data/notes.txt' else concat('/data/run', cast(s_suppkey as varchar(10)), '_R1.fq.gz') end as input_1,
  case when s_suppkey % 5 < 2 then concat('/data/run', cast(s_suppkey as varchar(10)), '_R2.fq.gz') when s_suppkey % 23 = 0 then '/data/x.txt' end as input_2,
  case when s_suppkey % 13 = 0 then ' ' else 'ISR' end as strandedness,
  case s_suppkey % 4 when 0 then 'short_paired' when 1 then 'Short_Single' when 2 then 'ont' else case when s_suppkey % 3 = 0 then 'odd' end end as read_type,
  case when s_suppkey % 2 = 0 then concat('s', cast(s_suppkey % 9 as varchar(4))) end as sample, case when s_suppkey % 6 < 4 then 'rep2' end as replicate
from supplier
"""

#: A table of adjusted p-values of several tests and sections, for rankings.
TESTS = """
select concat('sec', cast(l_linenumber % 4 as varchar(4))) as section, concat('u', cast(l_partkey as varchar(10))) as uid,
  case l_suppkey % 3 when 0 then 'primary' when 1 then 'anova' else 'welch' end as test,
  case l_returnflag when 'A' then 'ctrl_vs_high' when 'N' then 'ctrl_vs_low' else 'high_vs_low' end as comparison,
  min(cast(l_orderkey % 1000 + 1 as double) / 1000.0) as pval, min(cast(l_orderkey % 500 + 1 as double) / 500.0) as padj
from lineitem group by 1, 2, 3, 4
"""


def tables(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for n in names:
        spark.read.parquet(f"{sf_dir}/{n}.parquet").createOrReplaceTempView(n)


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables(spark, sf_dir, "lineitem")
    return spark.sql(SITES)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables(spark, sf_dir, "supplier")
    return spark.sql(FEATURES)


def samples(spark: SparkSession) -> DataFrame:
    return spark.sql(SAMPLES)


def deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of chains of seven features."""
    tables(spark, sf_dir, "part")
    root = "(n - (n - 1) % 7)"
    return spark.sql(f"""select concat('chr', cast({root} % 3 + 1 as varchar(4))) as seqid, concat('d', cast(n as varchar(10))) as feature_id,
      case when n % 7 <> 1 then concat('d', cast(n - 1 as varchar(10))) end as parent_id, concat('k', cast((n - 1) % 7 + 1 as varchar(4))) as type,
      cast(n * 10 as int) as start0, cast(n * 10 + 7 as int) as end0, 1 as strand, n as file_order from ({DEEP})""")


def sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables(spark, sf_dir, "supplier")
    return spark.sql(SHEET.replace('"group"', "`group`"))


def tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables(spark, sf_dir, "lineitem")
    return spark.sql(TESTS)
