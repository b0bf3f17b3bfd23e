"""The engine's queries in plain SQL for another database, written apart from the operators."""

from __future__ import annotations

from . import fixtures

COV, EDIT = 10, 2
ACGT = "ACGT"
PAIRS = [(i, j, x + y) for i, x in enumerate(ACGT) for j, y in enumerate(ACGT)]


def _ctes(*parts: str) -> str:
    return "with recursive " + ",\n".join(CTE[p].strip() for p in parts) + "\n"


def _big(e: str) -> str:
    return f"cast({e} as bigint)"


#: Counter columns from per-site g rows (ref, ra, rc, rg, rt, q).
SUMS = ", ".join(
    [f"{_big(f'sum(case when ref = {i} then 1 else 0 end)')} as obs_{b}" for i, b in enumerate("ACGTN")]
    + [f"{_big(f'sum(case when ref = {i} then q else 0 end)')} as qual_{b}" for i, b in enumerate("ACGTN")]
    + [f"{_big(f'sum(case when ref = {i} and r{ACGT[j].lower()} > 0 then 1 else 0 end)')} as site_{p}" for i, j, p in PAIRS]
    + [f"{_big(f'sum(case when ref = {i} then r{ACGT[j].lower()} else 0 end)')} as read_{p}" for i, j, p in PAIRS]
)
NAMES = [f"obs_{b}" for b in "ACGTN"] + [f"qual_{b}" for b in "ACGTN"] + [f"site_{p}" for _, _, p in PAIRS] + [f"read_{p}" for _, _, p in PAIRS]
AGAIN = ", ".join(f"{_big(f'sum({n})')} as {n}" for n in NAMES)
QUALIFIED = "qual_A + qual_C + qual_G + qual_T + qual_N"


def _vec(names: list[str], zero: bool = False) -> str:
    return "concat_ws(',', " + ", ".join(f"coalesce({n}, 0)" if zero else n for n in names) + ")"


def _vectors(zero: bool = False) -> str:
    return (
        f"{_vec([f'obs_{b}' for b in ACGT], zero)} as observed_bases, {_vec([f'qual_{b}' for b in ACGT], zero)} as qualified_bases, "
        f"{_vec([f'site_{p}' for _, _, p in PAIRS], zero)} as site_pairings, {_vec([f'read_{p}' for _, _, p in PAIRS], zero)} as read_pairings"
    )


VECTORS = _vectors()


def _keep(i: int, f: str) -> str:
    return f"case when coverage >= {COV} and (ref = {i} or {f} >= {EDIT}) then {f} else 0 end as r{ACGT[i].lower()}"


CTE = {
    "sites": f"fx_sites as ({fixtures.SITES})",
    "features": f"fx_features as ({fixtures.FEATURES})",
    "samples": f"fx_samples as ({fixtures.SAMPLES})",
    "tests": f"fx_tests as ({fixtures.TESTS})",
    "g": f"g as (select *, case when coverage >= {COV} then 1 else 0 end as q, {', '.join(_keep(i, f) for i, f in enumerate(['fa', 'fc', 'fg', 'ft']))} from fx_sites)",
    "hits": """hits as (select g.*, f.feature_id from g join fx_features f
      on f.seqid = g.seqid and g.pos >= f.start0 and g.pos < f.end0 and (f.strand = g.strand or f.strand = 0))""",
    "fc": f"fc as (select sample_idx, seqid, feature_id, {SUMS} from hits group by sample_idx, seqid, feature_id)",
    "tree": """tree as (
      select seqid, feature_id, parent_id, type, start0, end0, strand, file_order, 1 as lev, '.' as path, feature_id as root_id, type as root_type, strand as root_strand, cast(null as varchar) as iso_id, cast(null as varchar) as ptype
      from fx_features where parent_id is null
      union all
      select f.seqid, f.feature_id, f.parent_id, f.type, f.start0, f.end0, f.strand, f.file_order, t.lev + 1, t.path || ',' || t.feature_id, t.root_id, t.root_type, t.root_strand,
        case when t.lev = 1 then f.feature_id else t.iso_id end, t.type
      from fx_features f join tree t on f.parent_id = t.feature_id and f.seqid = t.seqid)""",
    "longest": """longest as (
      select seqid, root_id, iso_id, kind, length from (
        select *, row_number() over (partition by seqid, root_id order by kind, length desc, o) as n from (
          select c.seqid, c.root_id, c.iso_id, i.file_order as o, case when c.cds > 0 then 'CDS' else 'exon' end as kind, case when c.cds > 0 then c.cds else c.exon end as length
          from (select seqid, root_id, iso_id, cast(sum(case when type = 'CDS' then end0 - start0 else 0 end) as bigint) as cds, cast(sum(case when type = 'exon' then end0 - start0 else 0 end) as bigint) as exon
                from tree where lev = 3 group by seqid, root_id, iso_id) c
          join tree i on i.feature_id = c.iso_id and i.seqid = c.seqid where c.cds > 0 or c.exon > 0)) where n = 1)""",
    "chim": """chim0 as (select distinct seqid, root_id, root_type, root_strand, type, start0, end0 from tree where lev = 3),
    chim1 as (select *, case when start0 > max(end0) over (partition by seqid, root_id, type order by start0, end0 rows between unbounded preceding and 1 preceding) then 1 else 0 end as fresh from chim0),
    chim2 as (select *, sum(fresh) over (partition by seqid, root_id, type order by start0, end0 rows unbounded preceding) as island from chim1),
    chim as (select seqid, root_id, root_type, root_strand, type, root_id || '-' || type || '-chimaera' as feature_id, min(start0) as start0, max(end0) as end0 from chim2 group by seqid, root_id, root_type, root_strand, type, island)""",
    "cc": f"""chits as (select g.*, f.feature_id, f.type as ctype, f.root_id, f.root_type from g join chim f
      on f.seqid = g.seqid and g.pos >= f.start0 and g.pos < f.end0 and (f.root_strand = g.strand or f.root_strand = 0)),
    cc as (select sample_idx, seqid, feature_id as group_id, ctype, root_type as ptype, {SUMS} from chits group by all),
    cu as (select seqid, feature_id as group_id, type as ctype, root_id, root_type as ptype, root_strand, min(start0) as lo, max(end0) as hi, cast(sum(end0 - start0) as bigint) as total from chim group by all)""",
    "members": """m_feature as (select t.seqid, t.feature_id, a.feature_id as group_id, a.feature_id as id, a.path as parent_ids, a.ptype, t.type as ctype, a.strand, t.start0, t.end0
        from tree t join tree a on a.seqid = t.seqid and a.lev >= 2 and t.lev > a.lev and list_contains(string_split(t.path, ','), a.feature_id)),
    m_all_isoforms as (select seqid, feature_id, root_id as group_id, root_id || '-all_isoforms' as id, '.,' || root_id as parent_ids, root_type as ptype, type as ctype, root_strand as strand, start0, end0 from tree where lev >= 3),
    m_longest_isoform as (select t.seqid, t.feature_id, t.root_id as group_id, t.iso_id || '-longest_isoform' as id, '.,' || t.root_id as parent_ids, t.root_type as ptype, t.type as ctype, t.root_strand as strand, t.start0, t.end0
        from tree t join longest l on l.seqid = t.seqid and l.root_id = t.root_id and l.iso_id = t.iso_id where t.lev >= 3)""",
}
FC = ("sites", "features", "g", "hits", "fc", "tree")


def _mode(mode: str) -> str:
    m = f"m_{mode}"
    return _ctes(*FC, "longest", "members") + f"""
, e as (select seqid, group_id, ctype, id, parent_ids, ptype, strand, min(start0) as lo, max(end0) as hi from {m} group by all),
c as (select fc.sample_idx, m.seqid, m.group_id, m.ctype, {AGAIN} from fc join {m} m on m.seqid = fc.seqid and m.feature_id = fc.feature_id group by all)
select sample_idx, c.seqid, parent_ids, id, ptype, 'feature' as type, c.ctype, '{mode}' as mode, cast(lo + 1 as bigint) as start, cast(hi as bigint) as "end", strand, cast(hi - lo as bigint) as total_sites, {VECTORS}
from c join e on e.seqid = c.seqid and e.group_id = c.group_id and e.ctype = c.ctype where {QUALIFIED} > 0
"""


def _levels(genome: bool) -> str:
    """Each mode and level by its own group-by."""
    out = []
    for mode in ("all_isoforms", "longest_isoform", "chimaera"):
        if mode == "chimaera":
            fine, extent, keys = "select sample_idx, seqid, ptype, ctype, " + ", ".join(NAMES) + " from cc", "select distinct cc.sample_idx, cu.seqid, cu.ctype, lo, hi from cc join cu on cu.seqid = cc.seqid and cu.group_id = cc.group_id", "sample_idx, "
        else:
            fine = f"select fc.sample_idx, m.seqid, m.ptype, m.ctype, {', '.join('fc.' + n for n in NAMES)} from fc join m_{mode} m on m.seqid = fc.seqid and m.feature_id = fc.feature_id"
            extent, keys = f"select seqid, ctype, start0 as lo, end0 as hi from m_{mode}", ""
        place = "" if genome else "seqid, "
        for parent in (False, True):
            p = "ptype, " if parent else ""
            kind = "'global_' || " if genome else "'sequence_' || c.seqid || '_' || "
            on = "e.ctype = c.ctype" + ("" if genome else " and e.seqid = c.seqid") + (" and e.sample_idx = c.sample_idx" if keys else "")
            out.append(
                f"select c.sample_idx, {'' if genome else 'c.seqid, '}{kind}{'ptype || ' + chr(39) + '_' + chr(39) + ' || ' if parent else ''}c.ctype || '_{mode}' as id, {'ptype' if parent else 'cast(null as varchar) as ptype'}, c.ctype, '{mode}' as mode, cast(hi - lo as bigint) as total_sites, {VECTORS} "
                f"from (select sample_idx, {place}{p}ctype, {AGAIN} from ({fine}) group by sample_idx, {place}{p}ctype) c join (select {keys}{place}ctype, min(lo) as lo, max(hi) as hi from ({extent}) group by {keys}{place}ctype) e on {on} where {QUALIFIED} > 0"
            )
    return _ctes(*FC, "longest", "members", "chim", "cc") + "\nunion all\n".join(out)


EDITS = [(i, j, p) for i, j, p in PAIRS if i != j]
WIDE = _ctes(*FC, "samples") + f", w as (select fc.*, t.type, s.grp, s.sample, s.rep from fc join tree t on t.seqid = fc.seqid and t.feature_id = fc.feature_id join fx_samples s on s.sample_idx = fc.sample_idx where {QUALIFIED} > 0)"
EACH = "\nunion all ".join(
    f"select sample_idx, grp, sample, rep, seqid, feature_id as id, type, '{p}' as pairing, '{m}' as metric, {num} as num, {den} as den from w"
    for i, _, p in EDITS
    for m, num, den in (("espf", f"site_{p}", f"qual_{p[0]}"), ("espr", f"read_{p}", f"read_{p[0]}A + read_{p[0]}C + read_{p[0]}G + read_{p[0]}T"))
)
LONG = WIDE + f", mx as ({EACH}), long as (select *, case when den >= 1 then cast(num as double) / den end as value from mx)"
LEGACY_NAMES = [p for _, _, p in PAIRS]


def _cells(metric: str) -> str:
    """All samples of each row with an edited cell."""
    return LONG + f""", k as (select distinct seqid, id, type, pairing from long where metric = '{metric}' and value <> 0)
      select s.sample_idx, k.seqid, k.id, k.pairing, l.num, cast(l.den as bigint) as den, l.value from k cross join fx_samples s
      left join (select * from long where metric = '{metric}') l on l.seqid = k.seqid and l.id = k.id and l.type = k.type and l.pairing = k.pairing and l.sample_idx = s.sample_idx"""


def _prevalence(samples: float | None, group: float | None) -> str:
    per = LONG + ", per as (select seqid, id, type, pairing, metric, grp, count(*) as n from long where value is not null and value <> 0 group by all)"
    if samples is None:
        return per + " select distinct seqid, id, type, pairing, metric from per"
    rule = f"sum(n) / 12.0 >= {samples / 100}" + (f" or max(n / 4.0) >= {group / 100}" if group else "")
    return per + f" select seqid, id, type, pairing, metric from per group by all having {rule}"


COLUMNS = [(i, f"{('ctrl', 'low', 'high')[i % 3]}::s{i % 2 + 1}::rep{1 if i < 6 else 2}::espf") for i in range(12)]

VALUES = LONG + """, vals as (select k.pairing || '_' || k.metric || '_' || f.type as section, f.feature_id as uid, s.grp, s.sample, s.rep, l.value from fx_features f cross join fx_samples s
  cross join (select distinct pairing, metric from mx) k left join long l on l.id = f.feature_id and l.sample_idx = s.sample_idx and l.pairing = k.pairing and l.metric = k.metric)"""
VARIED = VALUES + """, varied as (select v.* from vals v join (select section, uid from vals group by all having var_samp(value) > 1e-10) k on k.section = v.section and k.uid = v.uid where value is not null),
mom as (select section, uid, grp, count(*) as n, avg(value) as mean, var_samp(value) as var from varied group by all),
two as (select a.section, a.uid, a.grp as grp1, b.grp as grp2, a.n as n1, b.n as n2, a.mean as mean1, b.mean as mean2, a.var as var1, b.var as var2 from mom a join mom b on a.section = b.section and a.uid = b.uid and a.grp < b.grp)"""
RANKED = VARIED + """, rk as (select *, rank() over (partition by section, uid order by value) + (count(*) over (partition by section, uid, value) - 1) / 2.0 as r, count(*) over (partition by section, uid, value) as t from varied),
kg as (select section, uid, grp, sum(r) as rs, count(*) as n, sum(t * t - 1) as tie from rk group by all),
ks as (select section, uid, sum(rs * rs / n) as q, cast(sum(n) as double) as n, cast(sum(tie) as double) as tie, count(*) as groups from kg group by all),
kh as (select section, uid, case when groups >= 2 and 1 - tie / (n * n * n - n) > 0 then (12 / (n * (n + 1)) * q - 3 * (n + 1)) / (1 - tie / (n * n * n - n)) end as h, cast(groups - 1 as int) as df from ks)"""

#: Two-sided p of Student's t in closed form, for up to six degrees of freedom (two groups of four).
T_P = """case df when 1 then 1 - 2 * th / pi() when 2 then 1 - sin(th) when 3 then 1 - 2 / pi() * (th + sin(th) * cos(th)) when 4 then 1 - sin(th) * (1 + cos(th) ** 2 / 2)
  when 5 then 1 - 2 / pi() * (th + sin(th) * (cos(th) + 2.0 / 3 * cos(th) ** 3)) when 6 then 1 - sin(th) * (1 + cos(th) ** 2 / 2 + 3.0 / 8 * cos(th) ** 4) end"""

UID_PART = "case when regexp_matches(regexp_replace(trim({0}), '^\\.?,?', ''), '^\\.*$') then '' else regexp_replace(trim({0}), '^\\.?,?', '') end"


def _uid() -> str:
    part = lambda c: UID_PART.format(f"coalesce({c}, '.')")
    cols = ["type", "seqid", "ptype", "parent_ids", "case when lower(type) in ('global', 'sequence') then null else id end", "ctype", "mode"]
    joined = "case mtype when 'aggregate' then 'agg' else 'feat' end || '-' || " + " || '-' || ".join(part(c) for c in cols)
    return _ctes("features", "tree") + f""", r as (
select seqid, '.' as parent_ids, feature_id as id, 'aggregate' as mtype, '.' as ptype, case when strand = 0 then 'sequence' else 'feature' end as type, 'exon' as ctype, 'chimaera' as mode from tree where lev = 1
union all select seqid, path, feature_id, 'feature', '.', type, '.', '.' from tree)
select trim(regexp_replace({joined}, '-+', '-', 'g'), '-') as uid from r"""


ORACLES: dict[str, str] = {
    "site_scan_normalised": _ctes("sites") + "select sample_idx, seqid, pos + 1 as position, strand, substr('ACGTN', ref + 1, 1) as base, concat_ws(',', fa, fc, fg, ft) as freqs, coverage from fx_sites",
    "site_qualified_long": _ctes("sites", "g") + " union all ".join(f"select sample_idx, seqid, pos, strand, ref, cast(q as bigint) as qualified, '{b}' as base, cast(r{b.lower()} as bigint) as reads, cast(1 as bigint) as sites from g where r{b.lower()} > 0" for b in ACGT),
    "site_all_sites_by_seq_genome": _ctes("sites", "features", "g") + f", k as (select * from g where seqid in (select seqid from fx_features)), a as (select sample_idx, seqid, {SUMS} from k group by grouping sets ((sample_idx, seqid), (sample_idx))) select sample_idx, seqid, case when seqid is null then 'global_all_sites' else 'sequence_' || seqid || '_all_sites' end as id, case when seqid is null then 'global' else 'sequence' end as type, {VECTORS} from a where {QUALIFIED} > 0",
    "quick_ag_ct_by_seq": _ctes("sites") + "select sample_idx, seqid, cast(sum(case when ref = 0 then fg else 0 end) as bigint) as a_to_g, cast(sum(case when ref = 1 then ft else 0 end) as bigint) as c_to_t from fx_sites group by all",
    "feature_counts": _ctes(*FC) + f"select sample_idx, t.seqid, t.path as parent_ids, t.feature_id as id, t.type, cast(start0 + 1 as bigint) as start, cast(end0 as bigint) as \"end\", t.strand, cast(end0 - start0 as bigint) as total_sites, {VECTORS} from fc join tree t on t.seqid = fc.seqid and t.feature_id = fc.feature_id where {QUALIFIED} > 0",
    "feature_counts_report_all": _ctes(*FC, "samples") + f"select s.sample_idx, t.seqid, t.feature_id as id, cast(end0 - start0 as bigint) as total_sites, {_vectors(True)} from tree t cross join fx_samples s left join fc on t.seqid = fc.seqid and t.feature_id = fc.feature_id and fc.sample_idx = s.sample_idx",
    "feature_counts_binned": _ctes("sites", "features", "g", "hits") + "select sample_idx, seqid, feature_id, count(*) as sites, cast(sum(coverage) as bigint) as coverage from hits group by all",
    "feature_type_pushdown": _ctes("features") + """, k as (select * from fx_features where type in ('gene', 'mRNA', 'CDS')),
      l as (select k.*, p.feature_id as p1, q.feature_id as p2 from k left join k p on p.feature_id = k.parent_id and p.seqid = k.seqid left join k q on q.feature_id = p.parent_id and q.seqid = k.seqid)
      select type, cast(1 + case when p1 is null then 0 when p2 is null then 1 else 2 end as int) as level, count(*) as n, cast(sum(end0 - start0) as bigint) as length from l group by 1, 2""",
    "feature_hierarchy_paths": _ctes("features", "tree") + "select seqid, feature_id, cast(lev as int) as level, path as parent_ids, root_id, root_type, iso_id from tree",
    "feature_hierarchy_deep": f"""with d as (select cast(n as bigint) as n, cast(n - (n - 1) % 7 as bigint) as r, cast((n - 1) % 7 as int) as k from ({fixtures.DEEP}))
      select 'chr' || (r % 3 + 1) as seqid, 'd' || n as feature_id, k + 1 as level, case when k = 0 then '.' else '.,' || array_to_string(list_transform(range(r, n), lambda x: 'd' || x), ',') end as parent_ids,
        'd' || r as root_id, 'k1' as root_type, case when k > 0 then 'd' || (r + 1) end as iso_id from d""",
    "feature_ancestors": _ctes("features", "tree") + "select t.seqid, t.feature_id, a.feature_id as ancestor_id, cast(a.lev as int) as ancestor_level from tree t join tree a on a.seqid = t.seqid and t.lev > a.lev and list_contains(string_split(t.path, ','), a.feature_id)",
    "longest_isoform_choice": _ctes("features", "tree", "longest") + "select * from longest",
    "chimaera_intervals": _ctes("features", "tree", "chim") + "select seqid, feature_id, type, start0, end0, root_strand as strand from chim",
    "chimaera_counts": _ctes("sites", "features", "g", "tree", "chim", "cc") + f"select sample_idx, cc.seqid, '.,' || root_id as parent_ids, cc.group_id as id, cc.ptype, 'feature' as type, cc.ctype, 'chimaera' as mode, cast(lo + 1 as bigint) as start, cast(hi as bigint) as \"end\", root_strand as strand, total as total_sites, {VECTORS} from cc join cu on cu.seqid = cc.seqid and cu.group_id = cc.group_id where {QUALIFIED} > 0",
    "rollup_feature_mode": _mode("feature"),
    "rollup_all_isoforms": _mode("all_isoforms"),
    "rollup_longest_isoform": _mode("longest_isoform"),
    "rollup_sequence": _levels(False),
    "rollup_genome": _levels(True),
    "aggregate_ids": _ctes("features", "tree") + "select distinct seqid, root_type as ptype, type as ctype, m.mode, 'sequence_' || seqid || '_' || root_type || '_' || type || '_' || m.mode as sequence_id, 'global_' || type || '_' || m.mode as global_id, 'sequence' as type from tree cross join (values ('all_isoforms'), ('longest_isoform'), ('chimaera')) as m(mode) where lev >= 3",
    "matrix_espf": _cells("espf"),
    "matrix_espr": _cells("espr"),
    "matrix_legacy_index": WIDE + " " + " union all ".join(f"select '{p}' as pairing, cast(sum(read_{LEGACY_NAMES[n]}) as bigint) as num, cast(sum(read_{p[0]}A + read_{p[0]}C + read_{p[0]}G + read_{p[0]}T) as bigint) as den from w" for n, (_, _, p) in enumerate(EDITS)),
    "matrix_wide_ag": LONG + " select seqid, id, type, " + ", ".join(f"max(case when sample_idx = {i} then value end) as \"{c}\"" for i, c in COLUMNS) + " from long where metric = 'espf' and pairing = 'AG' group by seqid, id, type having sum(case when value <> 0 then 1 else 0 end) > 0",
    "prevalence_any": _prevalence(None, None),
    "prevalence_samples_pct": _prevalence(50, None),
    "prevalence_group_pct": _prevalence(90, 75),
    "uid_build": _uid(),
    "safe_names": "select page_id, regexp_replace(url, '[^A-Za-z0-9._-]', '_', 'g') as safe, replace(replace(url, '.', 'all'), '-', '_') as section, regexp_replace(url, '[:/]', '_', 'g') as feature, regexp_replace(regexp_replace(regexp_replace(url, '^.*/', ''), '\\.[^.]*$', ''), '_[^_]*$', '') as file_id, regexp_matches(url, '^(https?|ftp|s3|gs|az)://') as is_url from pages",
    "sample_column_parse": _ctes("samples") + ", c as (select sample_idx, concat_ws('::', grp, sample, rep, 'espr') as col from fx_samples union all select sample_idx, concat_ws('::', grp, sample, rep, 'espr', 'x') from fx_samples) select sample_idx, col, case when n = 4 then p[1] end as grp, case when n = 4 then p[2] end as sample, case when n = 4 then p[3] end as rep, case when n = 4 then p[4] end as value_type from (select *, string_split(col, '::') as p, len(string_split(col, '::')) as n from c)",
    "sample_duplicates": _ctes("samples") + "select sample_idx, grp, sample, case when n > 1 then 'rep1_' || n else 'rep1' end as rep from (select *, row_number() over (partition by grp, sample order by sample_idx) as n from fx_samples)",
    "file_uid": "with p as (select p_partkey, replace(p_name, ' ', '_') || case when p_partkey % 2 = 0 then '_R1.fastq.gz' else '.bam' end as f from part) select p_partkey, regexp_replace(f, '(\\.(fastq|fq|bam|cram|sam|gz|bz2))+$', '') as prefix, regexp_replace(regexp_replace(f, '\\.[^.]*$', ''), '_[^_]*$', '') as file_id, p_partkey % 2 = 0 as is_fastq from part join p using (p_partkey)",
    "atog_transform": "select c_custkey, replace(replace(c_name, 'A', 'G'), 'a', 'g') as sequence from customer",
    "qc_missing": VALUES + " select section, grp, sample, rep, cast(sum(case when value is null then 1 else 0 end) as bigint) as missing, count(*) as total, round(100.0 * sum(case when value is null then 1 else 0 end) / count(*), 2) as missing_pct from vals group by all",
    "qc_describe": VALUES + " select section, grp, sample, rep, count(value) as count, round(avg(value), 6) as mean, round(stddev_samp(value), 6) as std, round(min(value), 6) as min, round(quantile_cont(value, 0.25), 6) as q25, round(quantile_cont(value, 0.5), 6) as q50, round(quantile_cont(value, 0.75), 6) as q75, round(max(value), 6) as max from vals where value is not null group by all",
    "group_statistics": VALUES + " select section, grp, count(value) as n, round(avg(value), 6) as mean, round(quantile_cont(value, 0.5), 6) as median, round(coalesce(stddev_samp(value), 0), 6) as std, round(min(value), 6) as min, round(max(value), 6) as max, round(quantile_cont(value, 0.25), 6) as q25, round(quantile_cont(value, 0.75), 6) as q75 from vals where value is not null group by all",
    "bmk_mean_by_group": VALUES + " select section, uid, grp, round(avg(value), 6) as mean, count(value) as n from vals group by all",
    "variance_filter_topk": VALUES + " select section, uid, round(v, 9) as variance from (select section, uid, v, row_number() over (partition by section order by round(v, 12) desc, uid) as n from (select section, uid, var_samp(value) as v from vals group by all) where v is not null) where n <= 50 and v > 1e-10",
    "coefficient_variation": VALUES + " select section, uid, round(case when avg(value) <> 0 then stddev_samp(value) / avg(value) end, 6) as cv from vals group by all",
    "kruskal_h": RANKED + " select section, uid, round(h, 6) as h, df from kh",
    "anova_f": VARIED + """, s as (select section, uid, count(*) as k, cast(sum(n) as double) as n, sum(n * mean) as t, sum(n * mean * mean) as b, sum((n - 1) * var) as w from mom where n >= 2 group by all)
      select section, uid, round(case when k >= 2 and w > 1e-12 then ((b - t * t / n) / (k - 1)) / (w / (n - k)) end, 6) as f, cast(k - 1 as int) as df1, cast(n - k as int) as df2 from s""",
    "bartlett_stat": VARIED + """, s as (select section, uid, count(*) as k, cast(sum(n) as double) as n, sum((n - 1) * var) as w, min(var) as least, sum(case when var > 0 then (n - 1) * ln(var) end) as l, sum(1.0 / (n - 1)) as r from mom where n >= 2 group by all)
      select section, uid, round(case when k >= 2 and least > 1e-12 then ((n - k) * ln(w / (n - k)) - l) / (1 + (r - 1 / (n - k)) / (3 * (k - 1))) end, 6) as bartlett, cast(k - 1 as int) as df from s""",
    "student_t": VARIED + """, s as (select *, ((n1 - 1) * var1 + (n2 - 1) * var2) / (n1 + n2 - 2) as p from two)
      select section, uid, grp1, grp2, round(case when n1 >= 2 and n2 >= 2 and p > 1e-12 then (mean1 - mean2) / sqrt(p * (1.0 / n1 + 1.0 / n2)) end, 6) as t, case when n1 >= 2 and n2 >= 2 and p > 1e-12 then cast(n1 + n2 - 2 as double) end as df from s""",
    "welch_t": VARIED + """, s as (select *, var1 / n1 as a, var2 / n2 as b from two)
      select section, uid, grp1, grp2, round(case when n1 >= 2 and n2 >= 2 and a + b > 1e-12 then (mean1 - mean2) / sqrt(a + b) end, 5) as t, round(case when n1 >= 2 and n2 >= 2 and a + b > 1e-12 then (a + b) * (a + b) / (a * a / (n1 - 1) + b * b / (n2 - 1)) end, 5) as df from s""",
    "mannwhitney_u": VARIED + """, c as (select a.section, a.uid, a.grp as grp1, b.grp as grp2, sum(case when a.value > b.value then 1.0 when a.value = b.value then 0.5 else 0 end) as u, count(*) as pairs from varied a join varied b on a.section = b.section and a.uid = b.uid and a.grp < b.grp group by all),
      e as (select section, uid, grp1, grp2, value, count(*) as t from (select two.section, two.uid, grp1, grp2, value from two join varied v on v.section = two.section and v.uid = two.uid and v.grp in (grp1, grp2)) group by all),
      x as (select section, uid, grp1, grp2, cast(sum(t * t * t - t) as double) as tie from e group by all)
      select c.section, c.uid, c.grp1, c.grp2, cast(u as double) as u, n1, n2, tie, round(1 - 2 * u / pairs, 6) as effect_size from c join two t on t.section = c.section and t.uid = c.uid and t.grp1 = c.grp1 and t.grp2 = c.grp2 join x on x.section = c.section and x.uid = c.uid and x.grp1 = c.grp1 and x.grp2 = c.grp2""",
    "effect_size_log2fc": VARIED + " select section, uid, grp1, grp2, round(mean1 - mean2, 6) as diff, round(case when mean1 > 0 and mean2 > 0 then log2(mean1 / mean2) end, 6) as log2fc from two",
    "group_pairs": VALUES + ", m as (select section, uid, grp, count(*) as n from vals where value is not null group by all) select a.section, a.grp as grp1, b.grp as grp2, count(*) as uids, cast(sum(a.n + b.n) as bigint) as values from m a join m b on a.section = b.section and a.uid = b.uid and a.grp < b.grp group by all",
    "pvalues_kruskal": RANKED + " select section, uid, round(exp(-h / 2), 6) as pval from kh where df = 2 and h is not null",
    "pvalues_anova": VARIED + f""", s as (select section, uid, count(*) as k, cast(sum(n) as double) as n, sum(n * mean) as t, sum(n * mean * mean) as b, sum((n - 1) * var) as w from mom where n >= 2 group by all),
      f as (select section, uid, k - 1 as d1, n - k as df, case when k >= 2 and w > 1e-12 then greatest(0, ((b - t * t / n) / (k - 1)) / (w / (n - k))) end as f from s)
      select section, uid, round(case when d1 = 2 then pow(1 + 2 * f / df, -df / 2) when d1 = 1 then {T_P} end, 6) + 0.0 as pval from (select *, atan(sqrt(f / df)) as th from f)""",
    "pvalues_student": VARIED + f""", s as (select *, n1 + n2 - 2 as df, ((n1 - 1) * var1 + (n2 - 1) * var2) / (n1 + n2 - 2) as p from two),
      t as (select *, case when n1 >= 2 and n2 >= 2 and p > 1e-12 then atan(abs((mean1 - mean2) / sqrt(p * (1.0 / n1 + 1.0 / n2))) / sqrt(df)) end as th from s)
      select section, uid, grp1, grp2, round({T_P}, 6) + 0.0 as pval from t""",
    "section_membership": _ctes(*FC) + f", r as (select distinct t.seqid, t.path, t.feature_id, t.type, t.root_id from fc join tree t on t.seqid = fc.seqid and t.feature_id = fc.feature_id where {QUALIFIED} > 0) select section, count(*) as rows from (select 'tree_' || root_id as section from r union all select 'roots_' || type from r where path = '.') group by section",
    "bh_fdr": _ctes("tests") + """, r as (select *, row_number() over (partition by section, test order by pval, uid, comparison) as k, count(*) over (partition by section, test) as m from fx_tests)
      select section, uid, test, comparison, pval, round(least(1.0, min(pval * m / k) over (partition by section, test order by k desc rows between unbounded preceding and current row)), 9) as padj from r""",
    "significant_any": _ctes("tests") + "select section, uid, cast(sum(case when padj < 0.05 then 1 else 0 end) as bigint) as n_significant_tests, min(padj) as min_padj from fx_tests group by all having min(padj) < 0.05",
    "global_ranking": _ctes("tests") + ", c as (select uid, count(distinct section) as t, count(distinct case when padj < 0.05 then section end) as s from fx_tests group by uid) select section, x.uid, comparison, padj, t as n_sections_total, s as n_sections_significant from fx_tests x join c on c.uid = x.uid where test = 'primary'",
    "sig_unique_common": _ctes("tests") + ", s as (select distinct section, uid, comparison from fx_tests where padj < 0.05) select section, uid, comparison, case when count(*) over (partition by section, uid) = 1 then 'unique' else 'common' end as kind from s",
    "gff3_scan": _ctes("features") + "select seqid, feature_id, parent_id, type, cast(start0 as int) as start0, cast(end0 as int) as end0, cast(strand as int) as strand from fx_features",
    "matrix_round_trip": LONG + ", k as (select distinct seqid, id, type from long where metric = 'espf' and pairing = 'AG' and value <> 0) select k.seqid, k.id, k.type, s.grp, s.sample, s.rep, round(l.value, 9) + 0.0 as value from k cross join fx_samples s left join (select * from long where metric = 'espf' and pairing = 'AG') l on l.seqid = k.seqid and l.id = k.id and l.type = k.type and l.sample_idx = s.sample_idx",
    "sheet_check": f"""with s as ({fixtures.SHEET}), c as (select "group" as grp, case when input_1 like 'data/%' then '/work/' || input_1 else input_1 end as input_1, input_2, nullif(trim(strandedness), '') as strand, lower(read_type) as read_type, sample, replicate from s),
      t as (select *, case when regexp_matches(input_1, '[.](fastq|fq)([.]gz)?$') then 'fastq' when input_1 like '%.bam' then 'alignment' end as kind, coalesce(read_type = 'short_paired' and input_2 is not null, false) as paired from c),
      u as (select *, case when paired then regexp_replace(regexp_replace(regexp_replace(input_1, '^.*/', ''), '[.][^.]*$', ''), '_[^_]*$', '') else regexp_replace(regexp_replace(input_1, '^.*/', ''), '([.](fastq|fq|bam|gz))+$', '') end as uid from t)
      select grp, input_1, read_type, paired, uid, coalesce(sample, uid) as sample, coalesce(replicate, 'rep1') as replicate,
        case when grp is null then 'group is missing' when input_1 is null then 'input_1 is missing' when kind is null then 'input_1 is neither reads nor an alignment'
          when kind = 'alignment' and input_2 is not null then 'an alignment has no input_2' when strand is null then 'strandedness is missing' when read_type is null then 'read_type is missing'
          when read_type = 'odd' then 'read_type is unknown' when input_2 like '%.txt' then 'input_2 holds no reads' when read_type = 'short_paired' and kind = 'fastq' and input_2 is null then 'short_paired needs input_2'
          when sample is null and replicate is not null then 'a replicate needs a sample' end as problem from u""",
    "channel_joins": """with n as (select s_suppkey as n, 'r' || s_suppkey as uid from supplier)
      select uid, uid || '.bam' as path, case when n % 4 = 0 then 'U' else 'ISR' end as strandedness from n where n % 6 = 0 union all select uid, uid || '.own.bam', null from n where n % 5 = 0""",
    "hyper_editing_merge": """with n as (select 'r' || (o_orderkey % 40) as uid, o_orderkey as read, o_orderkey % 40 as k from orders),
      m as (select uid, read, false as again from n where k % 2 = 0 and read % 3 = 0), h as (select uid, read, true as again from n where k % 5 < 3 and read % 3 = 1),
      a as (select * from m where uid in (select uid from h) union all select * from h where uid in (select uid from m))
      select uid, again, count(*) as reads, cast(sum(read) as bigint) as sum from a group by all""",
    "value_selectors": _ctes("features") + "select seqid, type, count(*) as n from fx_features where type in ('gene', 'mRNA', 'exon') group by all",
    "heatmap_labels": _ctes("features") + """, r as (select case when level = 2 then 'one' else 'many' end as section, feature_id as uid, case when level = 3 then seqid else 'c' end as seqid, case when level = 3 and file_order % 3 > 0 then type end as ptype,
        case when file_order % 2 = 0 then type end as ctype, case when level = 3 and file_order % 5 = 0 then 'all_sites' else 'chimaera' end as mode from fx_features where level >= 2),
      b as (select *, case when mode = 'all_sites' then mode else coalesce(ctype, uid) end as core from r)
      select section, uid, case when section = 'one' then core else concat_ws('_', seqid, ptype, core, case when mode <> 'all_sites' then mode end) end as label,
        cast(case when section = 'one' or mode = 'all_sites' then 0 when ptype is null then 1 else 2 end as int) as priority from b""",
    "sig_common_pairs": _ctes("tests") + ", s as (select distinct section, uid, comparison from fx_tests where padj < 0.05) select a.section, a.uid, a.comparison, b.comparison as other from s a join s b on a.section = b.section and a.uid = b.uid and a.comparison <> b.comparison",
    "test_ranking": _ctes("tests") + "select section, uid, comparison, padj, cast(row_number() over (partition by section order by padj, uid, comparison) as int) as rank from fx_tests where test = 'anova' and padj is not null",
    "edit_type_join": LONG + ", m as (select pairing, id from mx where metric = 'espr' and num > 0 and den >= 1), a as (select * from m where id like '%t%' and pairing < 'CT'), f as (select * from m where id not like '%t%' and pairing > 'AC') select pairing, count(*) as n from (select * from a union all select * from f) where pairing in (select pairing from a) and pairing in (select pairing from f) group by pairing",
    "sig_levels": _ctes("tests") + "select section, uid, test, comparison, case when padj < 0.05 then 2 when padj < 0.1 then 1 else 0 end as level, round(-log10(greatest(padj, 1e-300)), 6) + 0.0 as score from fx_tests",
    "replicate_pearson": VALUES + " select a.section, a.grp, a.sample, a.rep as rep1, b.rep as rep2, count(*) as n, round(case when var_pop(a.value) > 1e-18 and var_pop(b.value) > 1e-18 then corr(a.value, b.value) end, 6) as pearson_r from vals a join vals b on a.section = b.section and a.uid = b.uid and a.grp = b.grp and a.sample = b.sample and a.rep < b.rep where a.value is not null and b.value is not null group by all having count(*) >= 3",
    "sample_correlation": VALUES + ", l as (select section, uid, grp || '::' || sample || '::' || rep as s, coalesce(value, 0) as v from vals where (section, uid) in (select section, uid from vals group by all having count(value) > 0)) select a.section, a.s as sample1, b.s as sample2, round(case when var_pop(a.v) > 1e-18 and var_pop(b.v) > 1e-18 then corr(a.v, b.v) end, 6) as r from l a join l b on a.section = b.section and a.uid = b.uid and a.s < b.s group by all",
    "bmk_correlation_top50": VALUES + """, k as (select section, uid from (select section, uid, row_number() over (partition by section order by round(var_samp(value), 12) desc, uid) as n from vals group by section, uid having var_samp(value) is not null) where n <= 50),
      v as (select vals.* from vals join k on k.section = vals.section and k.uid = vals.uid where value is not null),
      c as (select a.section, a.uid as uid1, b.uid as uid2, count(*) as n, case when var_pop(a.value) > 1e-18 and var_pop(b.value) > 1e-18 then corr(a.value, b.value) end as r from v a join v b on a.section = b.section and a.grp = b.grp and a.sample = b.sample and a.rep = b.rep and a.uid < b.uid group by all)
      select section, uid1, uid2, n, round(r, 6) as r from c where n >= 6 and r is not null""",
}

ORACLES["report_round_trip"] = ORACLES["feature_counts"]
for _name, _q in (("reditools2_scan", "30.5"), ("reditools3_scan", "30.5"), ("jacusa2_scan", "null")):
    _score = "1.5" if _q == "null" else "0.0"
    ORACLES[_name] = _ctes("sites") + f"select seqid || '_' || sample_idx as seqid, pos, strand, ref, {'fa + fc + fg + ft' if _q == 'null' else 'coverage'} as coverage, fa, fc, fg, ft, cast({_q} as double) as mean_q, cast({_score} as double) as score from fx_sites"
