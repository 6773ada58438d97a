"""DuckDB SQL for each registered query (the independent correctness oracle).

The tables ``region nation customer supplier part orders lineitem events
documents embeddings pages benchmark labels conversations`` are views.
Quantiles are spelled out with R's type-7 rule rather than DuckDB's
``quantile_cont`` so both sides use the same arithmetic.
"""

from __future__ import annotations

from sylvan.plans.eav_view import duckdb_sql
from sylvan.sources.catalog import EXCLUDED_DATA_IDS, TRAIT_CATALOG

EXCL = ", ".join(str(i) for i in EXCLUDED_DATA_IDS)


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


CATALOG_VALUES = ", ".join(f"({_lit(a)}, {_lit(b)}, {_lit(c)})" for a, b, c in TRAIT_CATALOG)

# T: the EAV view; P: (trait, observation) pairs; X: the fan-out;
# K: kept item ids; V: first value rows; CL: first covariate rows.
BASE = f"""
with T as ({duckdb_sql()}),
P as (select distinct TraitID as trait, ObservationID from T
      where TraitID is not null and ObservationID is not null),
X as (select P.trait, T.* from T join P on T.ObservationID = P.ObservationID
      where T.TraitID is null or T.TraitID = P.trait),
K as (select distinct DataID from T
      where TraitID is not null and ObservationID is not null and coalesce(DataID not in ({EXCL}), true)),
XK as (select X.*, (coalesce(DataID in (select DataID from K where DataID is not null), false)
                   or (DataID is null and exists (select 1 from K where DataID is null))) as kept
       from X),
V as (select trait, Dataset, AccSpeciesName, ObservationID, OrigValueStr, UnitName from (
        select *, row_number() over (partition by trait, Dataset, AccSpeciesName, ObservationID order by ord) as rn
        from XK where kept) where rn = 1 and OrigValueStr is not null),
CL as (select trait, Dataset, AccSpeciesName, ObservationID, DataName, OrigValueStr from (
        select trait, Dataset, AccSpeciesName, ObservationID, coalesce(DataName, 'NA') as DataName, OrigValueStr, ord,
               row_number() over (partition by trait, Dataset, AccSpeciesName, ObservationID, coalesce(DataName, 'NA')
                                  order by ord) as rn
        from XK where TraitID is null and coalesce(DataID not in ({EXCL}), true) and not kept)
       where rn = 1 and OrigValueStr is not null),
W as (select trait, Dataset, AccSpeciesName, ObservationID,
        max(case when DataName = 'latitude' then OrigValueStr end) as latitude,
        max(case when DataName = 'Light Level' then OrigValueStr end) as "Light Level",
        max(case when DataName = 'err' then OrigValueStr end) as err,
        max(case when DataName = 'NA' then OrigValueStr end) as "NA"
      from CL group by trait, Dataset, AccSpeciesName, ObservationID),
M as (select V.*, W.latitude, W."Light Level", W.err, W."NA" from V join W
        on V.trait = W.trait and V.Dataset is not distinct from W.Dataset
       and V.AccSpeciesName is not distinct from W.AccSpeciesName and V.ObservationID = W.ObservationID),
CAT as (select * from (values {CATALOG_VALUES}) c(trait_id_value, trait_domain, trait_full_name)),
TT as (select M.Dataset as dataset, M.AccSpeciesName as acc_species_name,
         case when c.trait_domain is null then null
              when c.trait_domain = 'Leaf mass per area'
                then (case when try_cast(M.OrigValueStr as double) = 0 then 'inf'::double
                           else 1.0 / try_cast(M.OrigValueStr as double) end)
              else try_cast(M.OrigValueStr as double) end as trait_value,
         c.trait_domain, c.trait_full_name, M.ObservationID as observation_id, M.OrigValueStr as orig_value_str,
         case when c.trait_domain is null then null when c.trait_domain = 'Leaf mass per area' then 'mg/mm2'
              else M.UnitName end as unit_name,
         M.latitude, M."Light Level" as light_level, M.err, M."NA" as na
       from M left join CAT c on cast(M.trait as varchar) = c.trait_id_value),
TL as (select V.Dataset as dataset, V.AccSpeciesName as acc_species_name,
         case when c.trait_domain is null then null
              when c.trait_domain = 'Leaf mass per area'
                then (case when try_cast(V.OrigValueStr as double) = 0 then 'inf'::double
                           else 1.0 / try_cast(V.OrigValueStr as double) end)
              else try_cast(V.OrigValueStr as double) end as trait_value,
         c.trait_domain, c.trait_full_name, V.ObservationID as observation_id, V.OrigValueStr as orig_value_str,
         case when c.trait_domain is null then null when c.trait_domain = 'Leaf mass per area' then 'mg/mm2'
              else V.UnitName end as unit_name,
         CL.DataName as covariate, CL.OrigValueStr as covariate_value
       from V join CL on V.trait = CL.trait and V.Dataset is not distinct from CL.Dataset
         and V.AccSpeciesName is not distinct from CL.AccSpeciesName and V.ObservationID = CL.ObservationID
       left join CAT c on cast(V.trait as varchar) = c.trait_id_value),
SS as (select trait_domain, acc_species_name, count(*) as n, avg(v) as mean, stddev_samp(v) as sd,
              min(v) as min, max(v) as max
       from (select *, case when isnan(trait_value) then null else trait_value end as v from TT)
       group by trait_domain, acc_species_name)
"""


def _quantile(rel: str, group: str, p: float) -> str:
    """Type-7 quantile of ``v`` per group from ``rel`` (group, v, r, n), r 0-based."""
    h = f"((n - 1) * {p})"
    lo, hi = f"floor({h})", f"ceil({h})"
    frac = f"({h} - {lo})"
    x_lo = f"max(case when r = {lo} then v end)"
    x_hi = f"max(case when r = {hi} then v end)"
    return (
        f"(select case when any_value({frac}) = 0 or {x_hi} = {x_lo} then {x_lo} "
        f"else (1 - any_value({frac})) * {x_lo} + any_value({frac}) * {x_hi} end "
        f"from {rel} q where q.{group} is not distinct from o.{group})"
    )


def _summary_sql(long_rel: str, group: str, extra_select: str = "") -> str:
    """min/quartiles/mean/max/n_na per ``group`` over ``long_rel`` (group, v)."""
    ranked = f"(select {group}, v, row_number() over (partition by {group} order by v) - 1 as r, count(*) over (partition by {group}) as n from {long_rel} where v is not null)"
    return f"""
select o.{group}{extra_select}, min(v) as min, {_quantile(ranked, group, 0.25)} as q1,
       {_quantile(ranked, group, 0.5)} as median, avg(v) as mean, {_quantile(ranked, group, 0.75)} as q3,
       max(v) as max, count(*) filter (where v is null) as n_na
from {long_rel} o group by o.{group}
"""


def _describe_numeric(table: str, columns: list[str]) -> str:
    long = " union all ".join(
        f"select '{c}' as col, case when isnan(cast({c} as double)) then null else cast({c} as double) end as v from {table}"
        for c in columns
    )
    body = _summary_sql(f"({long})", "col")
    return f"select col as \"column\", min, q1, median, mean, q3, max, n_na from ({body})"


def _describe_strings(table: str, columns: list[str], maxsum: int = 7) -> str:
    long = " union all ".join(f"select '{c}' as col, {c} as value from {table}" for c in columns)
    return f"""
with L as ({long}),
C as (select col, value, count(*) as n from L where value is not null group by col, value),
I as (select col, count(*) as levels, sum(n) as total from C group by col),
NA as (select col, count(*) as na from L where value is null group by col),
S as (select coalesce(I.col, NA.col) as col, coalesce(levels, 0) as levels, coalesce(total, 0) as total,
             coalesce(na, 0) as na from I full join NA on I.col = NA.col),
S2 as (select *, levels <= {maxsum} - (case when na > 0 then 1 else 0 end) as fit,
              case when levels <= {maxsum} - (case when na > 0 then 1 else 0 end) then levels
                   else {maxsum - 1} - (case when na > 0 then 1 else 0 end) end as shown from S),
R as (select C.col, C.value, C.n, S2.fit, S2.shown, S2.total,
             case when S2.fit then row_number() over (partition by C.col order by C.value)
                  else row_number() over (partition by C.col order by C.n desc, C.value) end as rnk
      from C join S2 on C.col = S2.col)
select col as "column", value, n, cast(rnk as integer) as rank from R where rnk <= shown
union all
select col, '(Other)', cast(total - sum(n) as bigint), cast(max(rnk) + 1 as integer) from R
  where not fit and rnk <= shown group by col, total
union all
select col, 'NA''s', na, cast(least(levels, {maxsum - 1}) + 1 as integer) from S2 where na > 0
"""


def _chunks(mode: str) -> str:
    ranked = "(select *, row_number() over (order by doc_id) as pos, count(*) over () as N from labels)"
    if mode == "lossless":
        return f"""
select doc_id, quality, toxic, pos,
  cast(case when pos <= (N % 4) * (N // 4 + 1) then (pos - 1) // (N // 4 + 1)
            else (N % 4) + (pos - 1 - (N % 4) * (N // 4 + 1)) // greatest(N // 4, 1) end as integer) as chunk
from {ranked}
"""
    return f"""
select doc_id, quality, toxic, pos, cast(k as integer) as chunk
from {ranked} r join (values (0), (1), (2), (3)) c(k)
  on r.pos between (k * N) // 4 + 1 and (k * N) // 4 + greatest(N // 4, 1)
"""


def _null_profile() -> str:
    cols = ["ord", "ObservationID", "TraitID", "DataID", "DataName", "Dataset", "AccSpeciesName", "OrigValueStr", "UnitName"]
    parts = " union all ".join(
        f"select '{c}' as \"column\", cast(count(*) filter (where {c} is null) as double) / count(*) * 100 as pct from T"
        for c in cols
    )
    return f"with T as ({duckdb_sql()}) {parts}"


def _chunks_written(mode: str) -> str:
    """Traits in order of first appearance, rows in file order inside each."""
    inside = (
        """cast(case when pos <= (N % 4) * (N // 4 + 1) then (pos - 1) // (N // 4 + 1)
            else (N % 4) + (pos - 1 - (N % 4) * (N // 4 + 1)) // greatest(N // 4, 1) end as varchar) as k from P"""
        if mode == "lossless"
        else """cast(c.k as varchar) as k from P join (values (0), (1), (2), (3)) c(k)
  on P.pos between (c.k * N) // 4 + 1 and (c.k * N) // 4 + greatest(N // 4, 1)"""
    )
    return f"""
with E as (select *, min(event_id) over (partition by event_type) as first from events),
P as (select *, row_number() over (order by first, event_id) as pos, count(*) over () as N from E)
select 'data_traits_' || k as snapshot_name, event_type as trait_name,
  cast(case when event_id % 5 > 0 then event_id % 7 end as varchar) as id,
  'user ' || cast(user_id as varchar) as scrubbed_species_binomial, try_cast(cast(value as varchar) as double) as trait_value,
  'u' as unit, cast(event_id as varchar) as url_source, props as source_citation
from (select P.*, {inside})
"""


def _quality_report() -> str:
    numeric = ["o_orderkey", "o_custkey", "o_totalprice"]
    stats = ["min", "q1", "median", "mean", "q3", "max", "n_na"]
    unpivot = lambda part, rel: " union all ".join(
        f"select '{part}' as part, \"column\", '{s}' as item, cast({s} as double) as value from {rel}" for s in stats
    )
    days = "(select epoch(cast(cast(o_orderdate as date) as timestamp)) as o_orderdate from orders)"
    missing = [*numeric, "o_orderstatus", "o_orderdate", "o_orderpriority"]
    return f"""
with N as ({_describe_numeric("orders", numeric)}), D as ({_describe_numeric(days, ["o_orderdate"])}),
L as (select case when o_custkey % 10 > 0 then o_totalprice > 150000 end as large from orders)
{unpivot("numeric", "N")} union all {unpivot("dates", "D")}
union all select 'strings', "column", value, n from ({_describe_strings("orders", ["o_orderstatus", "o_orderpriority"])})
union all select 'logical', 'large', case when large is null then 'NA''s' else upper(cast(large as varchar)) end, count(*) from L group by large
union all select 'missing', 'large', 'pct', cast(count(*) filter (where large is null) as double) / count(*) * 100 from L
union all {" union all ".join(f"select 'missing', '{c}', 'pct', cast(count(*) filter (where {c} is null) as double) / count(*) * 100 from orders" for c in missing)}
"""


DOMAIN_SUMMARY = (
    BASE
    + """,
S5 as (select * from SS where n > 50 and trait_domain is not null),
LN as (select trait_domain || '|' || c as g, trait_domain, c as col,
              case when isnan(x) then null else x end as v
       from S5, lateral (values ('n', cast(n as double)), ('mean', mean), ('sd', sd), ('min', min), ('max', max)) t(c, x))
"""
    + "select split_part(g, '|', 1) as trait_domain, split_part(g, '|', 2) as \"column\", length, min, q1, median, mean, q3, max, n_na from ("
    + _summary_sql("LN", "g", ", count(*) as length")
    + ") union all select trait_domain, 'acc_species_name', count(*), null, null, null, null, null, null, null from S5 group by trait_domain"
)

SQL: dict[str, str] = {
    "trait_ids": f"with T as ({duckdb_sql()}) select cast(TraitID as varchar) as name, TraitID as value "
    "from (select distinct TraitID from T where TraitID is not null) order by value",
    "explode_by_trait": BASE + "select * from X",
    "item_overview": f"with T as ({duckdb_sql()}) select distinct TraitID as trait, DataID, DataName from T "
    "where TraitID is not null and ObservationID is not null",
    "item_selected": f"with T as ({duckdb_sql()}) select distinct TraitID as trait, DataID, DataName from T "
    f"where TraitID is not null and ObservationID is not null and coalesce(DataID not in ({EXCL}), true)",
    "keep_first": "select event_id, ts, user_id, event_type, value, props from ("
    "select *, row_number() over (partition by user_id, event_type order by event_id) as rn from events) where rn = 1",
    "trait_values": BASE + "select * from V",
    "covariates_long": BASE + "select * from CL",
    "covariates_wide": BASE + "select * from W",
    "trait_merged": BASE + "select * from M",
    "trait_merged_join": BASE + "select * from M",
    "trait_table": BASE + "select * from TT",
    "trait_table_long": BASE + "select * from TL",
    "trait_table_overflow": BASE + """
select * from TL where covariate not in (
  select DataName from (
    select DataName, row_number() over (order by trait, ord) as place from (
      select trait, coalesce(DataName, 'NA') as DataName, OrigValueStr, ord,
             row_number() over (partition by trait, Dataset, AccSpeciesName, ObservationID, coalesce(DataName, 'NA')
                                order by ord) as rn
      from XK where TraitID is null and coalesce(DataID not in (""" + EXCL + """), true) and not kept) where rn = 1 and OrigValueStr is not null)
  group by DataName order by min(place) limit 2)""",
    "species_summary": BASE + "select * from SS",
    "group_summary_part": "select p_brand, p_type, count(*) as n, avg(v) as mean, stddev_samp(v) as sd, min(v) as min, "
    "max(v) as max from (select *, case when isnan(p_retailprice) then null else p_retailprice end as v from part) "
    "group by p_brand, p_type",
    "domain_summary": DOMAIN_SUMMARY,
    "null_safe_semi": f"with T as ({duckdb_sql()}), K as (select Dataset, OrigValueStr from T where TraitID = 3116) "
    "select * from T where exists (select 1 from K where K.Dataset is not distinct from T.Dataset "
    "and K.OrigValueStr is not distinct from T.OrigValueStr)",
    "null_safe_anti": f"with T as ({duckdb_sql()}), K as (select Dataset, OrigValueStr from T where TraitID = 3116) "
    "select * from T where not exists (select 1 from K where K.Dataset is not distinct from T.Dataset "
    "and K.OrigValueStr is not distinct from T.OrigValueStr)",
    "missing_exact": "select distinct lower(p_type) as item from part where p_type is not null "
    "and lower(p_type) not in (select p_name from part where p_name is not null)",
    "missing_contains": "select distinct lower(r.p_type) as item from part r where r.p_type is not null "
    "and not exists (select 1 from part p where p.p_name is not null and contains(p.p_name, lower(r.p_type)))",
    "union_tolerant": "select c_custkey as custkey, c_name as name, c_nationkey as nationkey, c_acctbal as acctbal, "
    "c_mktsegment as mktsegment, cast(null as bigint) as suppkey from customer union all "
    "select null, s_name, s_nationkey, s_acctbal, null, s_suppkey from supplier",
    "discard_empty": "with I as (select c_mktsegment as source, case when c_mktsegment <> 'BUILDING' then c_custkey end as custkey, "
    "case when c_mktsegment <> 'BUILDING' then c_name end as name, "
    "case when c_mktsegment <> 'BUILDING' then c_acctbal end as acctbal from customer), "
    "S as (select source from I group by source having count(custkey) + count(name) + count(acctbal) > 0) "
    "select * from I where source in (select source from S)",
    "select_any_of": "select o_orderkey, o_totalprice, o_custkey from orders",
    "relocate": "select o_orderkey, o_totalprice, o_orderdate, o_custkey, o_orderstatus, o_orderpriority from orders",
    "clean_names": "select o_orderkey as order_key, o_custkey as customer_id, o_orderstatus as order_status, "
    "o_totalprice as total_price, o_orderdate as order_number_date, o_orderpriority as priority_percent from orders",
    "conform_records": f"with T as ({duckdb_sql()}) select DataName as trait_name, cast(ord as varchar) as id, "
    "AccSpeciesName as scrubbed_species_binomial, try_cast(OrigValueStr as double) as trait_value, "
    "UnitName as unit, Dataset as project_pi from T",
    "nest_roundtrip": "select n_regionkey, n_nationkey, n_name from nation",
    "nest_pieces_roundtrip": "select o_custkey, o_orderkey, o_totalprice from orders",
    "null_profile": _null_profile(),
    "describe_numeric": _describe_numeric(
        "lineitem",
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"],
    ),
    "describe_strings": _describe_strings("orders", ["o_orderstatus", "o_orderpriority"]),
    "describe_strings_part": _describe_strings("part", ["p_name", "p_brand", "p_type"]),
    "chunks_lossless": _chunks("lossless"),
    "chunks_truncating": _chunks("truncating"),
    "head_ordered": "select * from events order by event_id limit 1000",
    "snapshot_upkeep": """
select 'customer' as snapshot_name, count(*) as rows_read, cast(sum(cast(round(c_acctbal * 100) as bigint)) as bigint) as cents,
       cast(null as bigint) as orderkey, 1 as versions, count(*) as rows from customer where c_acctbal > 0
union all
select 'orders', count(*), null, max(o_orderkey), 1, count(*) from orders""",
    "latest_snapshot": "select 'customer' as snapshot_name, c.*, n.n_name from customer c join nation n on c.c_nationkey = n.n_nationkey",
    "available_traits": "select distinct event_type as trait_name from events",
    "ingest_selected": "select event_type as trait_name, cast(event_id as varchar) as id, "
    "'user ' || cast(user_id as varchar) as scrubbed_species_binomial, "
    "try_cast(cast(value as varchar) as double) as trait_value, 'u' as unit, props as source_citation "
    "from events where event_type in ('purchase', 'signup', 'view')",
    "trait_table_from_export": BASE + "select * from TT",
    "clean_names_letters": 'select o_orderkey as umol, o_custkey as orsted, o_orderstatus as strasse, o_totalprice as delta13_c, '
    "o_orderdate as grosse_m2, o_orderpriority as ano from orders",
    "nest_user_piece": "select o_custkey, o_custkey % 3 as piece, o_orderkey from orders",
    "snapshot_null_shift": "select 't' as snapshot_name, cast(null as varchar) as x, n_name as y from nation",
    "snapshot_renamed_column": "select 't' as snapshot_name, n_nationkey as key, n_name as label from nation",
    "snapshot_empty_newest": "select 'full' as snapshot_name, * from region",
    "snapshot_type_change": "select 't' as snapshot_name, 'r' || r_regionkey as r_regionkey, r_name from region",
    "snapshot_own_name_column": "select 'nations' as snapshot_name, n_nationkey as version, n_name as name from nation",
    "snapshot_numeric_name": "select '007' as snapshot_name, * from region",
    "snapshot_version_order": "select 'x' as snapshot_name, r_regionkey, r_name from region where r_regionkey > 0 "
    "union all select 'undated', n_nationkey, n_name from nation",
    "ingest_unchanged": "select event_type as trait_name, cast(1 as bigint) as versions, count(*) as n from events "
    "where event_type in ('purchase', 'signup', 'view') group by event_type",
    "chunks_written_lossless": _chunks_written("lossless"),
    "chunks_written_truncating": _chunks_written("truncating"),
    "quality_report": _quality_report(),
    "convert_columns": "select c_custkey, upper(c_name) as c_name, c_nationkey, c_acctbal, upper(c_mktsegment) as c_mktsegment from customer",
    "row_count": "select count(*) as n from lineitem",
    "any_all": "select p_brand, coalesce(bool_or(t), false) as any_large, coalesce(bool_and(t), true) as all_large from "
    "(select p_brand, case when p_brand <> 'Brand#11' then p_retailprice > 1000 end as t from part) group by p_brand",
    "first_group": "select * from part where p_brand = (select min(p_brand) from part)",
    "logical_names": "select p_partkey, p_name as name, case when p_partkey % 3 > 0 then '2023-05-0' || (p_partkey % 3) else '' end as date, "
    "cast(case when p_partkey % 6 = 1 then 12 else 0 end as bigint) as number from part",
}
