"""ANSI SQL (DuckDB) for the p queries that SQL can express; written apart from the Spark code, to check it."""

from __future__ import annotations

from tidemark.plans.fact import FACT_COLUMNS, NUMERIC_COLUMNS

_FACTOR = """case when {t} like '%million%' then 1000000 when {t} similar to '.*(thousand|millier|000).*' or regexp_matches({t}, '(^|[^a-z])k($|[^a-z])') then 1000
 when {t} similar to '.*(hundred|centaine).*' then 100 when {t} like '%dozen%' then 12 when {t} like '%pair%' then 2
 when {t} like '%tens %' or {t} like '%x 10%' then 10 end"""


def quantities(table: str) -> str:
    """Common table expressions ending in ``q``: the table with unit_factor and quantity."""
    return rf"""g as (select *, regexp_replace(regexp_replace(trim(regexp_replace(VALUE, '[\s\p{{Z}}]+', ' ', 'g')), '([0-9])[, ]+([0-9])', '\1\2', 'g'), '([0-9])[, ]+([0-9])', '\1\2', 'g') as _g from {table}),
n as (select *, try_cast(nullif(regexp_extract(_g, '^[+-]?[0-9]*[.]?[0-9]+'), '') as decimal(24,6)) as _n, lower(regexp_replace(_g, '^[+-]?[0-9]*[.]?[0-9]+', '')) as _rest,
 lower(UOM) as _u, lower(SCALAR_FACTOR) as _f from g),
w as (select *, coalesce(nullif(power(10, try_cast(trim(SCALAR_ID) as integer))::integer, 1), {_FACTOR.format(t='_f')}, {_FACTOR.format(t='_u')}, {_FACTOR.format(t='_rest')}, 1) as unit_factor from n),
q as (select *, cast(_n * cast(unit_factor as decimal(10,0)) as bigint) as quantity, {MONTH} as _month from w)"""


MONTH = r"regexp_replace(trim(REF_DATE), '^([0-9]{4})[-/M]([0-9]{2}).*$', '\1-\2')"
_SNAP = """s as (select feed_id, release_timestamp, max_by(sha256, landed_at) as sha256, max_by(release_label, landed_at) as release_label
 from source_snapshot where source_id = 'cmhc_housing_activity' group by 1, 2)"""


def _label(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(replace(lower({c}), '&', 'and'), '[(\[]([0-9]{{1,2}}|[a-z])[)\]]', ' ', 'g'), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


P1 = f"""with {quantities('cmhc_housing_activity')}, {_SNAP},
p as (select *, lag(sha256) over (partition by feed_id order by release_timestamp) as before from s),
r as (select _source_archive_sha256 as sha, trim(VECTOR) as vector, _month as ref_month, max(quantity) as v from q group by 1, 2, 3),
a as (select p.feed_id, p.release_label, r.vector, r.ref_month, r.v from p join r on r.sha = p.sha256 where p.before is not null),
b as (select p.feed_id, p.release_label, r.vector, r.ref_month, r.v from p join r on r.sha = p.before)
select feed_id, release_label, vector, ref_month, change_kind from (
 select feed_id, release_label, vector, ref_month, 'added' as change_kind from a anti join b using (feed_id, release_label, vector, ref_month)
 union all select feed_id, release_label, vector, ref_month, 'removed' from b anti join a using (feed_id, release_label, vector, ref_month)
 union all select a.feed_id, a.release_label, a.vector, a.ref_month, 'changed' from a join b using (feed_id, release_label, vector, ref_month) where a.v is distinct from b.v)"""

_KNOWN = {
    "cmhc_housing_activity": ("Type of unit", "case when {l} like '%starts%' then 'housing_starts' when {l} like '%completions%' then 'housing_completions' when {l} like '%under construction%' then 'housing_under_construction' end", "Housing estimates"),
    "cmhc_starts_by_market": ("Type of dwelling unit", "case when {l} similar to 'home ?owner' then 'starts_homeowner' when {l} = 'rental' then 'starts_rental' when {l} in ('condo', 'condominium') then 'starts_condominium' when {l} similar to 'co ?op(erative)?' then 'starts_cooperative' when {l} similar to 'other markets?' then 'starts_other_market' else 'starts_' || replace({l}, ' ', '_') end", "Type of market"),
}


def _cells(source: str) -> str:
    unit, column, member = _KNOWN[source]
    u, m = _label(f'"{unit}"'), _label(f'"{member}"')
    newest = "(select feed_id, max_by(sha256, release_timestamp) as sha256 from source_snapshot where source_id = 'cmhc_housing_activity' group by 1)" if source.endswith("activity") else "(select distinct feed_id, sha256 from source_snapshot where source_id = 'cmhc_starts_by_market')"
    place = _label("replace(lower(GEO), '(cma)', '')")
    return f"""select '{source}' as source_id, f.feed_id, x._month as ref_month, coalesce(nullif(regexp_extract(trim(x.DGUID), 'S0503([0-9]{{3}})$', 1), ''), c.cma_code) as cma_code,
 case when x._ul like 'total%' then 'total' when x._ul like 'semi%' then 'semi_detached' when x._ul like 'single%' then 'single_detached' when x._ul like 'row%' then 'row' when x._ul like 'apartment%' then 'apartment_and_other' end as dwelling_type,
 {column.format(l='x._ml')} as column_name, x.quantity, x.obs_id
from (with {quantities(source)} select *, {u} as _ul, {m} as _ml, {place} as _pl from q) x join {newest} f on f.sha256 = x._source_archive_sha256
left join (select cma_code, {_label('geography')} as _pl from cma_reference) c on c._pl = x._pl"""


def _states(cells: str, columns: tuple[str, ...]) -> str:
    values = ", ".join(f"('{c}')" for c in columns)
    key = "source_id, feed_id, ref_month, cma_code, dwelling_type"
    return f"""select {key}, column_name, case when n = 0 then 'empty' else 'conflict' end as cell_state from (
 select e.*, k.column_name, count(distinct c.quantity) as n from (select distinct {key} from ({cells})) e cross join (values {values}) k(column_name)
 left join ({cells}) c using ({key}, column_name) group by all) where n <> 1"""


MEASURES = ("housing_starts", "housing_completions", "housing_under_construction")
MEMBERS = ("starts_homeowner", "starts_rental", "starts_condominium", "starts_cooperative", "starts_other_market")
#: Members of the test tables beside the five.
OTHER_MEMBERS = ("starts_life_lease", "starts_market_unknown")
P2 = _states(_cells("cmhc_housing_activity"), MEASURES) + "\nunion all\n" + _states(_cells("cmhc_starts_by_market"), MEMBERS)

_ALL = (*FACT_COLUMNS, "source_load_batch_id", "source_validation_profile", "created_at_utc", "updated_at_utc")
_BOOL = tuple(c for c in FACT_COLUMNS if c.startswith("has_") or c == "starts_anomaly_flag")
_LEVEL = ("housing_starts", "housing_completions", "housing_under_construction", "market_starts_total", "new_housing_price_index", "residential_permit_value_dollars")


def _one(c: str) -> str:
    rule = f"(select {{}} from column_contract where column_name = '{c}')"
    x = f"cast({c} as double)"
    bad_range = f"count(*) filter (where {x} < {rule.format('min_value')} or {x} > {rule.format('max_value')})" if c in NUMERIC_COLUMNS else "0"
    return f"""select source_load_batch_id as load_batch_id, '{c}' as column_name, count(*) as n, count(*) - count({c}) as nulls,
 count(*) filter (where not regexp_full_match(cast({c} as varchar), {rule.format('pattern')})) as bad_pattern, {bad_range} as bad_range,
 {f'count(*) filter (where {c})' if c in _BOOL else 'null'} as trues, {f'quantile_cont({x}, 0.5)' if c in _LEVEL else 'null'} as med, {'true' if c in _BOOL else 'false'} as is_bool
 from fct_housing_monthly group by 1"""


_METRIC = {
    "row_count": "count(*)", "null_count_housing_completions": "count(*) - count(housing_completions)", "distinct_cma_codes": "count(distinct cma_code)",
    "true_count_has_activity_data": "count(*) filter (where has_activity_data)", "max_housing_completions": "max(housing_completions)",
}
P3 = f"""with p as ({' union all '.join(_one(c) for c in _ALL)}),
l as (select a.load_batch_id, (select max_by(b.load_batch_id, b.started_at_utc) from elt_load_audit b where b.status = 'SUCCEEDED' and b.validation_profile = a.validation_profile
 and b.started_at_utc < a.started_at_utc and b.load_batch_id in (select source_load_batch_id from fct_housing_monthly)) as before from elt_load_audit a),
d as (select n.*, o.n as n0, o.nulls as nulls0, o.trues as trues0, o.med as med0 from p n join l using (load_batch_id) join p o on o.load_batch_id = l.before and o.column_name = n.column_name),
a as (select load_batch_id, lower(validation_metrics) as t, json_valid(validation_metrics) as ok from elt_load_audit where status = 'SUCCEEDED'),
f as (select source_load_batch_id as load_batch_id, {', '.join(f'{e} as {m}' for m, e in _METRIC.items())} from fct_housing_monthly group by 1)
select load_batch_id, column_name, 'pattern' as finding from p where bad_pattern > 0
union all select load_batch_id, column_name, 'range' from p where bad_range > 0
union all select load_batch_id, column_name, 'null_rate' from d where 5 * abs(nulls * n0 - nulls0 * n) > n * n0
union all select load_batch_id, column_name, 'true_rate' from d where is_bool and 5 * abs(trues * (n0 - nulls0) - trues0 * (n - nulls)) > (n - nulls) * (n0 - nulls0)
union all select load_batch_id, column_name, 'level' from d where med0 >= 10 and (med > 2 * med0 or 2 * med < med0)
union all select load_batch_id, 'validation_metrics', 'metric' from a where not ok
""" + "".join(
    f"""union all select a.load_batch_id, '{m}', 'metric' from a left join f using (load_batch_id) where ok
 and coalesce(json_extract_string(t, '$.{m}'), json_extract_string(t, '$.metrics.{m}')) is not null
 and try_cast(coalesce(json_extract_string(t, '$.{m}'), json_extract_string(t, '$.metrics.{m}')) as bigint) is distinct from f.{m}
"""
    for m in _METRIC
)

P4 = f"""with {quantities('cmhc_housing_activity')} select obs_id, cast(unit_factor as integer) as unit_factor from q where quantity is not null and unit_factor <> 1 and _n <> 0"""

P5 = """with o as (select source_validation_profile as validation_profile, cma_code, dwelling_type, reference_month as m, max(housing_starts) as v from fct_housing_monthly group by all),
e as (select validation_profile, cma_code, dwelling_type, min(m) as lo, max(m) as hi from o group by all),
c as (select validation_profile, cma_code, dwelling_type, cast(unnest(generate_series(lo, hi, interval 1 month)) as date) as m from e),
t as (select c.*, o.v, (select sum(x.v) from o x where x.validation_profile = c.validation_profile and x.cma_code = c.cma_code and x.dwelling_type = c.dwelling_type
 and x.m between c.m - interval 2 month and c.m) as total from c left join o using (validation_profile, cma_code, dwelling_type, m))
select validation_profile, cma_code, dwelling_type, strftime(m, '%Y-%m') as ref_month from t where v is null and total > 0"""

P6 = r"""with l as (select *, regexp_full_match(line, '("([^"]|"")*"|[^",]*)(,("([^"]|"")*"|[^",]*))*') as ok from raw_lines where line_no <> 1),
f as (select *, regexp_extract_all(',' || line, ',("(?:[^"]|"")*"|[^",]*)', 1) as fields, case source_id when 'cmhc_housing_activity' then 16 else 18 end as need from l),
r as (select line_id, case when not ok then 'quoting' when len(fields) <> need then 'column_count'
 when not regexp_full_match(trim(trim(fields[1], '"'), ' '), '[0-9]{4}-(0[1-9]|1[0-2])') then 'ref_date'
 when not regexp_full_match(trim(trim(fields[case need when 16 then 12 else 14 end], '"'), ' '), '|[.][.]|[.][.][.]|x|F|[+-]?[0-9]+([.][0-9]+)?') then 'value' end as reason from f)
select line_id, reason from r where reason is not null"""

P1_CHANGES = P1.replace("select feed_id, release_label, vector, ref_month, change_kind from (", "select feed_id as feed, release_timestamp as release, release_label as label, vector, ref_month, change_kind, old_value, new_value from (")
for _old, _new in (
    ("select p.feed_id, p.release_label, r.", "select p.feed_id, p.release_timestamp, p.release_label, r."), ("ref_month, 'added' as change_kind from", "ref_month, release_timestamp, 'added' as change_kind, null as old_value, v as new_value from"),
    ("ref_month, 'removed' from", "ref_month, release_timestamp, 'removed', v, null from"), ("a.ref_month, 'changed' from", "a.ref_month, a.release_timestamp, 'changed', b.v, a.v from"),
):
    P1_CHANGES = P1_CHANGES.replace(_old, _new)


def _wide(source: str, columns: tuple[str, ...]) -> str:
    """Of each entity its cells by filtered aggregates, and the failures written out as JSON."""
    key = "source_id, feed_id, ref_month, cma_code, dwelling_type"
    values = ", ".join(f"max(v) filter (where column_name = '{c}') as {c}" for c in columns)
    return f"""with c as (select {key}, column_name, count(distinct quantity) as n, max(quantity) as v0, count(*) - count(quantity) as bad, min(obs_id) filter (where quantity is null) as first_bad from ({_cells(source)})
 where ref_month is not null and cma_code is not null and dwelling_type is not null group by all),
s as (select *, case when n = 1 then v0 end as v, case n when 0 then 'empty' when 1 then 'ok' else 'conflict' end as state from c),
j as (select *, case when column_name is not null and (n <> 1 or bad > 0) then '"' || column_name || '":{{' || case when n = 1 then '"value":' || v || ',' else '' end || '"state":"' || state || '","bad_rows":' || bad
 || case when first_bad is null then '' else ',"first_bad":' || first_bad end || '}}' end as t from s)
select {key}, {values}, '{{' || coalesce(string_agg(t, ',' order by column_name), '') || '}}' as failures from j group by {key}"""


P3_PROFILE = f"""with c as ({' union all '.join(f"select source_load_batch_id as load_batch_id, '{c}' as column_name, cast({c} as varchar) as value, count(*) as n from fct_housing_monthly group by 1, 3" for c in _ALL)}),
x as (select c.*, case when column_name in ({', '.join(f"'{c}'" for c in NUMERIC_COLUMNS)}) then cast(value as double) end as x, r.min_value, r.max_value, r.pattern from c left join column_contract r using (column_name)),
p as (select load_batch_id, column_name, sum(n)::bigint as "rows", coalesce(sum(n) filter (where value is null), 0)::bigint as nulls, count(value) as distinct_values, coalesce(sum(n) filter (where value = 'true'), 0)::bigint as trues,
 min(x) as min_number, max(x) as max_number, coalesce(sum(n) filter (where not regexp_full_match(value, pattern)), 0)::bigint as pattern_breaches,
 coalesce(sum(n) filter (where try_cast(value as double) < min_value or try_cast(value as double) > max_value), 0)::bigint as range_breaches, min(value) as min_text, max(value) as max_text,
 first(value order by (value is not null)::int desc, n desc, value desc) as top_value from x group by 1, 2),
m as ({' union all '.join(f"select source_load_batch_id as load_batch_id, '{c}' as column_name, cast(quantile_cont(cast({c} as double), 0.5) as decimal(30,5)) as median from fct_housing_monthly group by 1" for c in _LEVEL)})
select p.*, m.median from p left join m using (load_batch_id, column_name)"""

P4_ALL = f"""with {quantities('cmhc_housing_activity')} select obs_id, cast(unit_factor as integer) as unit_factor, quantity,
 case unit_factor when 1 then 'unit' when 2 then 'pair' when 10 then 'ten' when 12 then 'dozen' when 100 then 'hundred' when 1000 then 'thousand' when 1000000 then 'million' end as source_unit from q"""

P5_TOTALS = """with o as (select source_validation_profile as validation_profile, cma_code, dwelling_type, reference_month as m, max_by(housing_starts, (updated_at_utc, source_load_batch_id, housing_starts)) as v
 from fct_housing_monthly group by all),
e as (select validation_profile, cma_code, dwelling_type, min(m) as lo, max(m) as hi from o group by all),
c as (select validation_profile, cma_code, dwelling_type, cast(unnest(generate_series(lo, hi, interval 1 month)) as date) as m from e),
j as (select c.*, x.v, date_diff('month', x.m, c.m) as back from c left join o x on x.validation_profile = c.validation_profile and x.cma_code = c.cma_code and x.dwelling_type = c.dwelling_type and x.m between c.m - interval 11 month and c.m)
select validation_profile, cma_code, dwelling_type, m as reference_month, coalesce(bool_or(back = 0), false) as has_row, max(v) filter (where back = 0) as housing_starts,
""" + ",\n".join(
    f"coalesce(sum(v) filter (where back < {n}), 0)::bigint as total_{n}, count(v) filter (where back < {n}) as present_{n}, coalesce(sum(v) filter (where back < {n}), 0) / {n}.0::double as average_{n}" for n in (3, 12)
) + " from j group by all"

P6_VALID = P6.split("select line_id, reason from r")[0] + r""", v as (select f.*, r.reason, replace(case when left(x, 1) = '"' then substr(x, 2, length(x) - 2) else x end, '""', '"') as y, i from f join r using (line_id), lateral (select unnest(fields) as x, unnest(range(1, len(fields) + 1)) as i) where r.reason is null),
w as (select line_id, source_id, max(y) filter (where i = 1) as d, max(y) filter (where i = 2) as g, max(y) filter (where i = 3) as u, max(y) filter (where i = case need when 16 then 10 else 12 end) as vec,
 trim(max(y) filter (where i = case need when 16 then 12 else 14 end), ' ') as val, max(y) filter (where i = case need when 16 then 13 else 15 end) as st from v group by 1, 2)
select line_id, source_id, cast(trim(d, ' ') || '-01' as date) as reference_month, g as geography, u as dguid, vec as vector, try_cast(val as decimal(24,6)) as value,
 case when try_cast(val as decimal(24,6)) is null then nullif(val, '') end as value_code, nullif(st, '') as status from w"""

SQL = {
    "p1_found": P1, "p1_changes": P1_CHANGES, "p2_found": P2, "p2_wide_activity": _wide("cmhc_housing_activity", MEASURES), "p2_wide_market": _wide("cmhc_starts_by_market", (*MEMBERS, *OTHER_MEMBERS)),
    "p3_found": P3, "p3_profile": P3_PROFILE, "p4_found": P4, "p4_quantities": P4_ALL, "p5_found": P5, "p5_totals": P5_TOTALS, "p6_found": P6, "p6_valid": P6_VALID,
}
