"""DuckDB SQL for the reference operators' queries, written apart from the Spark code."""

from __future__ import annotations

from tidemark.specs import SOURCES

_PRICE = """price_raw as (select s_nationkey || '-' || l_returnflag || '-' || strftime(m, '%Y-%m-%d') as obs_id, strftime(m, '%Y-%m') as REF_DATE, 'Area ' || (154 + 17 * s_nationkey) as GEO,
 '2021S0503' || (154 + 17 * s_nationkey) as DGUID, case l_returnflag when 'A' then 'Total (house and land)' when 'N' then 'House only' else 'Land only' end as "New housing price indexes",
 'Index' as UOM, '347' as UOM_ID, 'units' as SCALAR_FACTOR, '0' as SCALAR_ID, 'v1' as VECTOR, '1.1' as COORDINATE, cast(v as varchar) as VALUE, null::varchar as STATUS, null::varchar as SYMBOL,
 null::varchar as TERMINATED, '1' as DECIMALS, 'statcan_new_housing_price_index' as _source_id, timestamp '2025-01-15 13:30:00' as _source_release_timestamp, repeat('p', 64) as _source_archive_sha256
 from (select cast(date_trunc('month', cast(l_shipdate as date) + interval 336 month) as date) as m, s_nationkey, l_returnflag, max(cast(l_extendedprice as decimal(18,4))) as v
 from lineitem join supplier on l_suppkey = s_suppkey group by 1, 2, 3))"""

_WHOLE = "case when normalized_value >= 0 and normalized_value = floor(normalized_value) then cast(normalized_value as bigint) end"
_SOURCE = {
    "cmhc_housing_activity": ("cmhc_housing_activity", _WHOLE, "case when housing_measure in ('Housing starts', 'Housing completions') then 'flow' when housing_measure = 'Housing under construction' then 'stock' else 'unknown' end as measure_temporality, coalesce(dwelling_type = 'Total units', false) as is_total_dwelling_type"),
    "cmhc_starts_by_market": ("cmhc_starts_by_market", _WHOLE, "'flow' as measure_temporality"),
    "statcan_building_permits": ("statcan_building_permits", "cast(normalized_value as decimal(24,4))", "coalesce(lower(building_type) like 'total%', false) as is_total_building_type"),
    "statcan_new_housing_price_index": ("price_raw", "case when normalized_value > 0 then cast(normalized_value as decimal(18,4)) end", "coalesce(index_component = 'Total (house and land)', false) as is_total_index"),
}


def _b(c: str) -> str:
    return f"nullif(trim(\"{c}\"), '')"


def typed(source: str, short: str) -> str:
    """CTEs ``<short>`` (normalised rows) and ``<short>_clean`` (one row per natural key)."""
    spec, (table, measure, extras) = SOURCES[source], _SOURCE[source]
    dims = ", ".join(f"{_b(r)} as {n}" for r, n in spec.dimensions)
    key = ", ".join(spec.natural_key)
    needed = " and ".join(f"{c} is not null" for c in (*spec.natural_key, "source_id", "geography", "source_release_timestamp", "source_archive_sha256"))
    return f"""{short}_0 as (select obs_id, {_b('_source_id')} as source_id, cast(try_strptime({_b('REF_DATE')}, '%Y-%m') as date) as reference_month, {_b('GEO')} as geography, {_b('DGUID')} as geography_dguid,
 {_b('UOM')} as unit, try_cast(UOM_ID as integer) as unit_id, {_b('SCALAR_FACTOR')} as scalar_factor, try_cast(SCALAR_ID as integer) as scalar_id, upper({_b('STATUS')}) as status_code, upper({_b('SYMBOL')}) as symbol_code,
 upper({_b('TERMINATED')}) as t_code, {_b('VECTOR')} as source_vector, {_b('COORDINATE')} as source_coordinate, try_cast(DECIMALS as integer) as source_decimals,
 cast(_source_release_timestamp as timestamp) as source_release_timestamp, {_b('_source_archive_sha256')} as source_archive_sha256,
 nullif(regexp_extract({_b('DGUID')}, 'S0503([0-9]{{3}})$', 1), '') as cma_code, cast(try_cast(VALUE as decimal(24,6)) * cast(case try_cast(SCALAR_ID as integer) when 0 then 1 when 3 then 1000 when 6 then 1000000 when 9 then 1000000000 end as decimal(10,0)) as decimal(35,6)) as normalized_value,
 {dims} from {table}),
{short}_1 as (select *, {measure} as {spec.measure}, {extras},
 case when cma_code is not null then 'cma' when regexp_matches(geography, '^(Census metropolitan areas|Total census metropolitan areas|All )') then 'aggregate' else 'other' end as geography_level,
 case when cma_code is not null then 'cma:' || cma_code when geography_dguid is not null then 'dguid:' || geography_dguid else 'name:' || geography end as geography_key,
 coalesce(status_code = 'R' or symbol_code = 'R', false) as is_revised, coalesce(status_code = 'P' or symbol_code = 'P', false) as is_preliminary,
 coalesce(status_code = 'T' or symbol_code = 'T' or t_code = 'T', false) as is_terminated, coalesce(status_code = 'X' or symbol_code = 'X', false) as is_suppressed,
 coalesce(status_code in ('..', '...', 'F') or symbol_code in ('..', '...', 'F'), false) as is_unavailable from {short}_0),
{short} as (select *, normalized_value is not null and not is_suppressed and not is_unavailable and {spec.measure} is not null as is_publishable from {short}_1),
{short}_clean as (select * from {short} where {needed} qualify row_number() over (partition by {key} order by source_release_timestamp desc nulls last, is_terminated, is_revised desc, is_publishable desc, source_vector desc nulls last, obs_id desc) = 1)"""


A, M, P, I = "cmhc_housing_activity", "cmhc_starts_by_market", "statcan_building_permits", "statcan_new_housing_price_index"
WA, WM, WP = f"with {typed(A, 'a')}", f"with {typed(M, 'm')}", f"with {typed(P, 'p')}"
WI = f"with {_PRICE}, {typed(I, 'i')}"


def _rows(source: str, table: str, *skip: str) -> str:
    return "obs_id, " + ", ".join(n for n, _ in SOURCES[source].clean_schema if n not in skip)


_DWELLING = """case {c} when 'Total units' then 'total' when 'Single-detached units' then 'single_detached' when 'Single units' then 'single_detached' when 'Semi-detached units' then 'semi_detached' when 'Row units' then 'row'
 when 'Apartment and other unit types' then 'apartment_and_other' when 'Apartment and other types of units' then 'apartment_and_other' else 'unmapped_' || regexp_replace(lower({c}), '[^a-z0-9]+', '_', 'g') end"""
_OK = "geography_level = 'cma' and cma_code is not null and is_publishable"


def _pivot(short: str, member: str, value: str, members: dict[str, str], count: str, prefix: str, flag: str = "", dwelling: bool = True) -> str:
    cols = ", ".join(f"max({value}) filter (where {member} = '{label}') as {name}" for name, label in members.items())
    unit = f", {_DWELLING.format(c='dwelling_type')} as dwelling_type" if dwelling else ""
    return f"""select reference_month, cma_code{unit}, {cols}, count(distinct {member}) as {count}{f', true as {flag}' if flag else ''}, max(source_release_timestamp) as {prefix}_release_timestamp,
 max(source_archive_sha256) as {prefix}_archive_sha256{f', max(geography) as {prefix}_geography' if dwelling else ''} from {short}_clean where {_OK} group by 1, 2{', 3' if dwelling else ''}"""


PIVOT_A = _pivot("a", "housing_measure", "housing_count", {"housing_starts": "Housing starts", "housing_completions": "Housing completions", "housing_under_construction": "Housing under construction"}, "activity_measure_count", "activity", "has_activity_data")
PIVOT_M = _pivot("m", "intended_market", "housing_starts_count", {"starts_homeowner": "Homeowner", "starts_rental": "Rental", "starts_condominium": "Condo", "starts_cooperative": "Co-op", "starts_other_market": "Other market"}, "market_member_count", "market", "has_market_data")
PIVOT_I = _pivot("i", "index_component", "index_value", {"new_housing_price_index": "Total (house and land)", "new_house_price_index": "House only", "new_land_price_index": "Land only"}, "price_index_component_count", "price", dwelling=False)
PERMIT = f"""select reference_month, cma_code, max(permit_value) as residential_permit_value_dollars, max(source_release_timestamp) as permit_release_timestamp, max(source_archive_sha256) as permit_archive_sha256
 from p_clean where {_OK} and building_type = 'Total residential' and work_type = 'Types of work, total' and permit_variable = 'Value of permits' and adjustment_type = 'Seasonally adjusted, current' group by 1, 2"""
_CORE = f"""{typed(A, 'a')}, {typed(M, 'm')}, pa as ({PIVOT_A}), pm as ({PIVOT_M}),
core as (select reference_month, cma_code, dwelling_type, housing_starts, housing_completions, housing_under_construction, activity_measure_count, coalesce(has_activity_data, false) as has_activity_data, activity_release_timestamp, activity_archive_sha256,
 starts_homeowner, starts_rental, starts_condominium, starts_cooperative, starts_other_market, market_member_count, coalesce(has_market_data, false) as has_market_data, market_release_timestamp, market_archive_sha256,
 coalesce(activity_geography, market_geography) as geography, coalesce(activity_measure_count = 3, false) as has_complete_activity, coalesce(market_member_count = 5, false) as has_complete_market_breakdown,
 case when market_member_count > 0 then coalesce(starts_homeowner, 0) + coalesce(starts_rental, 0) + coalesce(starts_condominium, 0) + coalesce(starts_cooperative, 0) + coalesce(starts_other_market, 0) end as market_starts_total
 from pa full join pm using (reference_month, cma_code, dwelling_type))"""
_ALL = f"with {_PRICE}, {_CORE}, {typed(P, 'p')}, {typed(I, 'i')}, pi as ({PIVOT_I}), pp as ({PERMIT})"
_RATIO = "case when housing_starts > 0 then round(housing_completions / housing_starts::double, 4) end as completion_to_start_ratio"
_KEYS = "reference_month, cma_code, dwelling_type"


def _trend(source: str, keys: str, columns: str) -> str:
    """The features by a join of each month with the twelve before it."""
    same = " and ".join(f"x.{k.strip()} = y.{k.strip()}" for k in keys.split(","))
    own = ", ".join(f"x.{k.strip()}" for k in keys.split(","))
    return f"""select {keys}, reference_month, {columns} from (select *, case when n3 = 3 then round(a3, 4) end as starts_3_month_average,
 case when rows12 = 12 and before <> 0 then round((v - before) / before::double * 100, 4) end as starts_year_over_year_pct, u - last_u as under_construction_month_change, n12 = 12 as has_12_month_anomaly_baseline,
 case when n12 = 12 then round(a12, 4) end as starts_prior_12_month_average, case when n12 = 12 then round(s12, 4) end as starts_prior_12_month_stddev,
 case when n12 = 12 and s12 > 0 then round((v - a12) / s12, 4) end as starts_anomaly_zscore, case when n12 = 12 and s12 > 0 then abs(round((v - a12) / s12, 4)) >= 2.0 end as starts_anomaly_flag
 from (select {own}, x.reference_month, x.housing_starts as v, x.housing_under_construction as u, count(y.housing_starts) filter (where k < 3) as n3, avg(y.housing_starts) filter (where k < 3) as a3,
 count(*) filter (where k > 0) as rows12, max(y.housing_starts) filter (where k = 12) as before, max(y.housing_under_construction) filter (where k = 1) as last_u,
 count(y.housing_starts) filter (where k > 0) as n12, avg(y.housing_starts) filter (where k > 0) as a12, stddev_samp(y.housing_starts) filter (where k > 0) as s12
 from (select x.*, y, date_diff('month', y.reference_month, x.reference_month) as k from {source} x join {source} y on {same} and y.reference_month between x.reference_month - interval 12 month and x.reference_month) x group by all))"""


_SERIES = "source_validation_profile, cma_code, dwelling_type"
_FACTS = f"(select distinct {_SERIES}, reference_month, housing_starts, housing_under_construction from fct_housing_monthly)"


def _series(columns: str) -> str:
    return _trend(_FACTS, _SERIES, columns)


_FEATURES = """starts_3_month_average, starts_year_over_year_pct, under_construction_month_change, has_12_month_anomaly_baseline, starts_prior_12_month_average, starts_prior_12_month_stddev,
 starts_anomaly_zscore, starts_anomaly_flag"""
FACT = f"""{_ALL}, joined as (select core.*, new_housing_price_index, new_house_price_index, new_land_price_index, price_index_component_count, price_release_timestamp, price_archive_sha256,
 price_index_component_count is not null as has_price_index_data, coalesce(price_index_component_count = 3, false) as has_complete_price_index, residential_permit_value_dollars, permit_release_timestamp, permit_archive_sha256,
 residential_permit_value_dollars is not null as has_permit_data, {_RATIO}, cast(year(reference_month) as integer) as reference_year
 from core left join pi using (reference_month, cma_code) left join pp using (reference_month, cma_code))
select * from joined join ({_trend('joined', 'cma_code, dwelling_type', _FEATURES)}) using (reference_month, cma_code, dwelling_type)"""

_KEY_NULLS = ("reference_month", "cma_code", "dwelling_type")
_NULLS = ("housing_starts", "housing_completions", "housing_under_construction", "market_starts_total")


def _base(where: str) -> str:
    f = "count(*) filter (where {})"
    both = "housing_starts is not null and market_starts_total is not null"
    parts = {
        "row_count": "count(*)", "years": "count(distinct reference_year)", **{f"unkeyed_{c}": f"count(*) - count({c})" for c in _KEY_NULLS}, **{f"empty_{c}": f"count(*) - count({c})" for c in _NULLS},
        "market_off_compared": f.format(both), "market_off": f.format("housing_starts <> market_starts_total"), "year_off": f.format("reference_year <> year(reference_month)"),
        "dwelling_unknown": f.format("dwelling_type not in ('total', 'single_detached', 'semi_detached', 'row', 'apartment_and_other')"), "anomalies": f.format("starts_anomaly_flag"),
        "without_market": f.format("has_activity_data and not has_market_data"), "without_activity": f.format("has_market_data and not has_activity_data"),
        "without_price": f.format("not has_price_index_data"), "without_permit": f.format("not has_permit_data"),
    }
    return "select " + ", ".join(f"{e} as {n}" for n, e in parts.items()) + f" from fct_housing_monthly where {where}"


def _reconcile() -> str:
    """Totals joined with the sums of their parts, measure by measure."""
    one = """select t.reference_month, t.cma_code, t.v, p.v as parts from (select reference_month, cma_code, max({m}) as v from pa where dwelling_type = 'total' group by 1, 2) t
 join (select reference_month, cma_code, sum({m}) as v, count({m}) as n, count(distinct dwelling_type) as kinds from pa where dwelling_type in ('single_detached', 'semi_detached', 'row', 'apartment_and_other') group by 1, 2) p
 using (reference_month, cma_code) where t.v is not null and n = 4 and kinds = 4"""
    parts = " union all ".join(one.format(m=m) for m in ("housing_starts", "housing_completions", "housing_under_construction"))
    return f"{WA}, pa as ({PIVOT_A}) select count(*) as components_off_compared, count(*) filter (where v <> parts) as components_off from ({parts})"


SQL: dict[str, str] = {
    "clean_blank_to_null": f"select obs_id, {', '.join(f'{_b(c)} as {c.lower()}' for c in ('GEO', 'STATUS', 'SYMBOL', 'VALUE', 'UOM'))} from {A}",
    "clean_common": f"{WA} select {_rows(A, 'a', 'housing_measure', 'dwelling_type', 'measure_temporality', 'is_total_dwelling_type', 'housing_count', 'is_publishable')} from a",
    "clean_month_parse": f"{WA} select obs_id, reference_month from a", "geo_code_extract": f"{WA} select obs_id, cma_code from a",
    "geo_level": f"{WA} select obs_id, geography_level from a", "geo_key": f"{WA} select obs_id, geography_key from a", "scalar_normalize": f"{WA} select obs_id, normalized_value from a",
    "status_flags": f"{WA} select obs_id, is_revised, is_preliminary, is_terminated, is_suppressed, is_unavailable from a", "publishable_flag": f"{WA} select obs_id, is_publishable from a",
    "integral_count": f"{WA} select obs_id, housing_count from a", "positive_decimal": f"{WI} select obs_id, index_value from i", "decimal_cast": f"{WP} select obs_id, permit_value from p",
    "clean_activity": f"{WA} select {_rows(A, 'a')} from a", "clean_market": f"{WM} select {_rows(M, 'm')} from m", "clean_permits": f"{WP} select {_rows(P, 'p')} from p", "clean_price": f"{WI} select {_rows(I, 'i')} from i",
    "drop_missing": f"{WA} select obs_id, reference_month, geography_key from a where reference_month is not null and geography_key is not null and housing_measure is not null and dwelling_type is not null and source_id is not null and geography is not null and source_release_timestamp is not null and source_archive_sha256 is not null",
    "profile_months": f"{WA} select obs_id, reference_month, cma_code from a where reference_month between date '2021-01-01' and date '2023-12-01' and geography_level = 'cma'",
    "profile_names": f"{WA} select obs_id, reference_month, geography from a where reference_month between date '2021-01-01' and date '2023-12-01' and geography in ('Port Merrow, Eastmark', 'Inverlath, Eastmark', 'Pellham, Eastmark')",
    "union_by_name": f"select obs_id, VECTOR as vector from {A}",
    "dedup_newest": f"{WA} select obs_id, reference_month, geography_key, housing_measure, dwelling_type, housing_count from a_clean",
    "clean_summary_activity": f"{WA} select count(*) as row_count, count(*) filter (where not is_publishable) as non_publishable_rows, min(reference_month) as first_month, max(reference_month) as last_month from a_clean",
    "canonical_label": f"select obs_id, {_DWELLING.format(c=_b('Type of unit'))} as dwelling_type from {A}",
    "rollup_eligible": f"{WA} select obs_id, cma_code, housing_count from a where {_OK}",
    "pivot_activity": f"{WA} {PIVOT_A}", "pivot_market": f"{WM} {PIVOT_M}", "pivot_price": f"{WI} {PIVOT_I}", "permit_series": f"{WP} {PERMIT}",
    "market_total": f"with {_CORE} select {_KEYS}, market_starts_total from core", "full_join_core": f"with {_CORE} select * from core",
    "left_join_price": f"{_ALL} select {_KEYS}, new_housing_price_index, new_house_price_index, new_land_price_index, price_index_component_count, price_index_component_count is not null as has_price_index_data, coalesce(price_index_component_count = 3, false) as has_complete_price_index from core left join pi using (reference_month, cma_code)",
    "left_join_permit": f"{_ALL} select {_KEYS}, residential_permit_value_dollars, residential_permit_value_dollars is not null as has_permit_data from core left join pp using (reference_month, cma_code)",
    "optional_context_absent": f"with {_CORE} select {_KEYS}, cast(null as decimal(18,4)) as new_housing_price_index, false as has_price_index_data, cast(null as decimal(24,4)) as residential_permit_value_dollars, false as has_permit_data from core",
    "guarded_ratio": f"{WA} select {_KEYS}, {_RATIO} from ({PIVOT_A})",
    "fact_full": FACT, "fact_sorted": FACT,
    "trailing3_avg": _series("starts_3_month_average"), "mom_change": _series("under_construction_month_change"), "yoy_pct": _series("starts_year_over_year_pct"),
    "baseline12": _series("has_12_month_anomaly_baseline, starts_prior_12_month_average, starts_prior_12_month_stddev"), "anomaly_zscore": _series("starts_anomaly_zscore"), "anomaly_flag": _series("starts_anomaly_flag"),
    "quality_base_metrics": _base("true"), "quality_empty_fact": _base("false"),
    "quality_duplicates": "select cast(coalesce(sum(n - 1), 0) as bigint) as repeated_rows from (select count(*) as n from fct_housing_monthly group by source_validation_profile, reference_month, cma_code, dwelling_type)",
    "quality_completeness": "select count(*) filter (where n <> 5) as places_incomplete, count(*) as places_incomplete_compared from (select count(distinct dwelling_type) as n from fct_housing_monthly group by reference_month, cma_code)",
    "quality_reconcile": _reconcile(),
    "staging_reconcile": f"select count(*) as row_count, count(distinct ({_SERIES}, reference_month)) as distinct_keys, min(reference_month) as first_month, max(reference_month) as last_month from fct_housing_monthly",
    "month_range_replace": f"""with n as (select * from fct_housing_monthly where not created_at_utc < timestamp '2024-01-01'), o as (select * from fct_housing_monthly where created_at_utc < timestamp '2024-01-01'),
 b as (select source_validation_profile, min(reference_month) as lo, max(reference_month) as hi from n group by 1)
 select {_SERIES}, reference_month, housing_starts from n union all select {_SERIES}, reference_month, housing_starts from o where not exists (select 1 from b where b.source_validation_profile = o.source_validation_profile and o.reference_month between b.lo and b.hi)""",
    "load_audit_shape": "select validation_profile, status, count(*) as batches, max(published_row_count) as most_published, min(reference_start) as first_month, max(reference_end) as last_month from (select * from elt_load_audit qualify row_number() over (partition by load_batch_id order by coalesce(completed_at_utc, started_at_utc) desc, status <> 'STARTED' desc) = 1) group by 1, 2",
}
