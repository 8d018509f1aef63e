"""Queries of the cleaning, rollup, assembly, trend, quality and publication operators over the project's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import publish
from tidemark.operators import assemble, quality
from tidemark.operators.normalize import blank, normalize, project
from tidemark.operators.revisions import clean_source, clean_summary, dedup_latest, drop_missing_keys, profile_filter, union_releases
from tidemark.operators.rollup import canonical_dwelling, eligible, permit_rollup, rollup
from tidemark.operators.trends import trends
from tidemark.plans.fact import FACT_COLUMNS
from tidemark.session import read, shared_folder
from tidemark.specs import ACTIVITY, ACTIVITY_ROLLUP, MARKET, MARKET_ROLLUP, PERMIT_CONTEXT, PERMITS, PRICE_CONTEXT, PRICE_ROLLUP, PRICES, Profile, QualityPolicy, SourceSpec, TrendSpec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ROW = ("obs_id",)
WINDOW = Profile("window", (), "2021-01-01", "2023-12-01")
NAMED = Profile("named", (), "2021-01-01", "2023-12-01", ("Port Merrow, Eastmark", "Inverlath, Eastmark", "Pellham, Eastmark"))
POLICY = QualityPolicy("all", 1, 10**12, null_thresholds={c: 0.5 for c in ("housing_starts", "housing_completions", "housing_under_construction", "market_starts_total")})


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def raw(spark: SparkSession, sf_dir: str, spec: SourceSpec) -> DataFrame:
    return price_lines(spark, sf_dir) if spec is PRICES else read(spark, sf_dir, spec.source_id)


def price_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price rows in the publisher's layout, made of order lines: no table holds any. One per ship month, nation and return flag."""
    lines = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    months = lines.groupBy(F.trunc(F.add_months(F.col("l_shipdate").cast("date"), 336), "month").alias("m"), F.col("s_nationkey").cast("int").alias("n"), "l_returnflag")
    top = months.agg(F.max(F.col("l_extendedprice").cast("decimal(18,4)")).alias("v"))
    code = (154 + 17 * F.col("n")).cast("string")
    label = F.when(F.col("l_returnflag") == "A", "Total (house and land)").when(F.col("l_returnflag") == "N", "House only").otherwise("Land only")
    null = F.lit(None).cast("string")
    return top.select(
        F.concat_ws("-", "n", "l_returnflag", "m").alias("obs_id"), F.date_format("m", "yyyy-MM").alias("REF_DATE"), F.concat(F.lit("Area "), code).alias("GEO"), F.concat(F.lit("2021S0503"), code).alias("DGUID"),
        label.alias("New housing price indexes"), F.lit("Index").alias("UOM"), F.lit("347").alias("UOM_ID"), F.lit("units").alias("SCALAR_FACTOR"), F.lit("0").alias("SCALAR_ID"), F.lit("v1").alias("VECTOR"),
        F.lit("1.1").alias("COORDINATE"), F.col("v").cast("string").alias("VALUE"), null.alias("STATUS"), null.alias("SYMBOL"), null.alias("TERMINATED"), F.lit("1").alias("DECIMALS"),
        F.lit(PRICES.source_id).alias("_source_id"), F.lit("2025-01-15 13:30:00").cast("timestamp_ntz").alias("_source_release_timestamp"), F.lit("p" * 64).alias("_source_archive_sha256"),
    )


def typed(spark: SparkSession, sf_dir: str, spec: SourceSpec) -> DataFrame:
    return normalize(raw(spark, sf_dir, spec), spec, ROW)


def clean(spark: SparkSession, sf_dir: str, spec: SourceSpec) -> DataFrame:
    return clean_source(raw(spark, sf_dir, spec), spec, tie=ROW)


# Cleaning: every row of the activity cube unless the name says another source.
@query
def clean_blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, ACTIVITY).select("obs_id", *(F.expr(blank(c)).alias(c.lower()) for c in ("GEO", "STATUS", "SYMBOL", "VALUE", "UOM")))


@query
def clean_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [n for n, _ in ACTIVITY.clean_schema if n not in ("housing_measure", "dwelling_type", "measure_temporality", "is_total_dwelling_type", "housing_count", "is_publishable")]
    return typed(spark, sf_dir, ACTIVITY).select("obs_id", *names)


def _columns(name: str, spec: SourceSpec, *columns: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return typed(spark, sf_dir, spec).select("obs_id", *columns)

    QUERIES[name] = run


_columns("clean_month_parse", ACTIVITY, "reference_month")
_columns("geo_code_extract", ACTIVITY, "cma_code")
_columns("geo_level", ACTIVITY, "geography_level")
_columns("geo_key", ACTIVITY, "geography_key")
_columns("scalar_normalize", ACTIVITY, "normalized_value")
_columns("status_flags", ACTIVITY, "is_revised", "is_preliminary", "is_terminated", "is_suppressed", "is_unavailable")
_columns("publishable_flag", ACTIVITY, "is_publishable")
_columns("integral_count", ACTIVITY, "housing_count")
_columns("positive_decimal", PRICES, "index_value")
_columns("decimal_cast", PERMITS, "permit_value")


def _clean(name: str, spec: SourceSpec) -> None:
    QUERIES[name] = lambda spark, sf_dir: project(typed(spark, sf_dir, spec), spec, ROW)


_clean("clean_activity", ACTIVITY)
_clean("clean_market", MARKET)
_clean("clean_permits", PERMITS)
_clean("clean_price", PRICES)


@query
def drop_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_missing_keys(typed(spark, sf_dir, ACTIVITY), ACTIVITY).select("obs_id", "reference_month", "geography_key")


@query
def profile_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_filter(typed(spark, sf_dir, ACTIVITY), WINDOW).select("obs_id", "reference_month", "cma_code")


@query
def profile_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_filter(typed(spark, sf_dir, ACTIVITY), NAMED).select("obs_id", "reference_month", "geography")


@query
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The releases of the cube read one by one and united: every row again, columns matched by name."""
    frame = raw(spark, sf_dir, ACTIVITY).select("obs_id", "VECTOR", "_source_release_timestamp")
    early = frame.filter("_source_release_timestamp < timestamp_ntz'2024-06-01 00:00:00'")
    late = frame.filter("not coalesce(_source_release_timestamp < timestamp_ntz'2024-06-01 00:00:00', false)").select("_source_release_timestamp", "VECTOR", "obs_id")
    return union_releases([early, late]).select("obs_id", F.col("VECTOR").alias("vector"))


@query
def dedup_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = drop_missing_keys(typed(spark, sf_dir, ACTIVITY), ACTIVITY)
    return dedup_latest(keyed, ACTIVITY, ROW).select("obs_id", "reference_month", "geography_key", "housing_measure", "dwelling_type", "housing_count")


@query
def clean_summary_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_summary(clean(spark, sf_dir, ACTIVITY))


# Rollups.
@query
def canonical_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, ACTIVITY).select("obs_id", canonical_dwelling(F.expr(blank("Type of unit"))).alias("dwelling_type"))


@query
def rollup_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eligible(typed(spark, sf_dir, ACTIVITY)).select("obs_id", "cma_code", "housing_count")


@query
def pivot_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup(clean(spark, sf_dir, ACTIVITY), ACTIVITY_ROLLUP)


@query
def pivot_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup(clean(spark, sf_dir, MARKET), MARKET_ROLLUP)


@query
def pivot_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup(clean(spark, sf_dir, PRICES), PRICE_ROLLUP)


@query
def permit_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permit_rollup(clean(spark, sf_dir, PERMITS))


@query
def market_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return full_join_core(spark, sf_dir).select(*assemble.KEYS, "market_starts_total")


# Assembly.
@query
def full_join_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.core(pivot_activity(spark, sf_dir), pivot_market(spark, sf_dir))


@query
def left_join_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = assemble.with_context(full_join_core(spark, sf_dir), pivot_price(spark, sf_dir), PRICE_CONTEXT)
    return joined.select(*assemble.KEYS, "new_housing_price_index", "new_house_price_index", "new_land_price_index", "price_index_component_count", "has_price_index_data", "has_complete_price_index")


@query
def left_join_permit(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = assemble.with_context(full_join_core(spark, sf_dir), permit_series(spark, sf_dir), PERMIT_CONTEXT)
    return joined.select(*assemble.KEYS, "residential_permit_value_dollars", "has_permit_data")


@query
def optional_context_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = assemble.with_context(assemble.with_context(full_join_core(spark, sf_dir), None, PRICE_CONTEXT), None, PERMIT_CONTEXT)
    return joined.select(*assemble.KEYS, "new_housing_price_index", "has_price_index_data", "residential_permit_value_dollars", "has_permit_data")


@query
def guarded_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.with_ratio(pivot_activity(spark, sf_dir)).select(*assemble.KEYS, "completion_to_start_ratio")


@query
def fact_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.build_fact({s.source_id: clean(spark, sf_dir, s) for s in (ACTIVITY, MARKET, PERMITS, PRICES)})


@query
def fact_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact written by the sink, one directory a year, and read again."""
    target = f"{shared_folder(spark)}/fact-{uuid.uuid4().hex}"
    publish.write_fact(fact_full(spark, sf_dir), target)
    return spark.read.parquet(target).select(*FACT_COLUMNS)


# Trends over the published facts, repeats removed, each profile by itself.
SERIES = ("source_validation_profile", "cma_code", "dwelling_type")


def _trend(name: str, *columns: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = read(spark, sf_dir, "fct_housing_monthly").select(*SERIES, "reference_month", "housing_starts", "housing_under_construction").distinct()
        return trends(rows, TrendSpec(keys=SERIES)).select(*SERIES, "reference_month", *columns)

    QUERIES[name] = run


_trend("trailing3_avg", "starts_3_month_average")
_trend("mom_change", "under_construction_month_change")
_trend("yoy_pct", "starts_year_over_year_pct")
_trend("baseline12", "has_12_month_anomaly_baseline", "starts_prior_12_month_average", "starts_prior_12_month_stddev")
_trend("anomaly_zscore", "starts_anomaly_zscore")
_trend("anomaly_flag", "starts_anomaly_flag")


# Quality over all published facts as one.
def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "fct_housing_monthly")


@query
def quality_base_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_metrics(_fact(spark, sf_dir), POLICY)


@query
def quality_empty_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_metrics(_fact(spark, sf_dir).filter("1 = 0"), POLICY)


@query
def quality_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repeats(_fact(spark, sf_dir), ("source_validation_profile", *POLICY.keys))


@query
def quality_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.place_metrics(_fact(spark, sf_dir), POLICY).select("places_incomplete", "places_incomplete_compared")


@query
def quality_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total against components in the fact built from the cubes, where each key has one row."""
    return quality.place_metrics(pivot_activity(spark, sf_dir), POLICY).select("components_off", "components_off_compared")


# Publication.
@query
def staging_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.staging_summary(_fact(spark, sf_dir), [*SERIES, "reference_month"])


@query
def month_range_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows created before 2024 with the months of the rows created since replaced by these, per profile."""
    rows = _fact(spark, sf_dir).select("source_validation_profile", *assemble.KEYS, "housing_starts", "created_at_utc")
    split = F.col("created_at_utc") < F.lit("2024-01-01").cast("timestamp_ntz")
    kept = publish.replace_months(rows.filter(split), rows.filter(~split), ["source_validation_profile"])
    return kept.select("source_validation_profile", *assemble.KEYS, "housing_starts")


@query
def load_audit_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each load batch the last state of its audit, counted by profile and state."""
    log = read(spark, sf_dir, "elt_load_audit").withColumn("at_utc", F.coalesce("completed_at_utc", "started_at_utc").cast("timestamp"))
    states = publish.last_states(log.select(*publish.AUDIT_COLUMNS))
    return states.groupBy("validation_profile", "status").agg(F.count("*").alias("batches"), F.max("published_row_count").alias("most_published"), F.min("reference_start").alias("first_month"), F.max("reference_end").alias("last_month"))
