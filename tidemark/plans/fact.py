"""The monthly fact's columns: a fixed contract of names and types in order."""

# The 45 columns of the monthly fact in contract order.
FACT_COLUMNS = (
    "reference_month", "cma_code", "dwelling_type", "housing_starts", "housing_completions", "housing_under_construction", "activity_measure_count", "has_activity_data",
    "activity_release_timestamp", "activity_archive_sha256", "starts_homeowner", "starts_rental", "starts_condominium", "starts_cooperative", "starts_other_market",
    "market_member_count", "has_market_data", "market_release_timestamp", "market_archive_sha256", "geography", "has_complete_activity", "has_complete_market_breakdown",
    "market_starts_total", "new_housing_price_index", "new_house_price_index", "new_land_price_index", "price_index_component_count", "price_release_timestamp",
    "price_archive_sha256", "has_price_index_data", "has_complete_price_index", "residential_permit_value_dollars", "permit_release_timestamp", "permit_archive_sha256",
    "has_permit_data", "completion_to_start_ratio", "starts_3_month_average", "starts_year_over_year_pct", "under_construction_month_change",
    "has_12_month_anomaly_baseline", "starts_prior_12_month_average", "starts_prior_12_month_stddev", "starts_anomaly_zscore", "starts_anomaly_flag", "reference_year",
)
_OTHER = ("_timestamp", "_sha256")
NUMERIC_COLUMNS = tuple(
    c for c in FACT_COLUMNS if not c.startswith("has_") and not c.endswith(_OTHER) and c not in ("reference_month", "cma_code", "dwelling_type", "geography", "starts_anomaly_flag")
)

# Types of the fact's columns; what is not listed is a count.
_DECIMALS = {"new_housing_price_index": "decimal(18,4)", "new_house_price_index": "decimal(18,4)", "new_land_price_index": "decimal(18,4)", "residential_permit_value_dollars": "decimal(24,4)"}
_DOUBLES = (
    "completion_to_start_ratio", "starts_3_month_average", "starts_year_over_year_pct", "starts_prior_12_month_average", "starts_prior_12_month_stddev", "starts_anomaly_zscore",
)
_TEXTS = ("cma_code", "dwelling_type", "geography")


def _type(column: str) -> str:
    if column in _DECIMALS:
        return _DECIMALS[column]
    if column in _DOUBLES:
        return "double"
    if column in _TEXTS or column.endswith("_sha256"):
        return "string"
    if column.startswith("has_") or column.endswith("_flag"):
        return "boolean"
    return {"reference_month": "date", "reference_year": "int"}.get(column, "timestamp_ntz" if column.endswith("_timestamp") else "bigint")


FACT_TYPES = {c: _type(c) for c in FACT_COLUMNS}
# Columns that published rows carry beside the fact's.
LOAD_TYPES = {"source_load_batch_id": "string", "source_validation_profile": "string", "created_at_utc": "timestamp_ntz", "updated_at_utc": "timestamp_ntz"}
FACT_DDL = ", ".join(f"{c} {t}{' not null' if c in ('reference_month', *_TEXTS, 'reference_year') or (t == 'boolean' and c != 'starts_anomaly_flag') else ''}" for c, t in FACT_TYPES.items())
PUBLISHED_DDL = FACT_DDL + ", " + ", ".join(f"{c} {t} not null" for c, t in LOAD_TYPES.items())
