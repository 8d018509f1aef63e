"""Specifications: what the sources, rollups, contexts, trends and gates are, as data. Compilers are in operators/."""

from __future__ import annotations

from dataclasses import dataclass, field

# The columns every cube ends with, and the provenance columns added at the scan.
TRAILING_COLUMNS = ("UOM", "UOM_ID", "SCALAR_FACTOR", "SCALAR_ID", "VECTOR", "COORDINATE", "VALUE", "STATUS", "SYMBOL", "TERMINATED", "DECIMALS")
LEADING_COLUMNS = ("REF_DATE", "GEO", "DGUID")
PROVENANCE = ("_source_id", "_source_release_timestamp", "_source_archive_sha256")

#: Columns every clean fact has, with their types; a source's dimensions and measure follow.
CLEAN_COMMON = (
    ("source_id", "string"), ("reference_month", "date"), ("geography", "string"), ("geography_dguid", "string"), ("geography_level", "string"), ("cma_code", "string"),
    ("unit", "string"), ("unit_id", "int"), ("scalar_factor", "string"), ("scalar_id", "int"), ("status_code", "string"), ("symbol_code", "string"),
    ("is_revised", "boolean"), ("is_preliminary", "boolean"), ("is_terminated", "boolean"), ("is_suppressed", "boolean"), ("is_publishable", "boolean"),
    ("source_vector", "string"), ("source_coordinate", "string"), ("source_decimals", "int"), ("source_release_timestamp", "timestamp_ntz"), ("source_archive_sha256", "string"),
)


@dataclass(frozen=True)
class SourceSpec:
    """A cube: its dimensions (raw -> clean name), its measure and extra clean columns as SQL over clean names.

    measure_sql reads ``normalized_value``, the exact decimal after scaling.
    """

    source_id: str
    product_id: int
    dimensions: tuple[tuple[str, str], ...]
    measure: str
    measure_type: str
    measure_sql: str
    extras: tuple[tuple[str, str, str], ...] = ()

    @property
    def raw_columns(self) -> tuple[str, ...]:
        return (*LEADING_COLUMNS, *(raw for raw, _ in self.dimensions), *TRAILING_COLUMNS)

    @property
    def natural_key(self) -> tuple[str, ...]:
        return ("reference_month", "geography_key", *(name for _, name in self.dimensions))

    @property
    def clean_schema(self) -> tuple[tuple[str, str], ...]:
        dims = tuple((name, "string") for _, name in self.dimensions)
        return (*CLEAN_COMMON, *dims, *((n, t) for n, t, _ in self.extras), (self.measure, self.measure_type))


_COUNT = "case when normalized_value >= 0 and normalized_value = floor(normalized_value) then try_cast(normalized_value as bigint) end"

# Labels of the publisher's members.
ACTIVITY = SourceSpec(
    "cmhc_housing_activity", 34100154, (("Housing estimates", "housing_measure"), ("Type of unit", "dwelling_type")), "housing_count", "bigint", _COUNT,
    (
        ("measure_temporality", "string", "case when housing_measure in ('Housing starts', 'Housing completions') then 'flow' when housing_measure = 'Housing under construction' then 'stock' else 'unknown' end"),
        ("is_total_dwelling_type", "boolean", "coalesce(dwelling_type = 'Total units', false)"),
    ),
)
MARKET = SourceSpec(
    "cmhc_starts_by_market", 34100148, (("Type of dwelling unit", "dwelling_type"), ("Type of market", "intended_market")), "housing_starts_count", "bigint", _COUNT,
    (("measure_temporality", "string", "'flow'"),),
)
PERMITS = SourceSpec(
    "statcan_building_permits", 34100292,
    (("Type of building", "building_type"), ("Type of work", "work_type"), ("Variables", "permit_variable"), ("Seasonal adjustment, value type", "adjustment_type")),
    "permit_value", "decimal(24,4)", "try_cast(normalized_value as decimal(24,4))",
    (("is_total_building_type", "boolean", "coalesce(startswith(lower(building_type), 'total'), false)"),),
)
PRICES = SourceSpec(
    "statcan_new_housing_price_index", 18100205, (("New housing price indexes", "index_component"),), "index_value", "decimal(18,4)",
    "case when normalized_value > 0 then try_cast(normalized_value as decimal(18,4)) end",
    (("is_total_index", "boolean", "coalesce(index_component = 'Total (house and land)', false)"),),
)
SOURCES = {s.source_id: s for s in (ACTIVITY, MARKET, PERMITS, PRICES)}


@dataclass(frozen=True)
class Profile:
    """A named bundle of sources, months (inclusive, yyyy-MM-dd) and areas: by code where given, else by name, else all of level cma."""

    name: str
    sources: tuple[str, ...]
    start: str
    end: str
    cma_names: tuple[str, ...] = ()
    cma_codes: tuple[str, ...] = ()


@dataclass(frozen=True)
class RollupSpec:
    """max(value) per member at a grain: output column -> member label, with a distinct-member count and provenance."""

    keys: tuple[str, ...]
    member: str
    value: str
    members: tuple[tuple[str, str], ...]
    count: str
    prefix: str
    flag: str | None = None
    canonical: str | None = None


ACTIVITY_ROLLUP = RollupSpec(
    ("reference_month", "cma_code", "dwelling_type"), "housing_measure", "housing_count",
    (("housing_starts", "Housing starts"), ("housing_completions", "Housing completions"), ("housing_under_construction", "Housing under construction")),
    "activity_measure_count", "activity", "has_activity_data", "dwelling_type",
)
MARKET_ROLLUP = RollupSpec(
    ("reference_month", "cma_code", "dwelling_type"), "intended_market", "housing_starts_count",
    (("starts_homeowner", "Homeowner"), ("starts_rental", "Rental"), ("starts_condominium", "Condo"), ("starts_cooperative", "Co-op"), ("starts_other_market", "Other market")),
    "market_member_count", "market", "has_market_data", "dwelling_type",
)
PRICE_ROLLUP = RollupSpec(
    ("reference_month", "cma_code"), "index_component", "index_value",
    (("new_housing_price_index", "Total (house and land)"), ("new_house_price_index", "House only"), ("new_land_price_index", "Land only")),
    "price_index_component_count", "price",
)
# The one permit series that overlaps no other, and the publisher's dwelling labels.
PERMIT_SERIES = {
    "building_type": "Total residential", "work_type": "Types of work, total", "permit_variable": "Value of permits", "adjustment_type": "Seasonally adjusted, current",
}

DWELLING_LABELS = {
    "Total units": "total", "Single-detached units": "single_detached", "Single units": "single_detached", "Semi-detached units": "semi_detached", "Row units": "row",
    "Apartment and other unit types": "apartment_and_other", "Apartment and other types of units": "apartment_and_other",
}
# How names of aggregates begin.
AGGREGATE_PREFIXES = ("Census metropolitan areas", "Total census metropolitan areas", "All ")


@dataclass(frozen=True)
class ContextSpec:
    """A side joined to every dwelling row of a month and area: its columns with types, and flags as SQL conditions over them."""

    source_id: str
    columns: tuple[tuple[str, str], ...]
    flags: tuple[tuple[str, str], ...]
    keys: tuple[str, ...] = ("reference_month", "cma_code")


def _provenance(prefix: str) -> tuple[tuple[str, str], ...]:
    return ((f"{prefix}_release_timestamp", "timestamp_ntz"), (f"{prefix}_archive_sha256", "string"))


# A price row counts though its total is missing; a permit row without a value does not.
PRICE_CONTEXT = ContextSpec(
    PRICES.source_id, (*((name, "decimal(18,4)") for name, _ in PRICE_ROLLUP.members), (PRICE_ROLLUP.count, "bigint"), *_provenance("price")),
    (("has_price_index_data", f"{PRICE_ROLLUP.count} is not null"), ("has_complete_price_index", f"coalesce({PRICE_ROLLUP.count} = {len(PRICE_ROLLUP.members)}, false)")),
)
PERMIT_CONTEXT = ContextSpec(
    PERMITS.source_id, (("residential_permit_value_dollars", "decimal(24,4)"), *_provenance("permit")), (("has_permit_data", "residential_permit_value_dollars is not null"),)
)


@dataclass(frozen=True)
class TrendSpec:
    """Gap-gated features of a monthly series: trailing average, month and year changes, baseline and anomaly."""

    keys: tuple[str, ...] = ("cma_code", "dwelling_type")
    month: str = "reference_month"
    flow: str = "housing_starts"
    stock: str = "housing_under_construction"
    prefix: str = "starts"
    trailing: int = 3
    baseline: int = 12
    threshold: float = 2.0


@dataclass(frozen=True)
class QualityPolicy:
    """Thresholds of the gates; a fraction is the greatest allowed share."""

    name: str
    min_rows: int
    max_rows: int
    keys: tuple[str, ...] = ("reference_month", "cma_code", "dwelling_type")
    dwelling_types: tuple[str, ...] = ("total", "single_detached", "semi_detached", "row", "apartment_and_other")
    null_thresholds: dict[str, float] = field(default_factory=dict)
    max_duplicate_rows: int = 0
    max_market_mismatch: float = 0.0
    max_component_mismatch: float = 0.0
    require_complete_dwellings: bool = False
