"""The queries p1 to p7 over the project's tables."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import ref_month
from tidemark.operators import parsing, profile, rolling, snapshots, spikes, units, widen
from tidemark.plans.cubes import ACTIVITY, MARKET, cube_cells, releases
from tidemark.session import cut, fits, read

FACT = "fct_housing_monthly"
LOAD, PROFILE = "source_load_batch_id", "source_validation_profile"


# 1
def p1_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = read(spark, sf_dir, ACTIVITY)
    archive = F.col("_source_archive_sha256").alias("archive")
    rows = cube.select(archive, F.trim("VECTOR").alias("vector"), ref_month(F.col("REF_DATE")).alias("ref_month"), *units.STATING)
    sizes = cube.groupBy(archive).agg(F.count("*").alias("rows"))
    return snapshots.snapshot_changes(rows, releases(spark, sf_dir, ACTIVITY), ["vector", "ref_month"], measure=units.dwelling_quantity, sizes=sizes)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_changes(spark, sf_dir).select(F.col("feed").alias("feed_id"), F.col("label").alias("release_label"), "vector", "ref_month", "change_kind")


# 2
ENTITY = ["source_id", "feed_id", "ref_month", "cma_code", "dwelling_type"]
MEASURES = ("housing_starts", "housing_completions", "housing_under_construction")
MEMBERS = ("starts_homeowner", "starts_rental", "starts_condominium", "starts_cooperative", "starts_other_market")


def p2_wide_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return widen.widen(cube_cells(spark, sf_dir, ACTIVITY, newest_only=True), ENTITY, MEASURES)


def p2_wide_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    return widen.widen(cube_cells(spark, sf_dir, MARKET, newest_only=False), ENTITY, MEMBERS)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    activity = widen.unresolved_cells(cube_cells(spark, sf_dir, ACTIVITY, newest_only=True), ENTITY, MEASURES)
    market = widen.unresolved_cells(cube_cells(spark, sf_dir, MARKET, newest_only=False), ENTITY, MEMBERS)
    return activity.unionByName(market)


# 3
LEVEL_COLUMNS = ("housing_starts", "housing_completions", "housing_under_construction", "market_starts_total", "new_housing_price_index", "residential_permit_value_dollars")
METRICS = ("row_count", "null_count_housing_completions", "distinct_cma_codes", "true_count_has_activity_data", "max_housing_completions")
MAX_CONTRACT_ROWS = 10_000


def contract(spark: SparkSession, sf_dir: str) -> list[tuple]:
    """(column, min, max, pattern) per column; a contract is written by people, and its length is checked."""
    rules = read(spark, sf_dir, "column_contract")
    if not fits(rules, MAX_CONTRACT_ROWS):
        raise ValueError(f"a contract of more than {MAX_CONTRACT_ROWS} columns")
    return [(r.column_name, None if r.min_value != r.min_value else r.min_value, None if r.max_value != r.max_value else r.max_value, r.pattern) for r in rules.collect()]


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One audit row per load: its succeeded attempt if there is one, else the last started."""
    audit = read(spark, sf_dir, "elt_load_audit").withColumn("succeeded", F.coalesce(F.col("status") == "SUCCEEDED", F.lit(False)))
    best = F.max(F.struct("succeeded", "started_at_utc", "validation_profile"))
    return audit.dropna(subset=["load_batch_id"]).groupBy(F.col("load_batch_id").alias("load")).agg(best.alias("a")).select("load", F.col("a.validation_profile").alias("profile"), F.col("a.started_at_utc").alias("started"), "a.succeeded")


def _metric_pairs(text: str | None) -> dict[str, str | None] | None:
    """The known metrics anywhere in a JSON text, keys in any case, numbers perhaps as texts; None if it is no JSON."""
    def refuse(token: str):
        raise ValueError(token)

    try:
        root = json.loads(text, parse_constant=refuse)  # type: ignore[arg-type]
    except (TypeError, ValueError, RecursionError):
        return None
    found: dict[str, str | None] = {}
    stack = [root]
    while stack:
        node = stack.pop()
        if isinstance(node, list):
            stack.extend(node)
        elif isinstance(node, dict):
            name = next((node[k] for k in node if k.lower() in ("name", "metric") and isinstance(node[k], str)), None)
            value = next((node[k] for k in node if k.lower() == "value"), None)
            for k, v in [*node.items(), *([(name, value)] if name is not None else [])]:
                if k.lower() in METRICS and not isinstance(v, dict | list):
                    found[k.lower()] = None if v is None else str(v)
                else:
                    stack.append(v)
    return found


def _read_metrics(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for load, text in zip(frame["load"], frame["text"], strict=True):
            got = _metric_pairs(text)
            rows += [(load, "validation_metrics", None)] if got is None else [(load, k, v) for k, v in got.items()]
        yield pd.DataFrame(rows, columns=["load", "column_name", "stated"])


def metric_findings(spark: SparkSession, sf_dir: str, shape: DataFrame) -> DataFrame:
    """Metrics of succeeded audit rows that differ from the load's profile; a text that is no JSON is itself a finding.

    A load without rows has counts of 0 and no maximum. A metric that a text doesn't give is not compared.
    """
    audit = read(spark, sf_dir, "elt_load_audit").filter("status = 'SUCCEEDED'").select(F.col("load_batch_id").alias("load"), F.col("validation_metrics").alias("text"))
    stated = audit.mapInPandas(_read_metrics, "load string, column_name string, stated string")
    at = {"completions": F.col("column_name") == "housing_completions", "codes": F.col("column_name") == "cma_code", "active": F.col("column_name") == "has_activity_data"}
    facts = shape.groupBy("load").agg(
        F.max("rows").alias("row_count"), F.max(F.when(at["completions"], F.col("nulls"))).alias("null_count_housing_completions"),
        F.max(F.when(at["codes"], F.col("distinct_values"))).alias("distinct_cma_codes"), F.max(F.when(at["active"], F.col("trues"))).alias("true_count_has_activity_data"),
        F.max(F.when(at["completions"], F.col("max_number"))).cast("bigint").alias("max_housing_completions"),
    )
    true = F.lit(None).cast("decimal(30,4)")
    for m in METRICS:
        fact = F.col(m) if m.startswith("max") else F.coalesce(F.col(m), F.lit(0))
        true = F.when(F.col("column_name") == m, fact.cast("decimal(30,4)")).otherwise(true)
    both = stated.join(facts, "load", "left")
    differs = (F.col("column_name") == "validation_metrics") | ~F.col("stated").try_cast("decimal(30,4)").eqNullSafe(true) | (F.col("stated").isNotNull() & F.col("stated").try_cast("decimal(30,4)").isNull())
    return both.filter(differs).select("load", "column_name", F.lit("metric").alias("finding")).distinct()


def _profiled(spark: SparkSession, sf_dir: str, texts: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(fact, profile, load before each load). Columns are unpivoted once; everything else comes from the counts."""
    fact = read(spark, sf_dir, FACT)
    numeric = [f.name for f in fact.schema.fields if isinstance(f.dataType, T.NumericType)]
    counts = cut(profile.value_counts(fact, LOAD, fact.columns))
    shape = cut(profile.profile_counts(counts, contract(spark, sf_dir), numeric, LEVEL_COLUMNS, texts))
    with_rows = shape.select("load").distinct()
    return fact, shape, profile.preceding_loads(attempts(spark, sf_dir).join(with_rows, "load"))


def p3_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profiled(spark, sf_dir, texts=True)[1].withColumnRenamed("load", "load_batch_id")


def p3_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = read(spark, sf_dir, FACT)
    numeric = [f.name for f in fact.schema.fields if isinstance(f.dataType, T.NumericType)]
    loads = attempts(spark, sf_dir).join(fact.select(F.col(LOAD).alias("load")).distinct(), "load")
    counts = cut(profile.value_counts(fact, LOAD, [c for c in fact.columns if c != LOAD]))
    return profile.population_shift(counts, profile.preceding_loads(loads).select("load", "before").dropna(), numeric).withColumnRenamed("load", "load_batch_id")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, shape, before = _profiled(spark, sf_dir, texts=False)
    booleans = [f.name for f in fact.schema.fields if isinstance(f.dataType, T.BooleanType)]
    rules = F.array_compact(F.array(F.when(F.col("pattern_breaches") > 0, F.lit("pattern")), F.when(F.col("range_breaches") > 0, F.lit("range"))))
    broken = shape.select("load", "column_name", F.explode(rules).alias("finding"))
    drift = profile.drift_findings(shape, before, booleans, LEVEL_COLUMNS)
    return broken.unionByName(drift).unionByName(metric_findings(spark, sf_dir, shape)).withColumnRenamed("load", "load_batch_id")


# 4
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.rescaled_rows(read(spark, sf_dir, ACTIVITY))


def p4_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's quantity in single dwelling units, with the unit it was recorded in."""
    return units.dwelling_quantity(read(spark, sf_dir, ACTIVITY)).select("obs_id", "source_unit", F.col("unit_factor").cast("int").alias("unit_factor"), "quantity")


# 5 and 7
SERIES = [PROFILE, "cma_code", "dwelling_type"]


def p5_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = read(spark, sf_dir, FACT)
    out = rolling.trailing_totals(fact, SERIES, "reference_month", "housing_starts", (3, 12), ("updated_at_utc", LOAD))
    return out.withColumnRenamed(PROFILE, "validation_profile")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = p5_totals(spark, sf_dir).filter("housing_starts is null and total_3 > 0")
    return gaps.select("validation_profile", "cma_code", "dwelling_type", F.date_format("reference_month", "yyyy-MM").alias("ref_month"))


def p7_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = spikes.implausible_months(read(spark, sf_dir, FACT), SERIES, "reference_month", "housing_starts", ("updated_at_utc", LOAD))
    return out.withColumnRenamed(PROFILE, "validation_profile")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_flags(spark, sf_dir).select("validation_profile", "cma_code", "dwelling_type", "ref_month")


# 6
# The publisher's columns in order.
HEAD, TAIL = ("REF_DATE", "GEO", "DGUID"), ("UOM", "UOM_ID", "SCALAR_FACTOR", "SCALAR_ID", "VECTOR", "COORDINATE", "VALUE", "STATUS", "SYMBOL", "TERMINATED", "DECIMALS")
CHECKS = {
    "REF_DATE": parsing.Check("ref_date", "try_cast(concat(value, '-01') as date)", r"[0-9]{4}-(?:0[1-9]|1[0-2])"),
    "VALUE": parsing.Check("value", "try_cast(value as double)", r"[+-]?[0-9]+(?:\.[0-9]+)?", ("", "..", "...", "x", "F")),
}
ACTIVITY_LINES = parsing.Layout(ACTIVITY, (*HEAD, "Housing estimates", "Type of unit", *TAIL), CHECKS)
PERMIT_LINES = parsing.Layout("statcan_building_permits", (*HEAD, "Type of building", "Type of work", "Variables", "Seasonal adjustment, value type", *TAIL), CHECKS)


def _checked(spark: SparkSession, sf_dir: str, with_fields: bool) -> DataFrame:
    lines = read(spark, sf_dir, "raw_lines").filter(F.coalesce(F.col("line_no") != 1, F.lit(True))).select("line_id", "source_id", "line")
    return parsing.checked_lines(lines, (ACTIVITY_LINES, PERMIT_LINES), with_fields=with_fields)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir, with_fields=False).filter("reason is not null").select("line_id", "reason")


def p6_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The valid records, typed: month, place, series, value (null for codes) and its code.

    A valid value is cast where it stands: that is one step of the same projection, while joining it from a dictionary of
    all values would shuffle every record.
    """
    checked = _checked(spark, sf_dir, with_fields=True).filter("reason is null")

    def field(name: str):
        at = F.when(F.col("source_id") == ACTIVITY_LINES.source, F.lit(ACTIVITY_LINES.columns.index(name))).otherwise(F.lit(PERMIT_LINES.columns.index(name)))
        return F.get("fields", at)

    value = F.trim(field("VALUE"))
    number = value.try_cast("decimal(24,6)")
    return checked.select(
        "line_id", "source_id", F.to_date(F.concat(F.trim(field("REF_DATE")), F.lit("-01"))).alias("reference_month"), field("GEO").alias("geography"), field("DGUID").alias("dguid"),
        field("VECTOR").alias("vector"), number.alias("value"), F.when(number.isNull(), F.nullif(value, F.lit(""))).alias("value_code"), F.nullif(field("STATUS"), F.lit("")).alias("status"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        p1_found, p1_changes, p2_found, p2_wide_activity, p2_wide_market, p3_found, p3_profile, p3_shift, p4_found, p4_quantities,
        p5_found, p5_totals, p6_found, p6_valid, p7_found, p7_flags,
    )
}
