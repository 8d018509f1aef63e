"""Rollups joined into the monthly fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.errors import AssemblyError
from tidemark.operators.rollup import market_total, permit_rollup, rollup
from tidemark.operators.trends import trends
from tidemark.plans.fact import FACT_COLUMNS
from tidemark.specs import ACTIVITY, ACTIVITY_ROLLUP, MARKET, MARKET_ROLLUP, PERMIT_CONTEXT, PRICE_CONTEXT, PRICE_ROLLUP, ContextSpec, TrendSpec

KEYS = ["reference_month", "cma_code", "dwelling_type"]


def core(activity: DataFrame, market: DataFrame) -> DataFrame:
    """Full join of the two rollups; a key may be in either or both."""
    def full(column: str, members: int):
        return F.coalesce(F.col(column) == members, F.lit(False))

    joined = activity.join(market, KEYS, "full")
    return joined.withColumns({
        "geography": F.coalesce("activity_geography", "market_geography"),
        "has_activity_data": F.coalesce("has_activity_data", F.lit(False)), "has_market_data": F.coalesce("has_market_data", F.lit(False)),
        "has_complete_activity": full("activity_measure_count", len(ACTIVITY_ROLLUP.members)), "has_complete_market_breakdown": full("market_member_count", len(MARKET_ROLLUP.members)),
        "market_starts_total": market_total(MARKET_ROLLUP),
    }).drop("activity_geography", "market_geography")


def with_context(fact: DataFrame, side: DataFrame | None, spec: ContextSpec) -> DataFrame:
    """A context's columns and flags beside each dwelling row; typed nulls where there is no such source.

    The side is left to AQE: broadcast if its measured size is small, else shuffled.
    """
    if side is None:
        fact = fact.withColumns({name: F.lit(None).cast(kind) for name, kind in spec.columns})
    else:
        fact = fact.join(side.select(*spec.keys, *(name for name, _ in spec.columns)), list(spec.keys), "left")
    return fact.withColumns({flag: F.expr(condition) for flag, condition in spec.flags})


def with_ratio(fact: DataFrame) -> DataFrame:
    ratio = F.round(F.col("housing_completions") / F.nullif(F.col("housing_starts"), F.lit(0)), 4)
    return fact.withColumn("completion_to_start_ratio", F.when(F.col("housing_starts") > 0, ratio))


def build_fact(clean: dict[str, DataFrame], trend: TrendSpec = TrendSpec()) -> DataFrame:
    """The 45-column fact from clean frames by source id; activity and market are required, the contexts optional."""
    missing = sorted({ACTIVITY.source_id, MARKET.source_id} - clean.keys())
    if missing:
        raise AssemblyError(f"missing required sources: {', '.join(missing)}")
    sides = {PRICE_CONTEXT: lambda rows: rollup(rows, PRICE_ROLLUP), PERMIT_CONTEXT: permit_rollup}
    joined = core(rollup(clean[ACTIVITY.source_id], ACTIVITY_ROLLUP), rollup(clean[MARKET.source_id], MARKET_ROLLUP))
    for spec, roll in sides.items():
        joined = with_context(joined, roll(clean[spec.source_id]) if spec.source_id in clean else None, spec)
    return trends(with_ratio(joined).withColumn("reference_year", F.year("reference_month")), trend).select(*FACT_COLUMNS)
