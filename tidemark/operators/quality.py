"""Fail-closed quality gates over the fact: conditions as data, compiled into one aggregation, and one report of all failures."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.errors import QualityError
from tidemark.plans.fact import FACT_TYPES
from tidemark.specs import QualityPolicy

# The columns of the fact that gates rely on; others are allowed.
CONTRACT = (
    "reference_month", "reference_year", "cma_code", "geography", "dwelling_type", "housing_starts", "housing_completions", "housing_under_construction", "market_starts_total",
    "new_housing_price_index", "residential_permit_value_dollars", "has_activity_data", "has_market_data", "has_price_index_data", "has_permit_data", "starts_anomaly_flag",
)
MEASURES = ("housing_starts", "housing_completions", "housing_under_construction")
PLACE = ("reference_month", "cma_code")
TOTAL = "total"


@dataclass(frozen=True)
class Issue:
    check: str
    message: str


@dataclass(frozen=True)
class Report:
    profile: str
    metrics: dict[str, int | float | None] = field(default_factory=dict)
    issues: tuple[Issue, ...] = ()

    @property
    def passed(self) -> bool:
        return not self.issues


@dataclass(frozen=True)
class Gate:
    """What is looked at (``among``), which of it is ``wrong``, both SQL conditions, and how much of that is let pass.

    ``most`` is a number of cases, ``share`` a part of those looked at; with neither the number is only reported.
    ``evidence``: having nothing to look at is a failure too, for then nothing was checked.
    """

    name: str
    check: str
    wrong: str
    among: str = "true"
    most: int | None = None
    share: float | None = None
    evidence: bool = False

    @property
    def base(self) -> str:
        return "row_count" if self.among == "true" else f"{self.name}_compared"

    def columns(self) -> list[Column]:
        counts = [F.expr(f"count_if(({self.among}) and ({self.wrong}))").alias(self.name)]
        return counts if self.among == "true" else [*counts, F.expr(f"count_if({self.among})").alias(self.base)]

    def issue(self, metrics: dict) -> Issue | None:
        found, looked_at = metrics[self.name], metrics[self.base]
        part = found / looked_at if looked_at else 0.0
        if self.evidence and not looked_at and metrics["row_count"]:
            return Issue(self.check, f"{self.name}: there is nothing to compare")
        if self.most is not None and found > self.most:
            return Issue(self.check, f"{self.name}: {found} cases, at most {self.most} are let pass")
        if self.share is not None and part > self.share:
            return Issue(self.check, f"{self.name}: {part:.6f} of {looked_at}, at most {self.share} is let pass")
        return None


def row_gates(policy: QualityPolicy) -> list[Gate]:
    """Gates that a row passes or fails by itself."""
    allowed = ", ".join(f"'{d}'" for d in policy.dwelling_types)
    return [
        *(Gate(f"unkeyed_{c}", "key_nulls", f"`{c}` is null", most=0) for c in policy.keys),
        *(Gate(f"empty_{c}", "null_threshold", f"`{c}` is null", share=share) for c, share in policy.null_thresholds.items()),
        Gate("market_off", "market_reconciliation", "housing_starts <> market_starts_total", "housing_starts is not null and market_starts_total is not null", share=policy.max_market_mismatch, evidence=True),
        Gate("year_off", "reference_year", "reference_year <> year(reference_month)", most=0),
        Gate("dwelling_unknown", "dwelling_domain", f"dwelling_type not in ({allowed})", most=0),
        Gate("anomalies", "", "starts_anomaly_flag"),
        Gate("without_market", "", "has_activity_data and not has_market_data"),
        Gate("without_activity", "", "has_market_data and not has_activity_data"),
        Gate("without_price", "", "not has_price_index_data"),
        Gate("without_permit", "", "not has_permit_data"),
    ]


def place_gates(policy: QualityPolicy) -> list[Gate]:
    """Gates of a month, area and measure; see place_totals for what they may name."""
    kinds, parts = len(policy.dwelling_types), len(_parts(policy))
    ready = f"part_kinds = {parts} and part_values = {parts} and total is not null"
    return [
        Gate("places_incomplete", "dwelling_completeness", f"kinds <> {kinds}", f"measure = '{MEASURES[0]}'", most=0 if policy.require_complete_dwellings else None),
        Gate("components_off", "component_reconciliation", "total <> part_sum", ready, share=policy.max_component_mismatch, evidence=True),
    ]


def _parts(policy: QualityPolicy) -> list[str]:
    return [d for d in policy.dwelling_types if d != TOTAL]


def _counted(rows: DataFrame, gates: Iterable[Gate]) -> DataFrame:
    columns = [c for g in gates for c in g.columns()]
    return rows.agg(*columns)


def row_metrics(fact: DataFrame, policy: QualityPolicy) -> DataFrame:
    """One row from one pass: row_count, years, and of each row gate what is wrong and what was looked at; zeros for an empty fact."""
    columns = [c for g in row_gates(policy) for c in g.columns()]
    return fact.agg(F.count("*").alias("row_count"), F.countDistinct("reference_year").alias("years"), *columns)


def place_totals(fact: DataFrame, policy: QualityPolicy) -> DataFrame:
    """A row per month, area and measure: kinds of dwellings, and the published total beside the sum of its parts.

    The measures are unpivoted first, so one aggregation serves all of them and no join is needed. Kinds are held as a
    set, of a handful of names.
    """
    cells = fact.select(*PLACE, "dwelling_type", F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in MEASURES))).alias("cell"))
    cells = cells.select(*PLACE, "dwelling_type", "cell.*")
    part, value = F.col("dwelling_type").isin(*_parts(policy)), F.col("value")
    return cells.groupBy(*PLACE, "measure").agg(
        F.size(F.collect_set("dwelling_type")).alias("kinds"), F.size(F.collect_set(F.when(part, F.col("dwelling_type")))).alias("part_kinds"),
        F.count(F.when(part, value)).alias("part_values"), F.sum(F.when(part, value)).alias("part_sum"), F.max(F.when(F.col("dwelling_type") == TOTAL, value)).alias("total"),
    )


def place_metrics(fact: DataFrame, policy: QualityPolicy) -> DataFrame:
    """One row: incomplete places, and comparisons of a total with its parts, made and failed.

    A comparison is made where every part has just one value and the total has one.
    """
    return _counted(place_totals(fact, policy), place_gates(policy))


def repeats(fact: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One row: rows in excess of one per key."""
    per_key = fact.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum("n") - F.count("*"), F.lit(0)).alias("repeated_rows"))


def schema_issues(fact: DataFrame, policy: QualityPolicy) -> list[Issue]:
    """Columns that are missing or of another type: those of the contract, and any the policy names."""
    types, out = dict(fact.dtypes), []
    for column in dict.fromkeys((*CONTRACT, *policy.keys, *policy.null_thresholds)):
        wanted = FACT_TYPES.get(column) if column in CONTRACT else types.get(column, "given")
        if types.get(column) != wanted:
            out.append(Issue("schema", f"{column} is {types.get(column, 'missing')}, not {wanted}"))
    return out


def evaluate(fact: DataFrame, policy: QualityPolicy) -> Report:
    """Run every gate and list every failure; a wrong schema ends the run before any metric."""
    wrong = schema_issues(fact, policy)
    if wrong:
        return Report(policy.name, {"row_count": None}, tuple(wrong))
    metrics: dict[str, int | float | None] = {}
    for frame in (row_metrics(fact, policy), place_metrics(fact, policy), repeats(fact, policy.keys)):
        metrics |= frame.first().asDict()
    rows = metrics["row_count"]
    issues = [] if policy.min_rows <= rows <= policy.max_rows else [Issue("row_count", f"{rows} rows, not {policy.min_rows} to {policy.max_rows}")]
    repeated = Gate("repeated_rows", "duplicate_keys", "", most=policy.max_duplicate_rows)
    issues += [i for g in (*row_gates(policy), repeated, *place_gates(policy)) if (i := g.issue(metrics)) is not None]
    return Report(policy.name, metrics, tuple(issues))


def require(fact: DataFrame, policy: QualityPolicy) -> Report:
    """The report, or QualityError with it if a gate fails."""
    report = evaluate(fact, policy)
    if not report.passed:
        raise QualityError(report)
    return report
