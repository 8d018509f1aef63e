"""Features of monthly series over frames of calendar months, so a gap is simply a month without a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.specs import TrendSpec


class Calendar:
    """Aggregates over the months from ``first`` to ``last`` relative to a row's own; all frames share one exchange and one sort."""

    def __init__(self, keys: tuple[str, ...], month: str) -> None:
        self.series = Window.partitionBy(*keys).orderBy(F.year(month) * 12 + F.month(month))

    def over(self, first: int, last: int, aggregate: Column) -> Column:
        return aggregate.over(self.series.rangeBetween(first, last))

    def full(self, first: int, last: int, what: Column) -> Column:
        """Whether every month of the frame has ``what``."""
        return self.over(first, last, F.count(what)) == last - first + 1


def trends(df: DataFrame, spec: TrendSpec = TrendSpec()) -> DataFrame:
    """Add trailing average, year change, month change of the stock, baseline, z-score and anomaly flag.

    Assumes one row per key and month. A feature is null unless all months it looks at are there: those of an average
    with a value, those of a year change as rows. The z-score comes from unrounded figures, the flag from the rounded
    score; without a score there is no flag. An empty table gives none.
    """
    months, flow, stock = Calendar(spec.keys, spec.month), F.col(spec.flow), F.col(spec.stock)
    year, base = (-12, -1), (-spec.baseline, -1)
    earlier = F.when(months.full(*year, F.lit(1)), months.over(-12, -12, F.max(flow)))
    mean, spread = (months.over(*base, f(flow)) for f in (F.avg, F.stddev_samp))
    based = months.full(*base, flow)

    def known(condition: Column, value: Column) -> Column:
        return F.when(condition, F.round(value, 4))

    p, n = spec.prefix, spec.baseline
    score, flag = f"{p}_anomaly_zscore", f"{p}_anomaly_flag"
    near = (1 - spec.trailing, 0)
    features = {
        f"{p}_{spec.trailing}_month_average": known(months.full(*near, flow), months.over(*near, F.avg(flow))),
        f"{p}_year_over_year_pct": known(earlier != 0, (flow - earlier) / F.nullif(earlier, F.lit(0)) * 100),
        "under_construction_month_change": stock - months.over(-1, -1, F.max(stock)),
        f"has_{n}_month_anomaly_baseline": based,
        f"{p}_prior_{n}_month_average": known(based, mean),
        f"{p}_prior_{n}_month_stddev": known(based, spread),
        score: known(based & (spread > 0), (flow - mean) / F.nullif(spread, F.lit(0.0))),
    }
    return df.withColumns(features).withColumn(flag, F.abs(score) >= spec.threshold)
