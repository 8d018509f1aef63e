"""Problem 5: totals and averages over trailing periods, by binary doubling over a dense calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def binary_blocks(length: int) -> list[int]:
    """Powers of two that add up to ``length``, largest first."""
    return [1 << i for i in reversed(range(length.bit_length())) if length >> i & 1]


def trailing_totals(df: DataFrame, entity: Sequence[str], time: str, value: str, lengths: Sequence[int], latest: Sequence[str] = (), unit: str = "month") -> DataFrame:
    """One row per entity and calendar period between its first and last row, with trailing totals and averages.

    Output: entity, ``time`` (date, first of the month or the day), ``has_row``, ``value``, and per length N total_N,
    present_N (periods that have a value) and average_N = total_N / N, periods without activity counting as 0.
    Windows that begin before the first row hold only what there is.
    Repeated rows of a period count once; where they differ, the row greatest by ``latest`` counts. A null value is a
    row without a count. Rows without a time are dropped; nulls in the entity form an entity; an empty table gives none.

    Sums of 1, 2, 4, ... periods come each from two shifted sums of half the length; a window is the sum of the
    blocks in its binary form. All shifts share one exchange and one sort; repeats are aggregated away before it, so a
    partition holds at most one row per calendar period of an entity.
    """
    start = F.trunc(F.col(time), "month") if unit == "month" else F.col(time).cast("date")
    step = F.expr("interval 1 month" if unit == "month" else "interval 1 day")
    once = (
        df.select(*entity, start.alias("_t"), F.struct(*(F.col(c) for c in latest), F.col(value).alias("_v")).alias("_r"))
        .dropna(subset=["_t"])
        .groupBy(*entity, "_t")
        .agg(F.max("_r")["_v"].alias("_v"))
    )
    series = Window.partitionBy(*entity).orderBy("_t")
    # Each row fills the gap up to the next one, so the calendar is dense without a join.
    filled = once.withColumn("_next", F.lead("_t").over(series)).withColumn(
        "_day", F.explode(F.when(F.col("_next").isNull(), F.array("_t")).otherwise(F.sequence("_t", F.date_sub("_next", 1), step)))
    )
    own = F.col("_day") == F.col("_t")
    dense = filled.select(*entity, F.col("_day").alias("_t"), own.alias("has_row"), F.when(own, F.col("_v")).alias("_v"))
    blocks = dense.withColumns({"_s1": F.coalesce(F.col("_v"), F.lit(0)), "_n1": F.col("_v").isNotNull().cast("int")})

    def shifted(name: str, by: int) -> Column:
        return F.lag(name, by, 0).over(series) if by else F.col(name)

    size = 1
    while size * 2 <= max(lengths):
        blocks = blocks.withColumns({f"_{k}{size * 2}": F.col(f"_{k}{size}") + shifted(f"_{k}{size}", size) for k in "sn"})
        size *= 2
    totals: dict[str, Column] = {}
    for n in lengths:
        for k, name in (("s", "total"), ("n", "present")):
            at, total = 0, F.lit(0)
            for b in binary_blocks(n):
                total = total + shifted(f"_{k}{b}", at)
                at += b
            totals[f"{name}_{n}"] = total
    out = blocks.withColumns(totals).withColumns({f"average_{n}": F.col(f"total_{n}") / n for n in lengths})
    return out.select(*entity, F.col("_t").alias(time), "has_row", F.col("_v").alias(value), *(f"{k}_{n}" for n in lengths for k in ("total", "present", "average")))
