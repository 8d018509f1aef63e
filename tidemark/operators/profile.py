"""Problem 3: an exact profile of every column of every load, from unpivoted column-value counts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RADIX = 200  # logarithmic steps per power of e in the first stage of the median and of quantiles
CLASSES, FEW_VALUES = 10, 20  # classes of a number in a comparison of loads; so many values are a class each


def _text(df: DataFrame, column: str) -> Column:
    c = F.col(f"`{column}`")
    text = c.cast("string")
    if not isinstance(df.schema[column].dataType, T.FractionalType) or isinstance(df.schema[column].dataType, T.DecimalType):
        return text
    plain = F.regexp_replace(c.try_cast("decimal(38,18)").cast("string"), r"(\.[0-9]+?)0*$", "$1")
    return F.when(text.contains("E"), F.coalesce(plain, text)).otherwise(text)


def value_counts(df: DataFrame, load: str, columns: Sequence[str]) -> DataFrame:
    """(load, column_name, value, n): how often each value of each column occurs in each load; value null for nulls.

    Values are texts of the columns' own types, numbers without exponents. One row per value leaves a map task, so a load that holds a third of
    all rows shuffles no more than its distinct values.
    """
    cells = F.posexplode(F.array(*(_text(df, c) for c in columns))).alias("place", "value")
    counted = df.select(F.col(load).alias("load"), cells).groupBy("load", "place", "value").agg(F.count("*").alias("n"))
    # Names come after the aggregation, which so hashes and moves a number for each.
    return counted.select("load", F.element_at(F.array(*map(F.lit, columns)), F.col("place") + 1).alias("column_name"), "value", "n")


def _rule(rules: dict[str, Column]) -> Column:
    out = F.lit(False)
    for name, failed in rules.items():
        out = F.when(F.col("column_name") == name, failed).otherwise(out)
    return F.coalesce(out, F.lit(False))


def breaches(contract: Sequence[tuple[str, float | None, float | None, str | None]]) -> tuple[Column, Column]:
    """(pattern breach, range breach) of a value by a contract of (column, min, max, pattern); nulls breach nothing."""
    v, x = F.col("value"), F.col("value").try_cast("double")
    by_pattern = {c: ~v.rlike(rf"^(?:{p})\z") for c, _, _, p in contract if p is not None}
    by_range = {}
    for c, lo, hi, _ in contract:
        tests = [t for t in ((x < lo) if lo is not None else None, (x > hi) if hi is not None else None) if t is not None]
        if tests:
            by_range[c] = tests[0] if len(tests) == 1 else tests[0] | tests[1]
    return _rule(by_pattern), _rule(by_range)


def exact_medians(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(load, column_name, median decimal) of numeric columns; the mean of the middle two where their number is even.

    Two stages keep every window small: counts per logarithmic bucket give the bucket of the middle ranks, then only
    that bucket's values are ordered.
    """
    keys = ["load", "column_name"]
    values = counts.filter(F.col("column_name").isin(*columns) & F.col("value").isNotNull()).withColumn("x", F.col("value").cast("decimal(28,4)"))
    d = F.col("x").cast("double")
    values = values.withColumn("b", (F.signum(d) * F.floor(F.log1p(F.abs(d)) * RADIX)).cast("int"))
    order = Window.partitionBy(*keys).orderBy("b")
    buckets = values.groupBy(*keys, "b").agg(F.sum("n").alias("bn"))
    buckets = buckets.withColumns({"upto": F.sum("bn").over(order), "total": F.sum("bn").over(Window.partitionBy(*keys))})
    low, high = F.floor((F.col("total") + 1) / 2), F.floor((F.col("total") + 2) / 2)
    middle = buckets.withColumns({"low": low, "high": high}).filter("upto >= low and upto - bn < high")
    near = values.join(middle.select(*keys, "b", (F.col("upto") - F.col("bn")).alias("below"), "low", "high"), [*keys, "b"])
    inner = Window.partitionBy(*keys, "b").orderBy("x")
    near = near.withColumn("r", F.col("below") + F.sum("n").over(inner))
    first = F.col("r") - F.col("n")
    picked = near.groupBy(*keys).agg(
        F.max(F.when((first < F.col("low")) & (F.col("r") >= F.col("low")), F.col("x"))).alias("m1"),
        F.max(F.when((first < F.col("high")) & (F.col("r") >= F.col("high")), F.col("x"))).alias("m2"),
    )
    return picked.select(*keys, ((F.col("m1") + F.col("m2")) / 2).cast("decimal(30,5)").alias("median"))


def column_profile(df: DataFrame, load: str, columns: Sequence[str], contract: Sequence[tuple], median_columns: Sequence[str] = ()) -> DataFrame:
    """One row per load and column: rows, nulls, distinct_values, trues, min/max as text and number, top_value, breaches, median.

    Repeated rows count as often as they occur. A null load is a load of its own; an empty table gives no rows.
    """
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    counts = value_counts(df, load, columns)
    return profile_counts(counts, contract, numeric, median_columns)


def profile_counts(counts: DataFrame, contract: Sequence[tuple], numeric: Sequence[str], median_columns: Sequence[str] = (), texts: bool = True) -> DataFrame:
    """column_profile from value counts already made; without ``texts`` min_text, max_text and top_value, which take a sort, are left out."""
    pattern, out_of_range = breaches(contract)
    has, x = F.col("value").isNotNull(), F.when(F.col("column_name").isin(*numeric), F.col("value").cast("double"))
    by_text = [F.min("value").alias("min_text"), F.max("value").alias("max_text"), F.max_by("value", F.when(has, F.struct("n", "value"))).alias("top_value")] if texts else []
    out = counts.groupBy("load", "column_name").agg(
        F.sum("n").alias("rows"), F.sum(F.when(has, 0).otherwise(F.col("n"))).alias("nulls"), F.count("value").alias("distinct_values"),
        F.sum(F.when(F.col("value") == "true", F.col("n")).otherwise(0)).alias("trues"), F.min(x).alias("min_number"), F.max(x).alias("max_number"),
        F.sum(F.when(pattern, F.col("n")).otherwise(0)).alias("pattern_breaches"), F.sum(F.when(out_of_range, F.col("n")).otherwise(0)).alias("range_breaches"), *by_text,
    )
    if median_columns:
        out = out.join(exact_medians(counts, median_columns), ["load", "column_name"], "left")
    return out


def quantile_edges(values: DataFrame, parts: int = CLASSES) -> DataFrame:
    """(load, column_name, edges): the inner quantiles of finite numbers x that occur n times, each a value, rising, repeats once.

    The k-th edge is the least value that at least k of ``parts`` shares of the numbers do not exceed. Two stages keep
    every window small, as in exact_medians.
    """
    keys = ["load", "column_name"]
    values = values.withColumn("b", (F.signum("x") * F.floor(F.log1p(F.abs("x")) * RADIX)).cast("int"))

    def passes_edge(upto: str, n: str) -> Column:
        return F.expr(f"least({parts - 1}, {parts} * {upto} div total) > {parts} * ({upto} - {n}) div total")

    buckets = values.groupBy(*keys, "b").agg(F.sum("n").alias("bn"))
    buckets = buckets.withColumns({"upto": F.sum("bn").over(Window.partitionBy(*keys).orderBy("b")), "total": F.sum("bn").over(Window.partitionBy(*keys))})
    near = values.join(buckets.filter(passes_edge("upto", "bn")).select(*keys, "b", (F.col("upto") - F.col("bn")).alias("below"), "total"), [*keys, "b"])
    near = near.withColumn("r", F.col("below") + F.sum("n").over(Window.partitionBy(*keys, "b").orderBy("x")))
    return near.filter(passes_edge("r", "n")).groupBy(*keys).agg(F.array_sort(F.collect_set("x")).alias("edges"))


def population_shift(counts: DataFrame, before: DataFrame, numeric: Sequence[str], floor: float = 1e-4) -> DataFrame:
    """(load, column_name, psi, chi_square): how each column's distribution moved since the load before it.

    Classes are the values themselves, dates and times are classed by month. Numbers with more than FEW_VALUES values in
    the two loads are classed by the exact deciles of the earlier load, open at both ends. Nulls are a class. An empty
    class counts as ``floor`` of the rows, as is usual for the population stability index; chi-square compares with the
    counts expected at the earlier shares.
    """
    keys = ["load", "column_name"]
    x = F.when(F.col("column_name").isin(*numeric), F.col("value").cast("double") + 0.0)
    counts = counts.withColumn("x", F.when(F.abs(x) < float("inf"), x))
    edges = quantile_edges(counts.filter("x is not null")).withColumnRenamed("load", "before")
    pairs, cell = before.select("load", "before").dropna(), ["load", "before", "column_name", "value", "x"]
    now = pairs.join(counts, "load").select(*cell, F.col("n").alias("n1"), F.lit(0).cast("bigint").alias("n0"))
    old = pairs.join(counts.withColumnRenamed("load", "before"), "before").select(*cell, F.lit(0).cast("bigint").alias("n1"), F.col("n").alias("n0"))
    values = now.unionByName(old)
    many = values.filter("x is not null").select(*keys, "x").distinct().groupBy(*keys).agg(F.count("x").alias("numbers")).filter(F.col("numbers") > FEW_VALUES)
    values = values.join(many, keys, "left").join(edges, ["before", "column_name"], "left")
    # A column without numbers in the earlier load has no deciles: all its numbers are new, and one class.
    by_decile = F.when(F.col("numbers").isNotNull(), F.concat(F.lit("q"), F.coalesce(F.size(F.filter("edges", lambda e: e < F.col("x"))), F.lit(0)).cast("string")))
    binned = F.when(F.col("x").isNotNull(), F.coalesce(by_decile, F.col("x").cast("string")))
    by_month = F.when(F.col("value").rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.substring("value", 1, 7))
    klass = F.coalesce(binned, by_month, F.col("value"), F.lit("\u0000"))
    both = values.groupBy(*keys, klass.alias("klass")).agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    totals = both.groupBy("load", "column_name").agg(F.sum("n1").alias("t1"), F.sum("n0").alias("t0"))
    p = both.join(totals, ["load", "column_name"]).withColumns({"p1": F.greatest(F.col("n1") / F.col("t1"), F.lit(floor)), "p0": F.greatest(F.col("n0") / F.col("t0"), F.lit(floor))})
    expected = F.col("p0") * F.col("t1")
    return p.groupBy("load", "column_name").agg(
        F.round(F.sum((F.col("p1") - F.col("p0")) * F.log(F.col("p1") / F.col("p0"))), 6).alias("psi"),
        F.round(F.sum((F.col("n1") - expected) * (F.col("n1") - expected) / expected), 4).alias("chi_square"),
    )


def stability_index(share: Column, before: Column, floor: float = 1e-4) -> Column:
    """Population stability index of a class and its complement, no share counting as less than ``floor``."""
    def part(p: Column, q: Column) -> Column:
        p, q = F.greatest(p, F.lit(floor)), F.greatest(q, F.lit(floor))
        return (p - q) * F.log(p / q)

    return part(share, before) + part(1 - share, 1 - before)


def preceding_loads(loads: DataFrame) -> DataFrame:
    """(load, profile, before): the load before each by start, among those that succeeded and have rows; null if none.

    loads: load, profile, started, succeeded, of loads with rows; one row per load.
    """
    # Start times may tie: the load's id breaks ties, so the order is total.
    w = Window.partitionBy("profile").orderBy("started", "load").rowsBetween(Window.unboundedPreceding, -1)
    return loads.select("load", "profile", F.last(F.when(F.col("succeeded"), F.col("load")), ignorenulls=True).over(w).alias("before"))


def drift_findings(profile: DataFrame, before: DataFrame, booleans: Sequence[str], level_columns: Sequence[str], rate: str = "0.2", factor: int = 2, least: int = 10) -> DataFrame:
    """(load, column_name, finding) for null_rate, true_rate and level, each load beside the one before it.

    A share is looked at where the population stability index of its two classes reaches the least a difference of
    ``rate`` can make, and then compared as exact products of whole numbers. A column without non-null values has no share and no level.
    """
    def num(c: str) -> Column:
        return F.col(c).cast("decimal(20,0)")

    old = profile.select(F.col("load").alias("before"), "column_name", *(F.col(c).alias(f"{c}_0") for c in ("rows", "nulls", "trues", "median")))
    both = profile.join(before.select("load", "before").dropna(), "load").join(old, ["before", "column_name"])
    both = both.withColumns({"full": F.col("rows") - F.col("nulls"), "full_0": F.col("rows_0") - F.col("nulls_0")})
    limit, r = F.lit(rate).cast("decimal(2,1)"), float(rate)
    least_index = 2 * r * math.log((1 + r) / (1 - r)) * 0.99  # two classes as far apart, equally far from a half; less a little for rounding

    def moved(a: str, n: str) -> Column:
        gap = F.abs(num(a).cast("double") * num(f"{n}_0").cast("double") - num(f"{a}_0").cast("double") * num(n).cast("double"))
        exactly = gap > limit.cast("double") * num(n).cast("double") * num(f"{n}_0").cast("double") + 1e-9
        return (stability_index(F.col(a) / F.nullif(F.col(n), F.lit(0)), F.col(f"{a}_0") / F.nullif(F.col(f"{n}_0"), F.lit(0))) >= least_index) & exactly

    level = (F.col("median_0") >= least) & ((F.col("median") > factor * F.col("median_0")) | (F.col("median") * factor < F.col("median_0")))
    found = F.array_compact(F.array(
        F.when(moved("nulls", "rows"), F.lit("null_rate")),
        F.when(F.col("column_name").isin(*booleans) & (F.col("full") > 0) & (F.col("full_0") > 0) & moved("trues", "full"), F.lit("true_rate")),
        F.when(F.col("column_name").isin(*level_columns) & level, F.lit("level")),
    ))
    return both.select("load", "column_name", F.explode(found).alias("finding"))
