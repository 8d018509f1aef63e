"""Problem 4: values in differing units to one canonical unit, by an equi-join with composed conversions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.units import UnitGraph, dwelling_units, read_units

STATING = ("VALUE", "SCALAR_ID", "SCALAR_FACTOR", "UOM")


def to_common_unit(df: DataFrame, graph: UnitGraph, target: str) -> DataFrame:
    """Add unit_factor, unit_offset and quantity = value_number * factor + offset, in ``target``, by source_unit.

    The join's right side is the unit registry: one row per unit, so it is broadcast whatever the data's size.
    A null value, or a unit the graph does not reach, gives a null quantity; the row stays.
    """
    table = F.broadcast(graph.table(df.sparkSession, target).select("source_unit", "unit_factor", "unit_offset"))
    clash = {"unit_factor", "unit_offset", "quantity"} & set(df.columns)
    return df.drop(*clash).join(table, "source_unit", "left").withColumn("quantity", F.col("value_number") * F.col("unit_factor") + F.col("unit_offset"))


def dwelling_quantity(df: DataFrame) -> DataFrame:
    """The quantity of raw cube rows as bigint single dwelling units, beside value_number, source_unit and unit_factor.

    Quantities are whole: a number that is not whole after conversion has none (null), like a code or an empty VALUE.
    """
    clash = {"value_number", "source_unit"} & set(df.columns)
    out = to_common_unit(read_units(df.drop(*clash)), dwelling_units(), "unit")
    return out.withColumn("quantity", F.when(F.col("quantity") == F.floor(F.col("quantity")), F.col("quantity").try_cast("bigint")))


def rescaled_rows(df: DataFrame) -> DataFrame:
    """obs_id and unit_factor of the rows whose number must be multiplied by a factor other than 1.

    A zero is the same number in every unit, so it needs no factor.
    """
    out = dwelling_quantity(df).filter(F.col("quantity").isNotNull() & (F.col("unit_factor") != 1) & (F.col("value_number") != 0))
    return out.select("obs_id", F.col("unit_factor").cast("int").alias("unit_factor"))
