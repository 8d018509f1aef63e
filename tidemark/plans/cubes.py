"""The raw cubes as the operators need them: feed, month, area, dwelling type, column and quantity of each row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import area_code, area_name, dwelling_type, measure_column, member_column, ref_month
from tidemark.operators.units import dwelling_quantity
from tidemark.session import read, small

ACTIVITY, MARKET = "cmhc_housing_activity", "cmhc_starts_by_market"


def releases(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Registrations of one source: feed, release, label, archive, landed."""
    return (
        read(spark, sf_dir, "source_snapshot")
        .filter(F.col("source_id") == source)
        .select(F.col("feed_id").alias("feed"), F.col("release_timestamp").cast("timestamp_ntz").alias("release"), F.col("release_label").alias("label"), F.col("sha256").alias("archive"), F.col("landed_at").alias("landed"))
    )


def with_area(df: DataFrame, areas: DataFrame) -> DataFrame:
    """Add cma_code: of the DGUID, else of the name; null if neither is known. The areas are a list of bounded, checked size."""
    names = small(areas.select(area_name(F.col("geography")).alias("area_name"), F.col("cma_code").alias("named_code")).dropna().dropDuplicates(["area_name"]))
    coded = df.withColumn("cma_code", area_code(F.col("DGUID")))
    keyed = coded.withColumn("area_name", F.when(F.col("cma_code").isNull(), area_name(F.col("GEO"))))
    return keyed.join(names, "area_name", "left").withColumn("cma_code", F.coalesce("cma_code", "named_code")).drop("area_name", "named_code")


def cube_cells(spark: SparkSession, sf_dir: str, source: str, newest_only: bool) -> DataFrame:
    """Rows of a cube as (source_id, feed_id, ref_month, cma_code, dwelling_type, column_name, quantity, obs_id).

    newest_only keeps each feed's newest archive, found in the registrations, so others are dropped by the join.
    """
    seen = releases(spark, sf_dir, source).dropna(subset=["feed", "archive"])
    if newest_only:
        seen = seen.dropna(subset=["release"]).groupBy("feed").agg(F.max(F.struct("release", "landed", "archive")).alias("r")).select("feed", "r.archive")
    archives = small(seen.select("feed", "archive").distinct())
    raw = read(spark, sf_dir, source).join(archives, F.col("_source_archive_sha256") == F.col("archive"))
    unit, column = ("Type of unit", measure_column(F.col("Housing estimates"))) if source == ACTIVITY else ("Type of dwelling unit", member_column(F.col("Type of market")))
    placed = with_area(dwelling_quantity(raw), read(spark, sf_dir, "cma_reference"))
    return placed.select(
        F.lit(source).alias("source_id"), F.col("feed").alias("feed_id"), ref_month(F.col("REF_DATE")).alias("ref_month"), "cma_code",
        dwelling_type(F.col(f"`{unit}`")).alias("dwelling_type"), column.alias("column_name"), "quantity", "obs_id",
    )
