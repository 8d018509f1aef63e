"""From releases to one row per natural key: union, required keys, profile and the newest revision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.errors import CleaningError
from tidemark.operators.normalize import normalize, project
from tidemark.specs import Profile, SourceSpec

MERGE_NEWEST, LATEST_ONLY = "merge_newest", "latest_only"
REQUIRED = ("source_id", "geography", "source_release_timestamp", "source_archive_sha256")


def union_releases(releases: Sequence[DataFrame]) -> DataFrame:
    """Rows of several releases of one source, matched by column name; frames with other columns are of another source."""
    if not releases:
        raise CleaningError("no release to read")
    if any(set(r.columns) != set(releases[0].columns) for r in releases):
        raise CleaningError("the releases differ in their columns, so they are of different sources")
    out = releases[0]
    for more in releases[1:]:
        out = out.unionByName(more)
    return out


def keep_latest_release(df: DataFrame) -> DataFrame:
    """Only the rows of the newest release of each source; rows without a release time fall away."""
    newest = df.groupBy("source_id").agg(F.max("source_release_timestamp").alias("source_release_timestamp"))
    return df.join(F.broadcast(newest), ["source_id", "source_release_timestamp"])  # one row per source


def drop_missing_keys(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Rows with all of their natural key and provenance; a null measure stays."""
    return df.dropna(subset=list(dict.fromkeys((*spec.natural_key, *REQUIRED))))


def profile_filter(df: DataFrame, profile: Profile) -> DataFrame:
    """Months of the profile, and its areas: by code if it gives codes, else by name, else all metropolitan ones."""
    months = df.filter(F.col("reference_month").between(F.lit(profile.start).cast("date"), F.lit(profile.end).cast("date")))
    if profile.cma_codes:
        return months.filter(F.col("cma_code").isin(*profile.cma_codes))
    if profile.cma_names:
        return months.filter(F.col("geography").isin(*profile.cma_names))
    return months.filter("geography_level = 'cma'")


def dedup_latest(df: DataFrame, spec: SourceSpec, tie: Sequence[str] = ()) -> DataFrame:
    """One row per natural key: newest release, active before terminated, revised first, publishable first.

    Remaining ties fall to the greater vector, then ``tie``, coordinate, checksum and value (descending), so the result
    doesn't depend on how rows are partitioned. Nulls come last. The rank needs only the
    top row, so Spark limits groups before the shuffle and a hot key ships one row per map task.
    """
    order = [F.desc_nulls_last("source_release_timestamp"), F.asc("is_terminated"), F.desc("is_revised"), F.desc("is_publishable"), F.desc_nulls_last("source_vector")]
    order += [F.desc_nulls_last(c) for c in (*tie, "source_coordinate", "source_archive_sha256", spec.measure, "status_code", "symbol_code", "geography")]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*spec.natural_key).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def clean_source(raw: DataFrame, spec: SourceSpec, profile: Profile | None = None, policy: str = MERGE_NEWEST, tie: Sequence[str] = ()) -> DataFrame:
    """The clean fact of a source. The profile is applied before the rank, so rows it drops are never shuffled.

    ``merge_newest`` keeps a key of an older release that newer ones dropped; ``latest_only`` does not.
    """
    typed = drop_missing_keys(normalize(raw, spec, tuple(tie)), spec)
    if policy == LATEST_ONLY:
        typed = keep_latest_release(typed)
    elif policy != MERGE_NEWEST:
        raise CleaningError(f"unknown release policy {policy!r}")
    if profile is not None:
        typed = profile_filter(typed, profile)
    return project(dedup_latest(typed, spec, tie), spec, tuple(tie))


def clean_summary(df: DataFrame) -> DataFrame:
    """One row: rows, unpublishable rows, first and last month."""
    return df.agg(
        F.count("*").alias("row_count"), F.coalesce(F.sum((~F.col("is_publishable")).cast("bigint")), F.lit(0)).alias("non_publishable_rows"),
        F.min("reference_month").alias("first_month"), F.max("reference_month").alias("last_month"),
    )
