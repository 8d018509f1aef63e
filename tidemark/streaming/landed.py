"""Landed CSV files as a stream: the same projection as in batch, for archives that arrive while others are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.normalize import normalize
from tidemark.sources.archives import raw_schema
from tidemark.specs import SourceSpec


def clean_stream(spark: SparkSession, folder: str, spec: SourceSpec, files_per_batch: int = 100) -> DataFrame:
    """Typed rows of every CSV file under ``folder/release=<label>/sha256=<sha>/``, as files arrive.

    Release and checksum come from the path. Dedup needs all releases, so it stays a batch step over what is written.
    """
    raw = spark.readStream.schema(raw_schema(spec)).option("header", True).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(folder)
    path = F.col("_metadata.file_path")
    label = F.regexp_extract(path, r"release=([0-9TZ]+)/", 1)
    return normalize(raw.withColumns({
        "_source_id": F.lit(spec.source_id), "_source_release_timestamp": F.try_to_timestamp(F.translate(label, "TZ", ""), F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz"),
        "_source_archive_sha256": F.regexp_extract(path, r"sha256=([0-9a-f]+)/", 1),
    }), spec)


def write_stream(rows: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet what has arrived, then stop; rerun to go on where it ended."""
    return rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
