"""Session helpers: one place for the checkpoint folder, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import SettingsError


def build_session(name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with AQE; anything given in ``conf`` wins (keys with ``__`` for the dots)."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    base = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true"}
    for key, value in (base | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``); where unset, as in tests, a local one is set, but never on a cluster."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise SettingsError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and forget how it was made."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def fits(df: DataFrame, max_rows: int, max_bytes: int | None = None) -> bool:
    """True if ``df`` has at most ``max_rows`` rows, and if asked no more than ``max_bytes`` of texts; never looks past the rows' bound."""
    some = df.limit(max_rows + 1)
    if max_bytes is None:
        return some.count() <= max_rows
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)).cast("bigint") for f in df.schema.fields if f.dataType.typeName() == "string"]
    rows, size = some.agg(F.count("*"), F.coalesce(F.sum(sum(texts, F.lit(0).cast("bigint"))), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def small(df: DataFrame, max_rows: int = 100_000, max_bytes: int | None = None) -> DataFrame:
    """Hint a broadcast only where the bounds are checked to hold; beyond them AQE picks a shuffled join."""
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
