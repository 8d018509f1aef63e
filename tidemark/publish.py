"""Publication: Parquet by year behind numbered manifests, month-range replacement, an append-only audit and a JDBC sink."""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import PublishError, SettingsError
from tidemark.operators.quality import Report, require
from tidemark.specs import QualityPolicy

KEYS = ["reference_month", "cma_code", "dwelling_type"]
AUDIT = (
    "load_batch_id string, validation_profile string, reference_start date, reference_end date, status string, validated_row_count bigint, "
    "staged_row_count bigint, published_row_count bigint, validation_metrics string, at_utc timestamp, error_message string"
)
AUDIT_COLUMNS = tuple(c.split()[0] for c in AUDIT.split(", "))
LEASE = timedelta(hours=6)
MESSAGE_LENGTH = 4000


@dataclass(frozen=True)
class Published:
    batch: str
    rows: int
    version: str


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def write_fact(fact: DataFrame, path: str) -> None:
    """One directory per reference_year, rows in key order within files.

    Years are spread over tasks by month, so a large year is not one task's work.
    """
    if "reference_year" not in fact.columns:
        raise PublishError("the fact has no reference_year to partition by")
    ordered = fact.repartition("reference_year", "reference_month").sortWithinPartitions("reference_year", *KEYS)
    ordered.write.mode("overwrite").option("compression", "snappy").partitionBy("reference_year").parquet(path)


@dataclass(frozen=True)
class Version:
    """A published state: its number and of each year the directory that holds it, relative to the table."""

    number: int
    years: dict[int, str]


def current_version(spark: SparkSession, table: str) -> Version | None:
    """The manifest with the greatest number; None if nothing is published."""
    fs, p, jvm = _fs(spark, f"{table}/_versions")
    if not fs.exists(p):
        return None
    numbers = [int(name.removesuffix(".json")) for s in fs.listStatus(p) if (name := s.getPath().getName()).endswith(".json") and name[0].isdigit()]
    if not numbers:
        return None
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(p, f"{max(numbers):012d}.json"))
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Version(max(numbers), {int(y): d for y, d in json.loads(text).items()})


def _announce(spark: SparkSession, table: str, version: Version) -> bool:
    """Make ``version`` the current one, unless its number is taken: then another publisher was first, and nothing changes.

    The manifest is written aside and renamed to its number, which fails where that exists; so readers see all of it or nothing.
    """
    fs, p, jvm = _fs(spark, f"{table}/_versions/{version.number:012d}.json")
    aside = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}")
    fs.mkdirs(p.getParent())
    out = fs.create(aside, False)
    out.write(bytearray(json.dumps({str(y): d for y, d in sorted(version.years.items())}).encode()))
    out.close()
    # The claim is what excludes: creating it without overwriting succeeds for one publisher only.
    claim = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".claim-{version.number:012d}")
    try:
        if fs.exists(claim) and not fs.exists(p) and time.time() - fs.getFileStatus(claim).getModificationTime() / 1000 > LEASE.total_seconds():
            fs.delete(claim, False)  # its publisher died before it could rename
        if fs.exists(p) or not fs.createNewFile(claim):
            return False
        return bool(fs.rename(aside, p))
    finally:
        if fs.exists(aside):
            fs.delete(aside, False)


def read_version(spark: SparkSession, table: str, version: Version, years: Iterable[int] | None = None) -> DataFrame | None:
    """Rows of a version, or of some of its years; None if there are none."""
    wanted = [d for y, d in sorted(version.years.items()) if years is None or y in set(years)]
    if not wanted:
        return None
    rows = spark.read.option("basePath", f"{table}/data").parquet(*(f"{table}/{d}" for d in wanted))
    return rows.drop("batch").withColumn("reference_year", F.col("reference_year").cast("int"))


def read_fact(spark: SparkSession, table: str) -> DataFrame:
    version = current_version(spark, table)
    rows = None if version is None else read_version(spark, table, version)
    if rows is None:
        raise PublishError(f"nothing is published at {table}")
    return rows


def replace_published(staged: DataFrame, table: str, first: date, last: date, attempts: int = 5) -> Version:
    """Publish ``staged`` in place of the months from ``first`` to ``last``.

    Only years that these months touch are written again; other years stay the files they are. A publisher that was
    overtaken starts over from the newer version, so no load is lost.
    """
    spark = staged.sparkSession
    years = range(first.year, last.year + 1)
    for _ in range(attempts):
        before = current_version(spark, table) or Version(0, {})
        old, rows = read_version(spark, table, before, years), staged
        if old is not None:
            rows = staged.unionByName(old.filter(~F.col("reference_month").between(F.lit(first), F.lit(last))).select(*staged.columns))
        folder = f"data/batch={uuid.uuid4().hex}"
        write_fact(rows, f"{table}/{folder}")
        fs, p, _ = _fs(spark, f"{table}/{folder}")
        written = {int(n.split("=")[1]): f"{folder}/{n}" for s in fs.listStatus(p) if (n := s.getPath().getName()).startswith("reference_year=")}
        version = Version(before.number + 1, {**{y: d for y, d in before.years.items() if y not in years}, **written})
        if _announce(spark, table, version):
            return version
        fs.delete(p, True)
    raise PublishError(f"{table}: overtaken {attempts} times")


def staging_summary(staged: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """One row: rows, distinct keys, first and last month."""
    return staged.agg(F.count("*").alias("row_count"), F.countDistinct(*keys).alias("distinct_keys"), F.min("reference_month").alias("first_month"), F.max("reference_month").alias("last_month"))


def replace_months(current: DataFrame, new: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """``current`` without the months between the first and last of ``new``, plus ``new``.

    With ``scope`` the range is per value of those columns. An empty ``new`` replaces nothing.
    """
    scope = scope or []
    bounds = new.groupBy(*scope).agg(F.min("reference_month").alias("_lo"), F.max("reference_month").alias("_hi"))
    if not scope:  # one row, so it is broadcast whatever the size of the data
        bounds = F.broadcast(bounds)
    inside = F.col("reference_month").between(F.col("_lo"), F.col("_hi"))
    on = inside if not scope else (inside & _same(current, bounds, scope))
    kept = current.join(bounds, on, "left_anti")
    return kept.unionByName(new)


def _same(a: DataFrame, b: DataFrame, columns: list[str]):
    out = F.lit(True)
    for c in columns:
        out = out & (a[c] == b[c])
    return out


def last_states(log: DataFrame) -> DataFrame:
    """One row per batch of an audit log: its last entry; of entries at one time, one that is not STARTED."""
    last = log.groupBy("load_batch_id").agg(F.max_by(F.struct(*log.columns), F.struct("at_utc", F.col("status") != "STARTED")).alias("r"))
    return last.select("r.*")


class Audit:
    """An append-only Parquet log of attempts; the newest row of a batch is its state."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        fs, p, _ = _fs(self.spark, self.path)
        return self.spark.read.schema(AUDIT).parquet(self.path) if fs.exists(p) else self.spark.createDataFrame([], AUDIT)

    def states(self) -> DataFrame:
        """One row per batch, by its last entry."""
        return last_states(self.read())

    def append(self, **row) -> None:
        self.spark.createDataFrame([tuple(row.get(c) for c in AUDIT_COLUMNS)], AUDIT).coalesce(1).write.mode("append").parquet(self.path)

    def start(self, batch: str, profile: str, now: datetime) -> None:
        """Claim the profile; refused while another attempt holds it and its lease has not run out."""
        running = self.states().filter((F.col("status") == "STARTED") & (F.col("validation_profile") == profile) & (F.col("at_utc") > F.lit(now - LEASE)))
        if not running.isEmpty():
            raise PublishError(f"a load of profile {profile!r} is running")
        self.append(load_batch_id=batch, validation_profile=profile, status="STARTED", at_utc=now)


def publish(fact: DataFrame, table: str, audit: Audit, report: Report, now: Callable[[], datetime] = lambda: datetime.now(UTC).replace(tzinfo=None)) -> Published:
    """Stage, reconcile, replace the months and log it; a failure leaves the published version as it was."""
    if not report.passed:
        raise PublishError("the report has not passed")
    spark, batch = fact.sparkSession, uuid.uuid4().hex
    audit.start(batch, report.profile, now())
    staging = f"{table}/_staging/{batch}"
    try:
        fact.write.parquet(staging)
        staged = spark.read.parquet(staging)
        s = staging_summary(staged).first()
        if s.row_count != report.metrics["row_count"] or s.distinct_keys != s.row_count:
            raise PublishError(f"staged {s.row_count} rows with {s.distinct_keys} keys, validated {report.metrics['row_count']}")
        stamp = F.lit(now()).cast("timestamp_ntz")
        loaded = {"source_load_batch_id": F.lit(batch), "source_validation_profile": F.lit(report.profile), "created_at_utc": stamp, "updated_at_utc": stamp}
        version = f"version {replace_published(staged.withColumns(loaded), table, s.first_month, s.last_month).number}" if s.row_count else "nothing"
        audit.append(
            load_batch_id=batch, validation_profile=report.profile, reference_start=s.first_month, reference_end=s.last_month, status="SUCCEEDED", validated_row_count=report.metrics["row_count"],
            staged_row_count=s.row_count, published_row_count=s.row_count, validation_metrics=json.dumps(report.metrics, sort_keys=True, default=str), at_utc=now(),
        )
        return Published(batch, s.row_count, version)
    except Exception as error:
        audit.append(load_batch_id=batch, validation_profile=report.profile, status="FAILED", at_utc=now(), error_message=str(error)[:MESSAGE_LENGTH])
        raise error if isinstance(error, PublishError) else PublishError(str(error)) from error
    finally:
        fs, p, _ = _fs(spark, staging)
        fs.delete(p, True)


@dataclass(frozen=True)
class Warehouse:
    """Where published rows go by JDBC. The password is kept out of what is printed."""

    url: str
    table: str
    user: str
    password: str = field(repr=False)
    batch_rows: int = 1000
    connections: int = 4
    driver: str | None = None

    def __post_init__(self) -> None:
        if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_$]*(?:\.[A-Za-z_][A-Za-z0-9_$]*){0,2}", self.table):
            raise SettingsError(f"{self.table!r} is no plain table name")
        if self.batch_rows <= 0 or self.connections <= 0:
            raise SettingsError("a batch has at least one row, and there is at least one connection")

    def options(self) -> dict[str, str]:
        out = {"url": self.url, "dbtable": self.table, "user": self.user, "password": self.password, "batchsize": str(self.batch_rows), "isolationLevel": "READ_COMMITTED"}
        return out | ({"driver": self.driver} if self.driver else {})


def load_warehouse(env: dict[str, str]) -> Warehouse | None:
    """From TIDEMARK_JDBC_URL, _TABLE, _USER, _PASSWORD, _BATCH_ROWS, _CONNECTIONS and _DRIVER; None where there is no URL."""
    given = {k.removeprefix("TIDEMARK_JDBC_").lower(): v for k, v in env.items() if k.startswith("TIDEMARK_JDBC_")}
    if not given.get("url", "").strip():
        return None
    missing = [k for k in ("table", "user", "password") if not given.get(k, "").strip()]
    if missing:
        raise SettingsError(f"empty settings: {', '.join('TIDEMARK_JDBC_' + k.upper() for k in missing)}")
    try:
        numbers = {k: int(given[k]) for k in ("batch_rows", "connections") if k in given}
    except ValueError as problem:
        raise SettingsError(str(problem)) from problem
    return Warehouse(given["url"].strip(), given["table"].strip(), given["user"].strip(), given["password"], driver=given.get("driver"), **numbers)


def write_jdbc(rows: DataFrame, to: Warehouse, mode: str = "append") -> None:
    """Rows stream from the executors in batches over a bounded number of connections; no row comes to the driver."""
    rows.coalesce(to.connections).write.format("jdbc").options(**to.options()).mode(mode).save()


def validate_then_write(fact: DataFrame, policy: QualityPolicy, writer: Callable[[DataFrame], None]) -> Report:
    """The report first, the writer only if it passes."""
    report = require(fact, policy)
    writer(fact)
    return report
