"""From landed archives to raw frames: discovery, member extraction, header check and a fail-fast CSV scan."""

from __future__ import annotations

import csv
import io
import os
import shutil
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import CleaningError
from tidemark.operators.revisions import union_releases
from tidemark.sources.landing import read_manifest
from tidemark.specs import SourceSpec

LABEL = "%Y%m%dT%H%M%SZ"


@dataclass(frozen=True)
class Snapshot:
    source_id: str
    release: datetime
    sha256: str
    archive: Path
    data_member: str


def discover(root: Path, spec: SourceSpec) -> list[Snapshot]:
    """All landed snapshots of a source in release order; their paths must agree with their manifests."""
    found = []
    for path in sorted(Path(root, spec.source_id).glob("release=*/sha256=*/manifest.json")):
        m = read_manifest(path)
        label, sha = path.parent.parent.name.removeprefix("release="), path.parent.name.removeprefix("sha256=")
        if m.get("source_id") != spec.source_id or m.get("sha256") != sha or m.get("release") != label or "data_member" not in m:
            raise CleaningError(f"{path} does not belong where it is")
        archive = path.parent / "archive.zip"
        if not archive.exists():
            raise CleaningError(f"{archive} is missing")
        try:
            release = datetime.strptime(label, LABEL).replace(tzinfo=UTC)
        except ValueError as problem:
            raise CleaningError(f"{path}: no release label {label!r}") from problem
        found.append(Snapshot(spec.source_id, release, sha, archive, m["data_member"]))
    if not found:
        raise CleaningError(f"no snapshot of {spec.source_id} under {root}")
    return sorted(found, key=lambda s: (s.release, s.sha256))


def check_header(z: zipfile.ZipFile, member: str, expected: tuple[str, ...]) -> None:
    with z.open(member) as f:
        header = next(csv.reader(io.TextIOWrapper(f, "utf-8-sig", newline="")), [])
    if tuple(header) != expected:
        raise CleaningError(f"{member}: the header is {header}, not {list(expected)}")


def extract(snapshot: Snapshot, spec: SourceSpec, into: Path) -> Path:
    """The data member as a file, its header checked first; done only once, and complete or not there at all."""
    target = Path(into, spec.source_id, f"sha256={snapshot.sha256}", Path(snapshot.data_member).name)
    with zipfile.ZipFile(snapshot.archive) as z:
        check_header(z, snapshot.data_member, spec.raw_columns)
        if target.exists() and target.stat().st_size == z.getinfo(snapshot.data_member).file_size:
            return target
        target.parent.mkdir(parents=True, exist_ok=True)
        part = target.with_name(f"{target.name}.{uuid.uuid4().hex}.part")  # a task may run twice at once
        try:
            with z.open(snapshot.data_member) as source, part.open("wb") as out:
                shutil.copyfileobj(source, out, 1 << 20)
            os.replace(part, target)
        finally:
            part.unlink(missing_ok=True)
    return target


def raw_schema(spec: SourceSpec) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in spec.raw_columns])


def scan(spark: SparkSession, path: str, spec: SourceSpec, snapshot: Snapshot) -> DataFrame:
    """Rows as texts with their provenance; a row with too many or too few fields fails the read."""
    rows = spark.read.schema(raw_schema(spec)).option("header", True).option("encoding", "UTF-8").option("mode", "FAILFAST").csv(path)
    return rows.withColumns({
        "_source_id": F.lit(spec.source_id), "_source_release_timestamp": F.lit(snapshot.release.replace(tzinfo=None)).cast("timestamp_ntz"), "_source_archive_sha256": F.lit(snapshot.sha256),
    })


def extract_all(spark: SparkSession, snapshots: list[Snapshot], spec: SourceSpec, into: Path) -> list[str]:
    """The data members of all snapshots as files, one task an archive; ``into`` must be a folder that all executors share.

    Only paths come back, one for each archive.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.itertuples():
                snapshot = Snapshot(spec.source_id, datetime.now(UTC), row.sha256, Path(row.archive), row.data_member)
                try:
                    out.append((row.no, str(extract(snapshot, spec, into)), None))
                except (CleaningError, OSError, zipfile.BadZipFile, KeyError) as problem:
                    out.append((row.no, None, str(problem)))
            yield pd.DataFrame(out, columns=["no", "path", "problem"])

    rows = [(i, s.sha256, str(s.archive), s.data_member) for i, s in enumerate(snapshots)]
    work = spark.createDataFrame(rows, "no int, sha256 string, archive string, data_member string").repartition(len(rows), "no")
    done = sorted(work.mapInPandas(run, "no int, path string, problem string").collect())
    wrong = [r.problem for r in done if r.problem is not None]
    if wrong:
        raise CleaningError("; ".join(wrong))
    return [r.path for r in done]


def read_snapshots(spark: SparkSession, root: Path, interim: Path, spec: SourceSpec) -> DataFrame:
    """All releases of a source, united by column name."""
    snapshots = discover(root, spec)
    if any(s.source_id != spec.source_id for s in snapshots):
        raise CleaningError(f"not all snapshots are of {spec.source_id}")
    paths = extract_all(spark, snapshots, spec, Path(interim))
    return union_releases([scan(spark, path, spec, s) for path, s in zip(paths, snapshots, strict=True)])
