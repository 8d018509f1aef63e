"""Landing of archives: metadata, link, hints, download, checks and content-addressed publication. Driver-side, no Spark.

The transport, clock, sleep and jitter are given, so nothing here needs a network in tests.
"""

from __future__ import annotations

import email.utils
import hashlib
import http.client
import json
import os
import random
import shutil
import tempfile
import time
import zipfile
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import UTC, datetime
from pathlib import Path, PurePosixPath
from typing import Any, Protocol
from urllib.parse import urlsplit
from zoneinfo import ZoneInfo

from tidemark.errors import IntegrityError, LandingError
from tidemark.sources.registry import HttpPolicy, Registry, Source

CHUNK = 1 << 20
ARCHIVE_TYPES = ("application/zip", "application/x-zip-compressed", "application/octet-stream")
RELEASE_ZONE = ZoneInfo("America/Toronto")
HINTS = ("etag", "last-modified", "content-length")


@dataclass
class Response:
    status: int
    headers: dict[str, str] = field(default_factory=dict)
    body: Iterable[bytes] = ()

    def json(self) -> Any:
        try:
            return json.loads(b"".join(self.body))
        except (OSError, http.client.HTTPException) as problem:
            raise LandingError(f"the answer broke off: {problem}") from problem
        except ValueError as problem:
            raise LandingError(f"the answer is no JSON: {problem}") from problem


class Transport(Protocol):
    def __call__(self, method: str, url: str, payload: Any = None) -> Response: ...


@dataclass(frozen=True)
class Landed:
    source_id: str
    status: str
    path: str
    sha256: str
    size: int
    release: str


def utc_release(text: str) -> datetime:
    """A release time in UTC; without a zone it is the publisher's local time."""
    try:
        at = datetime.fromisoformat(text)
    except ValueError as problem:
        raise LandingError(f"no release time: {text!r}") from problem
    return (at if at.tzinfo else at.replace(tzinfo=RELEASE_ZONE)).astimezone(UTC)


def release_label(at: datetime) -> str:
    return at.strftime("%Y%m%dT%H%M%SZ")


def file_sha256(path: Path) -> str:
    with path.open("rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def content_length(headers: dict[str, str]) -> int | None:
    text = headers.get("content-length")
    if text is None:
        return None
    if not text.isdigit():
        raise LandingError(f"no length: {text!r}")
    return int(text)


def retry_delay(attempt: int, after: str | None, policy: HttpPolicy, jitter: Callable[[float, float], float], now: datetime) -> float:
    """Seconds before the next attempt: Retry-After (seconds or a date, capped), else full jitter under a doubling cap."""
    if after:
        try:
            wait = float(after)
        except ValueError:
            try:
                wait = (email.utils.parsedate_to_datetime(after) - now).total_seconds()
            except (TypeError, ValueError):
                wait = -1.0
        if wait >= 0:
            return min(wait, policy.retry_after_cap_seconds)
    return jitter(0, min(policy.backoff_cap_seconds, policy.backoff_base_seconds * 2 ** (attempt - 1)))


def check_archive(path: Path, members: Iterable[str]) -> None:
    """Safe names, sound checksums, all members present; else IntegrityError."""
    try:
        with zipfile.ZipFile(path) as z:
            names = z.namelist()
            for name in names:
                pure = PurePosixPath(name)
                if pure.is_absolute() or ".." in pure.parts or "\\" in name:
                    raise IntegrityError(f"unsafe name in the archive: {name!r}")
            broken = z.testzip()
    except zipfile.BadZipFile as problem:
        raise IntegrityError(f"no archive: {problem}") from problem
    missing = sorted(set(members) - set(names))
    if broken or missing:
        raise IntegrityError(f"broken member {broken!r}" if broken else f"missing members: {', '.join(missing)}")


def _unbroken(body: Iterable[bytes], what: str) -> Iterable[bytes]:
    """The chunks of a body; a connection that breaks on the way is like bytes that are not what was promised, worth one more download."""
    try:
        yield from body
    except (OSError, http.client.HTTPException) as problem:
        raise IntegrityError(f"{what}: the download broke off: {problem}") from problem


class Lander:
    def __init__(
        self, registry: Registry, root: Path, transport: Transport, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic,
        jitter: Callable[[float, float], float] = random.uniform, now: Callable[[], datetime] = lambda: datetime.now(UTC),
    ) -> None:
        self.registry, self.root, self.transport, self.sleep, self.clock, self.jitter, self.now = registry, Path(root), transport, sleep, clock, jitter, now

    def land_profile(self, name: str) -> list[Landed]:
        return [self.land(self.registry.source(s)) for s in self.registry.profile(name).sources]

    def land(self, source: Source) -> Landed:
        release = utc_release(self._metadata(source)["releaseTime"])
        url = self._link(source)
        hints = self._hints(source, url)
        folder = self.root / self.registry.raw_subdirectory / source.id / f"release={release_label(release)}"
        found = self._already(source, folder, hints)
        if found:
            return found
        for attempt in (1, 2):  # broken bytes are worth one more download
            try:
                return self._download(source, url, folder, release, hints)
            except IntegrityError:
                if attempt == 2:
                    raise
        raise AssertionError

    def _call(self, method: str, url: str, payload: Any = None, accept: tuple[int, ...] = (200,)) -> Response:
        policy = self.registry.http
        for attempt in range(1, policy.max_attempts + 1):
            try:
                r = self.transport(method, url, payload)
            except OSError as problem:
                r, last = None, str(problem)
            else:
                if r.status in accept:
                    return r
                last = f"status {r.status}"
                if r.status not in policy.retryable_status_codes:
                    break
            if attempt < policy.max_attempts:
                self.sleep(retry_delay(attempt, r.headers.get("retry-after") if r else None, policy, self.jitter, self.now()))
        raise LandingError(f"{method} {url}: {last}")

    def _metadata(self, source: Source) -> dict[str, Any]:
        answer = self._call("POST", self.registry.cube_metadata_api_url, [{"productId": int(source.product_id)}]).json()
        first = answer[0] if isinstance(answer, list) and answer else {}
        cube = first.get("object", {}) if first.get("status") == "SUCCESS" else {}
        dims = tuple(d.get("dimensionNameEn") for d in cube.get("dimension", []))
        checks = {
            "status": bool(cube), "product": str(cube.get("productId")) == source.product_id, "frequency": cube.get("frequencyCode") == source.frequency_code,
            "currency": str(cube.get("archiveStatusEn", "")).startswith("CURRENT"), "dimensions": not source.dimensions or dims == source.dimensions,
            "months": str(cube.get("cubeStartDate", ""))[:7] <= source.baseline_end and str(cube.get("cubeEndDate", ""))[:7] >= source.baseline_start, "release": bool(cube.get("releaseTime")),
        }
        wrong = [k for k, ok in checks.items() if not ok]
        if wrong:
            raise LandingError(f"{source.id}: the metadata's {', '.join(wrong)} is not as registered")
        return cube

    def _link(self, source: Source) -> str:
        answer = self._call("GET", source.download_api_url).json()
        url = answer.get("object") if isinstance(answer, dict) and answer.get("status") == "SUCCESS" else None
        expected = urlsplit(source.expected_download_url)
        if not isinstance(url, str) or urlsplit(url).scheme != "https" or urlsplit(url).netloc != expected.netloc or url != source.expected_download_url:
            raise LandingError(f"{source.id}: an unexpected link {url!r}")
        return url

    def _hints(self, source: Source, url: str) -> dict[str, str]:
        r = self._call("HEAD", url, accept=(200, 405, 501))
        if r.status != 200:
            return {}
        size = content_length(r.headers)
        if size is not None and size > source.max_archive_bytes:
            raise LandingError(f"{source.id}: {size} bytes are more than {source.max_archive_bytes}")
        return {h: r.headers[h] for h in HINTS if h in r.headers}

    def _already(self, source: Source, folder: Path, hints: dict[str, str]) -> Landed | None:
        """A landed archive of this release with the same hints, if its bytes still are what they were."""
        for path in sorted(folder.glob("sha256=*/manifest.json")):
            manifest = read_manifest(path)
            if not hints or manifest.get("hints") != hints:
                continue
            archive = path.parent / "archive.zip"
            if not archive.exists() or file_sha256(archive) != manifest["sha256"]:
                raise IntegrityError(f"{archive} is not what its manifest says")
            check_archive(archive, (source.data_member, source.metadata_member))
            return Landed(source.id, "already_present", str(path.parent), manifest["sha256"], manifest["size"], manifest["release"])
        return None

    def _download(self, source: Source, url: str, folder: Path, release: datetime, hints: dict[str, str]) -> Landed:
        began, r = self.clock(), self._call("GET", url)
        kind = r.headers.get("content-type", "").split(";")[0].strip().lower()
        if kind and kind not in ARCHIVE_TYPES:
            raise LandingError(f"{source.id}: the answer is {kind}")
        folder.mkdir(parents=True, exist_ok=True)
        work = Path(tempfile.mkdtemp(prefix=".landing-", dir=folder))
        try:
            size, digest = 0, hashlib.sha256()
            with (work / "archive.zip").open("wb") as f:
                for chunk in _unbroken(r.body, source.id):
                    size += len(chunk)
                    if size > source.max_archive_bytes:
                        raise LandingError(f"{source.id}: more than {source.max_archive_bytes} bytes")
                    if self.clock() - began > self.registry.http.download_deadline_seconds:
                        raise LandingError(f"{source.id}: the download took too long")
                    digest.update(chunk)
                    f.write(chunk)
            promised = content_length(r.headers)
            if promised is not None and promised != size:
                raise IntegrityError(f"{source.id}: {size} bytes came, {promised} were promised")
            check_archive(work / "archive.zip", (source.data_member, source.metadata_member))
            sha = digest.hexdigest()
            manifest = {"source_id": source.id, "product_id": source.product_id, "url": url, "sha256": sha, "size": size, "release": release_label(release), "data_member": source.data_member, "hints": hints, "landed_at": release_label(self.now())}
            (work / "manifest.json").write_text(json.dumps(manifest, indent=2, sort_keys=True) + "\n", "utf-8")
            target = folder / f"sha256={sha}"
            try:
                os.rename(work, target)
                status = "downloaded"
            except OSError:  # another run was first; its bytes must be the same
                if not target.exists() or file_sha256(target / "archive.zip") != sha:
                    raise IntegrityError(f"{target} exists with other bytes") from None
                status = "already_present"
            return Landed(source.id, status, str(target), sha, size, release_label(release))
        finally:
            shutil.rmtree(work, ignore_errors=True)


def read_manifest(path: Path) -> dict[str, Any]:
    try:
        manifest = json.loads(Path(path).read_text("utf-8"))
    except (OSError, ValueError) as problem:
        raise LandingError(f"{path}: {problem}") from problem
    if not isinstance(manifest, dict):
        raise LandingError(f"{path} holds no object")
    return manifest
