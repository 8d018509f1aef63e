"""Registries and policies from TOML: frozen records, checked on load."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, fields
from pathlib import Path
from typing import Any

from tidemark.errors import PolicyError, RegistryError
from tidemark.specs import Profile, QualityPolicy


@dataclass(frozen=True)
class HttpPolicy:
    connect_timeout_seconds: float = 10
    read_timeout_seconds: float = 120
    download_deadline_seconds: float = 1800
    max_attempts: int = 4
    backoff_base_seconds: float = 1
    backoff_cap_seconds: float = 30
    retry_after_cap_seconds: float = 300
    retryable_status_codes: frozenset[int] = frozenset({408, 409, 425, 429, 500, 502, 503, 504})

    def __post_init__(self) -> None:
        bad = [f.name for f in fields(self) if f.name != "retryable_status_codes" and not getattr(self, f.name) > 0]
        if bad:
            raise RegistryError(f"not positive: {', '.join(bad)}")


@dataclass(frozen=True)
class Source:
    id: str
    product_id: str
    download_api_url: str
    expected_download_url: str
    data_member: str
    metadata_member: str
    max_archive_bytes: int
    frequency_code: int
    baseline_start: str
    baseline_end: str
    dimensions: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if not self.product_id.isdigit():
            raise RegistryError(f"{self.id}: the product id {self.product_id!r} is no number")
        if self.max_archive_bytes <= 0:
            raise RegistryError(f"{self.id}: no room for an archive")
        if self.baseline_start > self.baseline_end:
            raise RegistryError(f"{self.id}: the baseline ends before it starts")


@dataclass(frozen=True)
class Registry:
    raw_subdirectory: str
    cube_metadata_api_url: str
    http: HttpPolicy
    profiles: dict[str, Profile]
    sources: dict[str, Source]

    def profile(self, name: str) -> Profile:
        return _named(self.profiles, name, "profile")

    def source(self, name: str) -> Source:
        return _named(self.sources, name, "source")


def _named(known: dict[str, Any], name: str, what: str) -> Any:
    if name not in known:
        raise RegistryError(f"no {what} {name!r}; there are {', '.join(sorted(known))}")
    return known[name]


def _toml(path: str | Path, error: type[Exception]) -> dict[str, Any]:
    try:
        return tomllib.loads(Path(path).read_text("utf-8"))
    except (OSError, tomllib.TOMLDecodeError, UnicodeDecodeError) as problem:
        raise error(f"{path}: {problem}") from problem


#: Version of the files' layout that is understood; a file that says none has this one.
CONTRACT_VERSION = 1


def _contract(path: str | Path, error: type[Exception]) -> dict[str, Any]:
    raw = _toml(path, error)
    if raw.get("contract_version", CONTRACT_VERSION) != CONTRACT_VERSION:
        raise error(f"{path}: contract version {raw['contract_version']!r}, not {CONTRACT_VERSION}")
    return raw


def _record(kind: type, raw: dict[str, Any], where: str, error: type[Exception] = RegistryError) -> Any:
    given = {f.name: tuple(raw[f.name]) if isinstance(raw[f.name], list) else raw[f.name] for f in fields(kind) if f.name in raw}
    try:
        return kind(**given)
    except TypeError as problem:
        raise error(f"{where}: {problem}") from problem


def load_registry(path: str | Path) -> Registry:
    raw = _contract(path, RegistryError)
    listed = [_record(Source, s, f"source {s.get('id')}") for s in raw.get("sources", [])]
    for what, values in (("id", [s.id for s in listed]), ("product id", [s.product_id for s in listed])):
        if len(values) != len(set(values)):
            raise RegistryError(f"a source's {what} occurs twice")
    sources = {s.id: s for s in listed}
    profiles = {}
    for name, p in raw.get("profiles", {}).items():
        ids = tuple(p.get("source_ids", ()))
        if not ids or set(ids) - set(sources):
            raise RegistryError(f"profile {name}: unknown or no sources: {', '.join(sorted(set(ids) - set(sources))) or 'none'}")
        try:
            profiles[name] = Profile(name, ids, f"{p['reference_start']}-01", f"{p['reference_end']}-01", tuple(p.get("cma_names", ())), tuple(p.get("cma_codes", ())))
        except KeyError as missing:
            raise RegistryError(f"profile {name}: no {missing}") from missing
    http = dict(raw.get("http", {}))
    if "retryable_status_codes" in http:
        http["retryable_status_codes"] = frozenset(http["retryable_status_codes"])
    return Registry(raw.get("raw_subdirectory", "raw"), raw.get("cube_metadata_api_url", ""), _record(HttpPolicy, http, "http"), profiles, sources)


def load_policy(path: str | Path, name: str) -> QualityPolicy:
    """A named policy; shares must lie between 0 and 1, counts must make sense, keys and types be given once."""
    policies = _contract(path, PolicyError).get("profiles", {})
    if name not in policies:
        raise PolicyError(f"no policy {name!r}; there are {', '.join(sorted(policies))}")
    raw = policies[name]
    try:
        policy = QualityPolicy(
            name, int(raw["min_rows"]), int(raw["max_rows"]), tuple(raw["key_columns"]), tuple(raw["allowed_dwelling_types"]), {k: float(v) for k, v in raw["null_thresholds"].items()},
            int(raw["max_duplicate_rows"]), float(raw["max_market_mismatch_fraction"]), float(raw["max_component_mismatch_fraction"]), bool(raw["require_complete_dwelling_set"]),
        )
    except (KeyError, TypeError, ValueError, AttributeError) as problem:
        raise PolicyError(f"policy {name}: {problem!r}") from problem
    shares = {**policy.null_thresholds, "market": policy.max_market_mismatch, "components": policy.max_component_mismatch}
    wrong = [k for k, v in shares.items() if not 0 <= v <= 1]
    if wrong or not 0 <= policy.min_rows <= policy.max_rows or policy.max_duplicate_rows < 0:
        raise PolicyError(f"policy {name}: out of range: {', '.join(wrong) or 'row counts'}")
    for values in (policy.keys, policy.dwelling_types):
        if not values or len(values) != len(set(values)):
            raise PolicyError(f"policy {name}: keys and dwelling types must be given, each once")
    return policy
