"""Command line: show-config, ingest, clean, aggregate, run. Spark starts only where data is read."""

from __future__ import annotations

import argparse
import http.client
import json
import os
import sys
import urllib.error
import urllib.request
from dataclasses import dataclass
from pathlib import Path
from typing import Any

from tidemark.errors import EngineError, SettingsError
from tidemark.sources.landing import CHUNK, Lander, Response
from tidemark.sources.registry import HttpPolicy, Registry, load_policy, load_registry

PREFIX = "TIDEMARK_"


@dataclass(frozen=True)
class Settings:
    raw: Path
    interim: Path
    output: Path
    registry: Path
    policies: Path


def load_settings(env: dict[str, str] | None = None) -> Settings:
    """Paths from TIDEMARK_RAW, _INTERIM, _OUTPUT, _REGISTRY and _POLICIES; relative ones become absolute."""
    env = dict(os.environ) if env is None else env
    defaults = {"raw": "data/raw", "interim": "data/interim", "output": "data/output", "registry": "config/sources.toml", "policies": "config/validation.toml"}
    values = {k: env.get(PREFIX + k.upper(), v) for k, v in defaults.items()}
    blank = [k for k, v in values.items() if not v.strip()]
    if blank:
        raise SettingsError(f"empty settings: {', '.join(blank)}")
    return Settings(**{k: Path(v).expanduser().absolute() for k, v in values.items()})


def http_transport(policy: HttpPolicy):
    """Plain requests: one time limit for connecting, another for each read."""

    def limited(kind: type[http.client.HTTPConnection]) -> type:
        class Limited(kind):  # type: ignore[misc,valid-type]
            def connect(self) -> None:
                self.timeout = policy.connect_timeout_seconds
                super().connect()
                self.sock.settimeout(policy.read_timeout_seconds)

        return Limited

    class Plain(urllib.request.HTTPHandler):
        def http_open(self, request):
            return self.do_open(limited(http.client.HTTPConnection), request)

    class Secure(urllib.request.HTTPSHandler):
        def https_open(self, request):
            return self.do_open(limited(http.client.HTTPSConnection), request)

    opener = urllib.request.build_opener(Plain, Secure)

    def call(method: str, url: str, payload: Any = None) -> Response:
        data = None if payload is None else json.dumps(payload).encode()
        request = urllib.request.Request(url, data, {"Content-Type": "application/json"} if data else {}, method=method)
        try:
            r = opener.open(request)
        except urllib.error.HTTPError as error:
            r = error
        return Response(r.status, {k.lower(): v for k, v in r.headers.items()}, iter(lambda: r.read(CHUNK), b""))

    return call


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidemark")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("show-config", "ingest", "clean", "aggregate", "run"):
        p = commands.add_parser(name)
        if name != "show-config":
            p.add_argument("--profile", default="development")
        p.add_argument("--registry", type=Path)
        if name in ("aggregate", "run"):
            p.add_argument("--output", type=Path)
            p.add_argument("--policies", type=Path)
            p.add_argument("--publish-table", help="publish into this versioned table with an audit, instead of plain Parquet")
        if name == "run":
            p.add_argument("--skip-ingestion", action="store_true")
    return parser


def _clean_frames(spark, settings: Settings, registry: Registry, profile_name: str) -> dict:
    from tidemark.operators.revisions import clean_source
    from tidemark.sources.archives import read_snapshots
    from tidemark.specs import SOURCES

    profile = registry.profile(profile_name)
    root = settings.raw / registry.raw_subdirectory
    return {s: clean_source(read_snapshots(spark, root, settings.interim, SOURCES[s]), SOURCES[s], profile) for s in profile.sources}


def run_command(args: argparse.Namespace, settings: Settings) -> None:
    registry_path = args.registry or settings.registry
    if args.command == "show-config":
        print(json.dumps({k: str(v) for k, v in vars(settings).items()}, indent=2))
        return
    registry = load_registry(registry_path)
    if args.command in ("ingest", "run") and not getattr(args, "skip_ingestion", False):
        for landed in Lander(registry, settings.raw, http_transport(registry.http)).land_profile(args.profile):
            print(f"{landed.source_id}: {landed.status}, {landed.size} bytes, release {landed.release}")
    if args.command == "ingest":
        return
    from tidemark.operators.revisions import clean_summary
    from tidemark.session import build_session

    policy = load_policy(args.policies or settings.policies, args.profile) if args.command != "clean" else None
    spark = build_session()
    try:
        clean = _clean_frames(spark, settings, registry, args.profile)
        if policy is None:
            for source, frame in clean.items():
                s = clean_summary(frame).first()
                print(f"{source}: {s.row_count} rows, {s.non_publishable_rows} not publishable, {s.first_month} to {s.last_month}")
            return
        aggregate(spark, clean, policy, args, settings)
    finally:
        spark.stop()


def aggregate(spark, clean: dict, policy, args: argparse.Namespace, settings: Settings) -> None:
    from pyspark import StorageLevel
    from pyspark.sql import functions as F

    from tidemark import publish
    from tidemark.operators.assemble import build_fact
    from tidemark.operators.quality import require

    fact = build_fact(clean).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if args.publish_table:
            done = publish.publish(fact, args.publish_table, publish.Audit(spark, f"{args.publish_table}/_audit"), require(fact, policy))
            print(f"published {done.rows} rows as {done.version}")
            warehouse = publish.load_warehouse(dict(os.environ))
            if warehouse is not None:
                publish.write_jdbc(publish.read_fact(spark, args.publish_table).filter(F.col("source_load_batch_id") == done.batch), warehouse)
                print(f"wrote {done.rows} rows to {warehouse.table}")
        else:
            target = str(args.output or settings.output / "housing_monthly")
            report = publish.validate_then_write(fact, policy, lambda f: publish.write_fact(f, target))
            print(f"wrote {report.metrics['row_count']} rows, {report.metrics['anomalies']} anomalies, to {target}")
    finally:
        fact.unpersist()


def main(argv: list[str] | None = None) -> int:
    """0 if all went well, 1 if a step failed, 2 if the command or the settings are wrong."""
    args = build_parser().parse_args(argv)
    try:
        settings = load_settings()
    except SettingsError as error:
        print(error, file=sys.stderr)
        return 2
    try:
        run_command(args, settings)
    except EngineError as error:
        print(error, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
