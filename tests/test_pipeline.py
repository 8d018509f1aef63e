"""Landing, scanning, cleaning, assembling, gating and publishing on inline data."""

from __future__ import annotations

import hashlib
import io
import json
import zipfile
from dataclasses import replace
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark import cli, publish
from tidemark.errors import CleaningError, IntegrityError, LandingError, PolicyError, PublishError, QualityError, RegistryError, SettingsError
from tidemark.operators import assemble, quality
from tidemark.operators.normalize import normalize
from tidemark.operators.revisions import LATEST_ONLY, clean_source
from tidemark.operators.trends import trends
from tidemark.plans.fact import FACT_COLUMNS, FACT_TYPES, LOAD_TYPES
from tidemark.sources import archives
from tidemark.sources.landing import Lander, Response, retry_delay, utc_release
from tidemark.sources.registry import HttpPolicy, Registry, Source, load_policy, load_registry
from tidemark.specs import ACTIVITY, MARKET, PRICES, SOURCES, Profile, QualityPolicy, TrendSpec

DWELLINGS = {"Total units": 10, "Single-detached units": 4, "Semi-detached units": 3, "Row units": 2, "Apartment and other unit types": 1}


def raw_row(spec, month="2024-01", geo="Toronto, Ontario", dguid="2021S0503535", dims=(), value="1", scalar="0", status=None, symbol=None, terminated=None, vector="v1", release=datetime(2024, 2, 1), sha="s"):
    return (month, geo, dguid, *dims, "Units", "300", "units", scalar, vector, "1.1", value, status, symbol, terminated, "0", spec.source_id, release, sha)


def raw_frame(spark, spec, rows):
    columns = ", ".join(f"`{c}` string" for c in spec.raw_columns) + ", _source_id string, _source_release_timestamp timestamp_ntz, _source_archive_sha256 string"
    return spark.createDataFrame(rows, columns)


def activity(spark, *rows):
    return raw_frame(spark, ACTIVITY, [raw_row(ACTIVITY, **{"dims": ("Housing starts", "Total units")} | r) for r in rows])


def test_normalize(spark):
    rows = [
        {"value": "2", "scalar": "3"}, {"value": "-1"}, {"value": "1.5"}, {"value": "..", "status": ".."}, {"value": "5", "scalar": "4"}, {"value": "5", "status": " r "}, {"value": "5", "symbol": "X"},
        {"month": "2024-13"}, {"geo": "  ", "dguid": None}, {"dguid": None, "geo": "All places"}, {"value": None, "scalar": None}, {"value": "5", "terminated": "t"},
    ]
    got = normalize(activity(spark, *rows), ACTIVITY).collect()
    assert [r.housing_count for r in got] == [2000, None, None, None, None, 5, 5, 1, 1, 1, None, 5]
    assert [r.is_publishable for r in got] == [True, False, False, False, False, True, False, True, True, True, False, True]
    assert got[5].is_revised and got[6].is_suppressed and got[7].reference_month is None and got[8].geography is None and got[9].geography_level == "aggregate" and got[11].is_terminated
    assert normalize(activity(spark, {}).limit(0), ACTIVITY).count() == 0


def test_revisions(spark):
    old, new = {"release": datetime(2024, 1, 1), "value": "1"}, {"release": datetime(2024, 2, 1), "value": "2"}
    frame = activity(spark, old, new, new | {"value": "3", "terminated": "t"}, old | {"month": "2023-12"}, {"geo": None}, {"geo": "Elsewhere", "dguid": "2021A0001"})
    got = {(str(r.reference_month)[:7], r.cma_code): r.housing_count for r in clean_source(frame, ACTIVITY).collect()}
    assert got == {("2024-01", "535"): 2, ("2023-12", "535"): 1, ("2024-01", None): 1}
    assert clean_source(frame, ACTIVITY, policy=LATEST_ONLY).count() == 2
    profile = Profile("p", (), "2024-01-01", "2024-12-01")
    assert clean_source(frame, ACTIVITY, profile).count() == 1 and clean_source(frame, ACTIVITY, replace(profile, cma_names=("Elsewhere",))).count() == 1
    assert clean_source(frame, ACTIVITY, replace(profile, cma_codes=("535",))).count() == 1
    with pytest.raises(CleaningError):
        clean_source(frame, ACTIVITY, policy="?")


@pytest.fixture(scope="module")
def clean(spark):
    a, m = [], []
    for i in range(13):
        month = f"{2023 + i // 12}-{i % 12 + 1:02d}"
        for d, n in DWELLINGS.items():
            starts = n * (100 if i == 12 else i + 1)
            a += [raw_row(ACTIVITY, month=month, dims=(x, d), value=str(starts)) for x in ("Housing starts", "Housing completions", "Housing under construction")]
            m += [raw_row(MARKET, month=month, dims=(d, x), value=str(starts if x == "Rental" else 0)) for x in ("Homeowner", "Rental", "Condo", "Co-op", "Other market")]
    p = [raw_row(PRICES, month="2024-01", dims=(x,), value="101.5") for x in ("Total (house and land)", "House only", "Land only")]
    return {s.source_id: clean_source(raw_frame(spark, s, rows), s) for s, rows in ((ACTIVITY, a), (MARKET, m), (PRICES, p))}


@pytest.fixture(scope="module")
def fact(clean):
    return assemble.build_fact(clean).cache()


POLICY = QualityPolicy("development", 65, 65, null_thresholds={"housing_starts": 0.0, "new_housing_price_index": 1.0}, require_complete_dwellings=True)


def test_fact(spark, clean, fact):
    assert fact.columns == list(FACT_COLUMNS) and fact.count() == 65
    last = fact.filter("reference_month = '2024-01-01' and dwelling_type = 'apartment_and_other'").first()
    assert (last.starts_3_month_average, last.starts_year_over_year_pct, last.starts_prior_12_month_average) == (41.0, 9900.0, 6.5)
    assert last.starts_anomaly_zscore > 20 and last.starts_anomaly_flag and last.has_complete_price_index and not last.has_permit_data and last.market_starts_total == 100 and last.completion_to_start_ratio == 1.0
    assert fact.filter("starts_anomaly_flag is null").count() == 60
    with pytest.raises(assemble.AssemblyError):
        assemble.build_fact({ACTIVITY.source_id: clean[ACTIVITY.source_id]})


def test_trend_gaps(spark):
    rows = [("a", "b", date(2020 + i // 12, i % 12 + 1, 1), v, v) for i, v in enumerate(range(1, 20)) if i != 5]
    got = {r.reference_month: r for r in trends(spark.createDataFrame(rows, "cma_code string, dwelling_type string, reference_month date, housing_starts bigint, housing_under_construction bigint"), TrendSpec()).collect()}
    assert got[date(2020, 7, 1)].under_construction_month_change is None and got[date(2020, 8, 1)].starts_3_month_average is None and got[date(2020, 9, 1)].starts_3_month_average == 8.0
    assert not any(r.has_12_month_anomaly_baseline for m, r in got.items() if m < date(2021, 7, 1)) and got[date(2021, 7, 1)].has_12_month_anomaly_baseline


def test_gates(spark, fact):
    assert quality.evaluate(fact, POLICY).passed

    def failed(frame, policy=POLICY):
        return {i.check for i in quality.evaluate(frame, policy).issues}

    assert failed(fact, replace(POLICY, max_rows=64, min_rows=0)) == {"row_count"}
    assert failed(fact.unionByName(fact.limit(1))) >= {"row_count", "duplicate_keys"}
    assert failed(fact.withColumn("reference_year", F.lit(1999))) == {"reference_year"}
    assert failed(fact.withColumn("market_starts_total", F.col("market_starts_total") + 1)) == {"market_reconciliation"}
    assert failed(fact.withColumn("housing_starts", F.when(F.col("dwelling_type") == "total", 0).otherwise(F.col("housing_starts")))) >= {"component_reconciliation"}
    assert failed(fact.withColumn("dwelling_type", F.when(F.col("dwelling_type") != "row", F.col("dwelling_type")))) >= {"key_nulls", "dwelling_completeness", "component_reconciliation"}
    assert failed(fact.withColumn("dwelling_type", F.lit("igloo"))) >= {"dwelling_domain", "duplicate_keys"}
    assert failed(fact.withColumn("housing_starts", F.lit(None).cast("bigint"))) >= {"null_threshold", "market_reconciliation"}
    assert failed(fact.drop("cma_code")) == {"schema"} and failed(fact.limit(0)) == {"row_count"}
    assert failed(fact.drop("geography")) == {"schema"} and failed(fact.withColumn("housing_starts", F.col("housing_starts").cast("int"))) == {"schema"}
    # A column that only the policy names must be there too, or the gate is closed.
    for policy in (replace(POLICY, keys=(*POLICY.keys, "nowhere")), replace(POLICY, null_thresholds={"nowhere": 1.0})):
        assert failed(fact, policy) == {"schema"}
    assert not failed(fact.withColumn("extra", F.lit(1)), replace(POLICY, null_thresholds={"extra": 0.0}))
    written = []
    with pytest.raises(QualityError) as error:
        publish.validate_then_write(fact, replace(POLICY, max_rows=64, min_rows=64), written.append)
    assert not written and not error.value.report.passed
    publish.validate_then_write(fact, POLICY, written.append)
    assert len(written) == 1


def test_publish(spark, fact, tmp_path):
    table, report = str(tmp_path / "t"), quality.require(fact, POLICY)
    audit = publish.Audit(spark, table + "/_audit")
    publish.publish(fact, table, audit, report)
    shorter = fact.filter("reference_month >= '2023-06-01' and dwelling_type != 'row'")
    publish.publish(shorter, table, audit, replace(report, metrics=report.metrics | {"row_count": shorter.count()}))
    now = publish.read_fact(spark, table)
    assert now.count() == 5 * 5 + 8 * 4 and set(now.columns) == {*FACT_COLUMNS, *LOAD_TYPES} and now.select("source_load_batch_id").distinct().count() == 2
    assert {n: t for n, t in now.dtypes if n in FACT_TYPES} == FACT_TYPES
    first = publish.current_version(spark, table)
    january = fact.filter("reference_month = '2024-01-01'")
    publish.publish(january, table, audit, replace(report, metrics=report.metrics | {"row_count": 5}))
    second = publish.current_version(spark, table)
    assert second.number == 3 and second.years[2023] == first.years[2023] and second.years[2024] != first.years[2024]  # only the touched year
    assert publish.read_fact(spark, table).count() == 58 and not publish._announce(spark, table, second)
    with pytest.raises(PublishError):
        publish.publish(fact, table, audit, report if False else replace(report, metrics={"row_count": 1}))
    assert publish.read_fact(spark, table).count() == 58
    assert sorted(r.status for r in audit.states().collect()) == ["FAILED", "SUCCEEDED", "SUCCEEDED", "SUCCEEDED"]
    audit.start("x", "development", datetime.now(UTC).replace(tzinfo=None))
    with pytest.raises(PublishError):
        publish.publish(fact, table, audit, report)
    with pytest.raises(PublishError):
        publish.publish(fact, table, audit, replace(report, issues=(quality.Issue("a", "b"),)))
    publish.write_fact(fact, str(tmp_path / "plain"))
    assert {p.name for p in (tmp_path / "plain").glob("reference_year=*")} == {"reference_year=2023", "reference_year=2024"}


def test_overtaken_publishers_start_over(spark, fact, tmp_path, monkeypatch):
    """Two that start from the same version: the later one finds its number taken and builds on the other's."""
    table, real = str(tmp_path / "t"), publish._announce
    year = {y: fact.filter(f"reference_year = {y}") for y in (2023, 2024)}
    calls = []

    def announce(spark, table, version):
        calls.append(version.number)
        if len(calls) == 1:
            monkeypatch.setattr(publish, "_announce", real)
            publish.replace_published(year[2023], table, date(2023, 1, 1), date(2023, 12, 1))
            monkeypatch.setattr(publish, "_announce", announce)
        return real(spark, table, version)

    monkeypatch.setattr(publish, "_announce", announce)
    publish.replace_published(year[2024], table, date(2024, 1, 1), date(2024, 1, 1))
    assert calls == [1, 2] and publish.read_fact(spark, table).count() == 65


def test_warehouse_settings():
    env = {"TIDEMARK_JDBC_URL": "jdbc:x:y", "TIDEMARK_JDBC_TABLE": "s.t", "TIDEMARK_JDBC_USER": "u", "TIDEMARK_JDBC_PASSWORD": " p", "TIDEMARK_JDBC_BATCH_ROWS": "500"}
    to = publish.load_warehouse(env)
    assert to.options()["batchsize"] == "500" and to.password == " p" and " p" not in repr(to) and publish.load_warehouse({}) is None
    for broken in ({"TIDEMARK_JDBC_TABLE": "t; drop"}, {"TIDEMARK_JDBC_USER": " "}, {"TIDEMARK_JDBC_BATCH_ROWS": "x"}, {"TIDEMARK_JDBC_BATCH_ROWS": "0"}):
        with pytest.raises(SettingsError):
            publish.load_warehouse(env | broken)


# Sources.
SOURCE = Source(ACTIVITY.source_id, str(ACTIVITY.product_id), "https://x.example/link", "https://x.example/a.zip", "data.csv", "meta.csv", 10_000, 6, "2024-01", "2024-12")
REGISTRY = Registry("raw", "https://x.example/meta", HttpPolicy(), {"p": Profile("p", (SOURCE.id,), "2024-01-01", "2024-12-01")}, {SOURCE.id: SOURCE})
HEADER = ",".join(f'"{c}"' for c in ACTIVITY.raw_columns)
LINE = '"2024-01","Toronto, Ontario","2021S0503535","Housing starts","Row units","Units","300","units","0","v1","1.1","7","","","","0"'


def archive(text=f"﻿{HEADER}\n{LINE}\n"):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("data.csv", text.encode())
        z.writestr("meta.csv", "m")
    return out.getvalue()


def transport(body, fail=0, url=SOURCE.expected_download_url):
    calls = []

    def call(method, where, payload=None):
        calls.append((method, where))
        if method == "POST":
            if len(calls) <= fail:
                return Response(503, {"retry-after": "7"})
            cube = {"productId": int(SOURCE.product_id), "frequencyCode": 6, "archiveStatusEn": "CURRENT - a cube", "cubeStartDate": "2020-01-01", "cubeEndDate": "2025-01-01", "releaseTime": "2024-02-01T08:30", "dimension": []}
            return Response(200, {}, [json.dumps([{"status": "SUCCESS", "object": cube}]).encode()])
        if where.endswith("link"):
            return Response(200, {}, [json.dumps({"status": "SUCCESS", "object": url}).encode()])
        if method == "HEAD":
            return Response(200, {"etag": "e", "content-length": str(len(body))})
        return Response(200, {"content-type": "application/zip", "content-length": str(len(body))}, [body])

    call.calls = calls
    return call


def test_landing_and_scan(spark, tmp_path):
    slept = []
    t = transport(archive(), fail=1)
    lander = Lander(REGISTRY, tmp_path, t, sleep=slept.append)
    (first,) = lander.land_profile("p")
    assert first.status == "downloaded" and slept == [7.0] and first.release == "20240201T133000Z"
    assert lander.land(SOURCE).status == "already_present" and sum(c == ("GET", SOURCE.expected_download_url) for c in t.calls) == 1
    rows = archives.read_snapshots(spark, tmp_path / "raw", tmp_path / "interim", ACTIVITY).collect()
    assert len(rows) == 1 and rows[0].VALUE == "7" and rows[0]._source_archive_sha256 == first.sha256
    (tmp_path / "raw" / SOURCE.id / "release=20240201T133000Z" / f"sha256={first.sha256}" / "archive.zip").write_bytes(b"x")
    with pytest.raises(IntegrityError):
        lander.land(SOURCE)


def test_landing_refusals(tmp_path):
    bad = transport(b"no zip")
    with pytest.raises(IntegrityError):
        Lander(REGISTRY, tmp_path, bad, sleep=lambda s: None).land(SOURCE)
    assert sum(c == ("GET", SOURCE.expected_download_url) for c in bad.calls) == 2 and not list(tmp_path.rglob("archive.zip"))
    for t in (transport(archive(), url="https://elsewhere.example/a.zip"), transport(archive(), fail=9), transport(b"0" * 20_000)):
        with pytest.raises(LandingError):
            Lander(REGISTRY, tmp_path, t, sleep=lambda s: None).land(SOURCE)
    assert utc_release("2024-07-01T08:30").hour == 12
    now = datetime(2024, 1, 1, tzinfo=UTC)
    policy = HttpPolicy()
    assert retry_delay(3, None, policy, lambda a, b: b, now) == 4 and retry_delay(9, None, policy, lambda a, b: b, now) == 30 and retry_delay(1, "9999", policy, max, now) == 300
    assert retry_delay(1, "Mon, 01 Jan 2024 00:01:00 GMT", policy, max, now) == 60


def test_broken_download_is_tried_again(tmp_path):
    body, calls = archive(), []

    def breaking():
        yield body[:50]
        raise ConnectionResetError("reset")

    plain = transport(body)

    def call(method, where, payload=None):
        r = plain(method, where, payload)
        if (method, where) == ("GET", SOURCE.expected_download_url):
            calls.append(where)
            if len(calls) == 1:
                r.body = breaking()
        return r

    assert Lander(REGISTRY, tmp_path, call, sleep=lambda s: None).land(SOURCE).status == "downloaded" and len(calls) == 2
    calls.clear()
    always = lambda m, w, p=None: Response(200, {"content-type": "application/zip"}, breaking()) if (m, w) == ("GET", SOURCE.expected_download_url) else plain(m, w, p)
    with pytest.raises(LandingError):
        Lander(REGISTRY, tmp_path / "b", always, sleep=lambda s: None).land(SOURCE)
    assert not list((tmp_path / "b").rglob("archive.zip"))


def test_shipped_configuration():
    registry = load_registry("config/sources.toml")
    assert set(registry.sources) == set(SOURCES) and registry.profile("full").start == "2016-01-01" and registry.source(ACTIVITY.source_id).data_member == "34100154.csv"
    for name, spec in SOURCES.items():
        assert registry.source(name).product_id == str(spec.product_id) and registry.source(name).dimensions[1:] == tuple(raw for raw, _ in spec.dimensions)
    assert load_policy("config/validation.toml", "development").max_rows == 360 and load_policy("config/validation.toml", "full").null_thresholds["housing_starts"] == 0.01


def test_run_with_the_shipped_configuration(tmp_path, monkeypatch, spark, capsys):
    """clean and run --skip-ingestion over landed archives, with the default registry and policies."""
    monkeypatch.setenv("TIDEMARK_RAW", str(tmp_path / "raw"))
    monkeypatch.setenv("TIDEMARK_INTERIM", str(tmp_path / "interim"))
    monkeypatch.setenv("TIDEMARK_OUTPUT", str(tmp_path / "out"))
    areas = (("Toronto, Ontario", "535"), ("Vancouver, British Columbia", "933"), ("Calgary, Alberta", "825"))
    months = [f"{y}-{m:02d}" for y in (2024, 2025) for m in range(1, 13)]
    market = {"Total units": "Total units", "Single-detached units": "Single units", "Apartment and other unit types": "Apartment and other types of units"}

    def lines(spec):
        out = []
        for month in months:
            for name, code in areas:
                if spec is PRICES:
                    dims = [((x,), "101.5") for x in ("Total (house and land)", "House only", "Land only")]
                elif spec is ACTIVITY:
                    dims = [((x, d), str(n)) for d, n in DWELLINGS.items() for x in ("Housing starts", "Housing completions", "Housing under construction")]
                else:
                    dims = [((market.get(d, d), x), str(n if x == "Rental" else 0)) for d, n in DWELLINGS.items() for x in ("Homeowner", "Rental", "Condo", "Co-op", "Other market")]
                out += [",".join(f'"{v}"' for v in raw_row(spec, month, name, f"2021S0503{code}", ds, v)[: len(spec.raw_columns)]).replace('"None"', '""') for ds, v in dims]
        return out

    for spec in (ACTIVITY, MARKET, PRICES):
        blob = io.BytesIO()
        with zipfile.ZipFile(blob, "w") as z:
            z.writestr(f"{spec.product_id}.csv", ",".join(f'"{c}"' for c in spec.raw_columns) + "\n" + "\n".join(lines(spec)) + "\n")
        sha = hashlib.sha256(blob.getvalue()).hexdigest()
        folder = tmp_path / "raw" / "cubes" / spec.source_id / "release=20260101T133000Z" / f"sha256={sha}"
        folder.mkdir(parents=True)
        (folder / "archive.zip").write_bytes(blob.getvalue())
        (folder / "manifest.json").write_text(json.dumps({"source_id": spec.source_id, "sha256": sha, "release": "20260101T133000Z", "data_member": f"{spec.product_id}.csv"}))
    monkeypatch.setattr(type(spark), "stop", lambda self: None)  # the tests share one session
    assert cli.main(["clean"]) == 0 and "1080 rows, 0 not publishable" in capsys.readouterr().out
    assert cli.main(["run", "--skip-ingestion"]) == 0 and "wrote 360 rows" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "out" / "housing_monthly")).count() == 360


def test_header_drift(spark, tmp_path):
    Lander(REGISTRY, tmp_path, transport(archive("a,b\n1,2\n"))).land(SOURCE)
    with pytest.raises(CleaningError):
        archives.read_snapshots(spark, tmp_path / "raw", tmp_path / "interim", ACTIVITY)
    assert not list((tmp_path / "interim").rglob("*.csv"))
    with pytest.raises(CleaningError):
        archives.discover(tmp_path / "raw", MARKET)


def test_config(tmp_path, capsys, monkeypatch):
    source = 'id = "a"\nproduct_id = "{}"\ndownload_api_url = ""\nexpected_download_url = ""\ndata_member = ""\nmetadata_member = ""\nmax_archive_bytes = 1\nfrequency_code = 6\nbaseline_start = "2024-01"\nbaseline_end = "2024-02"\n'
    text = '[profiles.p]\nsource_ids = ["a"]\nreference_start = "2024-01"\nreference_end = "2024-02"\n[[sources]]\n'
    good, bad = tmp_path / "r.toml", tmp_path / "b.toml"
    good.write_text(text + source.format("1"))
    assert load_registry(good).profile("p").start == "2024-01-01"
    for broken in (text + source.format("x"), text.replace('"a"', '"z"') + source.format("1"), text + source.format("1") + "[[sources]]\n" + source.format("2"), "["):
        bad.write_text(broken)
        with pytest.raises(RegistryError):
            load_registry(bad)
    with pytest.raises(RegistryError, match="there are p"):
        load_registry(good).profile("q")
    policy = '[profiles.p]\nmin_rows = 1\nmax_rows = 2\nkey_columns = ["k"]\nallowed_dwelling_types = ["t"]\nrequire_complete_dwelling_set = true\nmax_duplicate_rows = 0\nmax_market_mismatch_fraction = {}\nmax_component_mismatch_fraction = 0.0\n[profiles.p.null_thresholds]\nx = 0.5\n'
    good.write_text(policy.format("0.1"))
    assert load_policy(good, "p").null_thresholds == {"x": 0.5}
    bad.write_text(policy.format("1.5"))
    with pytest.raises(PolicyError):
        load_policy(bad, "p")
    monkeypatch.setenv("TIDEMARK_RAW", "somewhere")
    assert cli.main(["show-config"]) == 0 and "/somewhere" in capsys.readouterr().out
    assert cli.main(["clean", "--registry", str(tmp_path / "none.toml")]) == 1
    monkeypatch.setenv("TIDEMARK_RAW", " ")
    assert cli.main(["show-config"]) == 2
