"""Problems 1 to 7 on small fixtures, against brute force where there is one, with nulls, ties, repeats and empty tables."""

from __future__ import annotations

import random
from datetime import date, datetime
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import text, units
from tidemark.functions.hashing import xxhash64_longs
from tidemark.operators import parsing, profile, rolling, snapshots, spikes, widen
from tidemark.operators.units import dwelling_quantity
from tidemark.plans import problems


def test_hash_is_the_jvms(spark):
    rng = np.random.default_rng(0)
    a, b = rng.integers(-(2**63), 2**63, 200), rng.integers(-(2**63), 2**63, 200)
    df = spark.createDataFrame(list(zip(a.tolist(), b.tolist(), strict=True)), "a bigint, b bigint")
    got = [r[0] for r in df.select(F.xxhash64("a", "b", F.lit(7).cast("bigint"))).collect()]
    assert got == xxhash64_longs(a, b, 7).tolist()


@pytest.mark.parametrize(
    ("written", "month"),
    [("2024-03", "2024-03"), (" 2024-03 ", "2024-03"), ("2024/3", "2024-03"), ("2024M03", "2024-03"), ("202403", "2024-03"), ("2024-03-01", "2024-03"), ("03/2024", "2024-03"), ("Mar 2024", "2024-03"), ("décembre 2023", "2023-12"), ("2024-13", None), ("2024", None), ("", None), (None, None)],
)
def test_months(spark, written, month):
    assert spark.createDataFrame([(written,)], "m string").select(text.ref_month(F.col("m"))).first()[0] == month


def test_labels(spark):
    df = spark.createDataFrame([("Single‑detached units",), (" Semi-detached units",), ("Apartment & other unit types (2)",), ("Granny flats",), (None,), ("",)], "c string")
    assert [r[0] for r in df.select(text.dwelling_type(F.col("c"))).collect()] == ["single_detached", "semi_detached", "apartment_and_other", "unmapped_granny_flats", None, None]
    df = spark.createDataFrame([("Home-owner",), ("CONDO (2)",), ("Co‑op",), ("Other  market",), ("Life lease ",)], "c string")
    assert [r[0] for r in df.select(text.member_column(F.col("c"))).collect()] == ["starts_homeowner", "starts_condominium", "starts_cooperative", "starts_other_market", "starts_life_lease"]


# 4
@pytest.mark.parametrize(
    ("value", "scalar_id", "factor", "uom", "unit", "quantity"),
    [
        ("12", "0", "units", "Units", "unit", 12), ("1,234", None, None, None, "unit", 1234), ("9 454", "0", "units", "Units", "unit", 9454), ("0.738 K", "3", "Thousands ", "Units (in 000s)", "thousand", 738),
        ("3 dozen", "0", "units", "Units", "dozen", 36), ("2", "0", None, "Units (pairs)", "pair", 4), ("4", "0", None, "Units x 10", "ten", 40), ("0.5", "2", None, "Dozens of units", "dozen*hundred", 600),
        ("1.5 (000)", " 3", None, None, "thousand", 1500), ("0.25", "0", "units", "millions d'unités", "million", 250000), ("..", "3", "thousands", "Units", "thousand", None), ("", "0", "units", "Units", "unit", None),
        (None, None, None, None, "unit", None), ("7 (1)", "0", "units", "Units (1)", "unit", 7), ("-5", "0", "units", "units", "unit", -5), ("0.5", "0", "units", "Units", "unit", None), ("2", "3", "hundreds", "Units", "hundred|thousand", None),
    ],
)
def test_quantities(spark, value, scalar_id, factor, uom, unit, quantity):
    df = spark.createDataFrame([(value, scalar_id, factor, uom, 1)], "VALUE string, SCALAR_ID string, SCALAR_FACTOR string, UOM string, quantity int")
    row = dwelling_quantity(df).first()
    assert (row.source_unit, row.quantity) == (unit, quantity)


def test_unit_graph():
    celsius = units.UnitGraph((units.Edge("f", "c", Fraction(5, 9), Fraction(-160, 9)), units.Edge("k", "c", Fraction(1), Fraction(-27315, 100))))
    scale, offset, hops = celsius.compositions("k")["f"]
    assert scale * 212 + offset == Fraction(37315, 100) and hops == 2
    with pytest.raises(units.UnitError):
        units.UnitGraph((units.Edge("a", "b", Fraction(2)), units.Edge("b", "c", Fraction(3)), units.Edge("a", "c", Fraction(7)))).compositions("c")


# 1
def brute_changes(rows, releases):
    out = set()
    for feed in {r[0] for r in releases}:
        per_time = {}
        for f, at, label, archive, landed in releases:
            if f == feed and at is not None and (at not in per_time or (landed, archive) > per_time[at][0]):
                per_time[at] = ((landed, archive), label, archive)
        order = [per_time[t] for t in sorted(per_time)]
        content = lambda a: {(r[1], r[2]): r[3] for r in rows if r[0] == a and r[1] and r[2]}
        for (_, _, before), (_, label, now) in zip(order, order[1:], strict=False):
            old, new = content(before), content(now)
            out |= {(feed, label, *k, "added") for k in new.keys() - old.keys()} | {(feed, label, *k, "removed") for k in old.keys() - new.keys()}
            out |= {(feed, label, *k, "changed") for k in new.keys() & old.keys() if new[k] != old[k]}
    return out


@pytest.mark.parametrize(("first_cells", "rounds"), [(144, 4), (12, 4), (6, 1)])
def test_snapshot_changes(spark, first_cells, rounds):
    rng = random.Random(5)
    rows, state = [], {}
    for archive in "abc":
        for _ in range(120):
            state[(f"v{rng.randrange(60)}", f"2024-{rng.randrange(1, 7):02d}")] = rng.choice([None, 1, 2, 3])
        for k in rng.sample(sorted(state), 15):
            del state[k]
        rows += [(archive, *k, v) for k, v in state.items()] * 2
    rows += [("a", None, "2024-01", 5), ("a", "v1", None, 5), ("z", "v1", "2024-01", 5), (None, "v1", "2024-01", 1)]
    at = [datetime(2024, i, 1) for i in range(1, 6)]
    releases = [("f", at[0], "L0", "a", at[0]), ("f", at[1], "L1", "b", at[0]), ("f", at[2], "L2", "b", at[1]), ("f", at[3], "L3", "c", at[0]), ("f", at[3], "L3", "c", at[2]), ("f", None, "no", "a", at[0]), ("f", at[4], "L4", "nothing", at[0])]
    r = spark.createDataFrame(rows, "archive string, vector string, ref_month string, quantity bigint")
    s = spark.createDataFrame(releases, "feed string, release timestamp_ntz, label string, archive string, landed timestamp_ntz")
    got = snapshots.snapshot_changes(r, s, ["vector", "ref_month"], first_cells=first_cells, rounds=rounds).collect()
    assert len(got) == len(set(got))
    assert {(x.feed, x.label, x.vector, x.ref_month, x.change_kind) for x in got} == brute_changes(rows, releases)
    assert snapshots.snapshot_changes(r.limit(0), s, ["vector", "ref_month"]).count() == 0
    assert snapshots.snapshot_changes(r, s.limit(0), ["vector", "ref_month"]).count() == 0


def test_pairs_held_several_times_are_peeled():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    kh, vh = rng.integers(0, 1 << 60, (2, 60))

    def sketches(part, archive, side):
        """Each chunk sketches the pairs it holds, so one that is in two or four of them counts as often."""
        for chosen in part:
            batch = pa.RecordBatch.from_arrays([pa.array(x) for x in (np.full(len(chosen), archive), np.zeros(len(chosen), np.int64), kh[chosen], vh[chosen])], names=["archive", "bucket", "kh", "vh"])
            for out in snapshots._sketcher(144, 5)(iter([batch, batch])):
                yield pa.Table.from_batches([out]).append_column("release", pa.array([7], pa.int64())).append_column("side", pa.array([side], pa.int32()))

    new = [np.arange(50), np.arange(10), np.arange(10, 20), np.arange(5, 12), np.arange(7, 9)]
    old = [np.arange(20, 60), np.arange(56, 60), np.arange(20, 25)]
    table = pa.concat_tables([*sketches(new, 1, 1), *sketches(old, 2, -1)])
    got = pa.Table.from_batches(list(snapshots._peeler(144, 5)(iter(table.combine_chunks().to_batches()))))
    assert not any(got["failed"].to_pylist()) and set(got["kh"].to_pylist()) == set(kh[[*range(25), *range(50, 60)]].tolist())


# 2
def test_widen(spark):
    rows = [("e1", "a", 5, 1), ("e1", "a", 5, 2), ("e1", "b", None, 4), ("e1", "b", None, 3), ("e1", "c", 1, 5), ("e1", "c", 2, 6), ("e2", "d", 7, 7), ("e2", "a", None, 8), ("e2", "a", 3, 9), ("e3", None, 1, 10), (None, "a", 1, 11)]
    df = spark.createDataFrame(rows, "e string, column_name string, quantity bigint, obs_id bigint").withColumn("value", F.lit("clash"))
    wide = widen.widen(df, ["e"], ["a", "x"])
    assert wide.columns == ["e", "a", "x", "b", "c", "d", "failures"]
    got = {r.e: r for r in wide.collect()}
    assert set(got) == {"e1", "e2", "e3"}
    assert (got["e1"].a, got["e1"].b, got["e1"].c, got["e1"].d) == (5, None, None, None) and got["e3"].failures == "{}"
    assert got["e1"].failures == '{"b":{"state":"empty","bad_rows":2,"first_bad":3},"c":{"state":"conflict","bad_rows":0}}' and (got["e2"].a, got["e2"].d) == (3, 7)
    assert got["e2"].failures == '{"a":{"value":3,"state":"ok","bad_rows":1,"first_bad":8}}'
    cases = {tuple(r) for r in widen.unresolved_cells(df, ["e"], ["a", "b", "c"]).collect()}
    assert cases == {("e1", "b", "empty"), ("e1", "c", "conflict"), ("e2", "b", "empty"), ("e2", "c", "empty"), ("e3", "a", "empty"), ("e3", "b", "empty"), ("e3", "c", "empty")}
    assert widen.widen(df.limit(0), ["e"], ["a"]).count() == 0
    with pytest.raises(ValueError, match="more than 2"):
        widen.attribute_names(widen.resolve_cells(df, ["e"]), 2)


def test_wide_activity_keeps_other_measures(spark, monkeypatch):
    key = ("a", "f", "2024-01", "417", "row")
    rows = [(*key, "housing_starts", 5, 1), (*key, "housing_demolitions", 7, 2), (*key, None, 1, 3)]
    cells = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in problems.ENTITY) + ", column_name string, quantity bigint, obs_id bigint")
    monkeypatch.setattr(problems, "cube_cells", lambda *_, **__: cells)
    wide = problems.p2_wide_activity(spark, "")
    assert wide.columns == [*problems.ENTITY, *problems.MEASURES, "housing_demolitions", "failures"]
    assert [(r.housing_starts, r.housing_completions, r.housing_demolitions) for r in wide.collect()] == [(5, None, 7)]


# 3
@settings(max_examples=6, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-1000, 100000)), min_size=1, max_size=60))
def test_exact_median(spark, values):
    df = spark.createDataFrame([("l", v) for v in values], "load string, x bigint")
    got = profile.exact_medians(profile.value_counts(df, "load", ["x"]), ["x"]).collect()
    full = [v for v in values if v is not None]
    assert [float(r["median"]) for r in got] == ([float(np.median(full))] if full else [])


def test_profile_and_drift(spark):
    rows = [("l1", i, "ab", True) for i in range(20, 40)] + [("l2", 3 * i, None if i % 2 else "A1", i % 4 == 0) for i in range(20, 40)] + [("l2", None, "ab", None)]
    df = spark.createDataFrame(rows, "load string, n bigint, s string, b boolean")
    p = profile.column_profile(df, "load", ["n", "s", "b"], [("n", 0.0, 100.0, None), ("s", None, None, "[a-z]+")], ["n"])
    got = {(r["load"], r.column_name): r for r in p.collect()}
    assert got["l2", "s"].pattern_breaches == 10 and got["l2", "s"].nulls == 10 and got["l2", "n"].range_breaches == 6 and got["l1", "n"].median == 29.5
    before = spark.createDataFrame([("l2", "p", "l1")], "load string, profile string, before string")
    found = {tuple(r) for r in profile.drift_findings(p, before, ["b"], ["n"]).collect()}
    assert found == {("l2", "s", "null_rate"), ("l2", "b", "true_rate"), ("l2", "n", "level")}
    shift = {r.column_name: r.psi for r in profile.population_shift(profile.value_counts(df, "load", ["n", "s", "b"]), before, ["n"]).collect()}
    assert all(v > 0.1 for v in shift.values())
    assert profile.column_profile(df.limit(0), "load", ["n"], [], ["n"]).count() == 0


def brute_shift(old, new):
    if len(set(old) | set(new)) - (None in {*old, *new}) > 20:
        full = sorted(v for v in old if v is not None)
        edges = sorted({full[-(-k * len(full) // 10) - 1] for k in range(1, 10)}) if full else []
        old, new = ([None if v is None else sum(e < v for e in edges) for v in vs] for vs in (old, new))
    share = lambda vs, c: max(vs.count(c) / len(vs), 1e-4)
    pairs = [(share(old, c), share(new, c), new.count(c)) for c in {*old, *new}]
    return sum((p1 - p0) * np.log(p1 / p0) for p0, p1, _ in pairs), sum((n - p0 * len(new)) ** 2 / (p0 * len(new)) for p0, _, n in pairs)


def test_shift_within_a_power_of_two(spark):
    rng = np.random.default_rng(7)
    old = {"index": (99 + 6 * rng.random(300)).round(1), "year": rng.integers(2021, 2023, 300), "same": rng.integers(-50, 50, 300), "ties": rng.choice([0, 0, 0, 5, *range(40)], 300), "new": np.full(300, np.nan)}
    new = {"index": (101 + 9 * rng.random(300)).round(1), "year": rng.integers(2021, 2024, 300), "same": rng.permutation(old["same"]), "ties": rng.choice([0, 5, 5, *range(60)], 300), "new": np.arange(300)}
    rows = [(load, *(None if np.isnan(data[c][i]) or (i % 50 == 0 and c == "index") else float(data[c][i]) for c in old)) for load, data in (("l1", old), ("l2", new)) for i in range(300)]
    df = spark.createDataFrame(rows, "load string, " + ", ".join(f"`{c}` double" for c in old))
    before = spark.createDataFrame([("l2", "l1")], "load string, before string")
    got = {r.column_name: (r.psi, r.chi_square) for r in profile.population_shift(profile.value_counts(df, "load", list(old)), before, list(old)).collect()}
    for i, c in enumerate(old):
        assert got[c] == pytest.approx(brute_shift(*([r[i + 1] for r in rows if r[0] == load] for load in ("l1", "l2"))), abs=1e-3), c
    assert got["same"] == (0, 0) and min(got["index"][0], got["year"][0]) > 0.25


def test_metric_texts():
    read = problems._metric_pairs
    assert read('{"ROW_COUNT": 5}') == {"row_count": "5"} and read('{"metrics": {"row_count": "5"}}') == {"row_count": "5"} and read('[{"name": "row_count", "value": 7}]') == {"row_count": "7"}
    assert read("{'row_count': 5}") is None and read(None) is None and read('{"row_count": 5') is None and read('{"row_count": NaN}') is None and read('{"x": 1}') == {}


# 5
@settings(max_examples=6, deadline=None)
@given(st.dictionaries(st.integers(0, 40), st.one_of(st.none(), st.integers(-5, 50)), min_size=1, max_size=25))
def test_trailing_totals(spark, series):
    rows = [("p", date(2020 + t // 12, t % 12 + 1, 1), v) for t, v in series.items()] * 2
    got = {(r.m.year - 2020) * 12 + r.m.month - 1: r for r in rolling.trailing_totals(spark.createDataFrame(rows, "p string, m date, v bigint"), ["p"], "m", "v", (3, 7, 12)).collect()}
    assert sorted(got) == list(range(min(series), max(series) + 1))
    for t, r in got.items():
        for n in (3, 7, 12):
            assert r[f"total_{n}"] == sum(series.get(k) or 0 for k in range(t - n + 1, t + 1))
            assert r[f"present_{n}"] == sum(series.get(k) is not None for k in range(t - n + 1, t + 1)) and abs(r[f"average_{n}"] - r[f"total_{n}"] / n) < 1e-9
        assert r.has_row == (t in series) and r.v == series.get(t)


def test_trailing_days_and_edges(spark):
    df = spark.createDataFrame([(None, date(2024, 1, 1), 1, 1), (None, date(2024, 1, 9), 2, 1), (None, date(2024, 1, 9), 5, 2), ("x", None, 3, 1)], "p string, d date, v bigint, rev int")
    got = rolling.trailing_totals(df, ["p"], "d", "v", (7, 30), ("rev",), unit="day").orderBy("d").collect()
    assert len(got) == 9 and got[-1].total_7 == 5 and got[-1].total_30 == 6 and rolling.binary_blocks(30) == [16, 8, 4, 2]
    assert rolling.trailing_totals(df.limit(0), ["p"], "d", "v", (3,)).count() == 0


# 6
LAYOUT = parsing.Layout("s", ("REF_DATE", "B", "VALUE"), {k: problems.CHECKS[k] for k in ("REF_DATE", "VALUE")})


def brute_line(line: str | None) -> str | None:
    if line is None:
        return "column_count"
    fields, i = [], 0
    while True:
        if line[i : i + 1] == '"':
            j, out = i + 1, ""
            while True:
                k = line.find('"', j)
                if k < 0:
                    return "quoting"
                out += line[j:k]
                if line[k + 1 : k + 2] == '"':
                    out, j = out + '"', k + 2
                    continue
                break
            i = k + 1
            if i < len(line) and line[i] != ",":
                return "quoting"
        else:
            k = line.find(",", i)
            out = line[i:] if k < 0 else line[i:k]
            if '"' in out:
                return "quoting"
            i += len(out)
        fields.append(out)
        if i >= len(line):
            break
        i += 1
    if len(fields) != 3:
        return "column_count"
    import re

    if not re.fullmatch(r"[0-9]{4}-(0[1-9]|1[0-2])", fields[0].strip(" ")):
        return "ref_date"
    return None if re.fullmatch(r"|\.\.|\.\.\.|x|F|[+-]?[0-9]+(\.[0-9]+)?", fields[2].strip(" ")) else "value"


def test_lines_against_a_scanner(spark):
    rng = random.Random(3)
    pieces = ['"', '""', ",", "2024-01", " 2024-12 ", "2024-13", "a", "1.5", "x", "..", "1e3", "é", "\u0001", "\u0002", "\n", " ", "-7"]
    lines = ["".join(rng.choices(pieces, k=rng.randrange(0, 9))) for _ in range(1500)]
    lines += [f"{d},{b},{v}" for d in ("2024-01", '"2024-02"', "2024-00") for b in ('"a,b"', '"q""q"', "b") for v in ("1", '""', "+1.", " F ", "1\n")]
    lines += [None, "", '"' * 9, "2024-01,b,1" + "0" * 50000, '2024-01,"' + '""' * 30000 + '",1']
    df = spark.createDataFrame([(i, "s", line, "z") for i, line in enumerate(lines)], "line_id int, source_id string, line string, reason string")
    got = {r.line_id: r.reason for r in parsing.checked_lines(df, (LAYOUT,)).select("line_id", "reason").collect()}
    assert len(got) == len(lines) and [i for i, line in enumerate(lines) if got[i] != brute_line(line)] == []
    other = spark.createDataFrame([(1, "?", "a,b,c"), (2, None, "a,b,c")], "line_id int, source_id string, line string")
    assert {r.reason for r in parsing.checked_lines(other, (LAYOUT,)).collect()} == {"column_count"} and parsing.checked_lines(other.limit(0), (LAYOUT,)).count() == 0
    fields = parsing.valid_records(parsing.checked_lines(df.filter("line like '%q\"\"q%'"), (LAYOUT,)), LAYOUT).select("B").distinct().collect()
    assert [r.B for r in fields] == ['q"q']


# 7
def scores(x, **more):
    return spikes.detail_scores(np.asarray(x, float)[None], **more)[0]


def spiked(x):
    return np.flatnonzero(np.abs(scores(x)) > 1).tolist()


def test_t_quantiles():
    got = spikes.t_quantiles(np.array([5, 15, 15, 1000]), np.array([0.025, 0.025, 0.0005, 0.025]))
    assert got == pytest.approx([2.5706, 2.1314, 4.0728, 1.9623], abs=2e-3)


def test_haar_side_against_plain_means():
    rng = np.random.default_rng(0)
    z = rng.normal(size=(3, 60))
    use = rng.random((3, 60)) > 0.3
    got = spikes.haar_side(z, use)
    for r in range(3):
        for t in range(60):
            means = [z[r, max(0, t - m) : t][use[r, max(0, t - m) : t]] for m in (7, 15, 31, 63)]
            some = next((m for m in means if len(m)), None)
            assert np.isnan(got[r, t]) if some is None else got[r, t] == pytest.approx(z[r, t] - some.mean())


def test_spikes(spark):
    rng = np.random.default_rng(2)
    level = 40 * (1 + 0.4 * np.sin(np.arange(48) / 12 * 2 * np.pi)) * np.where(np.arange(48) < 24, 1, 1.8)
    x = np.round(level * rng.uniform(0.9, 1.1, 48))
    assert not spiked(x)
    for at, value in ((5, 9999), (17, 8 * x[17]), (30, 1), (47, 5 * x[47])):
        y = x.copy()
        y[at] = value
        assert spiked(y) == [at]
    stuck = np.array([9.0, 10, 10, 10, 10, 10, 10, np.nan, 10, 10, 10, 10, 10, 3, 3, 3, 3, 3, 3])
    assert np.flatnonzero(spikes.stuck_runs(stuck)).tolist() == [1, 2, 3, 4, 5, 6] and not spikes.stuck_runs(np.zeros(0)).any()
    months = [date(2020 + i // 12, i % 12 + 1, 1) for i in range(48)]
    rows = [("p", None, m, int(v), 1) for m, v in zip(months, x, strict=True)] + [("p", "b", months[0], -4, 1), ("p", "b", months[2], None, 1), ("p", "b", None, 7, 1), ("p", None, months[9], 4000, 2)]
    df = spark.createDataFrame(rows, "p string, c string, m date, v bigint, rev int")
    got = {(r.c, r.ref_month, r.flag) for r in spikes.implausible_months(df, ["p", "c"], "m", "v", ("rev",)).collect()}
    assert got == {(None, "2020-10", "spike"), ("b", "2020-01", "impossible")}
    assert spikes.implausible_months(df.limit(0), ["p", "c"], "m", "v").count() == 0


def test_spikes_beside_a_change_of_level():
    rng = np.random.default_rng(4)
    months = np.arange(48)
    for rise in (2.2, 1 / 2.2):
        level = 150 * (1 + 0.4 * np.sin(months / 12 * 2 * np.pi)) * np.where(months < 24, 1, rise)
        x = np.round(level * rng.uniform(0.95, 1.05, 48))
        assert not spiked(x)
        for at in (3, 9, 16, 20, 28, 33, 40, 45):
            for times in (3.5, 1 / 8):
                y = x.copy()
                y[at] = np.round(y[at] * times)
                assert spiked(y) == [at], (rise, at, times)
    # The change itself is normal, however large.
    for at in (12, 17, 24, 31, 36):
        y = np.where(months < at, x, np.round(6 * x))
        assert not spiked(y)


def test_the_scale_is_the_series_own():
    """A given factor is a spike in a quiet series and none in a wild one, at any level of counts where Poisson scatter is small."""
    months, quiet_found, wild_found, clean = np.arange(48), 0, 0, 0
    for seed in range(20):
        rng = np.random.default_rng(seed)
        season = 1 + 0.4 * np.sin(months / 12 * 2 * np.pi)
        quiet, wild = np.round(4000 * season * rng.lognormal(0, 0.03, 48)), np.round(4000 * season * rng.lognormal(0, 0.25, 48))
        clean += len(spiked(quiet)) + len(spiked(wild))
        at = int(rng.integers(2, 46))
        for times in (1.4, 1 / 1.4):
            for x, scatter in ((quiet, "quiet"), (wild, "wild")):
                y = x.copy()
                y[at] = np.round(4000 * season[at] * times)
                hit = at in spiked(y)
                quiet_found += hit and scatter == "quiet"
                wild_found += hit and scatter == "wild"
    assert quiet_found == 40 and wild_found <= 1 and clean <= 2, (quiet_found, wild_found, clean)


def test_gaps_and_lengths_do_not_matter():
    rng = np.random.default_rng(5)
    series = [np.round(200 * rng.lognormal(0, 0.05, n)) for n in (7, 13, 48, 25, 240)]
    for x in series[2:]:
        x[rng.random(len(x)) < 0.2] = np.nan
        x[10] = 2500
    begins = np.array([24000 + i for i in range(5)])
    times = [b + np.flatnonzero(~np.isnan(x)) for b, x in zip(begins, series, strict=True)]
    begins = np.array([t.min() for t in times])
    rows, at, why, _ = spikes.flag_series(begins, times, [x[~np.isnan(x)] for x in series])
    assert sorted(zip(rows, at, why, strict=True)) == [(r, 24000 + r + 10, "spike") for r in (2, 3, 4)]
    assert not scores(np.full(48, np.nan)).any() and not scores(np.zeros(3)).any() and spikes.flag_series(np.zeros(0, int), [], []) == ([], [], [], [])
