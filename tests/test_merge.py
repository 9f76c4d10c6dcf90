"""Merges against row-by-row brute force, with and without hot keys."""

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from campuswatt.operators import merge as M

KEY, MEASURES = ["k"], ["a", "b"]
COLS = "k string, a double, b double, e int"


def brute_upsert(stored, rows, tol=0.001):
    state, stats = dict(stored), {"inserted": 0, "updated": 0, "unchanged": 0}
    for k, a, b, e, _ in sorted(rows, key=lambda r: r[4]):
        if k not in state:
            state[k], what = (a, b, e), "inserted"
        else:
            x, y, z = state[k]
            changed = abs(x - a) > tol or abs(y - b) > tol or z != e
            state[k], what = ((a, b, e), "updated") if changed else (state[k], "unchanged")
        stats[what] += 1
    return state, stats


def run_upsert(spark, stored, rows, **kw):
    target = spark.createDataFrame([(k, *v) for k, v in stored.items()], COLS)
    batch = spark.createDataFrame(rows, COLS + ", o int")
    out = M.upsert_tol(target, batch, KEY, MEASURES, ["o"], exact=["e"], **kw).cache()
    state = {r.k: (r.a, r.b, r.e) for r in out.collect()}
    stats = {r.counter: r.n for r in M.load_stats(out).collect()}
    return state, stats


def random_rows(seed, n, keys):
    """Values walk in steps around the tolerance; one key has most rows."""
    rnd = random.Random(seed)
    rows, value = [], 1.0
    for i in range(n):
        value += rnd.choice([0, 0.0004, -0.0004, 0.0008, -0.0008, 0.0011, 0.5])
        k = "hot" if rnd.random() < 0.6 else rnd.choice(keys)
        rows.append((k, round(value, 4), rnd.choice([2.0, 2.0, 2.0007]), rnd.choice([0] * 9 + [1]), i))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("hot_rows", [10_000, 5])
def test_upsert_equals_row_by_row(spark, seed, hot_rows):
    rows = random_rows(seed, 300, ["x", "y", "z"])
    stored = {"x": (1.0, 2.0, 0), "hot": (1.0003, 2.0, 0), "other": (9.0, 9.0, 9)} if seed % 2 else {"other": (9.0, 9.0, 9)}
    state, stats = run_upsert(spark, stored, rows, hot_rows=hot_rows, segments=7)
    want, want_stats = brute_upsert(stored, rows)
    assert state == want
    assert stats["processed"] == len(rows)
    assert {k: stats[k] for k in want_stats} == want_stats


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(0, 12), min_size=8, max_size=40), seed=st.integers(0, 12), stored=st.booleans())
def test_segments_compose_exactly(spark, values, seed, stored):
    """Any order of values a third of the tolerance apart, cut into segments."""
    rows = [("h", v / 3000, 0.0, 0, i) for i, v in enumerate(values)]
    known = {"h": (seed / 3000, 0.0, 0)} if stored else {"q": (0.0, 0.0, 0)}
    state, stats = run_upsert(spark, known, rows, hot_rows=2, segments=5)
    want, want_stats = brute_upsert(known, rows)
    assert state == want
    assert {k: stats[k] for k in want_stats} == want_stats


def test_drift_below_tolerance(spark):
    rows = [("d", v, 0.0, 0, i) for i, v in enumerate([1.0, 1.0008, 1.0016, 1.5])]
    state, stats = run_upsert(spark, {"z": (0.0, 0.0, 0)}, rows)
    assert state["d"] == (1.5, 0.0, 0)
    assert stats == {"processed": 4, "inserted": 1, "updated": 2, "unchanged": 1}


def test_upsert_twice_changes_nothing(spark):
    rows = [(f"k{i % 50}", float(i % 50), 1.0, 0, i) for i in range(50)]
    once, _ = run_upsert(spark, {"z": (0.0, 0.0, 0)}, rows)
    twice, stats = run_upsert(spark, once, rows)
    assert twice == once
    assert (stats["inserted"], stats["updated"], stats["unchanged"]) == (0, 0, 50)


def brute_nonnull(stored, rows, tol=0.001):
    state, inserted, updated = {k: list(v) for k, v in stored.items()}, 0, 0
    for k, c, p, _ in sorted(rows, key=lambda r: r[3]):
        if k not in state:
            state[k] = [c, p]
            inserted += 1
            continue
        for i, new in enumerate((c, p)):
            if new is not None and (state[k][i] is None or abs(state[k][i] - new) > tol):
                state[k][i] = new
                updated += 1
    return {k: tuple(v) for k, v in state.items()}, inserted, updated


@pytest.mark.parametrize("hot_rows", [1000, 3])
def test_merge_nonnull_equals_row_by_row(spark, hot_rows):
    rnd = random.Random(3)
    rows = [(rnd.choice("aaaabcd"), rnd.choice([None, 1.0, 1.0006, 1.0013, 2.0]), rnd.choice([None, None, 5.0, 5.0009, 7.0]), i)
            for i in range(60)]
    stored = {"a": (None, 5.0), "b": (1.0, None), "s": (3.0, None)}
    target = spark.createDataFrame([(k, *v) for k, v in stored.items()], "k string, c double, p double")
    batch = spark.createDataFrame(rows, "k string, c double, p double, o int")
    out = M.merge_nonnull(target, batch, ["k"], ["c", "p"], ["o"], hot_rows=hot_rows, segments=3).collect()
    want, inserted, updated = brute_nonnull(stored, rows)
    assert {r.k: (r.c, r.p) for r in out} == want
    assert (sum(r._inserted for r in out), sum(r._updated for r in out)) == (inserted, updated)
    assert {r.k: r._action for r in out}["s"] == "keep"


def test_insert_only_tests_duplicates_before_validity(spark):
    target = spark.createDataFrame([("old",)], "k string")
    rows = [("old", 1.0, 0), ("n", None, 1), ("n", 2.0, 2), ("n", 3.0, 3), ("n", None, 4), ("m", None, 5)]
    batch = spark.createDataFrame(rows, "k string, v double, o int")
    valid = F.col("v").isNotNull()
    got = M.insert_only(target, batch, ["k"], valid, ["o"]).collect()
    assert [(r.k, r.v) for r in got] == [("n", 2.0)]
    stats = {r.action: r.n for r in M.insert_only_stats(target, batch, ["k"], valid, ["o"]).collect()}
    assert stats == {"duplicate": 3, "inserted": 1, "invalid": 2}


BOOKING = "id int, date int, external_id string, is_active boolean"


def test_snapshot_diff(spark):
    target = spark.createDataFrame([
        (1, 1, "a", True), (2, 1, "b", True), (3, 2, "c", True), (4, 1, None, True), (5, 1, "d", False),
        (6, 1, "e", True), (7, 1, "e", True)], BOOKING)
    snap = spark.createDataFrame([(9, 1, "a", True)], BOOKING)
    out = {r.id: (r.is_active, r._deactivated) for r in M.snapshot_diff(target, snap, row_id="id").collect()}
    assert out == {1: (True, False), 2: (False, True), 3: (True, False), 4: (True, False), 5: (False, False),
                   6: (True, False), 7: (False, True)}
    itself = M.snapshot_diff(target, target.filter("is_active"), row_id="id")
    assert itself.filter("_deactivated").count() == 0
    nothing_known = M.snapshot_diff(target, snap, known_dates=spark.createDataFrame([(2,)], "date int"))
    assert nothing_known.filter("_deactivated").count() == 0


def test_booking_insert_skips_active_ids_and_keys(spark):
    cols = "date int, room string, external_id string, is_active boolean, o int"
    target = spark.createDataFrame([(1, "r1", "a", True, 0), (1, "r2", "b", True, 0), (1, "r3", "c", False, 0)], cols)
    batch = spark.createDataFrame([(1, "r9", "a", True, 1), (1, "r2", "x", True, 2), (1, "r3", "c", True, 3),
                                   (1, "r4", "y", True, 4), (1, "r4", "z", True, 5)], cols)
    got = M.booking_insert(target, batch, ["date", "room"], ["o"]).collect()
    assert sorted(r.external_id for r in got) == ["c", "y"]


def test_replace_dates_keeps_other_dates(spark):
    target = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 3.0)], "d int, v double")
    batch = spark.createDataFrame([(1, 9.0), (3, 8.0)], "d int, v double")
    assert sorted(map(tuple, M.replace_dates(target, batch, "d").collect())) == [(1, 9.0), (2, 3.0), (3, 8.0)]
