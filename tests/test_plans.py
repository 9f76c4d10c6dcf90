"""Physical plans: what must hold at any scale."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from campuswatt.operators import dims as D, joins as J, merge as M, ordering as R, series as E
from campuswatt.session import checkpoint_dir
from campuswatt.sources import files as FS
from entry_queries import registry
from entry_queries.dimensions import solar, solar_dims
from entry_queries.views import Views

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def readings(spark):
    return spark.range(1000).select(
        (F.col("id") % 3).alias("s"), (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("ts"),
        F.when(F.col("id") % 5 > 0, F.col("id").cast("double")).alias("v"))


def test_first_row_per_key_is_limited_before_the_shuffle(readings):
    text = plan(R.dedup_first(readings, ["s"], ["ts"]))
    assert text.count("WindowGroupLimit") == 2
    before_exchange = text[text.index("Exchange"):]
    assert "Partial" in before_exchange


@needs_data
@pytest.mark.parametrize("name", [
    "occupancy", "mart_occupancy", "explode_interval", "calendar", "booking_deactivate", "booking_insert", "floor_join",
    "hourly_merge", "star_denorm", "upsert_tol", "merge_nonnull", "interp_linear", "corr_matrix", "zscore", "plant_power"])
def test_no_cross_or_nested_loop_join(spark, name):
    text = plan(entry.queries()[name](spark, DATA))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@needs_data
@pytest.mark.parametrize("name", ["upsert_tol", "interp_time", "occupancy", "floor_join", "meteo_pivot", "explode_pairs", "star_denorm"])
def test_no_python_worker(spark, name):
    text = plan(entry.queries()[name](spark, DATA))
    assert "Python" not in text and "ArrowEval" not in text


# a window's or partition's cell is the series and the bucket together, so that a series without a name has cells too
CELL = r"struct\(s, s#\d+L, _bucket, (_bucket#\d+|date_trunc)"


def test_series_windows_run_per_bucket(readings):
    for df in (E.interp_linear(readings, ["v"], ["s"], "ts"), E.interp_time(readings, ["v"], ["s"], "ts"), E.fill(readings, ["v"], ["s"], "ts")):
        text = plan(df)
        row_windows = [line for line in text.splitlines() if re.search(r"- Window \[.*, ts#\d+ ASC", line)]
        assert row_windows and all("_cell" in line for line in row_windows)
        assert re.search(CELL, text)
    rolling = plan(E.rolling_sum(readings, "v", 24, ["s"], "ts", "r"))
    assert any("_chunk" in line for line in rolling.splitlines() if " Window [" in line)


def test_long_series_is_spread_over_buckets(spark, readings):
    """An input partitioned by series must not pin the series to one task."""
    pinned = readings.repartition(4, "s")
    text = plan(E.fill(pinned, ["v"], ["s"], "ts"))
    assert re.search(r"hashpartitioning\(_cell#", text) and re.search(CELL, text)


def test_filters_reach_the_scan(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 4).alias("ym"), F.lit(1.0).alias("v"))
    df.write.partitionBy("ym").parquet(str(tmp_path / "t"))
    text = plan(spark.read.parquet(str(tmp_path / "t")).filter(F.col("ym").isin(1, 2)).select("id"))
    assert re.search(r"PartitionFilters: \[.*ym#\d+ IN \(1,2\)", text)
    assert "ReadSchema: struct<id:bigint>" in text


def test_latest_snapshot_prunes_partitions(spark, tmp_path):
    df = spark.range(10).select("id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("load_date"))
    df.write.partitionBy("load_date").parquet(str(tmp_path / "t"))
    text = plan(FS.latest_snapshot(spark.read.parquet(str(tmp_path / "t"))))
    assert re.search(r"PartitionFilters: \[.*load_date#\d+ = Subquery", text)


def test_meters_join_without_a_nested_loop(spark):
    a = spark.range(10).select(F.col("id").alias("k"), F.col("id").alias("Value"), F.col("id").alias("o"))
    text = plan(J.lookup_first(a, a, ["k"], "Value", "other", ["o"]))
    assert "NestedLoop" not in text


def test_single_row_keys_are_not_collected(spark):
    """A batch without repeated keys needs no per-key lists."""
    target = spark.createDataFrame([("a", 1.0)], "k string, v double")
    batch = spark.range(50).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), F.lit(1.0).alias("v"), F.col("id").alias("o"))
    assert "collect_list" not in plan(M.upsert_tol(target, batch, ["k"], ["v"], ["o"]))


@needs_data
@pytest.mark.parametrize("name", ["dim_get_or_create", "quartile_flags", "quantiles", "chrono_split",
                                  "category_codes", "fold_metrics", "upsert_tol", "merge_nonnull"])
def test_building_a_query_writes_nothing(spark, name):
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    assert registry()[name].run(spark, DATA).schema
    assert set(os.listdir(folder)) == before


def test_repeated_keys_are_shuffled_once(spark):
    """Stored rows and the rows of repeated keys meet in one aggregate, without a join or a second reading."""
    target = spark.range(5).select(F.col("id").cast("string").alias("k"), F.lit(1.0).alias("v"))
    batch = spark.range(50).select((F.col("id") % 7).cast("string").alias("k"), F.lit(1.5).alias("v"), F.col("id").alias("o"))
    merged = M.upsert_tol(target, batch, ["k"], ["v"], ["o"])
    text = plan(merged)
    assert "Join" not in text and text.count("Range (0, 50") == 1
    got = {r.k: (r.v, r._action, r._rows) for r in merged.collect()}
    assert got == {str(i): (1.5, "update" if i < 5 else "insert", 8 if i == 0 else 7) for i in range(7)}


def test_null_keys_of_stored_rows_stay(spark):
    target = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 3.0), ("a", 9.0)], "k string, v double")
    batch = spark.createDataFrame([(None, 5.0, 1), ("a", 3.5, 1), ("a", 9.0, 2)], "k string, v double, o int")
    got = sorted(((r.k or "", r.v, r._action, r._updated) for r in M.upsert_tol(target, batch, ["k"], ["v"], ["o"]).collect()))
    assert got == [("", 1.0, "keep", 0), ("", 2.0, "keep", 0), ("", 5.0, "insert", 0), ("a", 9.0, "update", 2), ("a", 9.0, "update", 2)]


def test_clock_texts_are_split_once(spark):
    dim = spark.createDataFrame([(1, 7, 5), (2, 8, 0)], "id_time int, hour int, minute int")
    fact = spark.createDataFrame([("07:05:00",), ("8:00",), ("25:00",), ("x",), (None,)], "time string")
    out = D.lookup_time(fact, dim, "time")
    assert not any("split" in line for line in plan(out).splitlines() if "Join" in line)
    assert [(r.time, r.id_time) for r in out.collect()] == [("07:05:00", 1), ("8:00", 2), ("25:00", None), ("x", None), (None, None)]


@needs_data
def test_dimension_members_are_read_once(spark):
    v = Views(spark, DATA)
    for dim in solar_dims(v, solar(v)).values():
        assert not any("lineitem" in f for f in dim.inputFiles())
