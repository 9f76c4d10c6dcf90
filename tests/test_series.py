"""Series operators against pandas, over several buckets and with empty ones."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from campuswatt.operators import modelling as MO, ordering as R, series as E
from campuswatt.plans import training as T


@pytest.fixture(scope="module")
def frame():
    """Two hourly series over 100 days, gaps of all lengths, one empty month, gaps at both ends."""
    rnd = random.Random(5)
    parts = []
    for name, share in (("a", 0.3), ("b", 0.9)):
        ts = pd.date_range("2024-01-01", periods=2400, freq="h")
        values = [None if rnd.random() < share else round(rnd.uniform(-5, 40), 2) for _ in ts]
        parts.append(pd.DataFrame({"s": name, "ts": ts, "v": values}))
    df = pd.concat(parts)
    df.loc[(df.s == "b") & (df.ts.dt.month == 2), "v"] = None
    df.loc[df.ts < "2024-01-01 05:00", "v"] = None
    df.loc[df.ts > "2024-04-09 05:00", "v"] = None
    df["v"] = df["v"].astype(float)
    # uneven spacing
    return df[~((df.ts.dt.hour % 5 == 2) & df.v.isna())].reset_index(drop=True)


@pytest.fixture(scope="module")
def sdf(spark, frame):
    out = spark.createDataFrame(frame.astype({"ts": "datetime64[us]"}))
    return out.withColumn("v", F.when(~F.isnan("v"), F.col("v"))).repartition(5).cache()


def same(got, want, col="v"):
    got = got.select("s", "ts", col).toPandas().sort_values(["s", "ts"]).reset_index(drop=True)
    want = want.sort_values(["s", "ts"]).reset_index(drop=True)
    assert len(got) == len(want)
    np.testing.assert_allclose(got[col].astype(float), want[col].astype(float), rtol=0, atol=1e-9)


def per_series(frame, fn):
    out = frame.copy()
    for name in out.s.unique():
        rows = out.s == name
        out.loc[rows, "v"] = fn(out[rows].set_index("ts").v).values
    return out


def test_interp_linear(sdf, frame):
    same(E.interp_linear(sdf, ["v"], ["s"], "ts"), per_series(frame, lambda s: s.interpolate("linear").bfill().ffill()))


def test_interp_time(sdf, frame):
    same(E.interp_time(sdf, ["v"], ["s"], "ts"), per_series(frame, lambda s: s.interpolate("time").bfill().ffill()))


@pytest.mark.parametrize("how,fn", [
    ("ffill", lambda s: s.ffill()), ("bfill", lambda s: s.bfill()),
    ("ffill_bfill", lambda s: s.ffill().bfill()), ("bfill_ffill", lambda s: s.bfill().ffill())])
def test_fill(sdf, frame, how, fn):
    same(E.fill(sdf, ["v"], ["s"], "ts", how), per_series(frame, fn))


def test_lag_diff(sdf, frame):
    same(E.lag_diff(sdf, "v", ["s"], "ts", "d").withColumn("v", F.col("d")), per_series(frame, lambda s: s.diff()))


@pytest.mark.parametrize("n", [2, 24])
def test_rolling_sum_crosses_chunks(sdf, frame, n, monkeypatch):
    halo = R.with_halo
    monkeypatch.setattr(E, "with_halo", lambda df, keys, pos, before: halo(df, keys, pos, before, chunk=50))
    got = E.rolling_sum(sdf, "v", n, ["s"], "ts", "r").withColumn("v", F.col("r"))
    same(got, per_series(frame, lambda s: s.rolling(n, min_periods=1).sum()))


def test_one_series_without_keys(sdf, frame):
    a = frame[frame.s == "a"]
    got = E.interp_linear(sdf.filter("s = 'a'"), ["v"], [], "ts")
    same(got, per_series(a, lambda s: s.interpolate("linear").bfill().ffill()))


def test_group_mean_fill(sdf, frame):
    want = frame.copy()
    want["v"] = want.v.fillna(want.groupby(["s", want.ts.dt.date]).v.transform("mean"))
    same(E.group_mean_fill(sdf, "v", ["s", F.to_date("ts")]), want)


def test_quantiles_equal_numpy(spark):
    rnd = random.Random(1)
    values = [round(rnd.gauss(0, 3), 1) for _ in range(501)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = E.quantiles(df, "v", [0.0, 0.25, 0.75, 0.9, 1.0]).first()
    np.testing.assert_allclose(list(got), np.quantile(values, [0, 0.25, 0.75, 0.9, 1.0]))


def test_daily_resample_fills_empty_days(spark):
    df = spark.createDataFrame([("2024-01-01 05:00:00", 1.0), ("2024-01-04 06:00:00", 2.0), ("2024-01-04 07:00:00", 3.0)],
                               "t string, v double").withColumn("ts", F.to_timestamp("t"))
    got = {str(r.date): r.v for r in E.daily_resample(df, "v", [], "ts").collect()}
    assert got == {"2024-01-01": 1.0, "2024-01-02": 0.0, "2024-01-03": 0.0, "2024-01-04": 5.0}


def test_daylight_keeps_all_rows_of_a_dark_frame(spark):
    df = spark.createDataFrame([("2024-01-01 02:00:00",), ("2024-01-01 23:00:00",)], "t string").withColumn("ts", F.to_timestamp("t"))
    assert E.daylight(df).count() == 2
    lit = df.unionByName(df.limit(1).withColumn("ts", F.to_timestamp(F.lit("2024-01-01 12:00:00"))))
    assert E.daylight(lit).count() == 1


@pytest.mark.parametrize("n,want", [(1, (1, 1)), (2, (1, 1)), (3, (2, 1)), (10, (8, 2)), (101, (81, 20))])
def test_chrono_split_sizes(spark, n, want):
    df = spark.range(n).withColumnRenamed("id", "ts")
    got = MO.chrono_split(df, ["ts"]).agg(F.sum("is_train"), F.sum("is_test")).first()
    assert tuple(got) == want


def test_folds_are_contiguous_and_even(spark):
    got = [r.fold for r in MO.folds(spark.range(13), 5, ["id"]).orderBy("id").collect()]
    assert got == [0] * 3 + [1] * 3 + [2] * 3 + [3] * 2 + [4] * 2


def test_running_total_over_many_partitions(spark):
    df = spark.range(0, 1000, 1, 8).withColumn("w", F.col("id") % 7)
    got = R.running_total(df, ["id"], weight="w", into="t").orderBy("id").collect()
    in_runs = R.running_total(df, ["id"], weight="w", into="t", few=10, run_rows=90).orderBy("id").collect()
    assert in_runs == got
    total, want = 0, []
    for i in range(1000):
        total += i % 7
        want.append(total)
    assert [r.t for r in got] == want


@pytest.mark.parametrize("order", [["s", "i"], ["v"], ["n", "i"], ["hot", "i"], ["hot"], ["x"]])
def test_positions_in_one_sort_and_in_runs(spark, order):
    """Text, numbers with nulls, structs, and a value that most rows share."""
    df = spark.range(0, 3000, 1, 5).select(
        F.col("id").alias("i"), F.concat(F.lit("name"), F.md5(F.col("id").cast("string"))).alias("s"), (F.col("id") % 97).alias("v"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("n"), F.least(F.col("id"), F.lit(100)).alias("hot"),
        F.struct((F.col("id") % 10).alias("a"), F.col("id").alias("b")).alias("x"))
    for settings in ({}, {"few": 100, "run_rows": 200}):
        rows = R.global_position(df, order, **settings).orderBy("_pos").collect()
        assert [r._pos for r in rows] == list(range(3000))
        keys = [tuple((r[c] is not None, r[c]) for c in order) for r in rows]
        assert keys == sorted(keys)
    assert set(R.global_position(df, order, few=100, run_rows=200).columns) == {*df.columns, "_pos"}


def test_a_hot_value_lies_in_several_runs(spark):
    df = spark.range(0, 10_000, 1, 4).select("id", F.lit("same").alias("s"))
    rows, _ = R._in_runs(df.withColumn("_key0", F.col("s")), ["_key0"], 10_000, 1000)
    sizes = [r["count"] for r in rows.groupBy("_run").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 2000


@pytest.mark.parametrize("seed", range(5))
def test_quantiles_by_selection(spark, seed):
    """Skewed, tied and null data; only a few values are put in order."""
    rnd = random.Random(seed)
    kinds = [lambda: rnd.paretovariate(0.7), lambda: rnd.choice([1.0, 1.0, 1.0, 2.0]), lambda: float(rnd.randrange(-3, 3)),
             lambda: rnd.choice([0.0] * 9 + [rnd.random()]), lambda: rnd.gauss(0, 1)]
    values = [kinds[seed]() for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 50, "v double").repartition(4)
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.999, 1.0]
    want = np.quantile(values, shares)
    for few in (200_000, 40):
        np.testing.assert_allclose(list(E.quantiles(df, "v", shares, few=few).first()), want, rtol=1e-12, atol=1e-12)
    assert list(E.quantiles(df.limit(0), "v", [0.5]).first()) == [None]


def test_gap_methods(spark):
    rows = [("2024-01-01 00:00:00", 1.0, None, 4.0), ("2024-01-01 01:00:00", None, 2.0, None), ("2024-01-01 02:00:00", 5.0, None, 8.0)]
    df = spark.createDataFrame(rows, "ts string, temperature double, pred_a double, x double").withColumn("ts", F.col("ts").cast("timestamp"))
    cols = ["temperature", "pred_a", "x"]

    def values(method):
        return [tuple(r)[1:] for r in T.fill_gaps(df, cols, method=method).select("ts", *cols).orderBy("ts").collect()]

    assert values("drop") == []
    assert values("fill") == [(1.0, 0.0, 4.0), (3.0, 2.0, 6.0), (5.0, 0.0, 8.0)]
    assert values("interpolate") == [(1.0, 2.0, 4.0), (3.0, 2.0, 6.0), (5.0, 2.0, 8.0)]


@pytest.mark.parametrize("run", [
    lambda d: E.interp_linear(d, ["v"], ["s"], "ts"), lambda d: E.interp_time(d, ["v"], ["s"], "ts"),
    lambda d: E.fill(d, ["v"], ["s"], "ts"), lambda d: E.lag_diff(d, "v", ["s"], "ts", "v"),
    lambda d: E.rolling_sum(d, "v", 3, ["s"], "ts", "v"), lambda d: E.daily_amplitude(d, "v", ["s"], "ts", "v"),
    lambda d: E.group_mean_fill(d, "v", ["s"])])
def test_null_series_is_a_series(spark, sdf, run):
    """The series without a name behaves like any other, and a row without a time stays."""
    named, unnamed = sdf.filter("s = 'a'"), sdf.filter("s = 'a'").withColumn("s", F.lit(None).cast("string"))
    want = sorted((str(r.ts), r.v) for r in run(named).collect())
    got = run(unnamed.unionByName(sdf.filter("s = 'b'"))).collect()
    assert sorted((str(r.ts), r.v) for r in got if r.s is None) == want
    late = unnamed.limit(0).unionByName(spark.sql("SELECT 'a' AS s, CAST(NULL AS TIMESTAMP) AS ts, 1.0D AS v").select(*unnamed.columns))
    assert run(named.unionByName(late)).count() == named.count() + 1
