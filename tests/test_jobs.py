"""Whole jobs on small drop folders: loads, repeated loads, snapshots, forecasts, export."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

import feeds
from campuswatt.operators import quality as Q
from campuswatt.plans import jobs, loads as L, marts, training as T
from campuswatt.schemas import DIMENSIONS, FACTS, TABLES
from campuswatt.sources.warehouse import Warehouse


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    drops, root = tmp_path_factory.mktemp("drops"), tmp_path_factory.mktemp("wh")
    feeds.inverter_file(drops)
    feeds.meter_files(drops)
    feeds.booking_file(drops, "RoomAllocations_20230221.csv", feeds.FIRST_BOOKINGS)
    feeds.meteo_file(drops)
    wh = Warehouse(spark, str(root))
    return wh, jobs.load_all(spark, wh, str(drops)), drops


def test_all_tables_exist(loaded):
    wh = loaded[0]
    for name in TABLES:
        assert wh.read(name).columns == TABLES[name].names


def test_counters(loaded):
    stats = loaded[1]
    assert stats["FactEnergyConsumption"] == {"processed": 48, "inserted": 46, "duplicates": 0, "invalid": 2}
    assert stats["FactSolarProduction"]["inserted"] == stats["FactSolarProduction"]["processed"] == 4 + 7
    assert stats["FactMeteoSwissData"] == {"processed": 192, "inserted": 192, "updated": 0, "unchanged": 0}
    booked = stats["FactBookings"][0]
    # class x professor rows of one booking share their key: the first one is stored
    assert booked == {"processed": 7, "inserted": 4, "invalid": 0, "duplicates": 3, "deactivated": 0}


def test_rejects_keep_their_reason(loaded):
    reasons = {(r.table, r.reason): r.row for r in loaded[0].rejects().collect()}
    assert '"Pac":"bad"' in reasons["FactSolarProduction", "power is no number"]
    assert ("FactMeteoSwissData", "incomplete forecast") in reasons
    assert ("FactEnergyConsumption", "missing values") in reasons


def test_clean_all_takes_each_file_once(spark, tmp_path):
    drops, out = tmp_path / "d", str(tmp_path / "clean")
    drops.mkdir()
    feeds.meter_file(drops, feeds.DATES[0], "Consumption", {"1:00:00": "1", "2:00:00": "2"})
    feeds.inverter_file(drops)
    feeds.write(drops, "notes.csv", "any;thing\n1;2\n")
    assert len(jobs.clean_all(spark, str(drops), out, "2023-02-21")) == 3
    assert jobs.clean_all(spark, str(drops), out, "2023-02-22") == []
    feeds.meter_file(drops, feeds.DATES[1], "Consumption", {"1:00:00": "3"})
    assert len(jobs.clean_all(spark, str(drops), out, "2023-02-22")) == 1
    feeds.meter_file(drops, feeds.DATES[1], "Humidity", {"1:00:00": "3", "2:00:00": "4"})
    assert len(jobs.clean_all(spark, str(drops), out, "2023-02-22")) == 1     # a second run on the same day
    meters = spark.read.parquet(f"{out}/meter")
    assert {str(r.load_date): r.n for r in meters.groupBy("load_date").agg(F.count("*").alias("n")).collect()} == {
        "2023-02-21": 2, "2023-02-22": 3}
    assert [r.line for r in spark.read.parquet(f"{out}/unknown").orderBy("line_no").collect()] == ["any;thing", "1;2"]


def test_a_bad_file_stops_no_other(spark, tmp_path):
    drops, out = tmp_path / "d", str(tmp_path / "clean")
    drops.mkdir()
    feeds.meter_file(drops, feeds.DATES[0], "Consumption", {"1:00:00": "1"})
    feeds.booking_file(drops, "RoomAllocations_1.csv", [["2022-01-01", "u"]], ["Date", "User"])
    feeds.write(drops, "Pred_2023-02-21.csv", "Time,Site,Prediction,Measurement,Value\n2023-02-21 00:00:00,Bern,1,PRED_GLOB_ctrl,5\n")
    assert jobs.clean_all(spark, str(drops), out, "2023-02-21") == [f"{feeds.DATES[0]}-Consumption.csv"]
    rejects = {r.file: r.reason for r in spark.read.parquet(f"{out}/rejects").collect()}
    assert rejects == {"RoomAllocations_1.csv": "no usable rows", "Pred_2023-02-21.csv": "no usable rows"}
    feeds.booking_file(drops, "RoomAllocations_2.csv", feeds.FIRST_BOOKINGS)
    assert jobs.clean_all(spark, str(drops), out, "2023-02-22") == ["RoomAllocations_2.csv"]


def test_meter_rows_take_partners_of_their_own_day(spark, tmp_path):
    """A time that the day's own partner files lack is not filled from another day's files."""
    drops, wh = tmp_path / "d", Warehouse(spark, str(tmp_path / "wh"))
    drops.mkdir()
    first, second = feeds.DATES
    feeds.meter_file(drops, first, "Consumption", {"1:00:00": "1", "2:00:00": "2"})
    feeds.meter_file(drops, first, "Temperature", {"1:00:00": "5"})
    feeds.meter_file(drops, first, "Humidity", {"1:00:00": "5", "2:00:00": "5"})
    feeds.meter_file(drops, second, "Temperature", {"2:00:00": "9"})
    os.replace(os.path.join(drops, f"{second}-Temperature.csv"), os.path.join(drops, "99-Temperature.csv"))
    feeds.write(drops, f"{second}-Temperature.csv", open(os.path.join(drops, "99-Temperature.csv"), encoding="iso-8859-1").read().replace(second, first))
    feeds.meter_file(drops, "24.02.2023", "Consumption", {"1:00:00": "1"})
    assert jobs.load_all(spark, wh, str(drops))["FactEnergyConsumption"] == {"processed": 2, "inserted": 1, "duplicates": 0, "invalid": 1}
    assert [r.reason for r in wh.rejects().filter("reason LIKE 'missing partner%'").collect()] == ["missing partner file"]


def test_daily_production_features(spark, loaded):
    rows = T.production_daily_features(jobs.inverter_rows(loaded[0]), jobs.forecast_rows(loaded[0])).collect()
    assert [str(r.date) for r in rows] == ["2023-02-21"]
    assert rows[0].pv_output == 120.0 + 70.0 and rows[0].pred_glob_ctrl > 0


def test_repeated_load_changes_nothing(spark, loaded):
    wh, _, drops = loaded
    before = {n: sorted(map(str, wh.read(n).drop("last_modified").collect())) for n in TABLES}
    rejected = sorted(map(str, wh.rejects().collect()))
    again = jobs.load_all(spark, wh, str(drops))
    assert again["FactEnergyConsumption"]["inserted"] == 0
    assert again["FactSolarProduction"]["inserted"] == again["FactSolarProduction"]["updated"] == 0
    assert again["FactMeteoSwissData"]["unchanged"] == 192
    assert again["FactBookings"][0]["inserted"] == again["FactBookings"][0]["deactivated"] == 0
    assert {n: sorted(map(str, wh.read(n).drop("last_modified").collect())) for n in TABLES} == before
    assert sorted(map(str, wh.rejects().collect())) == rejected


def test_foreign_keys_hold(loaded):
    wh = loaded[0]
    dims = {s.names[0]: n for n, s in DIMENSIONS.items()}
    roles = {"id_time_start": "id_time", "id_time_end": "id_time", "id_professor": "id_user"}
    for fact, schema in FACTS.items():
        for col in schema.names:
            key = roles.get(col, col)
            if key in dims:
                assert Q.fk_orphans(wh.read(fact), wh.read(dims[key]), key, col).count() == 0


def test_bookings(loaded):
    wh = loaded[0]
    rows = {r.external_id: r for r in wh.read("FactBookings").collect()}
    anonymous = rows["2023-02-21_08:30_11:00_VS-BEL.N102_Unknown User"]
    assert anonymous.id_classroom is None
    types = {r.id_booking_type: r.code for r in wh.read("DimBookingType").collect()}
    assert types[anonymous.id_booking_type] == "DEF"
    users = [r.username for r in wh.read("DimUser").collect()]
    assert len([u for u in users if u.lower() == "ann"]) == 1


def test_next_snapshot_deactivates_and_inserts(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    drops = tmp_path / "d"
    drops.mkdir()
    feeds.booking_file(drops, "RoomAllocations_20230221.csv", feeds.FIRST_BOOKINGS)
    feeds.booking_file(drops, "RoomAllocations_20230222.csv", feeds.SECOND_BOOKINGS)
    first, second = jobs.load_all(spark, wh, str(drops))["FactBookings"]
    assert first["inserted"] == 4
    assert (second["inserted"], second["deactivated"]) == (1, 2)
    active = {r.external_id.split("_")[3] for r in wh.read("FactBookings").filter("is_active").collect()}
    assert active == {"VS-BEL.N101", "VS-BEL.N104"}
    assert wh.read("FactBookings").count() == 5


def test_forecast_job_and_export(spark, loaded, tmp_path):
    wh = loaded[0]
    start = datetime.date(2023, 2, 23)
    small = {"maxIter": 2, "maxDepth": 3}
    done = jobs.forecast_job(spark, wh, str(tmp_path), start, consumption_settings=small, grid=None,
                             production_settings={"numTrees": 3, "maxDepth": 3}, cutoff_days=0, daily=False)
    assert done["FactPrediction"]["inserted"] == 72
    assert done["metrics"]["consumption"]["hourly"]["n"] == 9
    hourly = spark.read.option("header", True).csv(f"{tmp_path}/forecast/production")
    assert hourly.count() == 72 and hourly.filter("cast(productionPrediction as double) < 0").count() == 0
    stored = wh.read("FactPrediction").join(wh.read("DimTime"), "id_time")
    midnight = stored.filter("hour = 0").collect()
    assert len(midnight) == 3
    assert all(r.predicted_consumption is not None and r.predicted_production is not None for r in midnight)
    assert stored.filter("hour > 0 AND predicted_consumption IS NOT NULL").count() == 0

    again = jobs.forecast_job(spark, wh, str(tmp_path), start, train=False, score=False)
    assert again["FactPrediction"]["inserted"] == 72 and wh.read("FactPrediction").count() == 72

    marts.export_star(wh, str(tmp_path / "star"))
    view = spark.read.option("header", True).csv(str(tmp_path / "star" / "SolarProductionView"))
    assert view.count() == wh.read("FactSolarProduction").count()


def test_star_export_is_in_time_order_over_its_files(spark, tmp_path):
    """Most rows lie in one month: it is cut over several files, and the files follow one another in time."""
    wh = Warehouse(spark, str(tmp_path / "wh"))
    n = 20_000
    days = spark.range(40).select((F.col("id") + 1).cast("int").alias("id_date"), F.lit(2024).alias("year"),
                                  F.when(F.col("id") < 28, 2).otherwise(3).alias("month"), (F.col("id") % 28 + 1).cast("int").alias("day"))
    clock = spark.range(96).select((F.col("id") + 1).cast("int").alias("id_time"), F.floor(F.col("id") / 4).cast("int").alias("hour"), (F.col("id") % 4 * 15).cast("int").alias("minute"))
    for table, rows in (("DimDate", days), ("DimTime", clock), ("DimInverter", spark.createDataFrame([(1, "INV1"), (2, "INV2")], "id_inverter int, inverter_name string")),
                        ("DimStatus", spark.createDataFrame([(1, "6")], "id_status int, status_name string"))):
        wh.write(table, rows)
    wh.write("FactSolarProduction", spark.range(n).select(
        (F.when(F.col("id") % 10 < 9, F.col("id") % 28).otherwise(28 + F.col("id") % 12) + 1).cast("int").alias("id_date"), (F.col("id") % 96 + 1).cast("int").alias("id_time"),
        (F.col("id") % 2 + 1).cast("int").alias("id_inverter"), F.lit(1).alias("id_status"), F.lit(1.0).alias("total_energy_produced"), F.lit(1.0).alias("energy_produced"),
        F.lit(0).alias("error_count"), F.when(F.col("id") % 10 < 9, 202402).otherwise(202403).alias("ym")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        marts.export_star(wh, str(tmp_path / "star"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted(f for f in os.listdir(tmp_path / "star" / "SolarProductionView") if f.startswith("part-"))
    times, february = [], 0
    for f in files:
        lines = (tmp_path / "star" / "SolarProductionView" / f).read_text().splitlines()[1:]
        own = [tuple(map(int, line.split(",")[:5])) for line in lines]
        february += any(t[1] == 2 for t in own)
        times += own
    assert len(times) == n and times == sorted(times) and february > 1


def test_forecast_values_change_only_beyond_the_tolerance(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.create_tables()
    daily = spark.createDataFrame([("23.02.2023", "10.0"), ("23.02.2023", "10.0005"), (None, "1")], "date string, consumptionPrediction string")
    hourly = spark.createDataFrame([("23.02.2023", "00:00", "2.0"), ("23.02.2023", "01:00", None)], "date string, hour string, productionPrediction string")
    stats = L.load_forecast(wh, daily, hourly, ("hour", "predicted_consumption"))
    assert stats["inserted"] == 1
    row = wh.read("FactPrediction").first()
    assert (row.predicted_consumption, row.predicted_production) == (10.0, 2.0)
