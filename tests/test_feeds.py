"""Readers and cleaners on small files."""

import datetime

import pytest
from pyspark.sql import functions as F

import feeds
from campuswatt.functions import academic, parsing as P
from campuswatt.operators import clean as C, occupancy as O
from campuswatt.plans import standard as S
from campuswatt.sources import files as FS, readers as R


def one(spark, expr, text):
    return spark.createDataFrame([(text,)], "t string").select(expr(F.col("t")).alias("x")).first().x


@pytest.mark.parametrize("text,want", [
    ("21.02.23", "2023-02-21"), ("1.2.23", "2023-02-01"), ("21.02.2023", "2023-02-21"), ("2023-02-21", "2023-02-21"),
    ("2/21/2023", "2023-02-21"), ("32.01.23", None), ("x", None), (None, None)])
def test_norm_date(spark, text, want):
    assert one(spark, P.norm_date, text) == want


def test_norm_date_format_comes_from_the_first_row(spark):
    df = spark.createDataFrame([("f", 1, "21.02.23"), ("f", 2, "22.02.2023"), ("g", 1, "22.02.2023")], "f string, o int, d string")
    got = {(r.f, r.o): r.d for r in C.norm_dates(df, "d", "f", ["o"]).collect()}
    assert got == {("f", 1): "2023-02-21", ("f", 2): None, ("g", 1): "2023-02-22"}


@pytest.mark.parametrize("text,want", [("7:5:3", "07:05:03"), ("23:59:59", "23:59:59"), ("24:00:00", None), ("10:00", None)])
def test_norm_time(spark, text, want):
    assert one(spark, P.norm_time, text) == want


@pytest.mark.parametrize("text,want", [
    ("8 janv. 2023", "2023-01-08"), ("31 août 2022", "2022-08-31"), ("8 jan 2023", None), ("8 janv.", None), ("31 févr. 2023", None)])
def test_fr_date(spark, text, want):
    got = one(spark, P.parse_fr_date, text)
    assert (got and str(got)) == want


def test_forced_year_loses_the_29th(spark):
    assert one(spark, lambda c: P.force_year(F.to_date(c), 2023), "2024-02-29") is None
    assert str(one(spark, lambda c: P.parse_fr_date(c, 2023), "5 mai 2019")) == "2023-05-05"


@pytest.mark.parametrize("text,want", [("07:30", 7.5), ("8", 8.0), ("8.25", 8.25), ("08:00:00", None), ("x", None)])
def test_decimal_hour(spark, text, want):
    assert one(spark, P.decimal_hour, text) == want


@pytest.mark.parametrize("name,want", [
    ("a_2024-01-02.csv", "2024-01-02"), ("02-01-2024-x", "2024-01-02"), ("x20240102", "2024-01-02"), ("2024_01_02", "2024-01-02"), ("none", None)])
def test_name_date(spark, name, want):
    got = one(spark, P.name_date, name)
    assert (got and str(got)) == want


def test_inverter_file(spark, tmp_path):
    feeds.inverter_file(tmp_path)
    got = R.clean_inverter_files(spark, str(tmp_path)).collect()
    by_key = {(r.Time, r.INV): r for r in got}
    assert {r.Date for r in got} == {"2023-02-21"}
    assert by_key["10:05:00", "1"].Pac == "12000"                     # first of two rows
    assert by_key["10:05:00", "2"].Pac == "2500" and by_key["10:05:00", "2"].Uac is None   # short block is padded
    assert not [k for k in by_key if k[0] in ("10:10:00",)]
    rows, rejects = S.std_min(R.clean_inverter_files(spark, str(tmp_path)), ["row"])
    std = {(r.time, r.inverter_name): r for r in rows.collect()}
    assert std["10:00:00", "1"].energy_produced == 0.5
    blank = std["10:15:00", "Unknown_Inverter"]
    assert (blank.status_name, blank.total_energy_produced, blank.error_count) == ("0", 0.0, 0)
    assert std["10:20:30", "1"].energy_produced == 0.0
    assert [r.Pac for r in rejects.collect()] == ["bad"]


def test_meter_files(spark, tmp_path):
    feeds.meter_files(tmp_path)
    got = R.clean_meter_files(spark, [str(tmp_path / f"{d}-Consumption.csv") for d in feeds.DATES]).collect()
    assert len(got) == 48
    assert {r.Date for r in got} == {"2023-02-21", "2023-02-22"}
    assert [r.Value for r in got if r.Time == "07:00:00"] == [17.0, 17.0]


def test_meteo_file(spark, tmp_path):
    feeds.meteo_file(tmp_path)
    got = R.clean_meteo_files(spark, str(tmp_path)).collect()
    assert {r.Site for r in got} == {"Sion", "Visp"}
    assert len(got) == 2 * 24 * 2 * 2 + 1
    row = next(r for r in got if (r.Date, r.Time, r.Site, r.Prediction) == ("2023-02-21", "00:00:00", "Sion", 1))
    assert row.PRED_T_2M_ctrl == 0.1                                  # first non-null, not the late duplicate
    assert all(r.PRED_TOT_PREC_ctrl == 0.0 for r in got if r.Time == "04:00:00")


def test_every_file_is_read_by_its_own_header(spark, tmp_path):
    feeds.write(tmp_path, "Pred_1.csv", "Time,Site,Prediction,Measurement,Value\n2023-02-21 00:00:00,Sion,1,PRED_GLOB_ctrl,5\n2023-02-21 00:00:00,Bern,1,PRED_GLOB_ctrl,5\n")
    feeds.write(tmp_path, "Pred_2.csv", "Time,Prediction,Measurement,Value\n2023-02-21 00:00:00,1,PRED_GLOB_ctrl,7\n2023-02-21 00:00:00,1,PRED_NEW,8\n")
    for order in (["Pred_1.csv", "Pred_2.csv"], ["Pred_2.csv", "Pred_1.csv"]):
        got = {(r.file, r.Site, r.PRED_GLOB_ctrl, r.PRED_NEW) for r in R.clean_meteo_files(spark, [str(tmp_path / n) for n in order]).collect()}
        assert got == {("Pred_1.csv", "Sion", 5.0, None), ("Pred_2.csv", None, 7.0, 8.0)}


def test_bookings_in_two_layouts_and_encodings(spark, tmp_path):
    one = feeds.booking_file(tmp_path, "RoomAllocations_1.csv", feeds.FIRST_BOOKINGS)
    text = "\t".join(["Année", "Mois", "Jour", "Début", "Fin", "Salle", "Utilisateur"]) + "\n2023\t2\t3\t8:00\t9:00\tVS-BEL1\tZoé\n"
    two = feeds.write(tmp_path, "RoomAllocations_2.csv", text, "iso-8859-1")
    bad = feeds.booking_file(tmp_path, "RoomAllocations_3.csv", [["2022-01-01", "u"]], ["Date", "User"])
    for paths in ([one, two, bad], [bad, two, one]):
        got = R.clean_booking_files(spark, paths).collect()
        assert len([r for r in got if r.file == "RoomAllocations_1.csv"]) == 7
        assert [(str(r.Date), r.user_name, r.start_time) for r in got if r.file == "RoomAllocations_2.csv"] == [("2023-02-03", "Zoé", "8:00")]
    assert [r.file for r in R.bad_headers(spark, [one, two, bad], "booking", C.lacks_booking_columns).collect()] == ["RoomAllocations_3.csv"]


def test_booking_file(spark, tmp_path):
    path = feeds.booking_file(tmp_path, "RoomAllocations_20230221.csv", feeds.FIRST_BOOKINGS)
    got = R.clean_booking_files(spark, [path]).collect()
    assert "Remarque" not in got[0].asDict()
    pairs = {(r["class"], r.professor) for r in got if r.room_name == "VS-BEL.N101" and str(r.Date) == "2023-02-21"}
    assert pairs == {("A1", "Prof X"), ("A1", "Prof Y"), ("A2", "Prof X"), ("A2", "Prof Y")}
    assert len(got) == 4 + 1 + 1 + 1      # other building, empty list and 31 February are gone


def test_booking_parts_and_missing_columns(spark, tmp_path):
    head = ["Année", "Mois", "Jour", "Start", "End", "Room", "User"]
    path = feeds.booking_file(tmp_path, "RoomAllocations_x.csv", [["2022", "2", "3", "8:00", "9:00", "VS-BEL1", "u"]], head)
    got = R.clean_booking_files(spark, [path], year=2023).collect()
    assert [str(r.Date) for r in got] == ["2023-02-03"]
    bad = feeds.booking_file(tmp_path, "RoomAllocations_y.csv", [["2022-01-01", "u"]], ["Date", "User"])
    with pytest.raises(ValueError, match="room_name"):
        R.clean_booking_files(spark, [bad])


def test_first_row_decides_the_date_format(spark):
    df = spark.createDataFrame([("f", 1, "8 mai 2023"), ("f", 2, "2023-05-09"), ("g", 1, "2023-05-10")], "f string, o int, Date string")
    got = sorted(str(r.Date) for r in C.booking_dates(df, file="f", order=["o"]).collect())
    assert got == ["2023-05-08", "2023-05-10"]


def test_explode_pairs_keeps_rows_if_none_expands(spark):
    df = spark.createDataFrame([(" , ", "p"), ("", "q")], "class string, professor string")
    assert C.explode_pairs(df).count() == 2
    one_null = spark.createDataFrame([(None, "p, q"), ("a", "")], "class string, professor string")
    assert sorted((r["class"], r.professor) for r in C.explode_pairs(one_null).collect()) == [(None, "p"), (None, "q")]


def test_encodings(spark, tmp_path):
    feeds.write(tmp_path, "u.csv", "é1\nb\n")
    feeds.write(tmp_path, "l.csv", "é1\r\nb\r\n", "iso-8859-1")
    got = sorted((r.file, r.line_no, r.line) for r in R.read_text_any(spark, str(tmp_path)).collect())
    assert got == [("l.csv", 0, "é1"), ("l.csv", 1, "b"), ("u.csv", 0, "é1"), ("u.csv", 1, "b")]


def test_a_file_has_one_encoding(spark, tmp_path):
    """The second line would be valid UTF-8 by itself; the third shows that the file is not."""
    feeds.write(tmp_path, "x.csv", "head\nÃ©x\nété\n", "iso-8859-1")
    feeds.write(tmp_path, "y.csv", "head\nÃ©x\n", "utf-8")
    got = sorted((r.source_file, r.line) for r in R.read_lines(spark, str(tmp_path)).collect())
    assert got == [("x.csv", "head"), ("x.csv", "Ã©x"), ("x.csv", "été"), ("y.csv", "head"), ("y.csv", "Ã©x")]


def test_half_hour_covers_no_whole_hour(spark):
    df = spark.createDataFrame([(datetime.date(2024, 1, 1), "07:30", "08:00", "r"), (datetime.date(2024, 1, 1), "07:30", "09:30", "r"),
                                (datetime.date(2024, 1, 1), "10:00", "10:00", "s")],
                               "date date, start_time string, end_time string, room_name string")
    got = {r.ts.hour: r.rooms_occupied for r in O.occupancy(df).collect() if r.rooms_occupied}
    assert got == {8: 1, 9: 1}


def test_academic_calendar(spark):
    cal = {str(r.date): r for r in academic.academic_calendar(spark).collect()}
    assert len(cal) == 395
    assert cal["2022-12-08"].holiday_name == "Immaculée conception" and cal["2022-12-08"].is_holiday_period == 1
    assert cal["2023-05-19"].is_ascension == 1 and cal["2023-05-21"].is_ascension == 0
    weeks = {r.academic_week for r in cal.values()} - {""}
    assert weeks == {f"A{i}" for i in range(17)} | {f"P{i}" for i in range(1, 17)}
    assert cal["2023-01-07"].academic_week == "A15" and cal["2023-01-08"].academic_week == ""


def test_file_selection(spark):
    files = spark.createDataFrame([("21.02.2023-PV.csv",), ("min230221.csv",), ("pred_2023-02-21.csv",), ("x.txt",), ("other.csv",)], "name string")
    assert {r.name for r in FS.feed_files(files, "solar").collect()} == {"21.02.2023-PV.csv", "min230221.csv"}
    routed = {r.name: r.feed for r in files.withColumn("feed", FS.route(F.col("name"))).collect()}
    assert routed["pred_2023-02-21.csv"] == "meteo" and routed["other.csv"] == "unknown"
    ledger = spark.createDataFrame([("min230221.csv",)], "name string")
    assert FS.new_files(files, ledger).count() == 4


def test_snapshots_until_falls_back_to_the_oldest(spark):
    df = spark.createDataFrame([("2024-01-05",), ("2024-01-06",)], "d string").select(F.to_date("d").alias("load_date"))
    assert FS.snapshots_until(df, "2024-01-09").count() == 2
    assert [str(r.load_date) for r in FS.snapshots_until(df, "2024-01-01").collect()] == ["2024-01-05"]
