"""Streams give what the batch path gives, and take each file and each batch once."""

import feeds
from campuswatt.plans import loads as L, standard as S
from campuswatt.sources import readers as R
from campuswatt.sources.warehouse import Warehouse
from campuswatt.streaming import ingest as T

ORDER = ["file", "block", "row"]


def test_each_file_enters_once(spark, tmp_path):
    drops = tmp_path / "drops"
    drops.mkdir()

    def run():
        stream = T.read_drops(spark, str(drops), "meter")
        T.ingest_stream(stream, R.clean_meter_lines, str(tmp_path / "raw"), str(tmp_path / "ck"), "2023-02-21").awaitTermination()
        return spark.read.parquet(str(tmp_path / "raw"))

    feeds.meter_file(drops, feeds.DATES[0], "Consumption", {"1:00:00": "1", "2:00:00": "2"})
    feeds.write(drops, "other.csv", "a;b\n1;2\n")
    assert run().count() == 2
    feeds.meter_file(drops, feeds.DATES[1], "CONSUMPTION", {"1:00:00": "3"})
    assert run().count() == 3
    assert run().count() == 3


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    feeds.meter_file(tmp_path, feeds.DATES[0], "Consumption", {"1:00:00": "1", "2:00:00": "2"})
    out = str(tmp_path / "raw")
    stream = lambda ck: T.ingest_stream(T.read_drops(spark, str(tmp_path), "meter"), R.clean_meter_lines, out, ck)
    stream(str(tmp_path / "a")).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    commits = tmp_path / "a" / "commits"
    for f in [*commits.iterdir()]:      # the last batch was written but not noted: it comes again
        if f.name.lstrip(".").startswith("0"):
            f.unlink()
    stream(str(tmp_path / "a")).awaitTermination()
    assert spark.read.parquet(out).count() == 2


def facts(wh):
    fact = wh.read("FactSolarProduction").join(wh.read("DimDate"), "id_date").join(wh.read("DimTime"), "id_time")
    return sorted(map(tuple, fact.select("year", "month", "day", "hour", "energy_produced").collect()))


def test_stream_upsert_equals_batch(spark, tmp_path):
    drops = tmp_path / "drops"
    drops.mkdir()
    for d in feeds.DATES:
        feeds.meter_file(drops, d, "PV", {"1:00:00": "1", "2:00:00": "2.5"})

    def load(lines, wh):
        return L.load_solar(wh, S.std_pv(R.clean_meter_lines(lines), ORDER), ORDER)

    streamed, direct = Warehouse(spark, str(tmp_path / "a")), Warehouse(spark, str(tmp_path / "b"))
    for wh in (streamed, direct):
        wh.create_tables()
    stream = T.read_drops(spark, str(drops), "solar", files_per_batch=1)
    T.merge_stream(stream, streamed, "FactSolarProduction", "pv", load, str(tmp_path / "ck")).awaitTermination()
    load(R.raw_lines(spark, str(drops)), direct)
    assert facts(streamed) == facts(direct) and len(facts(direct)) == 4
    assert streamed.last_batch("FactSolarProduction", "pv")[0] == 1


def bookings(wh):
    rows = wh.read("FactBookings").join(wh.read("DimRoom"), "id_room").join(wh.read("DimUser"), "id_user")
    return sorted(map(tuple, rows.select("external_id", "is_active", "room_name", "username").collect()))


def test_booking_streams_of_two_layouts_and_encodings_equal_the_batch(spark, tmp_path):
    drops = tmp_path / "drops"
    drops.mkdir()
    feeds.booking_file(drops, "RoomAllocations_1.csv", feeds.FIRST_BOOKINGS)
    text = "\t".join(["Année", "Mois", "Jour", "Début", "Fin", "Salle", "Utilisateur"]) + "\n2023\t2\t3\t8:00\t9:00\tVS-BEL1\tZoé\n"
    feeds.write(drops, "roomallocations_2.csv", text, "iso-8859-1")
    streamed, direct = Warehouse(spark, str(tmp_path / "a")), Warehouse(spark, str(tmp_path / "b"))

    def load(lines, wh):
        return L.load_snapshots(wh, R.clean_booking_lines(lines), ORDER)

    T.merge_stream(T.read_drops(spark, str(drops), "booking"), streamed, "FactBookings", "rooms", load, str(tmp_path / "ck")).awaitTermination()
    load(R.raw_lines(spark, str(drops)), direct)
    assert bookings(streamed) == bookings(direct)
    assert "Zoé" in {b[3] for b in bookings(direct)} and len(bookings(direct)) == 5


def test_the_same_batch_twice_gives_one_set_of_counters(spark, tmp_path):
    feeds.booking_file(tmp_path, "RoomAllocations_1.csv", feeds.FIRST_BOOKINGS)
    wh, seen = Warehouse(spark, str(tmp_path / "wh")), []

    def load(lines, of_batch):
        seen.append(L.load_snapshots(of_batch, R.clean_booking_lines(lines), ORDER))

    apply = T.load_once(wh, "FactBookings", "rooms", load)
    lines = R.raw_lines(spark, str(tmp_path / "RoomAllocations_1.csv")).drop("row")
    apply(lines, 0)
    once, version = bookings(wh), wh.last_batch("FactBookings", "rooms")
    apply(lines, 0)
    assert len(seen) == 1 and bookings(wh) == once and wh.last_batch("FactBookings", "rooms") == version == (0, seen[0])
    assert seen[0]["RoomAllocations_1.csv"]["inserted"] == 4
    apply(lines, 1)
    assert len(seen) == 2 and seen[1]["RoomAllocations_1.csv"]["inserted"] == 0


def test_a_batch_that_failed_before_the_switch_comes_again(spark, tmp_path, monkeypatch):
    from campuswatt.sources import manifest
    feeds.meter_file(tmp_path, feeds.DATES[0], "PV", {"1:00:00": "1"})
    wh = Warehouse(spark, str(tmp_path / "wh"))
    apply = T.load_once(wh, "FactSolarProduction", "pv", lambda lines, w: L.load_solar(w, S.std_pv(R.clean_meter_lines(lines), ORDER), ORDER))
    lines, real = R.raw_lines(spark, str(tmp_path / f"{feeds.DATES[0]}-PV.csv")).drop("row"), manifest.commit

    def dies(spark, root, m):
        if root.endswith("FactSolarProduction"):
            raise OSError("driver lost")
        return real(spark, root, m)

    monkeypatch.setattr(manifest, "commit", dies)
    try:
        apply(lines, 0)
    except OSError:
        pass
    assert wh.read("FactSolarProduction").count() == 0 and wh.last_batch("FactSolarProduction", "pv") == (-1, None)
    monkeypatch.setattr(manifest, "commit", real)
    apply(lines, 0)
    assert len(facts(wh)) == 1
