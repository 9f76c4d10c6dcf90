"""Several snapshots in one plan against one after another; versions of the warehouse tables."""

import random

import pytest
import feeds
from campuswatt.operators import merge as M
from campuswatt.plans import jobs, loads as L
from campuswatt.sources import manifest
from campuswatt.sources.warehouse import Warehouse

KEY = ["date", "slot"]
COLS = "date string, slot int, external_id string, o int, file string"


def one_by_one(stored, rows):
    """The loop: stored is [(date, slot, ext, active)]; returns all rows with what ended them, and the inserted ones."""
    state = [[*r, None, None] for r in stored]      # ..., gone, (o, file) of an inserted row
    for file in sorted({r[4] for r in rows}):
        snap = sorted((r for r in rows if r[4] == file), key=lambda r: r[3])
        dates, ids = {r[0] for r in snap}, {r[2] for r in snap}
        active = [s for s in state if s[3]]
        active_ids, active_keys = {s[2] for s in active if s[2] is not None}, {(s[0], s[1]) for s in active}
        fresh, taken = [], set()
        for d, k, e, o, _ in snap:
            if e not in active_ids and (d, k) not in active_keys and (d, k) not in taken:
                taken.add((d, k))
                fresh.append([d, k, e, True, None, (o, file)])
        for s in active:
            if s[0] in dates and s[2] is not None and s[2] not in ids:
                s[3], s[4] = False, file
        state += fresh
    return sorted(((*s[:5], *(s[5] or (None, None))) for s in state), key=str)


@pytest.mark.parametrize("seed", range(6))
def test_history_equals_one_snapshot_after_another(spark, seed):
    rnd = random.Random(seed)
    dates, files = ["d1", "d2", "d3"], [f"f{i}" for i in range(rnd.randrange(1, 7))]
    variants = {(d, k): [f"{d}-{k}-{v}" for v in range(rnd.choice([1, 1, 2, 3]))] + ([None] if rnd.random() < 0.1 else [])
                for d in dates for k in range(8)}
    rows, o = [], 0
    for file in files:
        for d in rnd.sample(dates, rnd.randrange(1, 4)):
            for k in range(8):
                for e in variants[d, k]:
                    for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                        o += 1
                        rows.append((d, k, e, o, file))
    stored = [(d, k, variants[d, k][0], rnd.random() < 0.7) for d in dates for k in range(8) if rnd.random() < 0.4]
    stored += [(d, k, e, False) for d, k, e, _ in stored if rnd.random() < 0.3]
    target = spark.createDataFrame(stored, "date string, slot int, external_id string, is_active boolean")
    kept, fresh = M.snapshot_history(target, spark.createDataFrame(rows, COLS).repartition(3), "date", KEY, ["o"])
    got = [(*r, None, None) for r in kept.select("date", "slot", "external_id", "is_active", "_gone").collect()]
    got += [tuple(r) for r in fresh.select("date", "slot", "external_id", "is_active", "_gone", "o", "file").collect()]
    assert sorted(got, key=str) == one_by_one(stored, rows)


def test_no_rows(spark):
    target = spark.createDataFrame([("d1", 1, "e", True)], "date string, slot int, external_id string, is_active boolean")
    kept, fresh = M.snapshot_history(target, spark.createDataFrame([], COLS), "date", KEY, ["o"])
    assert kept.first().is_active and fresh.count() == 0


def dates_of(wh):
    rows = wh.read("FactBookings").join(wh.read("DimRoom"), "id_room")
    return sorted((r.external_id, r.is_active) for r in rows.collect())


def test_files_at_once_equal_files_one_after_another(spark, tmp_path):
    at_once, single = Warehouse(spark, str(tmp_path / "a")), Warehouse(spark, str(tmp_path / "b"))
    rnd = random.Random(5)
    for n in range(4):
        rows = [feeds.booking_row(f"2023-02-{20 + d}", f"{h}:00", f"{h + 1}:00", f"VS-BEL.N10{r}", "u", "A", "P")
                for d in range(3) for h in range(8, 11) for r in range(2) if rnd.random() < 0.6]
        for where in (tmp_path / "all", tmp_path / f"d{n}"):
            where.mkdir(exist_ok=True)
            feeds.booking_file(where, f"RoomAllocations_{n}.csv", rows)
    stats = jobs.load_all(spark, at_once, str(tmp_path / "all"))["FactBookings"]
    one = [jobs.load_all(spark, single, str(tmp_path / f"d{n}"))["FactBookings"][0] for n in range(4)]
    assert stats == one and sum(s["deactivated"] for s in one) > 0
    assert dates_of(at_once) == dates_of(single)
    assert manifest.latest(spark, at_once.path("FactBookings")).number == 2       # empty, then one write


def test_a_bad_file_stops_no_load(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    drops = tmp_path / "d"
    drops.mkdir()
    feeds.booking_file(drops, "RoomAllocations_1.csv", [["2022-01-01", "u"]], ["Date", "User"])
    feeds.booking_file(drops, "RoomAllocations_2.csv", feeds.FIRST_BOOKINGS)
    feeds.write(drops, "Pred_1.csv", "When,What\n1,2\n")
    feeds.meteo_file(drops)
    stats = jobs.load_all(spark, wh, str(drops))
    assert [s["inserted"] for s in stats["FactBookings"]] == [4] and stats["FactMeteoSwissData"]["inserted"] == 192
    rejected = {(r.table, r.row) for r in wh.rejects().filter("reason = 'missing required columns'").collect()}
    assert rejected == {("FactBookings", '{"file":"RoomAllocations_1.csv"}'), ("FactMeteoSwissData", '{"file":"Pred_1.csv"}')}


# --- versions --------------------------------------------------------------------------

def rows(spark, *values):
    return spark.createDataFrame([(d, 1, float(v), 1.0, 1.0, ym) for d, v, ym in values],
                                 "id_date int, id_time int, energy_consumed double, humidity double, temperature double, ym int")


def stored(wh):
    return sorted((r.id_date, r.energy_consumed, r.ym) for r in wh.read("FactEnergyConsumption").collect())


def test_a_write_replaces_its_months_only(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.create_tables()
    table = "FactEnergyConsumption"
    wh.write(table, rows(spark, (1, 1, 202401), (2, 2, 202402)))
    wh.write(table, rows(spark, (3, 3, 202402)))
    wh.append(table, rows(spark, (4, 4, 202401), (5, 5, 202403)))
    assert stored(wh) == [(1, 1.0, 202401), (3, 3.0, 202402), (4, 4.0, 202401), (5, 5.0, 202403)]
    assert [r.id_date for r in wh.months(table, [202402]).collect()] == [3]
    assert wh.months(table, []).count() == 0 and wh.months(table, [209912]).count() == 0


def test_a_job_that_dies_before_the_switch_leaves_the_old_state(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path))
    wh.write("FactEnergyConsumption", rows(spark, (1, 1, 202401), (2, 2, 202402)))
    before, real = stored(wh), manifest.commit
    monkeypatch.setattr(manifest, "commit", lambda *a: (_ for _ in ()).throw(OSError("driver lost")))
    with pytest.raises(OSError):
        wh.write("FactEnergyConsumption", rows(spark, (9, 9, 202401)))
    assert stored(wh) == before
    monkeypatch.setattr(manifest, "commit", real)
    wh.write("FactEnergyConsumption", rows(spark, (9, 9, 202401)))
    assert stored(wh) == [(2, 2.0, 202402), (9, 9.0, 202401)]


def test_half_a_manifest_is_passed_over(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.write("FactEnergyConsumption", rows(spark, (1, 1, 202401)))
    (tmp_path / "FactEnergyConsumption" / "_manifest" / f"{2:010d}").write_text('{"parts": {')
    assert stored(wh) == [(1, 1.0, 202401)]
    wh.append("FactEnergyConsumption", rows(spark, (2, 2, 202401)))
    assert stored(wh) == [(1, 1.0, 202401), (2, 2.0, 202401)]


def test_two_writers_of_one_version(spark, tmp_path):
    root = str(tmp_path / "t")
    one, two = manifest.latest(spark, root), manifest.latest(spark, root)
    manifest.commit(spark, root, one)
    with pytest.raises(RuntimeError, match="another writer"):
        manifest.commit(spark, root, two)


def test_old_versions_go_and_many_folders_become_one(spark, tmp_path, monkeypatch):
    from campuswatt.sources import warehouse
    monkeypatch.setattr(warehouse, "MOST_FOLDERS", 3)
    wh = Warehouse(spark, str(tmp_path))
    for i in range(12):
        wh.append("FactEnergyConsumption", rows(spark, (i, i, 202401)))
    assert [r[0] for r in stored(wh)] == list(range(12))
    folder = tmp_path / "FactEnergyConsumption"
    assert len(manifest.latest(spark, str(folder)).parts["ym=202401"]) <= 3
    assert len([p for p in (folder / "_manifest").iterdir() if p.name.isdigit()]) == manifest.KEPT


def test_no_bookings(spark, tmp_path):
    assert jobs.stage_rooms(spark, Warehouse(spark, str(tmp_path)), {}) is None


def test_a_fact_that_fails_leaves_the_others_loaded(spark, tmp_path, monkeypatch):
    drops, wh = tmp_path / "d", Warehouse(spark, str(tmp_path / "wh"))
    drops.mkdir()
    feeds.inverter_file(drops)
    feeds.meteo_file(drops)
    feeds.booking_file(drops, "RoomAllocations_1.csv", feeds.FIRST_BOOKINGS)
    monkeypatch.setattr(L, "_load_meteo", lambda *a: (_ for _ in ()).throw(OSError("no weather")))
    with pytest.raises(ExceptionGroup, match="FactMeteoSwissData"):
        jobs.load_all(spark, wh, str(drops))
    assert wh.read("FactBookings").count() == 4 and wh.read("FactSolarProduction").count() > 0
    assert wh.read("FactMeteoSwissData").count() == 0
    monkeypatch.undo()
    assert jobs.load_all(spark, wh, str(drops))["FactMeteoSwissData"]["inserted"] == 192
