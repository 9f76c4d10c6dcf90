"""Fact loads: dimensions first, then the merge of the months the batch touches."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F

from campuswatt.functions import parsing as P
from campuswatt.operators import dims as D, merge as M, quality as Q
from campuswatt.plans import standard as S
from campuswatt.schemas import DIMENSIONS, FACT_KEYS, FACTS, METEO_MEASURES
from campuswatt.session import cut_lineage
from campuswatt.sources.warehouse import month_key, touched_months


def _grow(wh, table, src, order=None, ci=False):
    """Append the members the dimension lacks and return it."""
    key = [c for c in DIMENSIONS[table].names if not c.startswith("id_")]
    fresh = D.added_members(wh.read(table), src, key, order, ci)
    if not fresh.isEmpty():
        wh.append(table, fresh)
    return wh.read(table)


def _grow_dates(wh, batch, col="date"):
    return _grow(wh, "DimDate", D.date_members(batch, col))


def _grow_times(wh, batch, *cols):
    members = D.time_members(batch, cols[0])
    for c in cols[1:]:
        members = members.unionByName(D.time_members(batch, c))
    return _grow(wh, "DimTime", members)


def _store(wh, table, merged):
    """Write the merged months and return the counters, measured while writing."""
    seen = Observation(table)
    totals = [F.sum(c).alias(c) for c in ("_rows", "_inserted", "_updated")]

    def counters():
        got = {k: int(v or 0) for k, v in seen.get.items()}
        return {"processed": got["_rows"], "inserted": got["_inserted"], "updated": got["_updated"],
                "unchanged": got["_rows"] - got["_inserted"] - got["_updated"]}

    return wh.write(table, merged.observe(seen, *totals), counters)


@dataclass
class Staged:
    """Cleaned rows of a load with their date and clock columns; ``finish`` grows the dimensions and merges the fact.

    The dates and times of several loads can grow at once before they finish.
    """
    rows: DataFrame
    date: str
    times: tuple
    finish: Callable


def grow_shared(wh, staged):
    """Grow the dates and times of several loads in one step each: the loads find nothing new then."""
    members = {"DimDate": None, "DimTime": None}
    for s in staged:
        for table, part in [("DimDate", D.date_members(s.rows, s.date)), *[("DimTime", D.time_members(s.rows, c)) for c in s.times]]:
            members[table] = part if members[table] is None else members[table].unionByName(part)
    for table, src in members.items():
        if src is not None:
            _grow(wh, table, src)


def load_solar(wh, batch, order):
    """Tolerance upsert of standard inverter and plant rows."""
    return stage_solar(wh, batch, order).finish()


def stage_solar(wh, batch, order):
    batch = cut_lineage(batch)
    return Staged(batch, "date", ("time",), lambda: _load_solar(wh, batch, order))


def _load_solar(wh, batch, order):
    dates, times = _grow_dates(wh, batch), _grow_times(wh, batch, "time")
    inverters = _grow(wh, "DimInverter", batch.select("inverter_name"))
    statuses = _grow(wh, "DimStatus", batch.select("status_name"))
    rows = D.lookup_time(D.lookup_date(batch, dates, "date"), times, "time")
    rows = D.lookup(D.lookup(rows, inverters, ["inverter_name"]), statuses, ["status_name"])
    rows = rows.withColumn("ym", month_key(F.col("date")))
    key = ["ym", *FACT_KEYS["FactSolarProduction"]]
    rows = rows.dropna(subset=key)
    merged = M.upsert_tol(wh.months("FactSolarProduction", touched_months(batch)), rows, key,
                          ["total_energy_produced", "energy_produced"], order, exact=["error_count"])
    return _store(wh, "FactSolarProduction", merged)


def load_meteo(wh, batch, order):
    """Tolerance upsert of valid weather forecasts."""
    return stage_meteo(wh, batch, order).finish()


def stage_meteo(wh, batch, order):
    valid, rejects = Q.valid_meteo(batch, list(METEO_MEASURES.values()), "numPrediction")
    wh.reject("FactMeteoSwissData", rejects)
    valid = cut_lineage(valid.dropna(subset=["date", "time", "site_name"]))
    return Staged(valid, "date", ("time",), lambda: _load_meteo(wh, valid, order))


def _load_meteo(wh, valid, order):
    dates, times = _grow_dates(wh, valid), _grow_times(wh, valid, "time")
    sites = _grow(wh, "DimSite", valid.select("site_name"))
    rows = D.lookup(D.lookup_time(D.lookup_date(valid, dates, "date"), times, "time"), sites, ["site_name"])
    rows = rows.withColumn("ym", month_key(F.col("date")))
    key = ["ym", *FACT_KEYS["FactMeteoSwissData"]]
    merged = M.upsert_tol(wh.months("FactMeteoSwissData", touched_months(valid)), rows, key,
                          list(METEO_MEASURES.values()), order)
    return _store(wh, "FactMeteoSwissData", merged)


def load_energy(wh, consumption, temperature, humidity, order):
    """Insert-only load of meter rows that have all three readings."""
    return stage_energy(wh, consumption, temperature, humidity, order).finish()


def stage_energy(wh, consumption, temperature, humidity, order):
    key = ("day", "Date", "Time") if "day" in consumption.columns else ("Date", "Time")
    batch = S.meter_rows(consumption, temperature, humidity, order, key)
    batch = cut_lineage(batch.withColumnsRenamed({"Date": "date", "Time": "time"})
                        .withColumn("date", F.to_date("date")).dropna(subset=["date", "time"]))
    return Staged(batch, "date", ("time",), lambda: _load_energy(wh, batch, order))


def _load_energy(wh, batch, order):
    dates, times = _grow_dates(wh, batch), _grow_times(wh, batch, "time")
    rows = D.lookup_time(D.lookup_date(batch, dates, "date"), times, "time").withColumn("ym", month_key(F.col("date")))
    table, key = "FactEnergyConsumption", ["ym", *FACT_KEYS["FactEnergyConsumption"]]
    target = wh.months(table, touched_months(batch))
    counts = {r.action: r.n for r in M.insert_only_stats(target, rows, key, S.energy_valid(), order).collect()}
    fresh = M.insert_only(target, rows, key, S.energy_valid(), order)
    wh.reject(table, Q.valid_energy(rows)[1])
    stats = {"processed": sum(counts.values()), "inserted": counts.get("inserted", 0),
             "duplicates": counts.get("duplicate", 0), "invalid": counts.get("invalid", 0)}
    return wh.append(table, fresh, lambda: stats)


OPTIONAL_TEXT = ["professor", "activity", "codes", "reservation_type", "division", "class"]


def load_bookings(wh, batch, order):
    """Load of one snapshot: new bookings are inserted, vanished ones of the same dates deactivated."""
    return load_snapshots(wh, batch.withColumn("_snapshot", F.lit("")), order, "_snapshot").get("", NO_BOOKINGS)


NO_BOOKINGS = {"processed": 0, "inserted": 0, "invalid": 0, "duplicates": 0, "deactivated": 0}


def load_snapshots(wh, batch, order, snapshot="file"):
    """Load of several snapshots, one after another in the order of their names, in one plan.

    All dimensions grow at once, and every month is written once. Returns the counters of each snapshot.
    """
    return stage_snapshots(wh, batch, order, snapshot).finish()


def stage_snapshots(wh, batch, order, snapshot="file"):
    for c in OPTIONAL_TEXT:
        if c not in batch.columns:
            batch = batch.withColumn(c, F.lit(None).cast("string"))
    valid, rejects = Q.valid_booking(S.external_id(batch))
    wh.reject("FactBookings", rejects.drop(*[c for c in (snapshot,) if c.startswith("_")]))
    rows = D.default_member(valid.withColumnsRenamed({"codes": "code", "reservation_type": "booking_type"}))
    rows = cut_lineage(rows.withColumns({"classroom_name": P.none_to_null(F.col("class")), "Date": F.to_date("Date")}))

    order = [snapshot, *[c for c in order if c != snapshot]]
    return Staged(rows, "Date", ("start_time", "end_time"), lambda: _load_snapshots(wh, rows, rejects, order, snapshot))


def _load_snapshots(wh, rows, rejects, order, snapshot):
    dates, times = _grow_dates(wh, rows, "Date"), _grow_times(wh, rows, "start_time", "end_time")
    rooms = _grow(wh, "DimRoom", rows.select("room_name"))
    people = D.role_union(rows, ["user_name", "professor"], "username", order).filter("username <> ''")
    users = _grow(wh, "DimUser", people, [snapshot, "_role", *order[1:]], ci=True)
    activities = _grow(wh, "DimActivity", rows.select(F.col("activity").alias("activity_name"), *order), order, ci=True)
    types = _grow(wh, "DimBookingType", rows.select("code", "booking_type"))
    divisions = _grow(wh, "DimDivision", rows.select(F.col("division").alias("division_name"), *order), order, ci=True)
    classrooms = _grow(wh, "DimClassroom", rows.select("classroom_name", *order), order, ci=True)

    rows = D.lookup_date(rows, dates, "Date")
    rows = D.lookup_time(rows, times, "start_time", "id_time_start")
    rows = D.lookup_time(rows, times, "end_time", "id_time_end")
    rows = D.lookup(rows, rooms, ["room_name"])
    rows = D.lookup(rows, users, ["username"], ["user_name"], "id_user", ci=True)
    rows = D.lookup(rows, users, ["username"], ["professor"], "id_professor", ci=True)
    rows = D.lookup(rows, activities, ["activity_name"], ["activity"], ci=True)
    rows = D.lookup(rows, types, ["code", "booking_type"])
    rows = D.lookup(rows, divisions, ["division_name"], ["division"], ci=True)
    rows = D.lookup(rows, classrooms, ["classroom_name"], ci=True)
    rows = rows.withColumns({"ym": month_key(F.col("Date")), "last_modified": F.current_timestamp()})
    rows = cut_lineage(rows.dropna(subset=FACT_KEYS["FactBookings"]))

    table, names = "FactBookings", FACTS["FactBookings"].names
    target = wh.months(table, touched_months(rows, "Date"))
    stored, fresh = M.snapshot_history(target, rows, "id_date", FACT_KEYS[table], order, snapshot=snapshot)
    out = cut_lineage(stored.withColumn("_into", F.lit(None).cast("string"))
                      .unionByName(fresh.select(*names, "_gone", F.col(snapshot).alias("_into"))))

    def counters():
        """Counters per snapshot: a row a file and kind."""
        of = lambda df, column, kind: df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("name")).agg(
            F.count("*").alias("n")).withColumn("kind", F.lit(kind))
        parts = [of(rows, snapshot, "valid"), of(rejects, snapshot, "invalid"), of(out, "_into", "inserted"), of(out, "_gone", "deactivated")]
        found = {}
        for part in parts:
            for r in part.collect():
                found.setdefault(r.name, {})[r.kind] = r.n
        return {name: {"processed": n.get("valid", 0) + n.get("invalid", 0), "inserted": n.get("inserted", 0), "invalid": n.get("invalid", 0),
                       "duplicates": n.get("valid", 0) - n.get("inserted", 0), "deactivated": n.get("deactivated", 0)}
                for name, n in sorted(found.items())}

    return wh.write(table, out, counters)


def load_forecast(wh, consumption, production, order=("hour",)):
    """Forecast rows replace everything stored for their dates."""
    rows, rejects = Q.valid_forecast(S.combine_forecasts(consumption, production))
    wh.reject("FactPrediction", rejects)
    rows = cut_lineage(rows)
    dates, times = _grow_dates(wh, rows), _grow_times(wh, rows, "hour")
    rows = D.lookup_time(D.lookup_date(rows, dates, "date"), times, "hour").withColumn("ym", month_key(F.col("date")))
    table, key = "FactPrediction", ["ym", *FACT_KEYS["FactPrediction"]]
    target = wh.months(table, touched_months(rows))
    others = M.not_in(target, rows.select("id_date").distinct(), ["id_date"])
    merged = M.merge_nonnull(others, rows, key, ["predicted_consumption", "predicted_production"], list(order))
    return _store(wh, table, merged)
