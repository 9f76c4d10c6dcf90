"""Jobs: load the feeds of a drop folder, train and score the forecasts."""

from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from campuswatt.functions import academic
from campuswatt.operators.joins import star_join
from campuswatt.plans import loads as L, models as ML, standard as S, training as T
from campuswatt.schemas import METEO_MEASURES
from campuswatt.session import cut_lineage
from campuswatt.sources import files as FS, readers as R

ROW_ORDER = ["file", "block", "row"]


def list_files(spark, folder):
    """File listing of a drop folder: path, name, modification time. No content is read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
            .select("path", FS.base_name(F.col("path")).alias("name"), F.col("modificationTime").alias("mtime")))


def new_by_feed(spark, folder, ledger=None):
    """Paths per feed of the files the ledger lacks. File names are metadata of the job."""
    files = list_files(spark, folder).filter(F.col("name").endswith(".csv"))
    if ledger is not None:
        files = FS.new_files(files, ledger)
    by_feed = {}
    for r in files.withColumn("feed", FS.route(F.col("name"))).orderBy("name").collect():
        by_feed.setdefault(r.feed, []).append((r.name, r.path))
    return by_feed


def _paths(by_feed, feed, word=""):
    return [path for name, path in by_feed.get(feed, []) if word.lower() in name.lower()]


def cleaned(spark, by_feed, year=None):
    """Cleaned rows per feed; a feed without files, or with unreadable ones only, is absent."""
    readers = {
        "meter": R.clean_meter_files, "plant": R.clean_meter_files, "inverter": R.clean_inverter_files,
        "meteo": R.clean_meteo_files, "booking": lambda s, paths: R.clean_booking_files(s, paths, year),
        "unknown": R.read_text_any,
    }
    out = {}
    for feed, read in readers.items():
        if _paths(by_feed, feed):
            try:
                out[feed] = read(spark, _paths(by_feed, feed))
            except ValueError:
                continue      # no file of the feed has a usable header
    return out


def clean_all(spark, folder, out, load_date, year=None):
    """Clean every new file into ``out/<feed>``, partitioned by load date. Returns the files taken.

    Files of unknown kind go through line by line. A file enters the ledger only
    after its rows are written; a run that failed in between repeats without harm.
    A file that gave no rows (wrong header, no known site) goes to ``out/rejects``
    and not into the ledger; the others go on.
    """
    known = spark.createDataFrame([], "name string")
    try:
        known = spark.read.parquet(f"{out}/ledger").select("name")
    except AnalysisException:
        pass    # first run: there is no ledger yet
    by_feed = new_by_feed(spark, folder, known)
    frames = cleaned(spark, by_feed, year)
    for feed, rows in frames.items():
        R.write_feed(rows, f"{out}/{feed}", load_date, by_file=True)
    names = spark.createDataFrame([(n, feed) for feed, files in by_feed.items() for n, _ in files], "name string, feed string")
    written = None
    for feed in frames:
        part = (spark.read.schema("load_date date, file string").parquet(f"{out}/{feed}").filter(F.col("load_date") == F.lit(load_date).cast("date"))
                .select(F.col("file").alias("name"), F.lit(feed).alias("feed")).distinct())
        written = part if written is None else written.unionByName(part)
    taken = names if written is None else names.join(written, ["name", "feed"], "left_semi")
    lost = names.join(taken, ["name", "feed"], "left_anti").select(
        F.col("name").alias("file"), "feed", F.lit("no usable rows").alias("reason"))
    entries = cut_lineage(taken.select("name", F.lit(str(load_date)).alias("load_date")))
    if by_feed:
        R.write_feed(lost, f"{out}/rejects", load_date, by_file=True)
        entries.write.mode("append").parquet(f"{out}/ledger")
    return [r.name for r in entries.select("name").orderBy("name").collect()]


def _usable(spark, wh, table, feed, paths):
    """Paths of the files whose header has what the feed needs; the others are rejected and stop nobody."""
    if not paths:
        return []
    bad = R.bad_headers(spark, paths, feed).select("file", "reason")
    lost = {r.file for r in bad.collect()}      # names of bad files: metadata of the job, like the listing
    if lost:
        wh.reject(table, bad)
    return [p for p in paths if FS.bare_name(p) not in lost]


def stage_meters(spark, wh, by_feed):
    """Meter rows with the readings of the partner files of their own day; files without partners are rejected."""
    names = spark.createDataFrame([(n,) for n, _ in by_feed.get("meter", [])], "name string")
    matched, unmatched = FS.match_triples(names)
    wh.reject("FactEnergyConsumption", unmatched)
    sides = [_paths(by_feed, "meter", kind) for kind in ("Consumption", "Temperature", "Humidity")]
    if not all(sides):
        return None
    frames = [cut_lineage(R.clean_meter_files(spark, paths).withColumn("day", FS.file_date_token(F.col("file")))) for paths in sides]
    complete = matched.select(F.col("consumption").alias("file")).distinct()
    return L.stage_energy(wh, frames[0].join(complete, "file", "left_semi"), *frames[1:], order=ROW_ORDER)


def stage_solar(spark, wh, by_feed):
    parts = []
    if _paths(by_feed, "plant"):
        plant = R.clean_meter_files(spark, _paths(by_feed, "plant"))
        parts.append(S.std_pv(plant, ROW_ORDER).withColumns({"pass": F.lit(0), "inverter_no": F.lit(0).cast("bigint")}))
    if _paths(by_feed, "inverter"):
        inverters = R.clean_inverter_files(spark, _paths(by_feed, "inverter"))
        rows, rejects = S.std_min(inverters, [*ROW_ORDER, F.col("_block").cast("bigint").alias("inverter_no")])
        wh.reject("FactSolarProduction", rejects)
        parts.append(rows.withColumn("pass", F.lit(1)))
    if not parts:
        return None
    batch = parts[0]
    for p in parts[1:]:
        batch = batch.unionByName(p)
    return L.stage_solar(wh, batch, ["pass", *ROW_ORDER, "inverter_no"])


def stage_rooms(spark, wh, by_feed, year=None):
    """Booking files apply one after another in the order of their names: each is a snapshot of its dates.

    Finishing gives the counters of each file that can be read, in that order.
    """
    paths = _usable(spark, wh, "FactBookings", "booking", _paths(by_feed, "booking"))
    if not paths:
        return None
    staged = L.stage_snapshots(wh, R.clean_booking_files(spark, paths, year), ROW_ORDER)
    finish = staged.finish

    def per_file():
        found = finish()
        return [found.get(FS.bare_name(path), L.NO_BOOKINGS) for path in paths]

    staged.finish = per_file
    return staged


def stage_weather(spark, wh, by_feed):
    paths = _usable(spark, wh, "FactMeteoSwissData", "meteo", _paths(by_feed, "meteo"))
    if not paths:
        return None
    return L.stage_meteo(wh, S.std_meteo(R.clean_meteo_files(spark, paths), ["file"]), ["file"])


def _at_once(spark, tasks):
    """Run functions at once, each in a scheduler pool of its own: {name: (result, error)}."""
    def run(name, task):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            return task(), None
        except Exception as error:  # the others go on; the caller raises it
            return None, error

    with ThreadPoolExecutor(max(len(tasks), 1)) as pool:
        running = {name: pool.submit(run, name, task) for name, task in tasks.items()}
        return {name: one.result() for name, one in running.items()}


def load_all(spark, wh, folder, ledger=None, year=None):
    """Load every new file of the folder: meters, solar, rooms, weather. Returns the counters per fact.

    The facts are cleaned at once, then the dates and times of all of them grow together, then the facts are
    merged at once. A fact that fails leaves the others loaded; its error is raised when they are done.
    """
    wh.create_tables()
    by_feed = new_by_feed(spark, folder, ledger)
    stages = {
        "FactEnergyConsumption": lambda: stage_meters(spark, wh, by_feed),
        "FactSolarProduction": lambda: stage_solar(spark, wh, by_feed),
        "FactBookings": lambda: stage_rooms(spark, wh, by_feed, year),
        "FactMeteoSwissData": lambda: stage_weather(spark, wh, by_feed),
    }
    staged = _at_once(spark, stages)
    ready = {fact: s for fact, (s, _) in staged.items() if s is not None}
    L.grow_shared(wh, ready.values())
    done = _at_once(spark, {fact: s.finish for fact, s in ready.items()})
    errors = {fact: e for fact, (_, e) in [*staged.items(), *done.items()] if e is not None}
    if errors:
        raise ExceptionGroup(f"not loaded: {', '.join(sorted(errors))}", list(errors.values()))
    return {fact: done[fact][0] if fact in done else None for fact in stages}


# --- views of the warehouse as model inputs -------------------------------------------------

def with_ts(wh, fact, time="id_time"):
    """Fact rows with the timestamp of their date and time keys."""
    clock = wh.read("DimTime").withColumnRenamed("id_time", time)
    keyed = star_join(fact, [(wh.read("DimDate"), "id_date"), (clock, time)])
    return keyed.withColumn("ts", F.make_timestamp("year", "month", "day", "hour", "minute", F.lit(0))) \
        .drop("year", "month", "day", "hour", "minute")


def consumption_rows(wh):
    return with_ts(wh, wh.read("FactEnergyConsumption")).select("ts", F.col("energy_consumed").alias("consumption"))


def forecast_rows(wh):
    back = {column: measure.lower() for measure, column in METEO_MEASURES.items()}
    rows = with_ts(wh, wh.read("FactMeteoSwissData")).join(wh.read("DimSite"), "id_site")
    return rows.select("ts", F.col("site_name").alias("site"), F.col("numPrediction").alias("prediction"),
                       *[F.col(c).alias(m) for c, m in back.items()])


def booking_rows(wh):
    """Active bookings with the columns the room features need."""
    rows = wh.read("FactBookings").filter("is_active")
    clock = wh.read("DimTime").select("id_time", F.format_string("%02d:%02d", "hour", "minute").alias("clock"))
    rows = rows.join(clock.withColumnsRenamed({"id_time": "id_time_start", "clock": "start_time"}), "id_time_start")
    rows = rows.join(clock.withColumnsRenamed({"id_time": "id_time_end", "clock": "end_time"}), "id_time_end")
    rows = rows.join(wh.read("DimDate"), "id_date").join(wh.read("DimRoom"), "id_room")
    rows = rows.join(wh.read("DimActivity"), "id_activity", "left").join(wh.read("DimDivision"), "id_division", "left")
    return rows.select(F.make_date("year", "month", "day").alias("date"), "start_time", "end_time", "room_name",
                       F.col("activity_name").alias("activity"), F.col("division_name").alias("division"))


def inverter_rows(wh):
    """Stored energies back as power in W; the plant total is no inverter."""
    rows = with_ts(wh, wh.read("FactSolarProduction")).join(wh.read("DimInverter"), "id_inverter")
    rows = rows.join(wh.read("DimStatus"), "id_status").filter(F.col("inverter_name") != S.PLANT_INVERTER)
    return rows.select("ts", F.col("inverter_name").alias("inv"), F.col("status_name").alias("status"),
                       (F.col("energy_produced") * 1000 * 60 / S.STEP_MINUTES).alias("pac"),
                       F.col("total_energy_produced").alias("daysum"))


def forecast_job(spark, wh, folder, start, train=True, score=True, load=True, kind="xgboost", grid=ML.FOREST_GRID,
                 calendar=None, consumption_settings=None, production_settings=None, cutoff_days=T.CUTOFF_DAYS,
                 gaps="interpolate", daily=True):
    """Train the models, score the days from ``start`` on, load the forecasts. Each step can be skipped.

    The newest ``cutoff_days`` before ``start`` stay out of training. The production model is the best of
    ``grid``; with ``daily`` a model of the daily energy is trained beside it.
    """
    cutoff = F.lit(str(start - timedelta(days=cutoff_days))).cast("timestamp")
    calendar = academic.academic_calendar(spark) if calendar is None else calendar
    done = {}
    weather = rooms = None
    if train or score:
        weather, rooms = T.weather_features(forecast_rows(wh)), T.room_features(booking_rows(wh))
    if train:
        features = T.consumption_features(consumption_rows(wh).filter(F.col("ts") < cutoff), weather, rooms, calendar, gaps=gaps)
        model, names, metrics = T.train_consumption(cut_lineage(features), kind, **(consumption_settings or {}))
        ML.save_model(spark, model, f"{folder}/consumption", names, metrics, kind=kind)
        inverters = inverter_rows(wh).filter(F.col("ts") < cutoff)
        features = T.production_features(inverters, forecast_rows(wh), cutoff)
        p_model, p_names, p_metrics = T.train_production(features, grid=grid, **(production_settings or {}))
        ML.save_model(spark, p_model, f"{folder}/production", p_names, p_metrics)
        done["metrics"] = {"consumption": metrics, "production": p_metrics}
        if daily:
            rows = T.production_daily_features(inverters, forecast_rows(wh), cutoff=cutoff)
            d_model, d_names, d_metrics = T.train_production(rows, **(production_settings or {}))
            ML.save_model(spark, d_model, f"{folder}/production_daily", d_names, d_metrics)
            done["metrics"]["production_daily"] = d_metrics
    if score:
        model, info = ML.load_model(spark, f"{folder}/consumption")
        daily = T.score_consumption(spark, model, info["features"], start, weather, rooms, calendar=calendar)
        R.write_feed(daily, f"{folder}/forecast/consumption", fmt="csv")
        model, info = ML.load_model(spark, f"{folder}/production")
        hourly = T.score_production(spark, model, info["features"], start, forecast_rows(wh))
        R.write_feed(hourly, f"{folder}/forecast/production", fmt="csv")
    if load:
        daily = spark.read.option("header", True).csv(f"{folder}/forecast/consumption")
        hourly = spark.read.option("header", True).csv(f"{folder}/forecast/production")
        done["FactPrediction"] = L.load_forecast(wh, daily, hourly)
    return done
