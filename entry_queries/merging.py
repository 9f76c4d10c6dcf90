"""Merge queries: a stored table and a batch of new rows, both from the driver's tables."""

from pyspark.sql import functions as F

from campuswatt.operators import joins as J, merge as M, quality as Q
from campuswatt.operators.clean import split_ts
from campuswatt.operators.ordering import dedup_first
from campuswatt.plans import standard as S
from campuswatt.schemas import METEO_MEASURES
from entry_queries.cleaning import wide
from campuswatt.session import cut_lineage
from entry_queries.core import query
from entry_queries.dimensions import solar, solar_dims, with_keys
from entry_queries.views import INV_ORDER, INV_ORDER_SQL, MEASURES

SOLAR_KEY = ["date", "time", "inverter_name", "status_name"]
SOLAR_MEASURES = ["total_energy_produced", "energy_produced"]


@query("solar_std", "l_orderkey:i l_linenumber:i date:d time:s inverter_name:s status_name:s "
       "total_energy_produced:f energy_produced:f error_count:i", """
SELECT l_orderkey, l_linenumber, date, time, CASE WHEN l_partkey % 13 = 0 THEN 'Unknown_Inverter' ELSE inverter_name END AS inverter_name,
       CASE WHEN l_partkey % 17 = 0 THEN '0' ELSE status_name END AS status_name,
       CASE WHEN l_partkey % 19 = 0 THEN 0 ELSE total_energy_produced END AS total_energy_produced,
       CASE WHEN l_partkey % 29 = 0 THEN 0 ELSE energy_produced END AS energy_produced, error_count
FROM v_solar WHERE l_partkey % 23 <> 0
UNION ALL SELECT l_orderkey, l_linenumber, date, time, 'History', '0', 0, "DaySum", 0 FROM (SELECT *, "Date" AS date, "Time" AS time FROM v_inv)""")
def solar_std(v):
    """Inverter rows with gaps and unreadable cells, and plant rows, in one standard form."""
    part = F.col("l_partkey")
    raw = v.inv().withColumns({
        "INV": F.when(part % 13 != 0, F.col("INV")), "Status": F.when(part % 17 != 0, F.col("Status")),
        "DaySum": F.when(part % 19 == 0, "n/a").otherwise(F.col("DaySum").cast("string")),
        "Pac": F.when(part % 23 == 0, "??").when(part % 29 != 0, F.col("Pac").cast("string"))})
    rows, _ = S.std_min(raw, INV_ORDER)
    return J.union_feeds(rows, S.std_pv(v.inv().withColumnRenamed("DaySum", "Value"), INV_ORDER))


STORED_SQL = f"""stored AS (SELECT * EXCLUDE (rn) FROM (
  SELECT date, time, inverter_name, status_name,
         total_energy_produced + CASE l_partkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 0.0005 ELSE 1 END AS t, energy_produced AS e, error_count AS c,
         row_number() OVER (PARTITION BY date, time, inverter_name, status_name ORDER BY {INV_ORDER_SQL}) AS rn
  FROM v_solar WHERE l_linestatus = 'F') WHERE rn = 1)"""
FOLD_SQL = f"""WITH {STORED_SQL},
grouped AS (SELECT date, time, inverter_name, status_name, count(*) AS rows,
   list({{'t': total_energy_produced, 'e': energy_produced, 'c': error_count, 'n': 0}} ORDER BY {INV_ORDER_SQL}) AS l
   FROM v_solar GROUP BY ALL),
seeded AS (SELECT g.*, s.t IS NOT NULL AS known,
   CASE WHEN s.t IS NULL THEN l ELSE list_prepend({{'t': s.t, 'e': s.e, 'c': s.c, 'n': 0}}, l) END AS ll
   FROM grouped g LEFT JOIN stored s USING (date, time, inverter_name, status_name)),
folded AS (SELECT *, list_reduce(ll, lambda s, x: CASE WHEN abs(s.t - x.t) > 0.001 OR abs(s.e - x.e) > 0.001 OR s.c <> x.c
   THEN {{'t': x.t, 'e': x.e, 'c': x.c, 'n': s.n + 1}} ELSE s END) AS f FROM seeded)"""


def solar_stored(v):
    """Stored state: the first finished reading per key, some of them a little or clearly off."""
    off = F.when(F.col("l_partkey") % 3 == 0, 0.0).when(F.col("l_partkey") % 3 == 1, 0.0005).otherwise(1.0)
    rows = solar(v).filter("l_linestatus = 'F'").withColumn("total_energy_produced", F.col("total_energy_produced") + off)
    return dedup_first(rows, SOLAR_KEY, INV_ORDER).select(*SOLAR_KEY, *SOLAR_MEASURES, "error_count")


def solar_merged(v):
    return M.upsert_tol(solar_stored(v), solar(v), SOLAR_KEY, SOLAR_MEASURES, INV_ORDER, exact=["error_count"])


@query("upsert_tol", "date:d time:s inverter_name:s status_name:s total_energy_produced:f energy_produced:f error_count:i action:s",
       FOLD_SQL + """
SELECT date, time, inverter_name, status_name, f.t AS total_energy_produced, f.e AS energy_produced, f.c AS error_count,
       CASE WHEN NOT known THEN 'insert' WHEN f.n > 0 THEN 'update' ELSE 'unchanged' END AS action FROM folded""")
def upsert_tol(v):
    return solar_merged(v).withColumnRenamed("_action", "action")


@query("load_stats", "counter:s n:i", FOLD_SQL + """,
c AS (SELECT sum(rows) AS p, count(*) FILTER (WHERE NOT known) AS i, sum(f.n) AS u FROM folded)
SELECT unnest(['processed', 'inserted', 'updated', 'unchanged']) AS counter, unnest([p, i, u, p - i - u]) AS n FROM c""")
def load_stats(v):
    return M.load_stats(solar_merged(v))


METEO_KEY = ["date", "time", "site_name", "numPrediction"]


def meteo_rows(v):
    """All forecast rows of the wide table in standard form, complete ones only, issued per order."""
    rows = wide(v).withColumns({m: F.coalesce(m, F.lit(0.0)) for m in MEASURES})
    return S.std_meteo(split_ts(rows, "ts"), [])


@query("upsert_meteo", "date:d time:s site_name:s numPrediction:i temperature:f humidity:f rain:f radiation:f action:s", """WITH
w AS (SELECT CAST(ts AS DATE) AS date, strftime(ts, '%H:%M:%S') AS time, "Site" AS site_name, "Prediction" AS p, """ + ", ".join(
    f'coalesce("{m}", 0) AS m{i}' for i, m in enumerate(MEASURES)) + """ FROM v_wide),
s AS (SELECT *, m0 + CASE p WHEN 0 THEN 0 WHEN 1 THEN 0.0005 ELSE 1 END AS s0 FROM w WHERE site_name = 'Sion'),
j AS (SELECT w.*, s.s0, s0 IS NULL OR abs(w.m0 - s0) > 0.001 AS moved FROM w LEFT JOIN s USING (date, time, site_name, p))
SELECT date, time, site_name, p AS numPrediction, CASE WHEN moved THEN m0 ELSE s0 END AS temperature, m1 AS humidity, m2 AS rain, m3 AS radiation,
       CASE WHEN s0 IS NULL THEN 'insert' WHEN moved THEN 'update' ELSE 'unchanged' END AS action FROM j""")
def upsert_meteo(v):
    """The forecasts of one site are stored already, shifted by 0, 0.0005 or 1 degree."""
    rows = meteo_rows(v)
    off = F.when(F.col("numPrediction") == 0, 0.0).when(F.col("numPrediction") == 1, 0.0005).otherwise(1.0)
    stored = rows.filter("site_name = 'Sion'").withColumn("temperature", F.col("temperature") + off)
    return (M.upsert_tol(stored, rows, METEO_KEY, list(METEO_MEASURES.values()), METEO_KEY)
            .withColumnRenamed("_action", "action"))


def meter_side(v, kind):
    return v.meter().filter(F.col("event_type") == kind).select("user_id", "ts", "event_id", F.col("value").alias("Value"))


def meter_joined(v):
    sides = [meter_side(v, k) for k in ("click", "view", "signup")]
    return S.meter_rows(*sides, ["event_id"], key=("user_id", "ts"))


METER_SQL = """c AS (SELECT event_id, user_id, ts, value AS energy_consumed FROM v_meter WHERE event_type = 'click'),
t AS (SELECT user_id, ts, arg_min(value, event_id) AS temperature FROM v_meter WHERE event_type = 'view' GROUP BY ALL),
h AS (SELECT user_id, ts, arg_min(value, event_id) AS humidity FROM v_meter WHERE event_type = 'signup' GROUP BY ALL),
m AS (SELECT * FROM c LEFT JOIN t USING (user_id, ts) LEFT JOIN h USING (user_id, ts))"""


@query("meter_join", "event_id:i user_id:i ts:t energy_consumed:f temperature:f humidity:f reason:s", "WITH " + METER_SQL + """
SELECT *, CASE WHEN temperature IS NULL OR humidity IS NULL THEN 'missing values' END AS reason FROM m""")
def meter_join(v):
    """Consumption with the first temperature and humidity of the hour; incomplete rows carry a reason."""
    good, bad = Q.valid_energy(meter_joined(v))
    return good.unionByName(bad, allowMissingColumns=True)


INSERT_SQL = "WITH " + METER_SQL + """,
one AS (SELECT ts, event_id, user_id, energy_consumed, temperature, humidity, temperature IS NOT NULL OR humidity IS NOT NULL AS ok FROM m),
stored AS (SELECT DISTINCT date_trunc('hour', ts) AS ts FROM events WHERE event_type = 'error' AND value > 200)"""


def insert_batch(v):
    """Readings of all users compete for one row per hour; a row counts if it has a partner reading."""
    stored = (v.table("events").filter("event_type = 'error' AND value > 200")
              .select(F.date_trunc("hour", "ts").alias("ts")).distinct())
    valid = F.col("temperature").isNotNull() | F.col("humidity").isNotNull()
    return stored, meter_joined(v), valid


@query("insert_only", "ts:t event_id:i user_id:i energy_consumed:f", INSERT_SQL + """
SELECT ts, arg_min(event_id, event_id) AS event_id, arg_min(user_id, event_id) AS user_id, arg_min(energy_consumed, event_id) AS energy_consumed
FROM one WHERE ok AND ts NOT IN (SELECT ts FROM stored) GROUP BY ts""")
def insert_only(v):
    return M.insert_only(*insert_batch(v)[:2], ["ts"], insert_batch(v)[2], ["event_id"])


@query("insert_only_stats", "action:s n:i", INSERT_SQL + """,
firsts AS (SELECT ts, min(event_id) AS first FROM one WHERE ok GROUP BY 1)
SELECT CASE WHEN ts IN (SELECT ts FROM stored) OR event_id > first THEN 'duplicate' WHEN ok THEN 'inserted' ELSE 'invalid' END AS action,
       count(*) AS n FROM one LEFT JOIN firsts USING (ts) GROUP BY 1""")
def insert_only_stats(v):
    stored, batch, valid = insert_batch(v)
    return M.insert_only_stats(stored, batch, ["ts"], valid, ["event_id"])


EXT_SQL = """b AS (SELECT *, coalesce(user_name, 'Unknown User') AS u, strftime(date, '%Y-%m-%d') || '_' || start_time || '_' || end_time || '_' ||
  room_name || '_' || coalesce(user_name, 'Unknown User') AS external_id FROM v_book)"""


def bookings(v):
    return S.external_id(v.book().withColumnRenamed("date", "Date")).withColumnRenamed("Date", "date")


@query("booking_extid", "o_orderkey:i external_id:s", "WITH " + EXT_SQL + """
SELECT o_orderkey, external_id FROM b""")
def booking_extid(v):
    return bookings(v)


@query("booking_valid", "o_orderkey:i reason:s", """
SELECT o_orderkey, CASE WHEN user_name IS NULL THEN 'missing required values' END AS reason FROM v_book""")
def booking_valid(v):
    good, bad = Q.valid_booking(v.book().withColumnRenamed("date", "Date"))
    return good.unionByName(bad, allowMissingColumns=True)


# Stored bookings: those with an even priority number, one of six already inactive. Snapshot: all
# bookings whose status is not 'P'. So stored 'P' bookings vanish where their date has other bookings.
STORED_BOOKINGS_SQL = EXT_SQL + """,
target AS (SELECT *, o_orderkey % 6 <> 0 AS is_active FROM b WHERE left(division, 1) IN ('2', '4')),
snap AS (SELECT * FROM b WHERE activity = 'Cours' OR codes IS NULL OR codes <> 'P')"""


def booking_sides(v):
    b = bookings(v)
    target = b.filter(F.left("division", F.lit(1)).isin("2", "4")).withColumn("is_active", F.col("o_orderkey") % 6 != 0)
    return target, b.filter("activity = 'Cours' OR codes IS NULL OR codes <> 'P'")


@query("booking_deactivate", "o_orderkey:i is_active:i deactivated:i", "WITH " + STORED_BOOKINGS_SQL + """,
gone AS (SELECT external_id, max(o_orderkey) AS o_orderkey FROM target WHERE is_active AND date IN (SELECT date FROM snap)
         AND external_id NOT IN (SELECT external_id FROM snap) GROUP BY 1)
SELECT o_orderkey, is_active AND o_orderkey NOT IN (SELECT o_orderkey FROM gone) AS is_active,
       o_orderkey IN (SELECT o_orderkey FROM gone) AS deactivated FROM target""")
def booking_deactivate(v):
    target, snap = booking_sides(v)
    out = M.snapshot_diff(target, snap, row_id="o_orderkey").withColumnRenamed("_deactivated", "deactivated")
    return out.withColumns({c: F.col(c).cast("int") for c in ("is_active", "deactivated")})


@query("booking_insert", "o_orderkey:i external_id:s", "WITH " + STORED_BOOKINGS_SQL + """,
active AS (SELECT * FROM target WHERE is_active),
fresh AS (SELECT *, row_number() OVER (PARTITION BY date, start_time, end_time, room_name, u ORDER BY o_orderkey) AS rn FROM snap s
   WHERE external_id NOT IN (SELECT external_id FROM active) AND NOT EXISTS (SELECT 1 FROM active a WHERE a.date = s.date
     AND a.start_time = s.start_time AND a.end_time = s.end_time AND a.room_name = s.room_name AND a.u = s.u))
SELECT o_orderkey, external_id FROM fresh WHERE rn = 1""")
def booking_insert(v):
    target, snap = booking_sides(v)
    return M.booking_insert(target, snap, ["date", "start_time", "end_time", "room_name", "user_name"], ["o_orderkey"])


# Three snapshots of the booking dates; each lacks other bookings, so bookings vanish and return.
@query("booking_snapshots", "external_id:s o_orderkey:i file:s is_active:i gone:s", "WITH " + STORED_BOOKINGS_SQL + """,
snaps AS (SELECT 's1' AS file, * FROM b WHERE o_orderkey % 3 <> 0 UNION ALL SELECT 's2', * FROM b WHERE o_orderkey % 4 <> 1
          UNION ALL SELECT 's3', * FROM b WHERE o_orderkey % 5 <> 2),
nums AS (SELECT date, file, row_number() OVER (PARTITION BY date ORDER BY file) AS s FROM (SELECT DISTINCT date, file FROM snaps)),
seen AS (SELECT external_id, date, s, min(o_orderkey) AS o FROM snaps JOIN nums USING (date, file) GROUP BY ALL),
held AS (SELECT DISTINCT external_id, date FROM target WHERE is_active AND date IN (SELECT date FROM nums)),
present AS (SELECT external_id, date, s, o FROM seen UNION ALL SELECT external_id, date, 0, NULL FROM held),
numbered AS (SELECT *, s - row_number() OVER (PARTITION BY external_id ORDER BY s) AS run FROM present),
runs AS (SELECT external_id, date, min(s) AS first, max(s) + 1 AS after, min_by(o, s) AS o FROM numbered GROUP BY external_id, date, run),
ended AS (SELECT r.external_id, r.first, r.o, f.file AS file, g.file AS gone FROM runs r
          LEFT JOIN nums f ON f.date = r.date AND f.s = r.first LEFT JOIN nums g ON g.date = r.date AND g.s = r.after)
SELECT t.external_id, t.o_orderkey, 'stored' AS file, t.is_active AND e.gone IS NULL AS is_active, CASE WHEN t.is_active THEN e.gone END AS gone
FROM target t LEFT JOIN ended e ON e.external_id = t.external_id AND e.first = 0
UNION ALL SELECT external_id, o, file, gone IS NULL, gone FROM ended WHERE first > 0""")
def booking_snapshots(v):
    target, _ = booking_sides(v)
    b = bookings(v)
    snaps = None
    for name, by, rest in (("s1", 3, 0), ("s2", 4, 1), ("s3", 5, 2)):
        one = b.filter(F.col("o_orderkey") % by != rest).withColumn("file", F.lit(name))
        snaps = one if snaps is None else snaps.unionByName(one)
    key = ["date", "start_time", "end_time", "room_name", "user_name"]
    stored, fresh = M.snapshot_history(target, snaps, "date", key, ["o_orderkey"])
    names = ["external_id", "o_orderkey", "file", F.col("is_active").cast("int").alias("is_active"), F.col("_gone").alias("gone")]
    return stored.withColumn("file", F.lit("stored")).select(*names).unionByName(fresh.select(*names))


def forecast_sides(v):
    """Daily consumption and hourly production forecasts, as the scoring jobs write them."""
    e = v.table("events")
    daily = (e.filter("event_type = 'click'").groupBy(F.to_date("ts").alias("d"))
             .agg(F.round(F.sum("value"), 3).alias("consumptionPrediction"))
             .withColumn("date", F.date_format("d", "dd.MM.yyyy")))
    hourly = (e.filter("event_type = 'purchase'").groupBy(F.date_trunc("hour", "ts").alias("h"))
              .agg(F.round(F.sum("value"), 3).alias("productionPrediction"))
              .withColumns({"date": F.date_format("h", "dd.MM.yyyy"), "hour": F.date_format("h", "HH:mm")}))
    return daily, hourly


FORECAST_SQL = """fc AS (
  SELECT CAST(ts AS DATE) AS date, '00:00' AS hour, round(sum(value), 3) AS pc, CAST(NULL AS DOUBLE) AS pp FROM events WHERE event_type = 'click' GROUP BY 1
  UNION ALL SELECT CAST(date_trunc('hour', ts) AS DATE), strftime(date_trunc('hour', ts), '%H:%M'), NULL, round(sum(value), 3)
  FROM events WHERE event_type = 'purchase' GROUP BY date_trunc('hour', ts))"""
FORECAST = "date:d hour:s predicted_consumption:f predicted_production:f"


def forecast_rows(v):
    return Q.valid_forecast(S.combine_forecasts(*forecast_sides(v)))[0]


@query("forecast_union", FORECAST, "WITH " + FORECAST_SQL + """
SELECT date, hour, pc AS predicted_consumption, pp AS predicted_production FROM fc""")
def forecast_union(v):
    return forecast_rows(v)


OLD_SQL = """old AS (SELECT CAST(ts AS DATE) + 5 AS date, strftime(date_trunc('hour', ts), '%H:%M') AS hour,
  CASE WHEN hour(any_value(ts)) = 0 THEN NULL ELSE min(value) END AS pc, CASE WHEN hour(any_value(ts)) % 3 = 0 THEN NULL ELSE max(value) END AS pp
  FROM events WHERE event_type = 'error' GROUP BY CAST(ts AS DATE), strftime(date_trunc('hour', ts), '%H:%M'))"""


def old_forecasts(v):
    """Stored forecasts, five days later than the events, with gaps."""
    e = v.table("events").filter("event_type = 'error'").withColumn("h", F.date_trunc("hour", "ts"))
    e = e.groupBy("h").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    return e.select(F.date_add(F.to_date("h"), 5).alias("date"), F.date_format("h", "HH:mm").alias("hour"),
                    F.when(F.hour("h") != 0, F.col("lo")).alias("predicted_consumption"),
                    F.when(F.hour("h") % 3 != 0, F.col("hi")).alias("predicted_production"))


@query("replace_dates", FORECAST, "WITH " + FORECAST_SQL + ", " + OLD_SQL + """,
kept AS (SELECT * FROM old WHERE date NOT IN (SELECT date FROM fc) UNION ALL SELECT * FROM fc)
SELECT date, hour, pc AS predicted_consumption, pp AS predicted_production FROM kept""")
def replace_dates(v):
    return M.replace_dates(old_forecasts(v), forecast_rows(v), "date")


@query("merge_nonnull", FORECAST + " action:s", "WITH " + FORECAST_SQL + ", " + OLD_SQL + """,
new AS (SELECT date, hour, max(pc) AS nc, max(pp) AS np FROM fc GROUP BY ALL),
j AS (SELECT date, hour, o.pc, o.pp, nc, np, o.hour IS NOT NULL AS known, n.hour IS NOT NULL AS given,
        nc IS NOT NULL AND (o.pc IS NULL OR abs(o.pc - nc) > 0.001) AS mc, np IS NOT NULL AND (o.pp IS NULL OR abs(o.pp - np) > 0.001) AS mp
      FROM (SELECT *, hour AS h FROM old) o FULL JOIN new n USING (date, hour))
SELECT date, hour, CASE WHEN mc THEN nc ELSE pc END AS predicted_consumption, CASE WHEN mp THEN np ELSE pp END AS predicted_production,
  CASE WHEN NOT given THEN 'keep' WHEN NOT known THEN 'insert' WHEN mc OR mp THEN 'update' ELSE 'unchanged' END AS action FROM j""")
def merge_nonnull(v):
    measures = ["predicted_consumption", "predicted_production"]
    return (M.merge_nonnull(old_forecasts(v), forecast_rows(v), ["date", "hour"], measures, measures)
            .withColumnRenamed("_action", "action"))


@query("outer_merge", "user_id:i ts:t temperature:f humidity:f", """
SELECT user_id, ts, temperature, humidity
FROM (SELECT user_id, ts, arg_min(value, event_id) AS temperature FROM v_meter WHERE event_type = 'view' GROUP BY ALL)
FULL JOIN (SELECT user_id, ts, arg_min(value, event_id) AS humidity FROM v_meter WHERE event_type = 'signup' GROUP BY ALL) USING (user_id, ts)""")
def outer_merge(v):
    key = ["user_id", "ts"]
    temperature = dedup_first(meter_side(v, "view"), key, ["event_id"]).select(*key, F.col("Value").alias("temperature"))
    humidity = dedup_first(meter_side(v, "signup"), key, ["event_id"]).select(*key, F.col("Value").alias("humidity"))
    return J.outer_merge(temperature, humidity, key)


@query("daily_yield", "date:d inverter_name:s kwh:f readings:i", f"""WITH
one AS (SELECT * FROM (SELECT *, list(struct_pack(t := total_energy_produced, e := energy_produced, c := error_count) ORDER BY {INV_ORDER_SQL})
   OVER (PARTITION BY date, time, inverter_name, status_name ORDER BY {INV_ORDER_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS l,
   row_number() OVER (PARTITION BY date, time, inverter_name, status_name ORDER BY {INV_ORDER_SQL}) AS rn FROM v_solar) WHERE rn = 1),
folded AS (SELECT date, inverter_name, list_reduce(l, lambda s, x: CASE WHEN abs(s.t - x.t) > 0.001 OR abs(s.e - x.e) > 0.001 OR s.c <> x.c
   THEN x ELSE s END) AS f FROM one)
SELECT date, inverter_name, sum(f.e) AS kwh, count(*) AS readings FROM folded GROUP BY ALL""")
def daily_yield(v):
    """Flagship: readings to standard form, upsert into an empty fact, star join, daily energy per inverter."""
    rows, key = solar(v), ["id_date", "id_time", "id_inverter", "id_status"]
    dims = solar_dims(v, rows)
    # the merge counts the rows before it reads them: the ids are looked up once
    rows = cut_lineage(with_keys(v, rows, dims).select(*key, *SOLAR_MEASURES, "error_count", *INV_ORDER))
    fact = rows.filter(F.lit(False)).select(*key, *SOLAR_MEASURES, "error_count")
    fact = M.upsert_tol(fact, rows, key, SOLAR_MEASURES, INV_ORDER, exact=["error_count"])
    star = J.star_join(fact, [(dims["DimDate"], "id_date"), (dims["DimInverter"], "id_inverter")])
    return star.groupBy(F.make_date("year", "month", "day").alias("date"), "inverter_name").agg(
        F.sum("energy_produced").alias("kwh"), F.count("*").alias("readings"))
