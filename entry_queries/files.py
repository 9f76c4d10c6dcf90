"""Drop-file and mart queries."""

from pyspark.sql import functions as F

from campuswatt.operators.clean import prefix_filter
from campuswatt.plans import marts
from campuswatt.sources import files as S, readers as R
from entry_queries.core import query
from entry_queries.dimensions import solar

FEED_SQL = """SELECT *, CASE WHEN lower(name) LIKE 'min%' THEN 'inverter' WHEN lower(name) LIKE '%-pv%' THEN 'plant'
  WHEN lower(name) LIKE '%consumption%' OR lower(name) LIKE '%temperature%' OR lower(name) LIKE '%humidity%' THEN 'meter'
  WHEN lower(name) LIKE '%roomallocations%' THEN 'booking' WHEN lower(name) LIKE '%pred%' THEN 'meteo' ELSE 'unknown' END AS feed FROM v_drops"""


@query("feed_route", "day:d user_id:i name:s feed:s", FEED_SQL)
def feed_route(v):
    return v.drops().withColumn("feed", S.route(F.col("name")))


@query("feed_files", "day:d user_id:i name:s", """
SELECT day, user_id, name FROM v_drops WHERE name LIKE '%.csv' AND (lower(name) LIKE '%pv%' OR lower(name) LIKE '%min%')""")
def feed_files(v):
    return S.feed_files(v.drops(), "solar")


@query("ingest_antijoin", "user_id:i name:s", """
SELECT user_id, name FROM v_drops WHERE name NOT IN (SELECT name FROM v_drops WHERE day <= DATE '2024-01-10')""")
def ingest_antijoin(v):
    """Files of the first ten days are in the ledger."""
    ledger = v.drops().filter("day <= DATE'2024-01-10'").select("name").distinct()
    return S.new_files(v.drops(), ledger)


@query("latest_snapshot", "event_id:i load_date:d", """
SELECT event_id, CAST(ts AS DATE) AS load_date FROM events WHERE CAST(ts AS DATE) = (SELECT CAST(max(ts) AS DATE) FROM events)""")
def latest_snapshot(v):
    return S.latest_snapshot(v.table("events").withColumn("load_date", F.to_date("ts")))


@query("snapshots_until", "event_id:i load_date:d", """
SELECT event_id, CAST(ts AS DATE) AS load_date FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-12'""")
def snapshots_until(v):
    return S.snapshots_until(v.table("events").withColumn("load_date", F.to_date("ts")), "2024-01-15")


STATION_SQL = """SELECT DISTINCT strftime(ts, '%d.%m.%Y') || '_u' || CAST(user_id AS VARCHAR) || CASE event_type WHEN 'click' THEN '-Consumption'
  WHEN 'view' THEN '-Temperature' WHEN 'signup' THEN '-Humidity' ELSE '-PV' END || '.csv' AS name FROM events"""


@query("file_triples", "consumption:s temperature:s humidity:s reason:s", f"""WITH
f AS ({STATION_SQL}), m AS (SELECT name, split_part(name, '-', 1) AS token FROM f),
t AS (SELECT token, min(name) AS temperature FROM m WHERE name LIKE '%Temperature%' GROUP BY 1),
h AS (SELECT token, min(name) AS humidity FROM m WHERE name LIKE '%Humidity%' GROUP BY 1)
SELECT name AS consumption, temperature, humidity, CASE WHEN temperature IS NULL OR humidity IS NULL THEN 'missing partner file' END AS reason
FROM m LEFT JOIN t USING (token) LEFT JOIN h USING (token) WHERE name LIKE '%Consumption%'""")
def file_triples(v):
    """One file per user, day and kind; consumption files without both partners are rejected."""
    kind = (F.when(F.col("event_type") == "click", "-Consumption.csv").when(F.col("event_type") == "view", "-Temperature.csv")
            .when(F.col("event_type") == "signup", "-Humidity.csv").otherwise("-PV.csv"))
    name = F.concat(F.date_format("ts", "dd.MM.yyyy"), F.lit("_u"), F.col("user_id").cast("string"), kind)
    good, bad = S.match_triples(v.table("events").select(name.alias("name")).distinct())
    return good.unionByName(bad, allowMissingColumns=True).drop("token")


@query("latest_file", "kind:s path:s", """
SELECT event_type AS kind, 'f' || CAST(event_id AS VARCHAR) AS path FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, 'f' || CAST(event_id AS VARCHAR) DESC) AS rn FROM events) WHERE rn = 1""")
def latest_file(v):
    return S.latest_by_mtime(v.table("events").select(
        F.col("event_type").alias("kind"), F.col("ts").alias("mtime"),
        F.concat(F.lit("f"), F.col("event_id").cast("string")).alias("path")))


@query("lines_decode", "o_orderkey:i line_no:i line:s", """
SELECT o_orderkey, i AS line_no, CASE i WHEN 0 THEN 'réservé ' || o_orderpriority ELSE 'août ' || o_orderstatus END AS line
FROM orders, range(2) r(i)""")
def lines_decode(v):
    """Two-line texts, half of them in UTF-8, half in ISO-8859-1."""
    text = F.concat(F.lit("réservé "), "o_orderpriority", F.lit("\r\naoût "), "o_orderstatus", F.lit("\n"))
    content = F.when(F.col("o_orderkey") % 2 == 0, F.encode(text, "UTF-8")).otherwise(F.encode(text, "ISO-8859-1"))
    raw = v.table("orders").select("o_orderkey", content.alias("content"))
    return R.split_lines(raw.select("o_orderkey", R.decode_text("content").alias("text")))


# --- marts ----------------------------------------------------------------------------------

@query("mart_energy", "period:t produced:f consumed:f balance:f", """
SELECT period, coalesce(p, 0) AS produced, coalesce(c, 0) AS consumed, coalesce(p, 0) - coalesce(c, 0) AS balance
FROM (SELECT date_trunc('hour', ts) AS period, sum(value) AS p FROM events WHERE event_type = 'purchase' GROUP BY 1)
FULL JOIN (SELECT date_trunc('hour', ts) AS period, sum(value) AS c FROM events WHERE event_type = 'click' GROUP BY 1) USING (period)""")
def mart_energy(v):
    e = v.table("events")
    made = e.filter("event_type = 'purchase'").withColumnRenamed("value", "energy_produced")
    used = e.filter("event_type = 'click'").withColumnRenamed("value", "energy_consumed")
    return marts.energy_balance(made, used)


@query("mart_failures", "inverter_name:s date:d failures:i errors:i not_running:i", """
SELECT inverter_name, date, count(*) AS failures, sum(error_count) AS errors, count(*) FILTER (WHERE status_name <> '6') AS not_running
FROM v_solar WHERE error_count > 0 OR status_name <> '6' GROUP BY ALL""")
def mart_failures(v):
    return marts.failures(solar(v))


@query("mart_occupancy", "room_name:s ts:t bookings:i", """
SELECT room_name, date + to_hours(h) AS ts, count(*) AS bookings FROM (SELECT unnest(range(24)) AS h) JOIN v_book
  ON CAST(start_time[1:2] AS INT) + CAST(start_time[4:5] AS INT) / 60.0 <= h AND CAST(end_time[1:2] AS INT) > h
WHERE room_name LIKE 'VS-BEL%' GROUP BY ALL""")
def mart_occupancy(v):
    return marts.room_occupation(prefix_filter(v.book()))


@query("mart_forecast", "hour:i rmse:f mae:f n:i", """
SELECT hour(ts) AS hour, sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse, avg(abs(actual - predicted)) AS mae, count(*) AS n FROM v_actual GROUP BY 1""")
def mart_forecast(v):
    both = v.actual()
    return marts.forecast_quality(both.select("ts", "actual"), both.select("ts", "predicted"), by=[F.hour("ts").alias("hour")])
