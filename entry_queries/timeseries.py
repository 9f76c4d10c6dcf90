"""Series, occupation and join queries."""

from pyspark.sql import functions as F

from campuswatt.operators import joins as J, occupancy as O, ordering as R, series as E
from entry_queries.cleaning import wide
from entry_queries.core import query
from entry_queries.views import MEASURES

SERIES = "series:s ts:t value:f"


@query("hour_spine", "series:s ts:t", "SELECT series, ts FROM v_spine")
def hour_spine(v):
    span = v.span()
    names = v.series_known().select("series").distinct().withColumns({
        "lo": span.select("lo").scalar(), "hi": span.select("hi").scalar()})
    return E.hour_spine(names, "lo", "hi")


@query("lag_diff", SERIES + " change:f", """
SELECT series, ts, value, value - lag(value) OVER (PARTITION BY series ORDER BY ts) AS change FROM v_series""")
def lag_diff(v):
    return E.lag_diff(v.series(), "value", ["series"], "ts", "change")


@query("daily_amplitude", SERIES + " amplitude:f", """
SELECT series, ts, value, max(value) OVER w - min(value) OVER w AS amplitude FROM v_series WINDOW w AS (PARTITION BY series, CAST(ts AS DATE))""")
def daily_amplitude(v):
    return E.daily_amplitude(v.series(), "value", ["series"], "ts", "amplitude")


@query("rolling_sum", SERIES + " last_24:f", """
SELECT series, ts, value, sum(value) OVER (PARTITION BY series ORDER BY ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS last_24 FROM v_series""")
def rolling_sum(v):
    return E.rolling_sum(v.series(), "value", 24, ["series"], "ts", "last_24")


GAPS_SQL = """WITH numbered AS (SELECT *, CAST(row_number() OVER (PARTITION BY series ORDER BY ts) AS DOUBLE) AS pos, epoch(ts) AS sec FROM v_series),
known AS (SELECT *,
  last_value(value IGNORE NULLS) OVER a AS pv, last_value(CASE WHEN value IS NOT NULL THEN {axis} END IGNORE NULLS) OVER a AS pa,
  first_value(value IGNORE NULLS) OVER b AS nv, first_value(CASE WHEN value IS NOT NULL THEN {axis} END IGNORE NULLS) OVER b AS na
  FROM numbered WINDOW a AS (PARTITION BY series ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  b AS (PARTITION BY series ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


@query("interp_linear", SERIES, GAPS_SQL.format(axis="pos") + """
SELECT series, ts, CASE WHEN value IS NOT NULL THEN value WHEN pv IS NOT NULL AND nv IS NOT NULL THEN pv + (nv - pv) * ((pos - pa) / (na - pa))
  ELSE coalesce(pv, nv) END AS value FROM known""")
def interp_linear(v):
    return E.interp_linear(v.series(), ["value"], ["series"], "ts")


@query("interp_time", SERIES, GAPS_SQL.format(axis="sec") + """
SELECT series, ts, CASE WHEN value IS NOT NULL THEN value WHEN pv IS NOT NULL AND nv IS NOT NULL THEN pv + (nv - pv) * ((sec - pa) / (na - pa))
  ELSE coalesce(pv, nv) END AS value FROM known WHERE hour(ts) % 7 <> 3 OR value IS NOT NULL""")
def interp_time(v):
    """Some empty hours are left out, so that spacing is uneven and time differs from position."""
    uneven = v.series().filter((F.hour("ts") % 7 != 3) | F.col("value").isNotNull())
    return E.interp_time(uneven, ["value"], ["series"], "ts")


@query("ffill_mode", SERIES + " label:s", GAPS_SQL.format(axis="pos") + """,
labels AS (SELECT *, CASE WHEN value > 60 THEN 'high' WHEN value > 20 THEN 'mid' WHEN value IS NOT NULL THEN 'low' END AS lab FROM known),
mode AS (SELECT lab FROM labels WHERE lab IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, lab LIMIT 1)
SELECT series, ts, coalesce(pv, nv) AS value, coalesce(lab, (SELECT lab FROM mode)) AS label FROM labels""")
def ffill_mode(v):
    """Values fill forward, then backward; labels take the most frequent one."""
    value = F.col("value")
    label = F.when(value > 60, "high").when(value > 20, "mid").when(value.isNotNull(), "low")
    labelled = E.mode_fill(v.series().withColumn("label", label), "label")
    return E.fill(labelled, ["value"], ["series"], "ts")


@query("group_mean_fill", SERIES, """
SELECT series, ts, coalesce(value, avg(value) OVER (PARTITION BY series, CAST(ts AS DATE))) AS value FROM v_series""")
def group_mean_fill(v):
    return E.group_mean_fill(v.series(), "value", ["series", F.to_date("ts")])


@query("daily_resample", "user_id:i date:d total:f", """
SELECT user_id, date, coalesce(total, 0) AS total
FROM (SELECT user_id, CAST(unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY)) AS DATE) AS date FROM events GROUP BY 1)
LEFT JOIN (SELECT user_id, CAST(ts AS DATE) AS date, sum(value) AS total FROM events GROUP BY ALL) USING (user_id, date)""")
def daily_resample(v):
    return E.daily_resample(v.table("events"), "value", ["user_id"], "ts", "total")


@query("daylight_daily", "Site:s date:d " + " ".join(f"{m}:f" for m in MEASURES), """
SELECT "Site", CAST(ts AS DATE) AS date, avg("PRED_T_2M_ctrl") AS "PRED_T_2M_ctrl", avg("PRED_RELHUM_2M_ctrl") AS "PRED_RELHUM_2M_ctrl",
  sum("PRED_TOT_PREC_ctrl") AS "PRED_TOT_PREC_ctrl", avg("PRED_GLOB_ctrl") AS "PRED_GLOB_ctrl",
  avg("PRED_OTHER") AS "PRED_OTHER"
FROM v_wide WHERE hour(ts) BETWEEN 6 AND 19 GROUP BY ALL""")
def daylight_daily(v):
    return E.daylight_daily(wide(v), MEASURES, ["Site"])


@query("plant_power", "ts:t pv_output:f running:i", """WITH
p AS (SELECT ts, sum("Pac") AS pv_output, count(*) FILTER (WHERE "Status" = '6') AS running FROM v_inv GROUP BY 1)
SELECT ts, CASE WHEN (SELECT max(pv_output) FROM p) > 100 THEN pv_output / 1000 ELSE pv_output END AS pv_output, running FROM p""")
def plant_power(v):
    return E.plant_power(v.inv(), pac="Pac", status="Status")


INV_KEYS_SQL = "ts, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"


@query("daily_energy", "date:d pv_output:f", f"""WITH
last AS (SELECT * FROM (SELECT "Date", "INV", "DaySum" AS ds, row_number() OVER (PARTITION BY "Date", "INV" ORDER BY ts DESC, l_orderkey DESC,
  l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS rn FROM v_inv WHERE l_partkey % 5 <> 0) WHERE rn = 1),
d AS (SELECT "Date" AS date, sum(ds) AS e FROM last GROUP BY 1)
SELECT date, CASE WHEN (SELECT max(e) FROM d) > 1000 THEN e / 1000 ELSE e END AS pv_output FROM d""")
def daily_energy(v):
    """Some counters are missing; the last known one of the day counts."""
    inv = v.inv().withColumn("DaySum", F.when(F.col("l_partkey") % 5 != 0, F.col("DaySum")))
    return E.daily_energy(inv, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"],
                          inverter="INV", daysum="DaySum")


@query("best_forecast", "event_id:i Site:s ts:t Prediction:i Value:f", """
SELECT event_id, "Site", ts, "Prediction", "Value" FROM (SELECT *, row_number() OVER (PARTITION BY ts, "Site" ORDER BY "Prediction" DESC, event_id) AS rn
FROM v_meteo) WHERE rn = 1""")
def best_forecast(v):
    return E.best_forecast(v.meteo(), ["ts"], ["event_id"], horizon="Prediction", site="Site")


@query("target_time", "event_id:i target_ts:t", """
SELECT event_id, ts + to_hours("Prediction") AS target_ts FROM v_meteo
WHERE ts + to_hours("Prediction") <= (SELECT max(ts) FROM v_meteo) - INTERVAL 3 DAY""")
def target_time(v):
    """Forecasts for times later than three days before the last issue are cut off."""
    fc = v.meteo()
    cutoff = fc.agg(F.max("ts") - F.expr("interval 3 days")).scalar()
    return E.target_time(fc, horizon="Prediction", cutoff=cutoff)


@query("hour_fallback", "ts:t " + " ".join(f"{m}:f" for m in MEASURES), """WITH
best AS (SELECT * FROM (SELECT *, hour(ts) AS h, row_number() OVER (PARTITION BY hour(ts) ORDER BY "Prediction" DESC, ts, "Site") AS rn FROM v_wide) WHERE rn = 1),
spine AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM v_span)
SELECT s.ts, """ + ", ".join(f'CASE WHEN h IS NOT NULL THEN "{m}" ELSE (SELECT avg("{m}") FROM v_wide) END AS "{m}"' for m in MEASURES) + """
FROM spine s LEFT JOIN best b ON hour(s.ts) = h""")
def hour_fallback(v):
    spine = E.hour_spine(v.span(), "lo", "hi")
    return E.hour_fallback(wide(v), spine, MEASURES, ["ts", "Site"], horizon="Prediction")


@query("corr_matrix", "a:s b:s corr:f", """WITH
x AS (SELECT unnest(['quantity', 'price', 'discount', 'tax']) AS n)
SELECT p.n AS a, q.n AS b, c AS corr FROM x p, x q, (SELECT unnest([
 {'k': 'quantity-price', 'c': corr(l_quantity, l_extendedprice)}, {'k': 'quantity-discount', 'c': corr(l_quantity, l_discount)},
 {'k': 'quantity-tax', 'c': corr(l_quantity, l_tax)}, {'k': 'price-discount', 'c': corr(l_extendedprice, l_discount)},
 {'k': 'price-tax', 'c': corr(l_extendedprice, l_tax)}, {'k': 'discount-tax', 'c': corr(l_discount, l_tax)},
 {'k': 'quantity-quantity', 'c': 1.0}, {'k': 'price-price', 'c': 1.0}, {'k': 'discount-discount', 'c': 1.0}, {'k': 'tax-tax', 'c': 1.0}], recursive := true) FROM lineitem)
WHERE k IN (p.n || '-' || q.n, q.n || '-' || p.n)""")
def corr_matrix(v):
    li = v.table("lineitem").select(F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
                                    F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"))
    return E.corr_matrix(li, ["quantity", "price", "discount", "tax"])


@query("top_n", "p_partkey:i p_retailprice:f", """
SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10""")
def top_n(v):
    """The report of the ten largest values."""
    return R.top_n(v.table("part"), "p_retailprice", 10, ["p_partkey"])


# --- occupation -----------------------------------------------------------------------

HOURS_SQL = """t AS (SELECT *, CAST(start_time[1:2] AS INT) + CAST(start_time[4:5] AS INT) / 60.0 AS a, CAST(end_time[1:2] AS INT) AS b FROM v_book),
hours AS (SELECT unnest(generate_series(CAST(min(date) AS TIMESTAMP), CAST(max(date) AS TIMESTAMP) + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS ts FROM t),
covered AS (SELECT t.*, date + to_hours(h) AS ts FROM (SELECT unnest(range(24)) AS h) JOIN t ON a <= h AND b > h),
occ AS (SELECT hours.ts, count(o_orderkey) AS n, count(*) FILTER (WHERE activity = 'Cours') AS c, (SELECT count(DISTINCT room_name) FROM t) AS rooms
  FROM hours LEFT JOIN covered USING (ts) GROUP BY 1)"""


@query("occupancy", "ts:t rooms_occupied:i total_rooms:i occupation_rate:f", "WITH " + HOURS_SQL + """
SELECT ts, n AS rooms_occupied, rooms AS total_rooms, n / CAST(greatest(1, rooms) AS DOUBLE) AS occupation_rate FROM occ""")
def occupancy(v):
    return O.occupancy(v.book())


@query("course_ratio", "ts:t course_count:i course_ratio:f is_course_heavy:i", "WITH " + HOURS_SQL + """
SELECT ts, c AS course_count, c / CAST(CASE n WHEN 0 THEN 1 ELSE n END AS DOUBLE) AS course_ratio,
       c / CAST(CASE n WHEN 0 THEN 1 ELSE n END AS DOUBLE) > 0.7 AS is_course_heavy FROM occ""")
def course_ratio(v):
    return O.occupancy(v.book(), activity="activity")


@query("quartile_flags", "ts:t rooms_occupied:i is_high_occupation:i is_low_occupation:i", "WITH " + HOURS_SQL + """,
q AS (SELECT quantile_cont(n / CAST(rooms AS DOUBLE), 0.75) AS hi, quantile_cont(n / CAST(rooms AS DOUBLE), 0.25) AS lo FROM occ)
SELECT ts, n AS rooms_occupied, n / CAST(rooms AS DOUBLE) > hi AS is_high_occupation, n / CAST(rooms AS DOUBLE) < lo AS is_low_occupation FROM occ, q""")
def quartile_flags(v):
    return O.occupation_flags(O.occupancy(v.book()))


@query("quantiles", "q0:f q1:f q2:f", """
SELECT quantile_cont(value, 0.75) AS q0, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.9) AS q2 FROM events""")
def quantiles(v):
    return E.quantiles(v.table("events"), "value", [0.75, 0.25, 0.9])


DIVISIONS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
DIVISION_COLS = ["1-urgent_count", "2-high_count", "3-medium_count", "4-not_specified_count", "5-low_count"]


@query("division_counts", "ts:t " + " ".join(f"{c}:i" for c in DIVISION_COLS), "WITH " + HOURS_SQL + """
SELECT hours.ts, """ + ", ".join(f"count(*) FILTER (WHERE division = '{d}') AS \"{c}\"" for d, c in zip(DIVISIONS, DIVISION_COLS)) + """
FROM hours LEFT JOIN covered USING (ts) GROUP BY 1""")
def division_counts(v):
    book = v.book()
    return O.division_counts(book, O.division_values(book))


@query("room_hours", "room_name:s ts:t bookings:i", "WITH " + HOURS_SQL + """
SELECT room_name, ts, count(*) AS bookings FROM covered GROUP BY ALL""")
def room_hours(v):
    _, hours = O.booked_hours(v.book())
    return hours.groupBy("room_name", "ts").agg(F.count("*").alias("bookings"))


# --- joins ------------------------------------------------------------------------------

@query("floor_join", "event_id:i ts:t " + " ".join(f"{m}:f" for m in MEASURES), """WITH
fc AS (SELECT * FROM (SELECT *, ts + to_hours("Prediction") AS target, row_number() OVER (PARTITION BY ts + to_hours("Prediction") ORDER BY ts DESC, "Site" DESC) AS rn FROM v_wide) WHERE rn = 1)
SELECT event_id, e.ts, """ + ", ".join(f'"{m}"' for m in MEASURES) + """ FROM events e LEFT JOIN fc ON date_trunc('hour', e.ts) = target
WHERE hour(e.ts) BETWEEN 6 AND 19""")
def floor_join(v):
    """Each event with the latest forecast for its hour, daylight only."""
    fc = E.target_time(wide(v), horizon="Prediction")
    return J.floor_join(v.table("events"), fc, MEASURES, ["ts", "Site"])


@query("hourly_merge", "ts:t consumption:f temperature:f rooms_occupied:i day_total:f", """WITH
cons AS (SELECT ts, actual AS consumption FROM v_actual),
weather AS (SELECT ts, max("PRED_T_2M_ctrl") AS temperature FROM v_wide GROUP BY 1),
rooms AS (SELECT date_trunc('hour', ts) AS ts, count(DISTINCT user_id) AS rooms_occupied FROM events WHERE event_type = 'error' GROUP BY 1),
cal AS (SELECT CAST(ts AS DATE) AS date, sum(value) AS day_total FROM events GROUP BY 1)
SELECT ts, consumption, temperature, rooms_occupied, day_total FROM cons LEFT JOIN weather USING (ts) LEFT JOIN rooms USING (ts) LEFT JOIN cal ON CAST(ts AS DATE) = date""")
def hourly_merge(v):
    e = v.table("events")
    weather = wide(v).groupBy("ts").agg(F.max("PRED_T_2M_ctrl").alias("temperature"))
    rooms = (e.filter("event_type = 'error'").groupBy(F.date_trunc("hour", "ts").alias("ts"))
             .agg(F.count_distinct("user_id").alias("rooms_occupied")))
    calendar = e.groupBy(F.to_date("ts").alias("date")).agg(F.sum("value").alias("day_total"))
    consumption = v.actual().select("ts", F.col("actual").alias("consumption"))
    return J.hourly_merge(consumption, weather, rooms, calendar)


@query("explode_interval", "c_mktsegment:s date:d open_orders:i", """
SELECT c_mktsegment, date, count(*) AS open_orders FROM (
  SELECT c_mktsegment, unnest(generate_series(CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 AS INT), INTERVAL 1 DAY)) AS date
  FROM orders JOIN customer ON o_custkey = c_custkey) GROUP BY ALL""")
def explode_interval(v):
    """Orders open on each day: the interval join as an equi-join on days."""
    o = v.table("orders").join(v.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    o = o.select("c_mktsegment", F.to_date("o_orderdate").alias("first"),
                 F.date_add("o_orderdate", (F.col("o_orderkey") % 10).cast("int")).alias("last"))
    return J.explode_days(o, "first", "last").groupBy("c_mktsegment", "date").agg(F.count("*").alias("open_orders"))
