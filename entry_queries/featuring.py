"""Feature, calendar, split and metric queries."""

from pyspark.sql import functions as F

from campuswatt.functions import academic as A, features as G, parsing as P
from campuswatt.operators import modelling as MO
from campuswatt.plans import models as ML
from entry_queries.core import query

PARTS = ["hour", "day", "month", "day_of_week", "week_of_year", "day_of_year"]
FLAGS = ["is_day_hours", "is_evening_hours", "is_night_hours", "is_weekend", "is_working_day", "is_morning_class",
         "is_afternoon_class", "is_evening_class", "is_building_open", "is_building_closed"]
HOUR_DOW = "SELECT *, hour(ts) AS h, isodow(ts) - 1 AS w FROM events"


@query("time_features", "event_id:i " + " ".join(f"{c}:i" for c in PARTS + FLAGS), f"""
SELECT event_id, h AS hour, day(ts) AS day, month(ts) AS month, w AS day_of_week, week(ts) AS week_of_year, dayofyear(ts) AS day_of_year,
  h BETWEEN 8 AND 16 AS is_day_hours, h BETWEEN 17 AND 21 AS is_evening_hours, h < 8 OR h >= 22 AS is_night_hours,
  w >= 5 AS is_weekend, w < 5 AS is_working_day, h BETWEEN 8 AND 11 AND w < 5 AS is_morning_class, h BETWEEN 13 AND 16 AND w < 5 AS is_afternoon_class,
  h BETWEEN 17 AND 20 AND w < 5 AS is_evening_class, h BETWEEN 7 AND 21 AND w < 5 AS is_building_open, NOT (h BETWEEN 7 AND 21 AND w < 5) AS is_building_closed
FROM ({HOUR_DOW})""")
def time_features(v):
    return G.day_flags(G.calendar_parts(v.table("events")))


WAVES = [f"{n}_{f}" for n in ("hour", "day_of_week", "month") for f in ("sin", "cos")]


@query("cyclic", "event_id:i year_part:f " + " ".join(f"{c}:f" for c in WAVES), f"""
SELECT event_id, dayofyear(ts) / 365.0 AS year_part, sin(2 * pi() * h / 24) AS hour_sin, cos(2 * pi() * h / 24) AS hour_cos,
  sin(2 * pi() * w / 7) AS day_of_week_sin, cos(2 * pi() * w / 7) AS day_of_week_cos, sin(2 * pi() * month(ts) / 12) AS month_sin, cos(2 * pi() * month(ts) / 12) AS month_cos
FROM ({HOUR_DOW})""")
def cyclic(v):
    return G.cyclic(v.table("events"))


@query("season", "o_orderkey:i season:s is_winter:i is_spring:i is_summer:i is_autumn:i", """
SELECT o_orderkey, s AS season, s = 'winter' AS is_winter, s = 'spring' AS is_spring, s = 'summer' AS is_summer, s = 'autumn' AS is_autumn
FROM (SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter' WHEN month(o_orderdate) <= 5 THEN 'spring'
      WHEN month(o_orderdate) <= 8 THEN 'summer' ELSE 'autumn' END AS s FROM orders)""")
def season(v):
    return G.season(v.table("orders"), "o_orderdate")


CAL_FLAGS = [*A.FLAGS, "is_holiday", "is_weekend"]
PERIODS_SQL = ", ".join(f"(DATE '{a}', DATE '{b}', '{k}')" for a, b, k in A.PERIODS)
HOLIDAYS_SQL = ", ".join(f"(DATE '{d}', '{n}')" for d, n in A.HOLIDAYS)
RUNS_SQL = ", ".join(f"('{t}', {n}, DATE '{m}', {k})" for t, n, m, k in A.WEEK_RUNS)


@query("calendar", "date:d orders:i holiday_name:s academic_week:s " + " ".join(f"{c}:i" for c in CAL_FLAGS), f"""WITH
placed AS (SELECT try_strptime((CASE WHEN month(o_orderdate) >= 10 THEN '2022' ELSE '2023' END) || strftime(o_orderdate, '-%m-%d'), '%Y-%m-%d')::DATE AS date, count(*) AS orders
  FROM orders GROUP BY 1),
periods(a, b, kind) AS (VALUES {PERIODS_SQL}), holidays(day, name) AS (VALUES {HOLIDAYS_SQL}), runs(term, number, monday, n) AS (VALUES {RUNS_SQL}),
weeks AS (SELECT term || CAST(number + i AS VARCHAR) AS code, monday + CAST(7 * i AS INT) AS a FROM (SELECT *, unnest(range(n)) AS i FROM runs)),
x AS (SELECT p.*, coalesce(kind, '') AS k, name, code FROM placed p LEFT JOIN periods ON date BETWEEN a AND b LEFT JOIN holidays ON date = day
  LEFT JOIN weeks ON date BETWEEN weeks.a AND weeks.a + 5 WHERE date IS NOT NULL)
SELECT date, orders, coalesce(name, '') AS holiday_name, coalesce(code, '') AS academic_week, k LIKE '%n_semester' OR k = 'spring_semester' AS is_semester_period,
  k = 'autumn_semester' AS is_autumn_semester, k = 'spring_semester' AS is_spring_semester,
  k IN ('christmas_holiday', 'easter_holiday', 'summer_break', 'ascension') OR name IS NOT NULL AS is_holiday_period,
  k = 'christmas_holiday' AS is_christmas_holiday, k = 'easter_holiday' AS is_easter_holiday, k = 'summer_break' AS is_summer_break,
  k = 'between_semesters' AS is_between_semesters, k = 'exam_period' AS is_exam_period, k = 'ascension' AS is_ascension,
  name IS NOT NULL AS is_holiday, isodow(date) >= 6 AS is_weekend FROM x""")
def calendar(v):
    """Orders per day of the academic year; order dates are moved into it."""
    date = F.when(F.month("o_orderdate") >= 10, P.force_year(F.col("o_orderdate"), 2022)).otherwise(
        P.force_year(F.col("o_orderdate"), 2023))
    placed = v.table("orders").groupBy(date.alias("date")).agg(F.count("*").alias("orders"))
    return placed.join(A.academic_calendar(v.spark), "date")


@query("degree_days", "event_id:i heating_degree:f cooling_degree:f is_raining:i", """
SELECT event_id, CASE WHEN value IS NOT NULL AND event_id % 10 <> 0 THEN greatest(18 - value, 0) END AS heating_degree,
  CASE WHEN value IS NOT NULL AND event_id % 10 <> 0 THEN greatest(value - 22, 0) END AS cooling_degree, user_id % 3 > 0 AS is_raining FROM events""")
def degree_days(v):
    e = v.table("events").withColumns({"temperature": F.when(F.col("event_id") % 10 != 0, F.col("value")),
                                       "precipitation": (F.col("user_id") % 3).cast("double")})
    return G.degree_days(e)


@query("interactions", "event_id:i is_cold_and_occupied:i is_weekend_or_holiday:i temp_occupation_interaction:f is_business_hours:i", f"""
SELECT event_id, value < 10 AND h BETWEEN 7 AND 21 AND w < 5 AS is_cold_and_occupied, w >= 5 OR user_id % 9 = 0 AS is_weekend_or_holiday,
  value * (user_id % 12) AS temp_occupation_interaction, h BETWEEN 8 AND 17 AND w < 5 AS is_business_hours FROM ({HOUR_DOW})""")
def interactions(v):
    e = v.table("events").withColumns({
        "temperature": F.col("value"), "rooms_occupied": F.col("user_id") % 12,
        "is_holiday_period": (F.col("user_id") % 9 == 0).cast("int")})
    return G.interactions(G.day_flags(e))


@query("category_codes", "o_orderkey:i o_orderpriority:i o_orderstatus:i kind:i", """WITH
p AS (SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) - 1 AS c FROM (SELECT DISTINCT o_orderpriority FROM orders))
SELECT o_orderkey, c AS o_orderpriority, CASE WHEN o_orderkey % 8 = 0 THEN -1 WHEN o_orderstatus = 'F' THEN 0 WHEN o_orderstatus = 'O' THEN 1 ELSE 2 END AS o_orderstatus,
  0 AS kind FROM orders JOIN p USING (o_orderpriority)""")
def category_codes(v):
    o = v.table("orders").withColumns({"o_orderstatus": F.when(F.col("o_orderkey") % 8 != 0, F.col("o_orderstatus")),
                                       "kind": F.lit("order")})
    return MO.category_codes(o, ["o_orderpriority", "o_orderstatus", "kind"])


@query("clip_round", "event_id:i forecast:f day:s time:s", """
SELECT event_id, CASE WHEN value - 20 < 0 THEN 0 ELSE round(value - 20, 2) END AS forecast, strftime(ts, '%d.%m.%Y') AS day, strftime(ts, '%H:%M') AS time FROM events""")
def clip_round(v):
    return v.table("events").select("event_id", P.clip_round(F.col("value") - 20).alias("forecast"),
                                    P.fmt_date(F.col("ts")).alias("day"), P.fmt_hour(F.col("ts")).alias("time"))


@query("feature_select", "event_id:f pred_glob_ctrl:f hour_sin:f hour_cos:f day_of_year:f", """
SELECT event_id, 0 AS pred_glob_ctrl, sin(2 * pi() * hour(ts) / 24) AS hour_sin, cos(2 * pi() * hour(ts) / 24) AS hour_cos, 0 AS day_of_year FROM events""")
def feature_select(v):
    """Features the frame lacks are 0."""
    return G.select_features(G.cyclic(v.table("events")), ["event_id", "pred_glob_ctrl", "hour_sin", "hour_cos", "day_of_year"])


# --- splits and metrics -------------------------------------------------------------------

@query("chrono_split", "event_id:i is_train:i is_test:i", """
SELECT event_id, NOT test AS is_train, test AS is_test FROM (SELECT event_id,
  row_number() OVER (ORDER BY ts, event_id) > count(*) OVER () - greatest(1, CAST(floor(count(*) OVER () * 0.2) AS BIGINT)) AS test FROM events)""")
def chrono_split(v):
    return MO.chrono_split(v.table("events"), ["ts", "event_id"])


DRAW_SQL = "CAST('0x' || substr(md5(l_orderkey || '|' || l_linenumber || '|42'), 1, 8) AS BIGINT) % 10000"
LINE_KEY = ["l_orderkey", "l_linenumber"]


@query("hash_split", "l_orderkey:i l_linenumber:i is_train:i", f"SELECT l_orderkey, l_linenumber, {DRAW_SQL} < 8000 AS is_train FROM lineitem")
def hash_split(v):
    return MO.hash_split(v.table("lineitem"), LINE_KEY)


@query("sample_rows", "l_orderkey:i l_linenumber:i", f"SELECT l_orderkey, l_linenumber FROM lineitem WHERE {DRAW_SQL} < 1000")
def sample_rows(v):
    return MO.sample_rows(v.table("lineitem"), LINE_KEY, 0.1)


@query("zscore", "l_orderkey:i l_linenumber:i l_quantity:f l_tax:f", """
SELECT l_orderkey, l_linenumber, (l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER () AS l_quantity,
       (l_tax - avg(l_tax) OVER ()) / stddev_pop(l_tax) OVER () AS l_tax FROM lineitem""")
def zscore(v):
    return MO.zscore(v.table("lineitem"), ["l_quantity", "l_tax"])


METRICS = "rmse:f mae:f r2:f mape:f rss:f n:i"
METRICS_SQL = """sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse, avg(abs(actual - predicted)) AS mae,
  1 - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(*)) AS r2,
  avg(abs(actual - predicted) / greatest(abs(actual), 0.01)) * 100 AS mape, sum((actual - predicted) * (actual - predicted)) AS rss, count(*) AS n"""


@query("metrics", METRICS, "SELECT " + METRICS_SQL + " FROM v_actual")
def metrics(v):
    return MO.metrics(v.actual())


@query("daily_metrics", METRICS, "SELECT " + METRICS_SQL + """ FROM (
  SELECT CAST(ts AS DATE) AS d, sum(actual) AS actual, sum(predicted) AS predicted FROM v_actual GROUP BY 1)""")
def daily_metrics(v):
    return MO.daily_metrics(v.actual())


@query("residuals", "ts:t actual:f predicted:f residual:f", """
SELECT ts, actual, predicted, actual - predicted AS residual FROM v_actual""")
def residuals(v):
    return MO.residuals(v.actual())


@query("fold_metrics", "fold:i " + METRICS, "SELECT fold, " + METRICS_SQL + """
FROM (SELECT *, ntile(5) OVER (ORDER BY ts) - 1 AS fold FROM v_actual) GROUP BY 1""")
def fold_metrics(v):
    return MO.fold_metrics(v.actual(), 5, ["ts"])


@query("fold_scores", "fold:i " + METRICS, """WITH
p AS (SELECT *, ntile(5) OVER (ORDER BY ts) - 1 AS fold FROM v_actual),
m AS (SELECT f.fold, regr_slope(o.actual, o.predicted) AS s, regr_intercept(o.actual, o.predicted) AS i
  FROM (SELECT DISTINCT fold FROM p) f JOIN p o ON o.fold <> f.fold GROUP BY f.fold),
q AS (SELECT p.fold, p.actual, i + s * p.predicted AS predicted FROM p JOIN m ON p.fold = m.fold)
SELECT fold, """ + METRICS_SQL + " FROM q GROUP BY fold")
def fold_scores(v):
    """A linear model fitted anew for every fold."""
    return ML.fold_scores(v.actual(), ["predicted"], "actual", ML.linreg(), 5, ["ts"])


# --- models ---------------------------------------------------------------------------------

@query("linreg", "l_orderkey:i l_linenumber:i prediction:f", """
SELECT l_orderkey, l_linenumber, regr_intercept(l_extendedprice, l_quantity) OVER () + regr_slope(l_extendedprice, l_quantity) OVER () * l_quantity AS prediction FROM lineitem""")
def linreg(v):
    li = v.table("lineitem")
    model = ML.fit(li, ["l_quantity"], "l_extendedprice", ML.linreg())
    return model.transform(li)


def hourly_features(v):
    return G.cyclic(G.calendar_parts(v.actual()))


MODEL_FEATURES = ["predicted", "hour", "day_of_week", "hour_sin", "hour_cos"]


def split_features(v):
    """Training rows and the newest fifth of the rows."""
    rows = MO.chrono_split(hourly_features(v), ["ts"])
    return rows.filter("is_train = 1"), rows.filter("is_test = 1")


# The values a tree model predicts are its own; certain are the rows, the actual values and the range.
TEST_SQL = """
r AS (SELECT *, row_number() OVER (ORDER BY ts) AS rn, count(*) OVER () AS n FROM v_actual),
t AS (SELECT *, rn > n - greatest(1, CAST(floor(n * 0.2) AS BIGINT)) AS test FROM r)"""


# The models' own results; tests hold their error against the mean of the training rows.
@query("gbt_predictions", "ts:t actual:f prediction:f")
def gbt_predictions(v):
    train, test = split_features(v)
    return ML.fit(train, MODEL_FEATURES, "actual", ML.gbt()).transform(test)


@query("forest_predictions", "ts:t actual:f prediction:f")
def forest_predictions(v):
    train, test = split_features(v)
    return ML.fit(train, MODEL_FEATURES, "actual", ML.random_forest(), scale=True).transform(test)


SMALL_GRID = {"maxIter": [2, 4], "stepSize": [0.1, 0.3], "maxDepth": [2]}


@query("boosting_scores", "maxIter:i stepSize:f maxDepth:i mse:f")
def boosting_scores(v):
    """Cross-validated error of each setting of a small grid."""
    train, _ = split_features(v)
    return ML.boosting_search(train, MODEL_FEATURES, "actual", SMALL_GRID, folds=2, key=["ts"])[0]


@query("importance_values", "feature:s importance:f")
def importance_values(v):
    train, _ = split_features(v)
    return ML.importances(v.spark, ML.fit(train, MODEL_FEATURES, "actual", ML.random_forest()), MODEL_FEATURES)


@query("gbt_forecast", "ts:t actual:f is_number:i", "WITH" + TEST_SQL + """
SELECT ts, actual, 1 AS is_number FROM t WHERE test""")
def gbt_forecast(v):
    return gbt_predictions(v).withColumn("is_number", F.col("prediction").isNotNull() & ~F.isnan("prediction"))


@query("forest_forecast", "ts:t actual:f in_range:i", "WITH" + TEST_SQL + """
SELECT ts, actual, 1 AS in_range FROM t WHERE test""")
def forest_forecast(v):
    """Averages of training values stay inside their range."""
    train, _ = split_features(v)
    scored = forest_predictions(v)
    low, high = (train.agg(f("actual")).scalar() for f in (F.min, F.max))
    return scored.withColumn("in_range", F.col("prediction").between(low - 1e-9, high + 1e-9))


@query("importances", "feature:s is_share:i total:f", "SELECT unnest(["
       + ", ".join(f"'{f}'" for f in MODEL_FEATURES) + "]) AS feature, 1 AS is_share, 1 AS total FROM (SELECT count(*) FROM v_actual)")
def importances(v):
    out = importance_values(v)
    total = out.agg(F.sum("importance")).scalar()
    return out.withColumns({"is_share": F.col("importance").between(0, 1), "total": total})
