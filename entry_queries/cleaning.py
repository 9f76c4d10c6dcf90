"""Parsing and cleaning queries."""

from pyspark.sql import functions as F

from campuswatt.functions import parsing as P
from campuswatt.operators import clean as C, quality as Q
from campuswatt.operators.ordering import dedup_first, dedup_last
from entry_queries.core import query
from entry_queries.views import MEASURES

WIDE = "Site:s Prediction:i ts:t " + " ".join(f"{m}:f" for m in MEASURES)


@query("norm_date", "event_id:i text:s date:s", """
SELECT event_id, text, strftime(CASE WHEN two THEN try_strptime(text, '%d.%m.%y') WHEN dotted THEN try_strptime(text, '%d.%m.%Y')
       WHEN text LIKE '%-%' THEN try_strptime(text, '%Y-%m-%d') ELSE try_strptime(text, '%m/%d/%Y') END, '%Y-%m-%d') AS date
FROM (SELECT event_id, text, length(text) - length(replace(text, '.', '')) = 2 AS dotted,
             text LIKE '%.__' AND length(text) - length(replace(text, '.', '')) = 2 AS two
      FROM (SELECT event_id, CASE event_id % 6 WHEN 0 THEN strftime(ts, '%d.%m.%y') WHEN 1 THEN strftime(ts, '%d.%m.%Y')
                   WHEN 2 THEN strftime(ts, '%Y-%m-%d') WHEN 3 THEN strftime(ts, '%m/%d/%Y') WHEN 4 THEN '31.02.2024'
                   ELSE '2024-13-' || strftime(ts, '%d') END AS text FROM events))""")
def norm_date(v):
    d = lambda fmt: F.date_format("ts", fmt)
    case = F.col("event_id") % 6
    text = (F.when(case == 0, d("dd.MM.yy")).when(case == 1, d("dd.MM.yyyy")).when(case == 2, d("yyyy-MM-dd"))
            .when(case == 3, d("MM/dd/yyyy")).when(case == 4, "31.02.2024")
            .otherwise(F.concat(F.lit("2024-13-"), d("dd"))))
    return v.table("events").withColumn("text", text).withColumn("date", P.norm_date(F.col("text")))


@query("norm_time", "event_id:i text:s time:s", """
SELECT event_id, text, strftime(try_strptime(text, '%H:%M:%S'), '%H:%M:%S') AS time
FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%H:%M:%S') WHEN 1 THEN CAST(hour(ts) AS VARCHAR) || ':' || CAST(minute(ts) AS VARCHAR) || ':0'
      WHEN 2 THEN strftime(ts, '%H:%M') ELSE CAST(20 + hour(ts) AS VARCHAR) || ':00:00' END AS text FROM events)""")
def norm_time(v):
    case = F.col("event_id") % 4
    text = (F.when(case == 0, F.date_format("ts", "HH:mm:ss"))
            .when(case == 1, F.concat(F.hour("ts").cast("string"), F.lit(":"), F.minute("ts").cast("string"), F.lit(":0")))
            .when(case == 2, F.date_format("ts", "HH:mm"))
            .otherwise(F.concat((20 + F.hour("ts")).cast("string"), F.lit(":00:00"))))
    return v.table("events").withColumn("text", text).withColumn("time", P.norm_time(F.col("text")))


@query("name_date", "day:d user_id:i name:s date:d", r"""
SELECT day, user_id, name, coalesce(
  try_strptime(nullif(regexp_extract(name, '(\d{4}-\d{2}-\d{2})', 1), ''), '%Y-%m-%d'),
  try_strptime(nullif(regexp_extract(name, '(\d{2}-\d{2}-\d{4})', 1), ''), '%d-%m-%Y'),
  try_strptime(nullif(regexp_extract(name, '(\d{8})', 1), ''), '%Y%m%d'),
  try_strptime(nullif(regexp_extract(name, '(\d{4}_\d{2}_\d{2})', 1), ''), '%Y_%m_%d')) AS date
FROM v_drops""")
def name_date(v):
    return v.drops().withColumn("date", P.name_date(F.col("name")))


@query("fr_date", "o_orderkey:i text:s date:d", """
SELECT o_orderkey, text, CASE WHEN len(w) = 3 THEN try_strptime(w[3] || '-' || m[w[2]] || '-' || lpad(w[1], 2, '0'), '%Y-%m-%d') END AS date
FROM (SELECT *, string_split(text, ' ') AS w,
      MAP {'janv.': '01', 'févr.': '02', 'mars': '03', 'avr.': '04', 'mai': '05', 'juin': '06', 'juil.': '07', 'août': '08',
           'sept.': '09', 'oct.': '10', 'nov.': '11', 'déc.': '12'} AS m
  FROM (SELECT o_orderkey, CAST(day(o_orderdate) AS VARCHAR) || ' ' ||
     ['janv.', 'févr.', 'mars', 'avr.', 'mai', 'juin', 'juil.', 'août', 'sept.', 'oct.', 'nov.', 'dec'][month(o_orderdate)] ||
     CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE ' ' || CAST(year(o_orderdate) AS VARCHAR) END AS text FROM orders))""")
def fr_date(v):
    names = F.array(*[F.lit(m) for m in list(P.FRENCH_MONTHS)[:11]], F.lit("dec"))
    year = F.when(F.col("o_orderkey") % 9 == 0, "").otherwise(F.concat(F.lit(" "), F.year("o_orderdate").cast("string")))
    text = F.concat(F.dayofmonth("o_orderdate").cast("string"), F.lit(" "),
                    F.element_at(names, F.month("o_orderdate")), year)
    return v.table("orders").withColumn("text", text).withColumn("date", P.parse_fr_date(F.col("text")))


@query("date_parts", "o_orderkey:i date:d", """
SELECT o_orderkey, try_strptime('2023-' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') || '-' ||
       lpad(CAST(day(o_orderdate) + o_orderkey % 4 AS VARCHAR), 2, '0'), '%Y-%m-%d') AS date FROM orders""")
def date_parts(v):
    o = v.table("orders")
    return o.withColumn("date", P.date_from_parts(
        F.lit("2023"), F.month("o_orderdate"), F.dayofmonth("o_orderdate") + F.col("o_orderkey") % 4))


@query("force_year", "o_orderkey:i date:d", """
SELECT o_orderkey, try_strptime('2023' || strftime(o_orderdate, '-%m-%d'), '%Y-%m-%d') AS date FROM orders""")
def force_year(v):
    return v.table("orders").withColumn("date", P.force_year(F.col("o_orderdate"), 2023))


@query("time_key", "o_orderkey:i time:s hour:i minute:i", """
SELECT o_orderkey, time, hour(try_strptime(time, '%H:%M:%S')) AS hour, minute(try_strptime(time, '%H:%M:%S')) AS minute
FROM (SELECT o_orderkey, CASE WHEN len(string_split(t, ':')) = 2 THEN t || ':00' ELSE t END AS time
      FROM (SELECT o_orderkey, start_time || CASE WHEN o_orderkey % 3 = 0 THEN ':30' ELSE '' END AS t FROM v_book))""")
def time_key(v):
    t = F.concat("start_time", F.when(F.col("o_orderkey") % 3 == 0, ":30").otherwise(""))
    b = v.book().withColumn("t", t).withColumn("time", P.complete_time(F.col("t")))
    hour, minute = P.time_parts(F.col("t"))
    return b.withColumns({"hour": hour, "minute": minute})


@query("decimal_hour", "o_orderkey:i text:s hours:f", """
SELECT o_orderkey, text, CASE len(string_split(text, ':'))
    WHEN 2 THEN TRY_CAST(string_split(text, ':')[1] AS INT) + TRY_CAST(string_split(text, ':')[2] AS INT) / 60.0
    WHEN 1 THEN TRY_CAST(text AS DOUBLE) END AS hours
FROM (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN start_time WHEN 1 THEN CAST(o_orderkey % 24 + 0.25 AS VARCHAR)
      WHEN 2 THEN start_time || ':00' ELSE 'h' || start_time END AS text FROM v_book)""")
def decimal_hour(v):
    case = F.col("o_orderkey") % 4
    text = (F.when(case == 0, F.col("start_time"))
            .when(case == 1, F.concat((F.col("o_orderkey") % 24).cast("string"), F.lit(".25")))
            .when(case == 2, F.concat("start_time", F.lit(":00"))).otherwise(F.concat(F.lit("h"), "start_time")))
    return v.book().withColumn("text", text).withColumn("hours", P.decimal_hour(F.col("text")))


@query("strip_quotes", "o_orderkey:i room_name:s user_name:s", """
SELECT o_orderkey, trim('"' || room_name || '"', '"') AS room_name, trim('""' || user_name, '"') AS user_name FROM v_book""")
def strip_quotes(v):
    b = v.book().select(F.col("o_orderkey").alias('"o_orderkey"'),
                        F.concat(F.lit('"'), "room_name", F.lit('"')).alias('"room_name"'),
                        F.concat(F.lit('""'), "user_name").alias("user_name"))
    return C.strip_quotes(b)


@query("alias_coalesce", "o_orderkey:i room_name:s start_time:s user_name:s codes:s", """
SELECT o_orderkey, room_name, start_time, user_name, codes FROM v_book""")
def alias_coalesce(v):
    """Three kinds of files with different headers become one table."""
    b = v.book()
    old = b.filter("activity = 'Cours'").select(
        "o_orderkey", F.col("room_name").alias("Nom"), F.col("start_time").alias("Heure début"),
        F.col("user_name").alias("Utilisateur"), F.col("codes").alias("Code"))
    new = b.filter("activity <> 'Cours'").select(
        "o_orderkey", F.col("room_name").alias("Salle"), F.col("start_time").alias("Start"),
        F.col("user_name").alias("User"), F.col("codes").alias("Codes"))
    return C.canonical_mixed(old.unionByName(new, allowMissingColumns=True))


@query("booking_filter", "o_orderkey:i room_name:s", """
SELECT o_orderkey, room_name FROM v_book WHERE room_name LIKE 'VS-BEL%'""")
def booking_filter(v):
    b = v.book().withColumn("Remarque", F.lit("x"))
    return C.prefix_filter(C.drop_if_present(b))


@query("explode_pairs", "o_orderkey:i class:s professor:s", """
SELECT o_orderkey, a AS class, unnest(pb) AS professor
FROM (SELECT o_orderkey, unnest(pa) AS a, pb FROM (
  SELECT o_orderkey,
    CASE WHEN class IS NULL THEN [NULL] ELSE list_filter(list_transform(string_split(class, ','), lambda x: trim(x)), lambda x: x <> '') END AS pa,
    list_filter(list_transform(string_split(professor, ','), lambda x: trim(x)), lambda x: x <> '') AS pb FROM v_book))""")
def explode_pairs(v):
    return C.explode_pairs(v.book())


@query("clean_meter", "Date:d Time:s user_id:i Value:f", """
SELECT CAST(ts AS DATE) AS "Date", strftime(ts, '%H:%M:%S') AS "Time", user_id, value AS "Value"
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) AS rn
      FROM v_meter WHERE user_id % 7 <> 0 OR hour(ts) <> 3) WHERE rn = 1""")
def clean_meter(v):
    """Each user is a file of raw meter lines; some times are unreadable."""
    time = F.when((F.col("user_id") % 7 == 0) & (F.hour("ts") == 3), "24:61:00").otherwise(F.date_format("ts", "H:m:s"))
    raw = v.meter().select(
        F.date_format("ts", "dd.MM.yy").alias("Datum"), time.alias("Heure"), F.lit("kWh").alias("Unité"),
        F.col("value").cast("string").alias("Mesure"), F.lit("a").alias("Valeur Acquisition"), "event_id", "user_id")
    return C.clean_meter(raw, ["event_id"], file="user_id")


@query("dedup_first", "user_id:i ts:t event_type:s value:f", """
SELECT user_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, ts, event_type ORDER BY event_id) AS rn FROM v_meter) WHERE rn = 1""")
def first_reading(v):
    return dedup_first(v.meter(), ["user_id", "ts", "event_type"], ["event_id"])


@query("dedup_last", "user_id:i ts:t event_type:s value:f", """
SELECT user_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, ts, event_type ORDER BY event_id DESC) AS rn FROM v_meter) WHERE rn = 1""")
def last_reading(v):
    return dedup_last(v.meter(), ["user_id", "ts", "event_type"], ["event_id"])


@query("unpivot_blocks", "l_orderkey:i l_linenumber:i l_partkey:i block:i INV:s Pac:f Status:s Uac:f", """
SELECT l_orderkey, l_linenumber, l_partkey, b AS block, 'INV' || CAST(l_suppkey % 8 + b AS VARCHAR) AS "INV",
       l_extendedprice + b AS "Pac", CASE WHEN b < 2 THEN CAST(l_linenumber % 7 AS VARCHAR) END AS "Status",
       CASE WHEN b < 2 THEN l_quantity + b END AS "Uac"
FROM (SELECT *, unnest([0, 1, 2]) AS b FROM v_inv)""")
def unpivot_blocks(v):
    """Every line holds two full blocks of 11 cells and a short one of 2."""
    def block(b):
        cells = [F.concat(F.lit("INV"), (F.col("l_suppkey") % 8 + b).cast("string")), (F.col("Pac") + b).cast("string"),
                 F.col("DaySum").cast("string"), F.col("Status"), F.col("Error").cast("string")]
        return [*cells, *[F.lit("0")] * 5, (F.col("DaySum") + b).cast("string")]

    wide = v.inv().withColumn("cells", F.array(*block(0), *block(1), *block(2)[:2]))
    return (C.unpivot_blocks(wide, "cells", ["l_orderkey", "l_linenumber", "l_partkey"])
            .withColumnRenamed("_block", "block"))


@query("sentinel", "event_id:i Site:s Value:f", """
SELECT event_id, "Site", CASE WHEN "Value" = -99999.0 THEN 0.0 ELSE "Value" END AS "Value" FROM v_meteo""")
def sentinel(v):
    return C.replace_sentinel(v.meteo())


@query("site_filter", "event_id:i Site:s", """
SELECT event_id, "Site" FROM v_meteo WHERE "Site" IN ('Sion', 'Visp')""")
def site_filter(v):
    return C.filter_sites(v.meteo())


def wide(v):
    """Sites kept, sentinel replaced, measures in columns."""
    return C.pivot_first(C.filter_sites(C.replace_sentinel(v.meteo())), ["Site", "Prediction", "ts"],
                         "Measurement", "Value", MEASURES, ["event_id"])


@query("meteo_pivot", "Date:s Time:s Site:s Prediction:i " + " ".join(f"{m}:f" for m in MEASURES), """
SELECT *, strftime(ts, '%Y-%m-%d') AS "Date", strftime(ts, '%H:%M:%S') AS "Time" FROM v_wide""")
def meteo_pivot(v):
    return C.split_ts(wide(v), "ts").orderBy("Date", "Time", "Site", "Prediction")


@query("valid_meteo", WIDE + " reason:s", """
SELECT *, CASE WHEN """ + " AND ".join(f'"{m}" IS NOT NULL' for m in MEASURES) + """ THEN NULL ELSE 'incomplete forecast' END AS reason
FROM v_wide""")
def valid_meteo(v):
    good, bad = Q.valid_meteo(wide(v), MEASURES)
    return good.unionByName(bad, allowMissingColumns=True)


@query("rename_weather", "site:s prediction:i ts:t temperature:f humidity:f precipitation:f global_radiation:f", """
SELECT "Site" AS site, "Prediction" AS prediction, ts, "PRED_T_2M_ctrl" AS temperature, "PRED_RELHUM_2M_ctrl" AS humidity,
       "PRED_TOT_PREC_ctrl" AS precipitation, "PRED_GLOB_ctrl" AS global_radiation FROM v_wide""")
def rename_weather(v):
    return C.rename_weather(wide(v))


@query("rejects", "o_orderkey:i reason:s", """
SELECT o_orderkey, 'missing: ' || list_aggregate(list_filter([CASE WHEN user_name IS NULL THEN 'user_name' END,
       CASE WHEN class IS NULL THEN 'class' END, CASE WHEN codes IS NULL THEN 'codes' END], lambda x: x IS NOT NULL), 'string_agg', ', ') AS reason
FROM v_book WHERE user_name IS NULL OR class IS NULL OR codes IS NULL""")
def rejects(v):
    return Q.required(v.book(), ["user_name", "class", "codes"])[1]
