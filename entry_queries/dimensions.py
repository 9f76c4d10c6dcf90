"""Dimension queries."""

from pyspark.sql import functions as F

from campuswatt.functions import parsing as P
from campuswatt.operators import dims as D, quality as Q
from campuswatt.plans import marts, standard as S
from campuswatt.schemas import DIMENSIONS
from campuswatt.session import cut_lineage, empty_table
from entry_queries.core import query
from entry_queries.views import INV_ORDER


def empty(v, table):
    return empty_table(v.spark, DIMENSIONS[table])


def solar(v):
    """Inverter readings in standard form."""
    return S.std_min(v.inv(), ["ts", *INV_ORDER])[0]


def solar_dims(v, rows):
    """The four dimensions of the solar fact, grown from empty tables.

    The members are written once: the rows are read once a dimension, and the planner knows how small it is.
    """
    members = {
        "DimDate": (D.date_members(rows, "date"), ["year", "month", "day"]),
        "DimTime": (D.time_members(rows, "time"), ["hour", "minute"]),
        "DimInverter": (rows, ["inverter_name"]),
        "DimStatus": (rows, ["status_name"]),
    }
    return {n: D.upsert_dim(empty(v, n), cut_lineage(src.select(*key).distinct()), key) for n, (src, key) in members.items()}


def with_keys(v, rows, dims):
    rows = D.lookup_time(D.lookup_date(rows, dims["DimDate"], "date"), dims["DimTime"], "time")
    rows = D.lookup(rows, dims["DimInverter"], ["inverter_name"])
    return D.lookup(rows, dims["DimStatus"], ["status_name"])


SOLAR_DIMS_SQL = """WITH
dd AS (SELECT row_number() OVER (ORDER BY y, m, d) AS id_date, * FROM (SELECT DISTINCT year(date) AS y, month(date) AS m, day(date) AS d FROM v_solar)),
dt AS (SELECT row_number() OVER (ORDER BY h, mi) AS id_time, * FROM (SELECT DISTINCT CAST(time[1:2] AS INT) AS h, CAST(time[4:5] AS INT) AS mi FROM v_solar)),
di AS (SELECT row_number() OVER (ORDER BY inverter_name) AS id_inverter, * FROM (SELECT DISTINCT inverter_name FROM v_solar)),
ds AS (SELECT row_number() OVER (ORDER BY status_name) AS id_status, * FROM (SELECT DISTINCT status_name FROM v_solar))"""
SOLAR_JOIN_SQL = """v_solar f JOIN dd ON year(f.date) = y AND month(f.date) = m AND day(f.date) = d
  JOIN dt ON CAST(f.time[1:2] AS INT) = h AND CAST(f.time[4:5] AS INT) = mi JOIN di USING (inverter_name) JOIN ds USING (status_name)"""


@query("dim_get_or_create", "id_date:i year:i month:i day:i", """WITH
known AS (SELECT row_number() OVER (ORDER BY d) AS id, d FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)),
fresh AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE CAST(l_shipdate AS DATE) NOT IN (SELECT d FROM known)),
members AS (SELECT id, d FROM known UNION ALL
  SELECT (SELECT max(id) FROM known) + row_number() OVER (ORDER BY d), d FROM fresh)
SELECT id AS id_date, year(d) AS year, month(d) AS month, day(d) AS day FROM members""")
def dim_get_or_create(v):
    """Order dates are known; ship dates get the next ids."""
    key = ["year", "month", "day"]
    known = D.upsert_dim(empty(v, "DimDate"), D.date_members(v.table("orders"), "o_orderdate"), key)
    return D.upsert_dim(known, D.date_members(v.table("lineitem"), "l_shipdate"), key)


@query("dim_ci", "id_classroom:i classroom_name:s", """WITH
names AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN upper(c) ELSE c END AS name
  FROM (SELECT o_orderkey, CASE o_orderkey % 9 WHEN 1 THEN '' WHEN 2 THEN 'None' ELSE room_name || '/' || reservation_type END AS c FROM v_book)
  WHERE lower(c) NOT IN ('', 'none')),
firsts AS (SELECT lower(name) AS k, arg_min(name, o_orderkey) AS name FROM names GROUP BY 1)
SELECT row_number() OVER (ORDER BY k) AS id_classroom, name AS classroom_name FROM firsts""")
def dim_ci(v):
    """Classroom names ignore case, keep the first spelling and drop blanks."""
    case = F.col("o_orderkey") % 9
    name = F.when(case == 1, "").when(case == 2, "None").otherwise(F.concat("room_name", F.lit("/"), "reservation_type"))
    name = F.when(F.col("o_orderkey") % 2 == 0, F.upper(name)).otherwise(name)
    src = v.book().select("o_orderkey", P.none_to_null(name).alias("classroom_name"))
    return D.upsert_dim(empty(v, "DimClassroom"), src, ["classroom_name"], ["o_orderkey"], ci=True)


@query("dim_role", "id_user:i username:s", """WITH
names AS (SELECT user_name AS n FROM v_book UNION SELECT professor FROM v_book)
SELECT row_number() OVER (ORDER BY lower(n)) AS id_user, n AS username FROM names WHERE n IS NOT NULL""")
def dim_role(v):
    """Users and professors share one dimension."""
    people = D.role_union(v.book(), ["user_name", "professor"], "username", ["o_orderkey"])
    return D.upsert_dim(empty(v, "DimUser"), people, ["username"], ["_role", "o_orderkey"], ci=True)


@query("date_spine", "room_name:s date:d", """
SELECT room_name, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS date
FROM (SELECT room_name, min(date) AS lo, max(date) AS hi FROM v_book GROUP BY 1)""")
def date_spine(v):
    """Every day between the first and the last booking of a room."""
    bounds = v.book().groupBy("room_name").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    return D.date_spine(bounds, "lo", "hi")


@query("time_dim", "id_time:i hour:i minute:i readings:i", """
SELECT i + 1 AS id_time, i // 4 AS hour, i % 4 * 15 AS minute, count(event_id) AS readings
FROM range(96) r(i) LEFT JOIN events ON hour(ts) * 4 + minute(ts) // 15 = i GROUP BY i""")
def time_dim(v):
    """Quarter-hour members with the readings that fall on each."""
    e = v.table("events").select(F.hour("ts").alias("hour"), (F.floor(F.minute("ts") / 15) * 15).cast("int").alias("minute"))
    per_slot = e.groupBy("hour", "minute").agg(F.count("*").alias("readings"))
    return D.time_dim(v.spark).join(per_slot, ["hour", "minute"], "left").na.fill(0, ["readings"])


@query("star_lookup", "l_orderkey:i l_linenumber:i id_date:i id_time:i id_inverter:i id_status:i energy_produced:f",
       SOLAR_DIMS_SQL + """
SELECT l_orderkey, l_linenumber, id_date, id_time, id_inverter, id_status, energy_produced FROM """ + SOLAR_JOIN_SQL)
def star_lookup(v):
    rows = cut_lineage(solar(v))
    return with_keys(v, rows, solar_dims(v, rows))


STAR = "year:i month:i day:i hour:i minute:i inverter_name:s status_name:s energy_produced:f error_count:i"


@query("star_denorm", STAR, SOLAR_DIMS_SQL + """
SELECT y AS year, m AS month, d AS day, h AS hour, mi AS minute, inverter_name, status_name, energy_produced, error_count
FROM """ + SOLAR_JOIN_SQL)
def star_denorm(v):
    rows = cut_lineage(solar(v))
    dims = solar_dims(v, rows)
    fact = with_keys(v, rows, dims).drop("inverter_name", "status_name", "date", "time")
    return marts.solar_star(fact, dims["DimDate"], dims["DimTime"], dims["DimInverter"], dims["DimStatus"])


@query("booking_type_default", "o_orderkey:i id_booking_type:i code:s booking_type:s", """WITH
typed AS (SELECT o_orderkey, CASE WHEN codes IS NULL THEN 'DEF' ELSE codes END AS code,
                 CASE WHEN codes IS NULL THEN 'Default' ELSE reservation_type END AS booking_type FROM v_book),
members AS (SELECT row_number() OVER (ORDER BY code, booking_type) AS id_booking_type, * FROM (SELECT DISTINCT code, booking_type FROM typed))
SELECT o_orderkey, id_booking_type, code, booking_type FROM typed JOIN members USING (code, booking_type)""")
def booking_type_default(v):
    rows = v.book().withColumnsRenamed({"codes": "code", "reservation_type": "booking_type"})
    rows = D.default_member(rows)
    dim = D.upsert_dim(empty(v, "DimBookingType"), rows, ["code", "booking_type"])
    return D.lookup(rows, dim, ["code", "booking_type"])


@query("fk_orphans", "l_orderkey:i l_linenumber:i date:d", """
SELECT l_orderkey, l_linenumber, date FROM v_solar WHERE date NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""")
def fk_orphans(v):
    """Readings whose day is no order day."""
    days = v.table("orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return Q.fk_orphans(solar(v), days, "day", "date")
