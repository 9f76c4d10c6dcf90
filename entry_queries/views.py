"""The driver's tables seen as the feeds of the library, for Spark and for DuckDB.

=========== ========================= =================================================
view        table                     seen as
=========== ========================= =================================================
inv         lineitem                  inverter readings; the line's columns give the order
meteo       events                    long weather forecasts in 6-hour steps
meter       events                    consumption, temperature, humidity per user and hour
book        orders, customer          room bookings
series      events                    hourly series per event type and user group, with gaps
drops       events                    one drop file per user, day and type
=========== ========================= =================================================

Exact halves round up in Spark's ``round``; the SQL adds 1e-9 where a result is rounded to mills.
"""

from pyspark.sql import functions as F

from campuswatt.operators.series import hour_spine

INV_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
INV_ORDER_SQL = ", ".join(INV_ORDER)

MEASURE_OF = {"click": "PRED_T_2M_ctrl", "view": "PRED_RELHUM_2M_ctrl", "purchase": "PRED_TOT_PREC_ctrl",
              "signup": "PRED_GLOB_ctrl", "error": "PRED_OTHER"}
MEASURES = list(MEASURE_OF.values())

SQL_VIEWS = {
    "v_inv": """
SELECT CAST(l_shipdate AS DATE) AS "Date",
       lpad(CAST(l_orderkey % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST(l_linenumber * 5 AS VARCHAR), 2, '0') || ':00' AS "Time",
       CAST(l_shipdate AS DATE) + to_hours(l_orderkey % 24) + to_minutes(l_linenumber * 5) AS ts,
       'INV' || CAST(l_suppkey % 8 AS VARCHAR) AS "INV", CAST(l_linenumber % 7 AS VARCHAR) AS "Status",
       l_extendedprice AS "Pac", l_quantity AS "DaySum", CAST(l_partkey % 3 AS INT) AS "Error", lineitem.*
FROM lineitem""",
    "v_solar": """
SELECT "Date" AS date, "Time" AS time, ts, "INV" AS inverter_name, "Status" AS status_name,
       "DaySum" AS total_energy_produced, round("Pac" * 5 / 60 / 1000 + 1e-9, 3) AS energy_produced,
       "Error" AS error_count, """ + INV_ORDER_SQL + """
FROM v_inv""",
    "v_meteo": """
SELECT event_id, user_id,
       CASE user_id % 3 WHEN 0 THEN 'Sion' WHEN 1 THEN 'Visp' ELSE 'Other' END AS "Site",
       date_trunc('day', ts) + to_hours(CAST(hour(ts) // 6 * 6 AS BIGINT)) AS ts, CAST(user_id % 4 AS INT) AS "Prediction",
       CASE event_type """ + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MEASURE_OF.items()) + """ END AS "Measurement",
       CASE WHEN event_id % 17 = 0 THEN -99999.0 ELSE value END AS "Value"
FROM events""",
    "v_wide": """
SELECT "Site", "Prediction", ts, """ + ", ".join(
        f"""arg_min(v, event_id) FILTER (WHERE "Measurement" = '{m}') AS "{m}\"""" for m in MEASURES) + """
FROM (SELECT *, CASE WHEN "Value" = -99999.0 THEN 0.0 ELSE "Value" END AS v FROM v_meteo WHERE "Site" IN ('Sion', 'Visp'))
GROUP BY ALL""",
    "v_meter": """
SELECT event_id, user_id, date_trunc('hour', ts) AS ts, event_type, value FROM events""",
    "v_book": """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date,
       lpad(CAST(7 + o_orderkey % 12 AS VARCHAR), 2, '0') || CASE WHEN o_orderkey % 5 = 0 THEN ':30' ELSE ':00' END AS start_time,
       lpad(CAST(8 + o_orderkey % 12 + o_custkey % 3 AS VARCHAR), 2, '0') || ':00' AS end_time,
       CASE WHEN o_custkey % 5 = 4 THEN 'VS-OTH-' ELSE 'VS-BEL-' END || CAST(o_custkey % 20 AS VARCHAR) AS room_name,
       CASE WHEN o_orderkey % 50 = 7 THEN NULL ELSE c_name END AS user_name,
       CASE WHEN o_orderkey % 40 = 3 THEN ' , ' WHEN o_orderkey % 40 = 9 THEN NULL
            ELSE o_orderpriority || ' , ' || o_orderstatus END AS class,
       c_mktsegment || ', ' || c_name AS professor,
       CASE o_orderstatus WHEN 'F' THEN 'Cours' ELSE 'Autre' END AS activity, o_orderpriority AS division,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS codes, c_mktsegment AS reservation_type
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "v_span": """
SELECT date_trunc('hour', min(ts)) AS lo, date_trunc('hour', max(ts)) AS hi FROM events""",
    "v_names": """
SELECT DISTINCT event_type || '-' || CAST(user_id % 8 AS VARCHAR) AS series FROM events""",
    "v_spine": """
SELECT series, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM v_names, v_span""",
    "v_known": """
SELECT event_type || '-' || CAST(user_id % 8 AS VARCHAR) AS series, date_trunc('hour', ts) AS ts, max(value) AS value
FROM events GROUP BY ALL""",
    "v_series": """
SELECT series, ts, value FROM v_spine LEFT JOIN v_known USING (series, ts)""",
    "v_actual": """
SELECT date_trunc('hour', ts) AS ts,
       sum(CASE WHEN event_type = 'click' THEN value ELSE 0 END) AS actual,
       sum(CASE WHEN event_type = 'view' THEN value ELSE 0 END) AS predicted
FROM events GROUP BY ALL""",
    "v_drops": """
SELECT DISTINCT CAST(ts AS DATE) AS day, user_id,
       CASE event_type WHEN 'click' THEN strftime(ts, '%d.%m.%Y') || '-Consumption'
                       WHEN 'view' THEN strftime(ts, '%d.%m.%Y') || '-Temperature'
                       WHEN 'signup' THEN strftime(ts, '%d.%m.%Y') || '-Humidity'
                       WHEN 'purchase' THEN CASE user_id % 3 WHEN 0 THEN 'min' || strftime(ts, '%y%m%d')
                            WHEN 1 THEN strftime(ts, '%d.%m.%Y') || '-PV' ELSE 'Pred_' || strftime(ts, '%Y-%m-%d') END
                       ELSE CASE user_id % 2 WHEN 0 THEN 'RoomAllocations_' || strftime(ts, '%Y%m%d')
                            ELSE 'notes_' || strftime(ts, '%Y_%m_%d') END END
       || CASE WHEN user_id % 11 = 0 THEN '.txt' ELSE '.csv' END AS name
FROM events""",
}


class Views:
    """Spark side of the views over one data folder."""

    def __init__(self, spark, sf_dir):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name):
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return df.withColumns({f.name: F.col(f.name).cast("timestamp") for f in df.schema.fields
                               if f.dataType.typeName() == "timestamp_ntz"})

    def inv(self):
        li = self.table("lineitem")
        hour, minute = F.col("l_orderkey") % 24, F.col("l_linenumber") * 5
        return li.select(
            F.to_date("l_shipdate").alias("Date"),
            F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":"), F.lpad(minute.cast("string"), 2, "0"),
                     F.lit(":00")).alias("Time"),
            (F.col("l_shipdate") + F.make_dt_interval(hours=hour.cast("int"), mins=minute.cast("int"))).alias("ts"),
            F.concat(F.lit("INV"), (F.col("l_suppkey") % 8).cast("string")).alias("INV"),
            (F.col("l_linenumber") % 7).cast("string").alias("Status"),
            F.col("l_extendedprice").alias("Pac"), F.col("l_quantity").alias("DaySum"),
            (F.col("l_partkey") % 3).cast("int").alias("Error"), *li.columns)

    def meteo(self):
        e = self.table("events")
        site = F.when(F.col("user_id") % 3 == 0, "Sion").when(F.col("user_id") % 3 == 1, "Visp").otherwise("Other")
        names = F.create_map(*[F.lit(x) for pair in MEASURE_OF.items() for x in pair])
        step = F.make_dt_interval(hours=F.floor(F.hour("ts") / 6).cast("int") * 6)
        return e.select(
            "event_id", "user_id", site.alias("Site"), (F.date_trunc("day", "ts") + step).alias("ts"),
            (F.col("user_id") % 4).cast("int").alias("Prediction"),
            F.element_at(names, F.col("event_type")).alias("Measurement"),
            F.when(F.col("event_id") % 17 == 0, -99999.0).otherwise(F.col("value")).alias("Value"))

    def meter(self):
        return self.table("events").withColumn("ts", F.date_trunc("hour", "ts")).drop("props")

    def book(self):
        o, c = self.table("orders"), self.table("customer")
        k, cust = F.col("o_orderkey"), F.col("o_custkey")
        first = F.lpad((7 + k % 12).cast("string"), 2, "0")
        last = F.lpad((8 + k % 12 + cust % 3).cast("string"), 2, "0")
        return o.join(c, cust == F.col("c_custkey")).select(
            "o_orderkey", F.to_date("o_orderdate").alias("date"),
            F.concat(first, F.when(k % 5 == 0, ":30").otherwise(":00")).alias("start_time"),
            F.concat(last, F.lit(":00")).alias("end_time"),
            F.concat(F.when(cust % 5 == 4, "VS-OTH-").otherwise("VS-BEL-"), (cust % 20).cast("string")).alias("room_name"),
            F.when(k % 50 != 7, F.col("c_name")).alias("user_name"),
            F.when(k % 40 == 3, " , ").when(k % 40 == 9, F.lit(None)).otherwise(
                F.concat("o_orderpriority", F.lit(" , "), "o_orderstatus")).alias("class"),
            F.concat("c_mktsegment", F.lit(", "), "c_name").alias("professor"),
            F.when(F.col("o_orderstatus") == "F", "Cours").otherwise("Autre").alias("activity"),
            F.col("o_orderpriority").alias("division"),
            F.when(k % 7 != 0, F.col("o_orderstatus")).alias("codes"),
            F.col("c_mktsegment").alias("reservation_type"))

    def span(self):
        e = self.table("events")
        return e.agg(F.date_trunc("hour", F.min("ts")).alias("lo"), F.date_trunc("hour", F.max("ts")).alias("hi"))

    def series_known(self):
        e = self.table("events")
        name = F.concat("event_type", F.lit("-"), (F.col("user_id") % 8).cast("string")).alias("series")
        return e.groupBy(name, F.date_trunc("hour", "ts").alias("ts")).agg(F.max("value").alias("value"))

    def series(self):
        known, span = self.series_known(), self.span()
        names = known.select("series").distinct().withColumns({
            "lo": span.select("lo").scalar(), "hi": span.select("hi").scalar()})
        return hour_spine(names, "lo", "hi").join(known, ["series", "ts"], "left")

    def actual(self):
        def total(kind):
            return F.sum(F.when(F.col("event_type") == kind, F.col("value")).otherwise(0.0))

        return self.table("events").groupBy(F.date_trunc("hour", "ts").alias("ts")).agg(
            total("click").alias("actual"), total("view").alias("predicted"))

    def drops(self):
        def day(fmt):
            return F.date_format("ts", fmt)

        t, u = F.col("event_type"), F.col("user_id")
        name = (F.when(t == "click", F.concat(day("dd.MM.yyyy"), F.lit("-Consumption")))
                .when(t == "view", F.concat(day("dd.MM.yyyy"), F.lit("-Temperature")))
                .when(t == "signup", F.concat(day("dd.MM.yyyy"), F.lit("-Humidity")))
                .when((t == "purchase") & (u % 3 == 0), F.concat(F.lit("min"), day("yyMMdd")))
                .when((t == "purchase") & (u % 3 == 1), F.concat(day("dd.MM.yyyy"), F.lit("-PV")))
                .when(t == "purchase", F.concat(F.lit("Pred_"), day("yyyy-MM-dd")))
                .when(u % 2 == 0, F.concat(F.lit("RoomAllocations_"), day("yyyyMMdd")))
                .otherwise(F.concat(F.lit("notes_"), day("yyyy_MM_dd"))))
        ending = F.when(u % 11 == 0, ".txt").otherwise(".csv")
        return self.table("events").select(F.to_date("ts").alias("day"), "user_id",
                                           F.concat(name, ending).alias("name")).distinct()
