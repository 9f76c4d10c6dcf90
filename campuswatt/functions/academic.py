"""Academic calendar: one row per day with period flags, holidays and week codes."""

from pyspark.sql import functions as F

# Periods of the academic year 2022-2023 (first day, last day, kind).
PERIODS = [
    ("2022-09-19", "2022-12-20", "autumn_semester"),
    ("2022-12-21", "2023-01-04", "christmas_holiday"),
    ("2023-01-05", "2023-01-17", "autumn_semester"),
    ("2023-01-18", "2023-01-28", "exam_period"),
    ("2023-01-29", "2023-02-19", "between_semesters"),
    ("2023-02-20", "2023-04-06", "spring_semester"),
    ("2023-04-07", "2023-04-16", "easter_holiday"),
    ("2023-04-17", "2023-05-17", "spring_semester"),
    ("2023-05-18", "2023-05-20", "ascension"),
    ("2023-05-21", "2023-06-20", "spring_semester"),
    ("2023-06-21", "2023-07-01", "exam_period"),
    ("2023-07-02", "2023-09-18", "summer_break"),
]

# Single holidays.
HOLIDAYS = [
    ("2022-11-01", "Toussaint"),
    ("2022-12-08", "Immaculée conception"),
    ("2023-05-29", "Lundi de Pentecôte"),
    ("2023-06-08", "Fête Dieu"),
]

# First days of runs of teaching weeks (Monday to Saturday) and their codes.
WEEK_RUNS = [
    ("A", 0, "2022-09-12", 15),
    ("A", 15, "2023-01-02", 2),
    ("P", 1, "2023-02-20", 8),
    ("P", 9, "2023-04-24", 8),
]

FIRST_DAY, LAST_DAY = "2022-09-01", "2023-09-30"

# Flags each kind of period sets.
FLAGS = {
    "is_semester_period": {"autumn_semester", "spring_semester"},
    "is_autumn_semester": {"autumn_semester"},
    "is_spring_semester": {"spring_semester"},
    "is_holiday_period": {"christmas_holiday", "easter_holiday", "summer_break", "ascension"},
    "is_christmas_holiday": {"christmas_holiday"},
    "is_easter_holiday": {"easter_holiday"},
    "is_summer_break": {"summer_break"},
    "is_between_semesters": {"between_semesters"},
    "is_exam_period": {"exam_period"},
    "is_ascension": {"ascension"},
}


def _days(df, first, last):
    return df.withColumn("date", F.explode(F.sequence(F.col(first), F.col(last), F.expr("interval 1 day"))))


def academic_calendar(spark, periods=PERIODS, holidays=HOLIDAYS, week_runs=WEEK_RUNS,
                      first_day=FIRST_DAY, last_day=LAST_DAY):
    """Each period is spread over its days, so that the lookup is an equi-join on the date."""
    spine = spark.sql(f"SELECT explode(sequence(DATE'{first_day}', DATE'{last_day}', INTERVAL 1 DAY)) AS date")

    kinds = _days(spark.createDataFrame(periods, "first string, last string, kind string")
                  .select(F.to_date("first").alias("first"), F.to_date("last").alias("last"), "kind"),
                  "first", "last")
    flags = kinds.groupBy("date").agg(*[
        F.max(F.col("kind").isin(*sorted(members)).cast("int")).alias(flag) for flag, members in FLAGS.items()])

    days_off = (spark.createDataFrame(holidays, "date string, holiday_name string")
                .select(F.to_date("date").alias("date"), "holiday_name"))

    runs = spark.createDataFrame(week_runs, "term string, number int, monday string, weeks int")
    weeks = (runs.select("*", F.posexplode(F.sequence(F.lit(0), F.col("weeks") - 1)).alias("i", "_n"))
             .select(F.concat("term", (F.col("number") + F.col("i")).cast("string")).alias("academic_week"),
                     F.date_add(F.to_date("monday"), 7 * F.col("i")).alias("first"))
             .withColumn("last", F.date_add("first", 5)))
    weeks = _days(weeks, "first", "last").select("date", "academic_week")

    out = spine.join(flags, "date", "left").join(days_off, "date", "left").join(weeks, "date", "left")
    holiday = F.col("holiday_name").isNotNull()
    cols = [F.col("date")]
    for flag in FLAGS:
        value = F.coalesce(F.col(flag), F.lit(0))
        if flag == "is_holiday_period":
            value = F.greatest(value, holiday.cast("int"))
        cols.append(value.alias(flag))
    cols += [holiday.cast("int").alias("is_holiday"),
             F.coalesce("holiday_name", F.lit("")).alias("holiday_name"),
             (F.weekday("date") >= 5).cast("int").alias("is_weekend"),
             F.coalesce("academic_week", F.lit("")).alias("academic_week")]
    return out.select(*cols)
