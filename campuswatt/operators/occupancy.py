"""Hourly occupation from bookings."""

from pyspark.sql import functions as F

from campuswatt.functions import parsing as P
from campuswatt.operators.joins import explode_hours
from campuswatt.operators.series import hour_spine, quartile_flags

COURSE = "cours"         # fixed value: activity text of a course
MOST_DIVISIONS = 1000
COURSE_HEAVY = 0.7       # fixed value: share of courses that makes an hour course-heavy


def booked_hours(bookings, date="date", start="start_time", end="end_time", with_seconds=False):
    """One row per booking and whole hour it covers. Times that do not parse drop the row.

    The strict parser rejects ``HH:MM:SS``; ``with_seconds`` accepts it.
    """
    def hours(c):
        text = F.regexp_replace(F.col(c), r"^(\d+:\d+):\d+$", "$1") if with_seconds else F.col(c)
        return P.decimal_hour(text)

    timed = bookings.withColumns({"_from": hours(start), "_to": hours(end)}).dropna(subset=[date, "_from", "_to"])
    return timed, (explode_hours(timed, F.col("_from"), F.col("_to"), "hour").filter(F.col("hour").between(0, 23))
                   .withColumn("ts", F.col(date).cast("timestamp") + F.make_dt_interval(hours=F.col("hour"))))


def _spine(timed, date):
    days = timed.agg(F.min(date).cast("timestamp").alias("_lo"), F.max(date).cast("timestamp").alias("_hi"))
    days = days.withColumn("_hi", F.col("_hi") + F.expr("interval 23 hours")).filter(F.col("_lo").isNotNull())
    return hour_spine(days, "_lo", "_hi")


def occupancy(bookings, date="date", room="room_name", activity=None, distinct_rooms=False, with_seconds=False):
    """Booked rows per hour of the span, share of the known rooms, and course counts.

    Counts booking rows (a room booked for two classes counts twice) unless
    ``distinct_rooms`` is set.
    """
    timed, hours = booked_hours(bookings, date, with_seconds=with_seconds)
    counted = F.count_distinct(room) if distinct_rooms else F.count("*")
    aggs = [counted.alias("rooms_occupied")]
    if activity:
        course = F.coalesce(F.lower(activity) == COURSE, F.lit(False))
        aggs.append(F.count_if(course).alias("course_count"))
    per_hour = hours.groupBy("ts").agg(*aggs)
    rooms = timed.agg(F.count_distinct(room)).scalar()
    out = _spine(timed, date).join(per_hour, "ts", "left").na.fill(0).withColumn("total_rooms", rooms)
    out = out.withColumn("occupation_rate", F.col("rooms_occupied") / F.greatest(F.lit(1), F.col("total_rooms")))
    if activity:
        occupied = F.when(F.col("rooms_occupied") == 0, 1).otherwise(F.col("rooms_occupied"))
        out = out.withColumn("course_ratio", F.col("course_count") / occupied)
        out = out.withColumn("is_course_heavy", (F.col("course_ratio") > COURSE_HEAVY).cast("int"))
    return out


def occupation_flags(occupied, col="occupation_rate"):
    return quartile_flags(occupied, col)


def division_values(bookings, division="division"):
    """Known divisions as (value, column name): feature metadata, read from the dimension-sized distinct."""
    rows = (bookings.select(division).dropna().distinct()
            .select(F.col(division).alias("v"), F.concat(P.slug(F.col(division)), F.lit("_count")).alias("n"))
            .orderBy("v").limit(MOST_DIVISIONS + 1).collect())
    if len(rows) > MOST_DIVISIONS:
        raise ValueError(f"more than {MOST_DIVISIONS} divisions: each would be a column")
    return [(r.v, r.n) for r in rows]


def division_counts(bookings, values, date="date", division="division"):
    """Bookings per hour and division, one column per division; hours without one count 0."""
    timed, hours = booked_hours(bookings, date)
    aggs = [F.count_if(F.coalesce(F.col(division) == v, F.lit(False))).alias(name) for v, name in values]
    return _spine(timed, date).join(hours.groupBy("ts").agg(*aggs), "ts", "left").na.fill(0)
