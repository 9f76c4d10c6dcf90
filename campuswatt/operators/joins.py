"""Joins of facts, forecasts, bookings and calendars."""

from functools import reduce

from pyspark.sql import functions as F

from campuswatt.operators.ordering import dedup_first, dedup_last
from campuswatt.operators.series import daylight


def union_feeds(*dfs):
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def not_in(a, b, key):
    return a.join(b.select(*key), list(key), "left_anti")


def star_join(fact, dims, order=()):
    """Inner equi-join of a fact with its dimensions; ``dims``: [(table, key column)]."""
    for dim, key in dims:
        fact = fact.join(dim, key)
    return fact.orderBy(*order) if order else fact


def left_merge(left, right, on, suffix):
    """Left join; right columns the left side has too get the suffix."""
    clash = {c: c + suffix for c in right.columns if c in left.columns and c not in on}
    return left.join(right.withColumnsRenamed(clash), list(on), "left")


def hourly_merge(consumption, weather, rooms, calendar, ts="ts"):
    """Consumption rows with weather and occupation of their hour and the calendar of their day."""
    out = left_merge(consumption, weather, [ts], "_weather")
    out = left_merge(out, rooms, [ts], "_room")
    out = out.withColumn("date", F.to_date(ts))
    return left_merge(out, calendar, ["date"], "_cal").drop("date")


def floor_join(fact, forecast, cols, order, ts="ts", fc_ts="target_ts", unit="hour"):
    """Each fact row with the latest forecast of its hour, daylight hours only."""
    per_hour = dedup_last(forecast.withColumn("_hour", F.date_trunc(unit, fc_ts)), ["_hour"], order)
    out = fact.withColumn("_hour", F.date_trunc(unit, ts)).join(per_hour.select("_hour", *cols), "_hour", "left")
    return daylight(out.drop("_hour"), ts)


def outer_merge(a, b, on):
    return a.join(b, list(on), "full_outer")


def lookup_first(a, b, key, value, into, order):
    """Value of the first matching row of ``b``."""
    first = dedup_first(b, key, order)
    return a.join(first.select(*key, F.col(value).alias(into)), list(key), "left")


def explode_hours(df, start, end, into="hour"):
    """One row per whole hour h with start <= h < end (decimal hours).

    Rows cover at most 24 hours of one day, and the equi-join that follows needs
    no range condition. An interval without a whole hour yields nothing.
    """
    lo, hi = F.ceil(start), F.ceil(end) - 1
    hours = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn("_h", F.explode(hours)).withColumn(into, F.col("_h").cast("int")).drop("_h")


def explode_days(df, start, end, into="date"):
    """One row per day of a closed interval of dates."""
    valid = df.filter(F.col(start) <= F.col(end))
    return valid.withColumn(into, F.explode(F.sequence(F.col(start), F.col(end), F.expr("interval 1 day"))))
