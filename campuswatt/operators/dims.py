"""Dimensions: get-or-create keys, lookups, date and time members."""

from functools import reduce

from pyspark.sql import functions as F

from campuswatt.functions import parsing as P
from campuswatt.operators.ordering import dedup_first, global_position

# Booking type of rows without one.
DEFAULT_BOOKING_TYPE = {"code": "DEF", "booking_type": "Default"}


def new_members(dim, src, key, order=None, ci=False):
    """Natural keys of ``src`` the dimension lacks.

    With ``ci`` the key ignores case and the stored spelling is the first one seen.
    """
    src = src.dropna(subset=list(key))
    if not ci:
        distinct = src.select(*key).distinct()
        return distinct.join(dim.select(*key), list(key), "left_anti")
    name = key[0]
    seen = src.select(name, *(order or [name])) if order else src.select(name)
    folded = dedup_first(seen.withColumn("_k", F.lower(name)), ["_k"], order or [name]).select("_k", name)
    return folded.join(dim.select(F.lower(name).alias("_k")), "_k", "left_anti").select(name)


def added_members(dim, src, key, order=None, ci=False):
    """New members with the next ids, in key order.

    Ids are dense: positions come from a distributed sort, not from one task.
    """
    id_col = next(c for c in dim.columns if c not in key)
    by = [F.lower(key[0])] if ci else list(key)
    fresh = global_position(new_members(dim, src, key, order, ci), by, into="_pos")
    last = dim.agg(F.coalesce(F.max(id_col), F.lit(0))).scalar()
    return fresh.select((last + F.col("_pos") + 1).cast(dim.schema[id_col].dataType).alias(id_col), *key)


def upsert_dim(dim, src, key, order=None, ci=False):
    """Known members keep their id, new ones get the next ids."""
    fresh = added_members(dim, src, key, order, ci)
    return dim.select(*fresh.columns).unionByName(fresh)


def lookup(fact, dim, key, on=None, into=None, ci=False):
    """Add the surrogate id of the dimension member. ``on``: fact columns or expressions matching ``key``.

    A plain left join: the planner broadcasts the dimension while its size allows
    and shuffles, with skew handling, beyond.
    """
    on = [F.col(o) if isinstance(o, str) else o for o in (on or key)]
    id_col = next(c for c in dim.columns if c not in key)
    side = dim.select(F.col(id_col).alias(into or id_col), *[
        (F.lower(k) if ci else F.col(k)).alias(f"_d_{k}") for k in key])
    matches = [(F.lower(f) if ci else f) == F.col(f"_d_{k}") for f, k in zip(on, key)]
    return fact.join(side, reduce(lambda a, b: a & b, matches), "left").drop(*[f"_d_{k}" for k in key])


def role_union(df, cols, into, order=()):
    """All names found in several role columns, one after the other."""
    parts = [df.select(F.col(c).alias(into), F.lit(i).alias("_role"), *order) for i, c in enumerate(cols)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def default_member(df, cols=("code", "booking_type"), member=None):
    """If any of the columns is missing, all take the default member."""
    member = member or DEFAULT_BOOKING_TYPE
    missing = F.lit(False)
    for c in cols:
        missing = missing | F.col(c).isNull() | (F.col(c) == "")
    return df.withColumns({c: F.when(missing, F.lit(member[c])).otherwise(F.col(c)) for c in cols})


def date_members(df, col):
    """Days of a date column; repeats go before the parsing."""
    days = df.select(col).distinct()
    return days.select(F.year(col).alias("year"), F.month(col).alias("month"), F.dayofmonth(col).alias("day"))


def time_members(df, col):
    """Minutes of a clock text column; repeats go before the parsing."""
    hour, minute = P.time_parts(F.col(col))
    return df.select(col).distinct().select(hour.alias("hour"), minute.alias("minute"))


def lookup_date(fact, dim_date, col, into="id_date"):
    """Id of the day of a DATE column or ISO text."""
    d = F.col(col).try_cast("date")
    return lookup(fact, dim_date, ["year", "month", "day"], [F.year(d), F.month(d), F.dayofmonth(d)], into)


def lookup_time(fact, dim_time, col, into="id_time"):
    """Id of the minute of a clock text. The text is split once, in a column: join keys would split it for every use."""
    hour, minute = P.clock_parts(F.col("_words"))
    parsed = (fact.withColumn("_words", F.split(col, ":")).withColumns({"_hour": hour, "_minute": minute}).drop("_words"))
    return lookup(parsed, dim_time, ["hour", "minute"], ["_hour", "_minute"], into).drop("_hour", "_minute")


def date_spine(bounds, start, end, into="date"):
    """Every day from ``start`` to ``end`` inclusive, for each row of ``bounds``."""
    days = F.sequence(F.col(start), F.col(end), F.expr("interval 1 day"))
    return bounds.withColumn(into, F.explode(days)).drop(start, end)


def time_dim(spark, minutes=15):
    """Clock members every ``minutes`` minutes of a day."""
    slots = 24 * 60 // minutes
    return spark.range(slots).select(
        (F.col("id") + 1).cast("int").alias("id_time"),
        F.floor(F.col("id") * minutes / 60).cast("int").alias("hour"),
        (F.col("id") * minutes % 60).cast("int").alias("minute"))
