"""Time-series operators.

``df`` holds one row per (keys, ts). A whole series never has to fit one task:
windows run per calendar bucket, and what a bucket needs from its neighbours
travels through a table with one row per bucket.
"""

import math

from pyspark.sql import Window as W, functions as F

from campuswatt.operators.ordering import (FEW_ROWS, _as_cols, bucketed, cell, dedup_first, dedup_last,
                                           series_position, with_halo)


def hour_spine(bounds, start, end, into="ts", step="1 hour"):
    """One row per step from ``start`` to ``end`` inclusive, for each row of ``bounds``.

    Hours come day by day, so that a long span is no long array in one row.
    """
    if step == "1 hour":
        last = F.floor((F.unix_seconds(F.col(end).cast("timestamp")) - F.unix_seconds(F.col(start).cast("timestamp"))) / 3600)
        days = bounds.withColumn("_last", last).filter("_last >= 0").withColumn("_day", F.explode(F.sequence(F.lit(0), F.floor(F.col("_last") / 24))))
        hours = days.withColumn("_hour", F.explode(F.sequence(F.col("_day") * 24, F.least(F.col("_day") * 24 + 23, F.col("_last")))))
        return (hours.withColumn(into, F.col(start) + F.make_dt_interval(hours=F.col("_hour").cast("int")))
                .drop(start, end, "_last", "_day", "_hour"))
    return (bounds.withColumn(into, F.explode(F.sequence(F.col(start), F.col(end), F.expr(f"interval {step}"))))
            .drop(start, end))


def lag_diff(df, col, keys, ts, into):
    """Difference to the row before."""
    halo = with_halo(series_position(df, keys, ts), keys, "_pos", 1)
    w = W.partitionBy(*keys, "_chunk").orderBy("_pos")
    return (halo.withColumn(into, F.col(col) - F.lag(col).over(w))
            .filter("NOT _halo").drop("_chunk", "_halo", "_pos", "_bucket"))


def rolling_sum(df, col, n, keys, ts, into):
    """Sum over the last ``n`` rows (fewer at the start)."""
    halo = with_halo(series_position(df, keys, ts), keys, "_pos", n - 1)
    w = W.partitionBy(*keys, "_chunk").orderBy("_pos").rowsBetween(-(n - 1), 0)
    return (halo.withColumn(into, F.sum(col).over(w))
            .filter("NOT _halo").drop("_chunk", "_halo", "_pos", "_bucket"))


def daily_amplitude(df, col, keys, ts, into, min_rows=24):
    """Max minus min of the day, on every row of the day; only for series of at least ``min_rows`` rows."""
    df = df.withColumn("_day", F.to_date(ts))
    per_day = df.groupBy(*keys, "_day").agg(
        (F.max(col) - F.min(col)).alias(into), F.count("*").alias("_n"))
    series_rows = F.sum("_n").over(W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0)))
    per_day = per_day.withColumn(into, F.when(series_rows >= min_rows, F.col(into))).drop("_n")
    per_day = per_day.select(cell(*keys, "_day").alias("_cell"), into)
    return df.withColumn("_cell", cell(*keys, "_day")).join(per_day, "_cell").drop("_day", "_cell")


def _neighbours(df, cols, keys, ts, bucket):
    """Add ``_prev_c``/``_next_c``: (row axis, value) of the nearest non-null at or before/after the row."""
    by_bucket = [*keys, "_bucket"]
    known = {c: F.when(F.col(c).isNotNull(), F.struct(F.col("_axis").alias("at"), F.col(c).alias("v"))) for c in cols}
    df = df.withColumns({f"_known_{c}": k for c, k in known.items()})
    edges = df.groupBy(*by_bucket).agg(*[
        agg for c in cols for agg in (F.max(f"_known_{c}").alias(f"_last_{c}"), F.min(f"_known_{c}").alias(f"_first_{c}"))])
    along = W.partitionBy(*keys).orderBy("_bucket")
    left, right = along.rowsBetween(W.unboundedPreceding, -1), along.rowsBetween(1, W.unboundedFollowing)
    carries = edges.select(*by_bucket, *[
        carry for c in cols for carry in (
            F.last(f"_last_{c}", ignorenulls=True).over(left).alias(f"_in_{c}"),
            F.first(f"_first_{c}", ignorenulls=True).over(right).alias(f"_out_{c}"))])
    inside = W.partitionBy("_cell").orderBy(ts)
    past, future = inside.rowsBetween(W.unboundedPreceding, 0), inside.rowsBetween(0, W.unboundedFollowing)
    carries = carries.withColumn("_cell", cell(*by_bucket)).drop(*by_bucket)
    out = df.withColumn("_cell", cell(*by_bucket)).repartition("_cell").join(carries, "_cell")
    out = out.withColumns({
        name: value for c in cols for name, value in (
            (f"_prev_{c}", F.coalesce(F.last(f"_known_{c}", ignorenulls=True).over(past), F.col(f"_in_{c}"))),
            (f"_next_{c}", F.coalesce(F.first(f"_known_{c}", ignorenulls=True).over(future), F.col(f"_out_{c}"))))})
    return out.drop("_cell", *[f"_{kind}_{c}" for kind in ("known", "in", "out") for c in cols])


def _clean(df, cols):
    return df.drop("_axis", "_bucket", "_pos", *[f"_{kind}_{c}" for kind in ("prev", "next") for c in cols])


def _interpolate(df, cols, keys, ts, bucket):
    df = _neighbours(df, cols, keys, ts, bucket)
    filled = {}
    for c in cols:
        p, n = F.col(f"_prev_{c}"), F.col(f"_next_{c}")
        share = (F.col("_axis") - p["at"]) / (n["at"] - p["at"])
        filled[c] = (F.when(F.col(c).isNotNull(), F.col(c))
                     .when(p.isNotNull() & n.isNotNull(), p["v"] + (n["v"] - p["v"]) * share)
                     .otherwise(F.coalesce(p["v"], n["v"])))
    return _clean(df.withColumns(filled), cols)


def interp_linear(df, cols, keys, ts, bucket="month"):
    """Fill gaps on a straight line over row positions; ends take the nearest value."""
    df = series_position(df, keys, ts, bucket).withColumn("_axis", F.col("_pos").cast("double"))
    return _interpolate(df, cols, keys, ts, bucket)


def interp_time(df, cols, keys, ts, bucket="month"):
    """Fill gaps on a straight line over time; ends take the nearest value."""
    df = bucketed(df, ts, bucket).withColumn("_axis", F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(1e6))
    return _interpolate(df, cols, keys, ts, bucket)


def fill(df, cols, keys, ts, how="ffill_bfill", bucket="month"):
    """Copy neighbours into gaps: ``ffill``, ``bfill`` or one after the other."""
    df = bucketed(df, ts, bucket).withColumn("_axis", F.unix_micros(F.col(ts).cast("timestamp")))
    df = _neighbours(df, cols, keys, ts, bucket)
    order = {"ffill": ["prev"], "bfill": ["next"], "ffill_bfill": ["prev", "next"], "bfill_ffill": ["next", "prev"]}[how]
    return _clean(df.withColumns({c: F.coalesce(*[F.col(f"_{side}_{c}")["v"] for side in order]) for c in cols}), cols)


def mode_of(df, col):
    """Most frequent value of ``col``; the smallest one on a tie. One row."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("_n"))
    return counts.agg(F.min_by(col, F.struct(-F.col("_n"), F.col(col))).alias(col))


def mode_fill(df, col, default=""):
    """Replace NULL by the most frequent value."""
    return df.withColumn(col, F.coalesce(F.col(col), mode_of(df, col).scalar(), F.lit(default)))


def group_mean_fill(df, col, by):
    """Replace NULL by the mean of the group (``by``: column expressions or names)."""
    by = {f"_g{i}": b for i, b in enumerate(_as_cols(by))}
    df = df.withColumns(by).withColumn("_cell", cell(*by))
    means = df.groupBy("_cell").agg(F.avg(col).alias("_mean"))
    return df.join(means, "_cell").withColumn(col, F.coalesce(col, "_mean")).drop("_mean", "_cell", *by)


def daily_resample(df, col, keys, ts, into=None):
    """Sum per day; days without rows between the first and the last one count 0."""
    into = into or col
    daily = df.groupBy(*keys, F.to_date(ts).alias("date")).agg(F.coalesce(F.sum(col), F.lit(0.0)).alias(into))
    bounds = daily.groupBy(*keys).agg(F.min("date").alias("_lo"), F.max("date").alias("_hi"))
    spine = hour_spine(bounds, "_lo", "_hi", into="date", step="1 day")
    return spine.join(daily, [*keys, "date"], "left").withColumn(into, F.coalesce(into, F.lit(0.0)))


def daylight(df, ts="ts", lo=6, hi=19):
    """Rows of daylight hours; all rows if there are none."""
    inside = F.hour(ts).between(lo, hi)
    any_inside = df.agg(F.coalesce(F.max(inside.cast("int")), F.lit(0))).scalar()
    return df.filter(inside | (any_inside == 0))


def daylight_daily(df, cols, keys=(), ts="ts", lo=6, hi=19):
    """Daily forecast features from daylight hours: rain adds up, the rest is averaged."""
    aggs = [(F.sum(c) if "prec" in c.lower() or "rain" in c.lower() else F.avg(c)).alias(c) for c in cols]
    return df.filter(F.hour(ts).between(lo, hi)).groupBy(*keys, F.to_date(ts).alias("date")).agg(*aggs)


# --- inverters and forecasts ------------------------------------------------------

RUNNING = 6          # fixed value: status code of a running inverter
WATT_LIMIT = 100     # above this maximum the plant power is in W, not kW
WATT_HOUR_LIMIT = 1000


def _scaled(df, col, limit):
    """Divide by 1000 if the largest value shows that the unit is the small one."""
    largest = df.agg(F.max(col)).scalar()
    return df.withColumn(col, F.when(largest > limit, F.col(col) / 1000).otherwise(F.col(col)))


def plant_power(inv, ts="ts", pac="pac", status="status"):
    """Power of all inverters per timestamp and how many of them run."""
    running = F.coalesce(F.col(status).cast("string") == str(RUNNING), F.lit(False))
    out = inv.groupBy(ts).agg(F.sum(pac).alias("pv_output"), F.count_if(running).alias("running"))
    return _scaled(out, "pv_output", WATT_LIMIT)


def daily_energy(inv, order, ts="ts", inverter="inv", daysum="daysum"):
    """Last known day counter of each inverter, added up per day."""
    counters = inv.filter(F.col(daysum).isNotNull()).withColumn("date", F.to_date(ts))
    last = dedup_last(counters, ["date", inverter], [ts, *order])
    return _scaled(last.groupBy("date").agg(F.sum(daysum).alias("pv_output")), "pv_output", WATT_HOUR_LIMIT)


def best_forecast(fc, key, order, horizon="prediction", site=None):
    """Row with the highest horizon per key (and site); the first in order on a tie."""
    keys = [*key, site] if site else list(key)
    return dedup_first(fc, keys, [F.col(horizon).desc(), *order])


def target_time(fc, ts="ts", horizon="prediction", cutoff=None, into="target_ts"):
    """Time the forecast is for; ``cutoff`` drops forecasts for later times."""
    out = fc.withColumn(into, F.col(ts) + F.make_dt_interval(hours=F.col(horizon).cast("int")))
    return out if cutoff is None else out.filter(F.col(into) <= cutoff)


def hour_fallback(fc, spine, cols, order, ts="ts", horizon="prediction"):
    """Forecast of each spine hour: the row of that hour of day with the highest horizon, else the mean."""
    by_hour = dedup_first(fc.withColumn("_h", F.hour(ts)), ["_h"], [F.col(horizon).desc(), *order]).select("_h", *cols)
    out = spine.withColumn("_h", F.hour(ts)).join(by_hour.withColumn("_hit", F.lit(True)), "_h", "left")
    filled = {c: F.when(F.col("_hit"), F.col(c)).otherwise(F.coalesce(fc.agg(F.avg(c)).scalar(), F.lit(0.0)))
              for c in cols}
    return out.withColumns(filled).drop("_h", "_hit")


# --- statistics --------------------------------------------------------------------

SKETCH = 10_000      # accuracy of the approximate quantiles that set the brackets


def _brackets(values, ranks, few):
    """(n, {rank: value or (lo, hi, rank inside)}) for 0-based ranks ``ranks(n)`` of the sorted values.

    A rank's bracket comes from approximate quantiles and is counted; a rank that meets the lower or upper end
    has its value. What lies strictly between is the next bracket while it is more than ``few`` values, so a
    column of many equal values narrows as fast as any other. Each turn is two passes that keep a few numbers.
    """
    n = values.count()
    found, todo = {}, {}
    for r in sorted(set(ranks(n))):
        if n <= few:
            found[r] = (None, None, r)
        else:
            todo[r] = (None, None, r, n)        # open ends, place among the values between, their number
    share = 2 / SKETCH
    while todo:
        inside = {r: _between(lo, hi) for r, (lo, hi, *_) in todo.items()}
        cuts = {r: [max(at / size - share, 0.0), min((at + 1) / size + share, 1.0)] for r, (_, _, at, size) in todo.items()}
        ends = values.agg(*[F.percentile_approx(F.when(inside[r], F.col("_v")), cuts[r], SKETCH).alias(str(r)) for r in todo]).first()
        counts = []
        for r in todo:
            lo, hi = (F.lit(v) for v in ends[str(r)])
            counts += [F.count_if(inside[r] & (F.col("_v") < lo)).alias(f"{r}_below"), F.count_if(F.col("_v") == lo).alias(f"{r}_lo"),
                       F.count_if(inside[r] & (F.col("_v") < hi)).alias(f"{r}_upto"), F.count_if(F.col("_v") == hi).alias(f"{r}_hi")]
        counted, missed = values.agg(*counts).first(), False
        for r, (old_lo, old_hi, at, size) in list(todo.items()):
            lo, hi = ends[str(r)]
            first = counted[f"{r}_below"] + counted[f"{r}_lo"]
            between = max(counted[f"{r}_upto"] - first, 0)
            if counted[f"{r}_below"] <= at < first:
                found[r] = lo
            elif first <= at < first + between:
                todo[r] = (lo, hi, at - first, between)
                if between <= few:
                    found[r] = (lo, hi, at - first)
            elif lo != hi and first + between <= at < first + between + counted[f"{r}_hi"]:
                found[r] = hi
            else:
                missed = True
        todo = {r: b for r, b in todo.items() if r not in found}
        share = min(share * 4, 1.0) if missed else share
    return n, found


def _between(lo, hi):
    inside = F.lit(True)
    if lo is not None:
        inside = inside & (F.col("_v") > lo)
    return inside if hi is None else inside & (F.col("_v") < hi)


def quantiles(df, col, probabilities, few=FEW_ROWS):
    """Exact quantiles with linear interpolation, one row with ``q0, q1, ...``.

    Values are selected by rank, not sorted: brackets around the wanted ranks narrow until ``few`` values are
    left in each, and only these are put in order. NULL counts nowhere; without values the quantiles are NULL.
    """
    values = df.filter(F.col(col).isNotNull()).select(F.col(col).alias("_v"))
    places = lambda n: {r for p in probabilities for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))} if n else ()
    n, found = _brackets(values, places, few)
    if not n:
        return values.agg(*[F.max("_v").cast("double").alias(f"q{i}") for i in range(len(probabilities))])
    lists = {(lo, hi): F.sort_array(F.collect_list(F.when(_between(lo, hi), F.col("_v"))))
             for lo, hi, _ in (b for b in found.values() if isinstance(b, tuple))}
    names = {bracket: f"_list{i}" for i, bracket in enumerate(lists)}
    row = values.agg(F.count("*").alias("_n"), *[lists[b].alias(names[b]) for b in lists])

    def value(r):
        known = found[r]
        return F.get(F.col(names[known[:2]]), F.lit(known[2])) if isinstance(known, tuple) else F.lit(known)

    out = []
    for i, p in enumerate(probabilities):
        rank = p * (n - 1)
        lo, hi = value(math.floor(rank)), value(math.ceil(rank))
        out.append((lo + (hi - lo) * F.lit(rank - math.floor(rank))).alias(f"q{i}"))
    return row.select(*out)


def quartile_flags(df, col, high="is_high_occupation", low="is_low_occupation"):
    """Above the upper / below the lower quartile of the column."""
    bounds = quantiles(df, col, [0.75, 0.25]).select(F.struct("q0", "q1")).scalar()
    return df.withColumns({
        high: F.coalesce(F.col(col) > bounds["q0"], F.lit(False)).cast("int"),
        low: F.coalesce(F.col(col) < bounds["q1"], F.lit(False)).cast("int")})


def corr_matrix(df, cols):
    """Correlation of every pair of columns, long form, in one pass over the data."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = df.agg(*[F.corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    entries = [F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"`{i}`").alias("corr"))
               for i, (a, b) in enumerate(pairs) for x, y in ({(a, b), (b, a)})]
    return row.select(F.inline(F.array(*entries)))
