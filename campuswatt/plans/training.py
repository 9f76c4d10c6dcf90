"""Feature frames, training and scoring of the two forecast models."""

from datetime import timedelta

from pyspark.sql import functions as F

from campuswatt.functions import academic, features as G, parsing as P
from campuswatt.operators import joins as J, modelling as MO, occupancy as O, series as E
from campuswatt.operators.clean import WEATHER_NAMES, rename_weather
from campuswatt.plans import models as ML
from campuswatt.session import cut_lineage

WEATHER = list(WEATHER_NAMES.values())
RAIN_WINDOW = 24
CUTOFF_DAYS = 3      # fixed value: newest days kept out of training
FORECAST_DAYS = 3    # fixed value: days a scoring job looks ahead


def weather_features(forecasts, site="site", order=("site",)):
    """Best forecast per time with degree days, changes and rain of the last day."""
    fc = rename_weather(forecasts)
    best = E.best_forecast(fc, ["ts"], [o for o in order if o in fc.columns] or ["ts"]).select("ts", *WEATHER)
    out = G.degree_days(best)
    out = E.lag_diff(out, "temperature", [], "ts", "temp_change_1h")
    out = E.daily_amplitude(out, "temperature", [], "ts", "daily_temp_amplitude")
    return E.rolling_sum(out, "precipitation", RAIN_WINDOW, [], "ts", "precipitation_24h")


def room_features(bookings, divisions=None):
    """Hourly occupation, course and division counts with high and low flags."""
    out = O.occupation_flags(O.occupancy(bookings, activity="activity"))
    if "division" in bookings.columns:
        divisions = O.division_values(bookings) if divisions is None else divisions
        out = out.join(O.division_counts(bookings, divisions), "ts", "left")
    return out


GAPS = ("interpolate", "drop", "fill")


def fill_gaps(df, cols, ts="ts", method="interpolate", interpolate=E.interp_linear):
    """Numeric gaps by interpolation, by dropping their rows, or by defaults.

    The defaults: 0 for forecasts, the mean of the day for temperature and humidity, the rest interpolated.
    """
    if method == "drop":
        return df.dropna(subset=list(cols))
    if method == "fill":
        df = df.na.fill(0.0, [c for c in cols if c.startswith("pred_")])
        for c in ("temperature", "humidity"):
            if c in cols:
                df = E.group_mean_fill(df, c, [F.to_date(ts)])
    return interpolate(df, list(cols), [], ts)


def consumption_features(base, weather, rooms, calendar, interpolate=E.interp_linear, gaps="interpolate"):
    """Model rows: one per row of ``base`` (ts, maybe consumption), without gaps.

    Weather gaps go by ``gaps`` (:func:`fill_gaps`), occupation gaps are 0, calendar gaps are 0 or ''.
    """
    out = J.hourly_merge(base, weather, rooms, calendar)
    weather_cols = [c for c in weather.columns if c != "ts"]
    out = out.withColumns({c: F.col(c).cast("double") for c in weather_cols})
    out = fill_gaps(out, weather_cols, "ts", gaps, interpolate)
    out = G.season(G.cyclic(G.day_flags(G.calendar_parts(out))))
    out = G.interactions(out)
    text = {f.name for f in out.schema.fields if f.dataType.typeName() == "string"}
    skipped = {"ts", "consumption", *text}
    return out.na.fill("", list(text)).na.fill(0, [c for c in out.columns if c not in skipped])


def daily_steps(rows, ts="ts"):
    """Sums of hourly results per day."""
    return rows.groupBy(F.to_date(ts).alias("date")).agg(F.sum("prediction").alias("prediction"))


def _as_dict(df):
    return {k: (None if v is None else float(v)) for k, v in df.first().asDict().items()}


def train_consumption(features, kind="xgboost", order=("ts",), **changes):
    """Fit on the older 80 % of the rows, measure on the rest. Returns (model, features, metrics)."""
    names = [c for c in features.columns if c not in ("ts", "consumption")]
    split = cut_lineage(MO.chrono_split(features, list(order)))
    model = ML.fit(split.filter("is_train = 1"), names, "consumption", ML.model_of(kind, **changes),
                   scale=kind.lower() == "randomforest")
    tested = cut_lineage(model.transform(split.filter("is_test = 1")).select(
        "ts", F.col("consumption").alias("actual"), F.col("prediction").alias("predicted")))
    return model, names, {"hourly": _as_dict(MO.metrics(tested)), "daily": _as_dict(MO.daily_metrics(tested))}


def production_features(inverters, forecasts, cutoff=None):
    """Plant power with the forecast of its hour, daylight only, without gaps."""
    power = E.plant_power(inverters)
    fc = E.target_time(forecasts.toDF(*[c.lower() for c in forecasts.columns]), cutoff=cutoff)
    cols = [c for c in fc.columns if c.startswith("pred_")]
    order = [c for c in ("ts", "site", "prediction") if c in fc.columns]
    merged = J.floor_join(power, fc, cols, order)
    merged = E.interp_linear(merged, cols, [], "ts")
    return with_clock(merged)


def production_daily_features(inverters, forecasts, order=("status",), cutoff=None):
    """Daily energy with the daylight forecasts of the day (target: day counters instead of power)."""
    energy = E.daily_energy(inverters, list(order)).withColumn("ts", F.col("date").cast("timestamp"))
    fc = E.target_time(forecasts.toDF(*[c.lower() for c in forecasts.columns]), cutoff=cutoff)
    cols = [c for c in fc.columns if c.startswith("pred_")]
    daily = E.daylight_daily(fc, cols, ts="target_ts")
    merged = E.interp_linear(energy.join(daily, "date", "left"), cols, [], "ts")
    return merged.withColumn("day_of_year", F.dayofyear("ts") / F.lit(365.0))


def with_clock(df):
    """Clock features of the production model."""
    waves = G.cyclic(df).withColumn("day_of_year", F.col("year_part"))
    return waves.drop("year_part", "day_of_week_sin", "day_of_week_cos", "month_sin", "month_cos")


def train_production(features, kind="random_forest", grid=None, folds=ML.SEARCH_FOLDS, **changes):
    """Random 80/20 split, optional grid search, metrics on the rest. Returns (model, features, metrics)."""
    names = G.feature_names(features)
    rows = cut_lineage(MO.hash_split(features.dropna(subset=["pv_output"]).na.fill(0.0, names), ["ts"]))
    train = rows.filter("is_train = 1")
    estimator = ML.model_of(kind, **changes)
    if grid:
        model = ML.grid_search(train, names, "pv_output", estimator, grid, folds, scale=True).bestModel
    else:
        model = ML.fit(train, names, "pv_output", estimator, scale=True)
    tested = model.transform(rows.filter("is_train = 0")).select(
        F.col("pv_output").alias("actual"), F.col("prediction").alias("predicted"))
    return model, names, _as_dict(MO.metrics(tested))


def score_spine(spark, start, days=FORECAST_DAYS):
    """Hours of ``days`` days from a date."""
    last = start + timedelta(days=days)
    return spark.sql(f"SELECT explode(sequence(TIMESTAMP'{start}', TIMESTAMP'{last}' - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS ts")


def score_consumption(spark, model, names, start, weather, rooms, days=FORECAST_DAYS, calendar=None):
    """Daily consumption forecast: (date as dd.MM.yyyy, consumptionPrediction)."""
    calendar = academic.academic_calendar(spark) if calendar is None else calendar
    rows = consumption_features(score_spine(spark, start, days), weather, rooms, calendar, E.interp_time)
    lacking = [n for n in names if n not in rows.columns]
    rows = rows.withColumns({n: F.lit(0.0) for n in lacking}) if lacking else rows
    daily = daily_steps(model.transform(rows))
    return daily.select(P.fmt_date(F.col("date")).alias("date"), F.col("prediction").alias("consumptionPrediction"))


def score_production(spark, model, names, start, forecasts, days=FORECAST_DAYS):
    """Hourly production forecast: (date, hour, productionPrediction), never negative."""
    fc = forecasts.toDF(*[c.lower() for c in forecasts.columns])
    cols = [c for c in fc.columns if c.startswith("pred_")]
    order = [c for c in ("ts", "site") if c in fc.columns]
    rows = with_clock(E.hour_fallback(fc, score_spine(spark, start, days), cols, order))
    rows = rows.withColumns({n: F.coalesce(F.col(n), F.lit(0.0)) if n in rows.columns else F.lit(0.0) for n in names})
    return model.transform(rows).select(
        P.fmt_date(F.col("ts")).alias("date"), P.fmt_hour(F.col("ts")).alias("hour"),
        P.clip_round(F.col("prediction")).alias("productionPrediction"))
