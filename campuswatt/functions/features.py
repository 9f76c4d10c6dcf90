"""Calendar and weather features, as columns added to a frame."""

import math

from pyspark.sql import functions as F

# Season of each month.
SEASONS = {
    1: "winter", 2: "winter", 3: "spring", 4: "spring", 5: "spring", 6: "summer",
    7: "summer", 8: "summer", 9: "autumn", 10: "autumn", 11: "autumn", 12: "winter",
}

# Comfort limits in degrees Celsius.
HEATING_LIMIT, COOLING_LIMIT, COLD_LIMIT = 18.0, 22.0, 10.0


def _flag(condition):
    return F.coalesce(condition, F.lit(False)).cast("int")


def calendar_parts(df, ts="ts"):
    t = F.col(ts)
    return df.withColumns({
        "hour": F.hour(t), "day": F.dayofmonth(t), "month": F.month(t),
        "day_of_week": F.weekday(t), "week_of_year": F.weekofyear(t), "day_of_year": F.dayofyear(t),
    })


def day_flags(df, ts="ts"):
    h, dow = F.hour(ts), F.weekday(ts)
    working = dow < 5

    def between(lo, hi):
        return (h >= lo) & (h < hi)

    opened = between(7, 22) & working
    return df.withColumns({
        "is_day_hours": _flag(between(8, 17)),
        "is_evening_hours": _flag(between(17, 22)),
        "is_night_hours": _flag((h < 8) | (h >= 22)),
        "is_weekend": _flag(dow >= 5),
        "is_working_day": _flag(working),
        "is_morning_class": _flag(between(8, 12) & working),
        "is_afternoon_class": _flag(between(13, 17) & working),
        "is_evening_class": _flag(between(17, 21) & working),
        "is_building_open": _flag(opened),
        "is_building_closed": _flag(~opened),
    })


def cyclic(df, ts="ts"):
    cols = {}
    for name, value, period in (("hour", F.hour(ts), 24), ("day_of_week", F.weekday(ts), 7),
                                ("month", F.month(ts), 12)):
        angle = value * F.lit(2 * math.pi / period)
        cols[f"{name}_sin"] = F.sin(angle)
        cols[f"{name}_cos"] = F.cos(angle)
    cols["year_part"] = F.dayofyear(ts) / F.lit(365.0)
    return df.withColumns(cols)


def season(df, ts="ts"):
    months = F.create_map(*[F.lit(x) for pair in SEASONS.items() for x in pair])
    df = df.withColumn("season", F.element_at(months, F.month(ts)))
    return df.withColumns({
        f"is_{name}": _flag(F.col("season") == name) for name in ("winter", "spring", "summer", "autumn")
    })


def degree_days(df, temperature="temperature", rain="precipitation"):
    """Heating and cooling degrees; a missing temperature stays missing."""
    t, cols = F.col(temperature), {}
    cols["heating_degree"] = F.when(t.isNotNull(), F.greatest(HEATING_LIMIT - t, F.lit(0.0)))
    cols["cooling_degree"] = F.when(t.isNotNull(), F.greatest(t - COOLING_LIMIT, F.lit(0.0)))
    if rain in df.columns:
        cols["is_raining"] = _flag(F.col(rain) > 0)
    return df.withColumns(cols)


def interactions(df, ts="ts", temperature="temperature", rooms="rooms_occupied"):
    """Features that combine weather, occupation and opening hours."""
    cols = {}
    if temperature in df.columns and "is_building_open" in df.columns:
        cols["is_cold_and_occupied"] = _flag((F.col(temperature) < COLD_LIMIT) & (F.col("is_building_open") == 1))
    if "is_weekend" in df.columns and "is_holiday_period" in df.columns:
        cols["is_weekend_or_holiday"] = _flag((F.col("is_weekend") == 1) | (F.col("is_holiday_period") == 1))
    if rooms in df.columns and temperature in df.columns:
        cols["temp_occupation_interaction"] = F.col(temperature) * F.col(rooms)
    cols["is_business_hours"] = _flag((F.hour(ts) >= 8) & (F.hour(ts) < 18) & (F.weekday(ts) < 5))
    return df.withColumns(cols)


def select_features(df, names, default=0.0):
    """Just the named features; a feature the frame lacks is a constant."""
    return df.select(*[F.col(n) if n in df.columns else F.lit(default).alias(n) for n in names])


# Features of the production model fed by forecasts only, and of
# the one that also sees measured weather.
FORECAST_FEATURES = ["pred_glob_ctrl", "pred_t_2m_ctrl", "pred_relhum_2m_ctrl", "pred_tot_prec_ctrl",
                     "hour_sin", "hour_cos", "day_of_year"]
MEASURED_FEATURES = ["pred_glob_ctrl", "pred_t_2m_ctrl", "temperature", "pred_relhum_2m_ctrl", "humidity",
                     "hour_sin", "hour_cos", "day_of_year"]


def feature_names(df, full=False):
    """Names of the model's features the frame has."""
    return [n for n in (MEASURED_FEATURES if full else FORECAST_FEATURES) if n in df.columns]
