"""Marts for the dashboards: energy balance, failures, occupation, forecast quality, solar star."""

from pyspark.sql import functions as F

from campuswatt.operators import modelling as MO
from campuswatt.operators.joins import star_join
from campuswatt.operators.occupancy import booked_hours
from campuswatt.operators.series import RUNNING


def solar_star(fact, dim_date, dim_time, dim_inverter, dim_status):
    """Solar fact with readable dimension values."""
    joined = star_join(fact, [(dim_date, "id_date"), (dim_time, "id_time"), (dim_inverter, "id_inverter"),
                              (dim_status, "id_status")])
    return joined.select("year", "month", "day", "hour", "minute", "inverter_name", "status_name",
                         "total_energy_produced", "energy_produced", "error_count")


def energy_balance(production, consumption, unit="hour", ts="ts"):
    """Produced and consumed energy per hour or day; periods with one side only stay."""
    made = production.groupBy(F.date_trunc(unit, ts).alias("period")).agg(F.sum("energy_produced").alias("produced"))
    used = consumption.groupBy(F.date_trunc(unit, ts).alias("period")).agg(F.sum("energy_consumed").alias("consumed"))
    both = made.join(used, "period", "full_outer").na.fill(0.0, ["produced", "consumed"])
    return both.withColumn("balance", F.col("produced") - F.col("consumed"))


def failures(solar, date="date", inverter="inverter_name", status="status_name"):
    """Failure rows per inverter and day: an error count or a status that is not running."""
    stopped = F.coalesce(F.col(status) != str(RUNNING), F.lit(True))
    bad = solar.filter((F.col("error_count") > 0) | stopped)
    return bad.groupBy(inverter, date).agg(
        F.count("*").alias("failures"), F.sum("error_count").alias("errors"),
        F.count_if(stopped).alias("not_running"))


def room_occupation(bookings, date="date", room="room_name"):
    """Bookings per room and hour."""
    _, hours = booked_hours(bookings, date)
    return hours.groupBy(room, "ts").agg(F.count("*").alias("bookings"))


def forecast_quality(actual, forecast, by=()):
    """Metrics of forecasts against the actual values of the same time."""
    return MO.metrics(actual.join(forecast, "ts"), by=by)


def export_star(wh, folder):
    """Solar dimensions, the fact and the joined view as CSV folders.

    The view is in time order over all its files: a range shuffle on time and inverter cuts hot months too.
    """
    names = ["DimDate", "DimTime", "DimInverter", "DimStatus", "FactSolarProduction"]
    tables = {n: wh.read(n) for n in names}
    tables["FactSolarProduction"] = tables["FactSolarProduction"].drop("ym")
    view = solar_star(*[tables[n] for n in ("FactSolarProduction", "DimDate", "DimTime", "DimInverter", "DimStatus")])
    view = view.orderBy("year", "month", "day", "hour", "minute", "inverter_name", "status_name")
    for name, df in {**tables, "SolarProductionView": view}.items():
        df.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")
