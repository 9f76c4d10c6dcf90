"""Standard forms of cleaned feeds, ready for the fact loads."""

from pyspark.sql import functions as F

from campuswatt.functions import parsing as P
from campuswatt.operators.joins import lookup_first, union_feeds
from campuswatt.operators.quality import complete, split_valid
from campuswatt.schemas import METEO_MEASURES

# Members for rows that name no inverter or status.
PLANT_INVERTER, UNKNOWN_INVERTER, NO_STATUS = "History", "Unknown_Inverter", "0"
UNKNOWN_USER = "Unknown User"
STEP_MINUTES = 5       # fixed value: spacing of inverter readings


def energy_kwh(pac):
    """Energy of one reading interval from the power in W."""
    return F.round(pac * STEP_MINUTES / 60 / 1000, 3)


def std_min(df, order):
    """Inverter rows as fact measures. (rows, rejects): a power that is no number rejects the row."""
    pac = P.number(df, "Pac")
    if df.schema["Pac"].dataType.typeName() == "string":
        absent = F.col("Pac").isNull() | (F.lower("Pac") == "nan")
        readable, rejects = split_valid(df, absent | pac.isNotNull(), "power is no number")
    else:
        readable, rejects = split_valid(df, F.lit(True), "power is no number")
    out = readable.select(
        F.to_date("Date").alias("date"), F.col("Time").alias("time"),
        F.coalesce(F.col("INV").cast("string"), F.lit(UNKNOWN_INVERTER)).alias("inverter_name"),
        F.coalesce(F.col("Status").cast("string"), F.lit(NO_STATUS)).alias("status_name"),
        F.coalesce(P.number(df, "DaySum"), F.lit(0.0)).alias("total_energy_produced"),
        F.coalesce(energy_kwh(pac), F.lit(0.0)).alias("energy_produced"),
        F.coalesce(P.number(df, "Error").try_cast("int"), F.lit(0)).alias("error_count"),
        *order)
    return out, rejects


def std_pv(df, order):
    """Plant rows: one History inverter, energy only."""
    return df.select(
        F.to_date("Date").alias("date"), F.col("Time").alias("time"),
        F.lit(PLANT_INVERTER).alias("inverter_name"), F.lit(NO_STATUS).alias("status_name"),
        F.lit(0.0).alias("total_energy_produced"),
        F.coalesce(P.number(df, "Value"), F.lit(0.0)).alias("energy_produced"),
        F.lit(0).alias("error_count"), *order)


def std_meteo(df, order):
    return df.select(
        F.to_date("Date").alias("date"), F.col("Time").alias("time"), F.col("Site").alias("site_name"),
        F.col("Prediction").try_cast("int").alias("numPrediction"),
        *[F.col(src).alias(dst) for src, dst in METEO_MEASURES.items()], *order)


def meter_rows(consumption, temperature, humidity, order, key=("Date", "Time")):
    """Consumption rows with the first temperature and humidity reading of the same time."""
    out = consumption.withColumnRenamed("Value", "energy_consumed")
    out = lookup_first(out, temperature, key, "Value", "temperature", order)
    return lookup_first(out, humidity, key, "Value", "humidity", order)


def energy_valid():
    return complete(["energy_consumed", "temperature", "humidity"])


def external_id(df):
    """Identity of a booking in its source: date, raw times, room and user."""
    df = df.withColumn("user_name", F.coalesce("user_name", F.lit(UNKNOWN_USER)))
    parts = [F.date_format("Date", "yyyy-MM-dd"), *[F.col(c) for c in ("start_time", "end_time", "room_name", "user_name")]]
    text = parts[0]
    for p in parts[1:]:
        text = F.concat(text, F.lit("_"), p)
    return df.withColumn("external_id", text)


def combine_forecasts(consumption, production):
    """Daily consumption (at 00:00) and hourly production as one list of rows."""
    def iso(c):
        return F.coalesce(F.try_to_timestamp(c, F.lit("dd.MM.yyyy")), F.try_to_timestamp(c)).cast("date")

    daily = consumption.select(
        iso(F.col("date")).alias("date"), F.lit("00:00").alias("hour"),
        F.col("consumptionPrediction").cast("double").alias("predicted_consumption"))
    hourly = production.select(
        iso(F.col("date")).alias("date"), "hour",
        F.col("productionPrediction").cast("double").alias("predicted_production"))
    return union_feeds(daily, hourly)
