"""Galaxy schema and feed schemas."""

from pyspark.sql import types as T

INT, LONG, DBL, STR = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
BOOL, TS, DATE = T.BooleanType(), T.TimestampType(), T.DateType()


def _table(*cols):
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in cols])


def _dim(id_col, *cols):
    return _table((id_col, INT, False), *[(name, kind, False) for name, kind in cols])


DIMENSIONS = {
    "DimDate": _dim("id_date", ("year", INT), ("month", INT), ("day", INT)),
    "DimTime": _dim("id_time", ("hour", INT), ("minute", INT)),
    "DimRoom": _dim("id_room", ("room_name", STR)),
    "DimUser": _dim("id_user", ("username", STR)),
    "DimActivity": _dim("id_activity", ("activity_name", STR)),
    "DimBookingType": _dim("id_booking_type", ("code", STR), ("booking_type", STR)),
    "DimDivision": _dim("id_division", ("division_name", STR)),
    "DimClassroom": _dim("id_classroom", ("classroom_name", STR)),
    "DimInverter": _dim("id_inverter", ("inverter_name", STR)),
    "DimStatus": _dim("id_status", ("status_name", STR)),
    "DimSite": _dim("id_site", ("site_name", STR)),
}

# Facts carry the partition column ``ym`` (yyyymm of the row's date): a merge
# rewrites only the months its batch touches.
FACTS = {
    "FactBookings": _table(
        ("id_date", INT, False), ("id_time_start", INT, False), ("id_time_end", INT, False),
        ("id_room", INT, False), ("id_user", INT, False), ("id_professor", INT, True),
        ("id_classroom", INT, True), ("id_booking_type", INT, True), ("id_division", INT, True),
        ("id_activity", INT, True), ("is_active", BOOL, False), ("last_modified", TS, True),
        ("external_id", STR, True), ("ym", INT, False)),
    "FactEnergyConsumption": _table(
        ("id_date", INT, False), ("id_time", INT, False), ("energy_consumed", DBL, False),
        ("humidity", DBL, False), ("temperature", DBL, False), ("ym", INT, False)),
    "FactSolarProduction": _table(
        ("id_date", INT, False), ("id_time", INT, False), ("id_inverter", INT, False),
        ("id_status", INT, False), ("total_energy_produced", DBL, False),
        ("energy_produced", DBL, False), ("error_count", INT, False), ("ym", INT, False)),
    "FactPrediction": _table(
        ("id_date", INT, False), ("id_time", INT, False), ("predicted_consumption", DBL, True),
        ("predicted_production", DBL, True), ("ym", INT, False)),
    "FactMeteoSwissData": _table(
        ("id_date", INT, False), ("id_time", INT, False), ("id_site", INT, False),
        ("numPrediction", INT, False), ("temperature", DBL, False), ("humidity", DBL, False),
        ("rain", DBL, False), ("radiation", DBL, False), ("ym", INT, False)),
}

TABLES = {**DIMENSIONS, **FACTS}

FACT_KEYS = {
    "FactBookings": ["id_date", "id_time_start", "id_time_end", "id_room", "id_user"],
    "FactEnergyConsumption": ["id_date", "id_time"],
    "FactSolarProduction": ["id_date", "id_time", "id_inverter", "id_status"],
    "FactPrediction": ["id_date", "id_time"],
    "FactMeteoSwissData": ["id_date", "id_time", "id_site", "numPrediction"],
}

# Names of the measures of one inverter block, in file order.
INVERTER_BLOCK = ["INV", "Pac", "DaySum", "Status", "Error", "Pdc1", "Pdc2", "Udc1", "Udc2", "Temp", "Uac"]

# Forecast measurements kept by the warehouse and their column there.
METEO_MEASURES = {
    "PRED_T_2M_ctrl": "temperature",
    "PRED_RELHUM_2M_ctrl": "humidity",
    "PRED_TOT_PREC_ctrl": "rain",
    "PRED_GLOB_ctrl": "radiation",
}

# File-name tokens per feed.
FEEDS = {
    "solar": ["PV", "min"],
    "meter": ["Consumption", "Temperature", "Humidity"],
    "booking": ["RoomAllocations"],
    "meteo": ["Pred"],
}

SITES = ["Sion", "Visp"]
