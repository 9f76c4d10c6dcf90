"""Row checks. Rows that fail go to a rejects table with the reason."""

from functools import reduce

from pyspark.sql import functions as F


def _ok(condition):
    return F.coalesce(condition, F.lit(False))


def split_valid(df, condition, reason):
    """(valid rows, rejected rows with their reason)."""
    ok = _ok(condition)
    return df.filter(ok), df.filter(~ok).withColumn("reason", F.lit(reason))


def missing_reason(cols):
    """``missing: a, b`` for the columns that are NULL, NULL if none is."""
    gaps = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols]), lambda x: x.isNotNull())
    return F.when(F.size(gaps) > 0, F.concat(F.lit("missing: "), F.array_join(gaps, ", ")))


def required(df, cols):
    """(rows with all columns filled, rejects)."""
    marked = df.withColumn("reason", missing_reason(cols))
    return marked.filter("reason IS NULL").drop("reason"), marked.filter("reason IS NOT NULL")


def complete(cols):
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def valid_meteo(df, measures, horizon="Prediction"):
    """Weather rows with a whole-number horizon and all measures."""
    return split_valid(df, complete(measures) & F.col(horizon).cast("string").try_cast("int").isNotNull(),
                       "incomplete forecast")


def valid_energy(df):
    return split_valid(df, complete(["energy_consumed", "temperature", "humidity"]), "missing values")


def valid_booking(df):
    return split_valid(df, complete(["room_name", "Date", "start_time", "end_time", "user_name"]),
                       "missing required values")


def valid_forecast(df):
    either = F.col("predicted_consumption").isNotNull() | F.col("predicted_production").isNotNull()
    return split_valid(df, F.col("date").isNotNull() & either, "no date or no prediction")


def fk_orphans(fact, dim, key, on=None):
    """Fact rows whose non-null foreign key has no dimension member."""
    on = on or key
    return (fact.filter(F.col(on).isNotNull())
            .join(dim.select(F.col(key).alias(on)), on, "left_anti"))
