"""Selecting drop files. A file listing is a DataFrame with ``path`` or ``name`` columns."""

from urllib.parse import unquote

from pyspark.sql import functions as F

from campuswatt.functions import parsing as P
from campuswatt.operators.joins import lookup_first, not_in
from campuswatt.operators.ordering import dedup_last
from campuswatt.schemas import FEEDS

# Fixed value: folder names of cleaned snapshots.
SNAPSHOT_PATTERN = r"cleaned_data_(\d{4}-\d{2}-\d{2})"


def base_name(path):
    return F.substring_index(path, "/", -1)


def bare_name(path):
    """File name of a path as the listing gives it, where odd characters are escaped."""
    return unquote(path.rsplit("/", 1)[-1])


def _has_token(name, tokens):
    hit = F.lit(False)
    for t in tokens:
        hit = hit | F.contains(F.lower(name), F.lit(t.lower()))
    return hit


def feed_files(files, feed, name="name"):
    """CSV files whose name contains any token of the feed."""
    return files.filter(F.col(name).endswith(".csv") & _has_token(F.col(name), FEEDS[feed]))


def route(name):
    """Feed a file name belongs to; unknown files are copied unchanged."""
    bare = F.lower(name)
    return (F.when(bare.startswith("min"), "inverter")
            .when(F.contains(bare, F.lit("-pv")), "plant")
            .when(_has_token(name, FEEDS["meter"]), "meter")
            .when(_has_token(name, FEEDS["booking"]), "booking")
            .when(_has_token(name, FEEDS["meteo"]), "meteo")
            .otherwise("unknown"))


def passthrough(df):
    return df


def new_files(files, ledger, name="name"):
    """Files the ledger does not list yet."""
    return not_in(files, ledger, [name])


def name_date_until(files, cutoff, name="name"):
    """Files without a date in their name, or with one up to the cutoff."""
    found = P.name_date(F.col(name))
    return files.filter(found.isNull() | (found <= cutoff))


def snapshot_date(path):
    return P.name_date(F.regexp_extract(path, SNAPSHOT_PATTERN, 1))


def latest_snapshot(df, col="load_date"):
    """Rows of the latest load date; the scalar prunes partitions."""
    return df.filter(F.col(col) == df.agg(F.max(col)).scalar())


def snapshots_until(df, ref, days=3, col="load_date"):
    """Rows of snapshots at least ``days`` old; the oldest snapshot if none is."""
    limit = F.date_sub(F.lit(ref).cast("date"), days)
    usable = df.agg(F.max(F.when(F.col(col) <= limit, F.col(col)))).scalar()
    oldest = df.agg(F.min(col)).scalar()
    return df.filter(F.col(col) <= F.coalesce(usable, oldest))


def latest_by_mtime(files, kind="kind", mtime="mtime", path="path"):
    """Newest file per kind."""
    return dedup_last(files, [kind], [mtime, path])


def file_date_token(name):
    """Text before the first dash of a meter file's name."""
    return F.substring_index(name, "-", 1)


def match_triples(files, name="name"):
    """(consumption, temperature, humidity) files of one date; rejects: consumption files without partners."""
    lower = F.lower(name)

    def of(kind):
        return files.filter(F.contains(lower, F.lit(kind.lower()))).select(
            F.col(name).alias(kind), file_date_token(F.col(name)).alias("token"))

    consumption, temperature, humidity = (of(t) for t in FEEDS["meter"])
    both = lookup_first(consumption.withColumnRenamed("Consumption", "consumption"),
                        temperature, ["token"], "Temperature", "temperature", ["Temperature"])
    both = lookup_first(both, humidity, ["token"], "Humidity", "humidity", ["Humidity"])
    complete = F.col("temperature").isNotNull() & F.col("humidity").isNotNull()
    return both.filter(complete), both.filter(~complete).withColumn("reason", F.lit("missing partner file"))
