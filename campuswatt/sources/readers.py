"""Readers and writers of feed files."""

import csv

from pyspark.sql import functions as F

from campuswatt.functions import parsing as P
from campuswatt.operators import clean as C
from campuswatt.schemas import METEO_MEASURES

# Separator and quoting of each feed.
FORMATS = {
    "meter": {"sep": ";", "quote": '"'},
    "plant": {"sep": ";", "quote": '"'},
    "inverter": {"sep": ";", "quote": ""},
    "booking": {"sep": "\t", "quote": ""},
    "meteo": {"sep": ",", "quote": '"'},
    "clean": {"sep": ",", "quote": '"'},
}


MOST_MEASUREMENTS = 200


def decode_text(content):
    """Text of a binary or text column in the encoding its bytes are valid in."""
    return F.expr(f"CASE WHEN is_valid_utf8({content}) THEN decode(CAST({content} AS BINARY), 'UTF-8') "
                  f"ELSE decode(CAST({content} AS BINARY), 'ISO-8859-1') END")


def split_lines(df, text="text", into="line"):
    """One row per line with its number; a trailing newline gives no line."""
    lines = F.split(F.regexp_replace(text, r"\r?\n$", ""), r"\r?\n")
    return df.select(*[c for c in df.columns if c != text], F.posexplode(lines).alias("line_no", into))


def read_text_any(spark, path):
    """Lines of small text files in mixed encodings: (file, line_no, line)."""
    files = (spark.read.format("binaryFile").load(path)
             .select(F.substring_index("path", "/", -1).alias("file"), decode_text("content").alias("text")))
    return split_lines(files)


def located(text, numbered=True):
    """Lines of a text source as stored, with file, folder and order in the file. A stream numbers each batch itself."""
    meta = F.col("_metadata")
    lines = text.select(
        F.col("value").alias("line"), meta["file_name"].alias("source_file"),
        F.regexp_extract(meta["file_path"], r"^(.*)/[^/]*$", 1).alias("source_dir"), meta["file_block_start"].alias("block"))
    return (lines.withColumn("row", F.monotonically_increasing_id()) if numbered else lines).filter("trim(line) <> ''")


def raw_lines(spark, path):
    """Lines of text files, not decoded yet. Large files are split; a split is at least a line, so no file has to fit a cell."""
    return located(spark.read.text(path))


def _decoded(line, utf8):
    """A line in the encoding of its file: UTF-8 if all its lines are valid, else ISO-8859-1."""
    text = F.when(F.col(utf8), F.col(line)).otherwise(F.decode(F.col(line).cast("binary"), "ISO-8859-1"))
    return F.regexp_replace(text, "^\ufeff", "")


_FILE = ["source_dir", "source_file"]


def _files(lines):
    """First line of each file, and whether all its lines are valid UTF-8."""
    return lines.groupBy(*_FILE).agg(F.min_by("line", F.struct("block", "row")).alias("_first"),
                                     F.bool_and(F.expr("is_valid_utf8(line)")).alias("_utf8"))


def read_lines(spark, path):
    """Lines of text files, each file in one encoding."""
    lines = raw_lines(spark, path)
    return lines.join(_files(lines), _FILE).withColumn("line", _decoded("line", "_utf8")).drop("_first", "_utf8")


def headed(lines):
    """Decoded lines behind the first one of each file, which comes as ``head``; a file of one line has no rows.

    Lines that repeat the first one are headers too. The first line is known by its text, so the two readings
    of the files need not agree on row numbers.
    """
    files = _files(lines)
    rows = lines.join(files, _FILE).filter("line <> _first")
    rows = rows.withColumns({"line": _decoded("line", "_utf8"), "head": _decoded("_first", "_utf8")}).drop("_first", "_utf8")
    return rows, files.select(*_FILE, _decoded("_first", "_utf8").alias("head"))


def _header(line, feed):
    """Cells of a header line; a repeated name gets a number."""
    quote = FORMATS[feed]["quote"]
    cells = next(csv.reader([line], delimiter=FORMATS[feed]["sep"], **({"quotechar": quote} if quote else {"quoting": csv.QUOTE_NONE})))
    seen, out = {}, []
    for c in cells:
        seen[c] = seen.get(c, -1) + 1
        out.append(f"{c}.{seen[c]}" if seen[c] else c)
    return out


def _variants(heads, feed, lacks=None):
    """Different header lines of the files and their cells: one of each layout, however many files there are."""
    lines = [r.head for r in heads.select("head").distinct().orderBy("head").collect()]
    known = {line: _header(line, feed) for line in lines}
    return {line: cells for line, cells in known.items() if lacks is None or not lacks(cells)}


def read_feed(spark, path, feed, names=None, lacks=None):
    """:func:`feed_rows` of files."""
    return feed_rows(raw_lines(spark, path), feed, names, lacks)


def feed_rows(lines, feed, names=None, lacks=None):
    """Rows of a delimited feed as text, with file name and order of the row in its file; ``lines`` as stored.

    Every file is read by its own header line and its own encoding. The columns are those of all headers; a
    file that lacks one has NULL there, and ``header`` has the names of the file. With ``names`` the columns
    are taken by position instead. Weather files skip lines with another number of cells. Files whose header
    ``lacks`` something are left out.
    """
    fmt = FORMATS[feed]
    lines, heads = headed(lines)
    variants = _variants(heads, feed, lacks)
    width = max([len(c) for c in variants.values()] + [len(names or ())]) + 1
    cells = F.from_csv("line", ", ".join(f"c{i} string" for i in range(width)), {"sep": fmt["sep"], "quote": fmt["quote"]})
    kind = F.array_position(F.array(*[F.lit(h) for h in variants]).cast("array<string>"), F.col("head"))
    rows = lines.withColumn("_kind", kind).filter("_kind > 0").withColumn("_cells", cells)
    layouts = list(variants.values())
    if feed == "meteo":
        size = F.element_at(F.array(*[F.lit(len(c)) for c in layouts]).cast("array<int>"), F.col("_kind").cast("int"))
        rows = rows.filter((F.size(F.split("line", fmt["sep"])) == size) | F.contains("line", F.lit('"')))
    if names:
        columns = {n: [i if i < len(c) else None for c in layouts] for i, n in enumerate(names)}
    else:
        every = list(dict.fromkeys(n for c in layouts for n in c))
        columns = {n: [c.index(n) if n in c else None for c in layouts] for n in every}

    def cell(places):
        """The column in each layout."""
        out = F.lit(None).cast("string")
        for k, i in enumerate(places):
            if i is not None:
                out = F.when(F.col("_kind") == k + 1, F.col(f"_cells.c{i}")).otherwise(out)
        return out

    header = F.element_at(F.array(*[F.array(*[F.lit(n) for n in c]) for c in layouts]).cast("array<array<string>>"), F.col("_kind").cast("int"))
    return rows.select(*[cell(places).alias(n) for n, places in columns.items()], header.alias("header"),
                       "source_file", "source_dir", "block", "row")


def lacks_meteo_columns(columns):
    return not set(METEO_COLUMNS) <= set(columns)


LACKS = {"booking": C.lacks_booking_columns, "meteo": lacks_meteo_columns}


def bad_headers(spark, path, feed, lacks=None):
    """(file, reason) of files whose header lacks something."""
    _, heads = headed(raw_lines(spark, path))
    good = list(_variants(heads, feed, lacks or LACKS.get(feed)))
    return (heads.filter(~F.col("head").isin(good)) if good else heads).select(
        F.col("source_file").alias("file"), F.lit("missing required columns").alias("reason"))


def inverter_rows(lines):
    """Inverter lines as (Date, Time, cells): block headers repeat, so cells go by position."""
    lines, _ = headed(lines)
    cells = F.split("line", FORMATS["inverter"]["sep"])
    return lines.select(F.col("source_file").alias("file"), "block", "row", F.get(cells, F.lit(0)).alias("Date"), F.get(cells, F.lit(1)).alias("Time"),
                        F.transform(F.slice(cells, F.lit(3), F.greatest(F.size(cells) - 2, F.lit(0))),
                                    lambda c: F.nullif(F.trim(c), F.lit(""))).alias("cells"))


METER_NAMES = ["Date", "Time", "Unit", "Value"]    # by position; the unit is dropped
METEO_COLUMNS = ["Time", "Prediction", "Measurement", "Value"]


# Cleaned rows of lines as stored: the same for files and for the micro-batches of a stream.

def clean_inverter_lines(lines):
    blocks = C.unpivot_blocks(inverter_rows(lines), "cells", ["file", "block", "row", "Date", "Time"])
    return C.clean_inverters(blocks, ["block", "row"], "file")


def clean_meter_lines(lines):
    raw = feed_rows(lines, "meter", names=METER_NAMES)
    # a file of three columns has no unit
    raw = raw.withColumn("Value", F.when(F.size("header") > 3, F.col("Value")).otherwise(F.col("Unit"))).drop("header", "source_dir")
    return C.clean_meter(raw, ["block", "row"], file="source_file").withColumnRenamed("source_file", "file")


def clean_meteo_lines(lines, names=None):
    """Weather rows with all their measurements in columns; ``names`` takes these only."""
    raw = feed_rows(lines, "meteo").drop("source_dir")
    typed = raw.withColumns({"Value": P.number(raw, "Value"), "Prediction": F.col("Prediction").try_cast("int")})
    if names is None:      # the measurements of a weather model: metadata, like the columns they become
        found = [r[0] for r in typed.select(F.trim("Measurement").alias("m")).filter("m <> ''").distinct().orderBy("m").limit(MOST_MEASUREMENTS + 1).collect()]
        if len(found) > MOST_MEASUREMENTS:
            raise ValueError(f"more than {MOST_MEASUREMENTS} measurements: is this a weather feed?")
        names = [*METEO_MEASURES, *[m for m in found if m not in METEO_MEASURES]]
    wide = C.clean_meteo(typed, list(names), ["source_file", "block", "row"], file="source_file")
    return wide.withColumnRenamed("source_file", "file")


def clean_booking_lines(lines, year=None):
    """Bookings, each file by its own header; files that lack a required column are left out.

    If all files lack one, that is an error.
    """
    raw = feed_rows(lines, "booking", lacks=C.lacks_booking_columns).drop("source_dir", "header")
    return C.clean_bookings(raw, year=year, file="source_file", order=["block", "row"]).withColumnRenamed("source_file", "file")


def clean_inverter_files(spark, path):
    return clean_inverter_lines(raw_lines(spark, path))


def clean_meter_files(spark, path):
    return clean_meter_lines(raw_lines(spark, path))


def clean_meteo_files(spark, path, names=None):
    return clean_meteo_lines(raw_lines(spark, path), names)


def clean_booking_files(spark, paths, year=None):
    return clean_booking_lines(raw_lines(spark, paths), year)


def write_feed(df, path, load_date=None, fmt="parquet", by_file=False):
    """Cleaned rows; Parquet is partitioned by load date, CSV is for exchange.

    Only the partitions of the written rows are replaced. With ``by_file`` each
    source file has its own: a repeated file replaces itself and nothing else.
    """
    if load_date is not None:
        df = df.withColumn("load_date", F.lit(load_date).cast("date"))
    parts = [c for c in ("load_date", "file") if c in df.columns and (c != "file" or by_file)]
    writer = df.write.mode("overwrite")
    if parts:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*parts)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
