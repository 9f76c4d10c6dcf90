"""Cleaning operators: from raw feed rows to normal form."""

from pyspark.sql import functions as F

from campuswatt.functions import parsing as P
from campuswatt.operators.ordering import dedup_first
from campuswatt.schemas import INVERTER_BLOCK, SITES

# Header variants of the booking feed, most wanted first.
BOOKING_ALIASES = {
    "Date": ["Date", "date", "Date de réservation", "DateReservation"],
    "room_name": ["Nom", "nom", "Salle", "salle", "Room"],
    "start_time": ["Date de début", "Start Time", "Heure début", "start_time", "Start", "Début"],
    "end_time": ["Date de fin", "End Time", "Heure fin", "end_time", "End", "Fin"],
    "reservation_type": ["Type de réservation", "TypeReservation", "Type"],
    "codes": ["Codes", "Code"],
    "user_name": ["Nom de l'utilisateur", "Utilisateur", "User"],
    "class": ["Classe", "Class", "Classes"],
    "activity": ["Activité", "Activity"],
    "professor": ["Professeur", "Professor"],
    "division": ["Division", "Department"],
}
BOOKING_REQUIRED = ["Date", "start_time", "end_time", "room_name"]

# Booking columns nobody needs.
BOOKING_UNUSED = [
    "Nom entier", "Rés.-no", "Sigle de la salle remplacée", "Nom entier de la salle remplacée",
    "Date de début.1", "Date de fin.1", "Périodicité", "Poste de dépenses", "Remarque", "Annotation",
]
ROOM_PREFIX = "VS-BEL"

# Weather column names and the words that identify an unknown one.
WEATHER_NAMES = {
    "pred_t_2m_ctrl": "temperature",
    "pred_relhum_2m_ctrl": "humidity",
    "pred_tot_prec_ctrl": "precipitation",
    "pred_glob_ctrl": "global_radiation",
}
WEATHER_WORDS = {
    "temperature": ["t_2m", "temp"],
    "humidity": ["hum"],
    "precipitation": ["prec"],
    "global_radiation": ["glob"],
}
SENTINEL = -99999.0


def drop_null_keys(df, keys):
    return df.dropna(subset=list(keys))


def drop_if_present(df, cols=BOOKING_UNUSED):
    return df.drop(*cols)


def file_sample(df, col, file, order):
    """First value of ``col`` per file, next to every row of the file."""
    first = dedup_first(df, [file], order).select(file, F.col(col).alias("_sample"))
    return df.join(first, file, "left")


def norm_dates(df, col, file, order):
    """ISO dates; the format is the one of the first row of each file."""
    return file_sample(df, col, file, order).withColumn(col, P.norm_date(F.col(col), F.col("_sample"))).drop("_sample")


def clean_meter(df, order, file=None, unused=("Valeur Acquisition",)):
    """Meter file to (Date, Time, Value): positions 1, 2 and 4; bad keys and repeats go."""
    file_cols = [] if file is None else [file]
    carried = [c for c in df.columns if c in (*file_cols, *order)]
    body = [c for c in df.columns if c not in carried]
    if len(body) > 3:
        body = [c for i, c in enumerate(body) if i != 2]
    body = [c for c in body if c not in unused]
    out = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(body, ("Date", "Time", "Value"))], *carried)
    if file is None:
        out = out.withColumn("Date", P.norm_date(F.col("Date")))
    else:
        out = norm_dates(out, "Date", file, order)
    out = out.withColumns({"Time": P.norm_time(F.col("Time")), "Value": P.number(out, "Value")})
    return dedup_first(drop_null_keys(out, ["Date", "Time"]), [*file_cols, "Date", "Time"], order)


def unpivot_blocks(df, cells, carry, names=INVERTER_BLOCK):
    """One row per block of ``len(names)`` cells; a short last block is padded with NULL.

    ``cells`` is an array column with the measures of all inverters of a line.
    """
    width = len(names)
    n_blocks = F.ceil(F.size(cells) / width).cast("int")
    starts = F.when(n_blocks > 0, F.sequence(F.lit(0), n_blocks - 1)).otherwise(F.array().cast("array<int>"))
    exploded = df.withColumn("_block", F.explode(starts))
    return exploded.select(*carry, "_block", *[
        F.get(F.col(cells) if isinstance(cells, str) else cells, F.col("_block") * width + i).alias(n)
        for i, n in enumerate(names)])


def clean_inverters(df, order, file):
    """Rows of :func:`unpivot_blocks` with normal keys, first row per (Date, Time, INV)."""
    out = norm_dates(df, "Date", file, [*order, "_block"]).withColumn("Time", P.norm_time(F.col("Time")))
    return dedup_first(drop_null_keys(out, ["Date", "Time"]), [file, "Date", "Time", "INV"], [*order, "_block"])


def replace_sentinel(df, cols=None, sentinel=SENTINEL, by=0.0):
    numeric = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.replace(sentinel, by, subset=cols or numeric)


def filter_sites(df, sites=SITES, col="Site", header=None):
    """Known sites only; a feed, or by ``header`` (column names) a file, without a site column stays whole."""
    if col not in df.columns:
        return df
    known = F.col(col).isin(*sites)
    return df.filter(known if header is None else known | ~F.array_contains(header, col))


def empty_files(df, kept, file):
    """Files that lose all their rows in a filter: they are rejected."""
    return df.select(file).distinct().join(kept.select(file).distinct(), file, "left_anti") \
        .withColumn("reason", F.lit("no usable rows"))


def pivot_first(df, index, col, value, names, order, optional=()):
    """Wide form: first non-null value per index and name in the given order; ``optional`` index columns may be NULL."""
    df = df.dropna(subset=[c for c in index if c not in optional])
    at = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    aggs = [F.min_by(value, F.when((F.col(col) == n) & F.col(value).isNotNull(), at)).alias(n) for n in names]
    return df.filter(F.col(col).isNotNull() & F.col(value).isNotNull()).groupBy(*index).agg(*aggs)


def split_ts(df, ts, date="Date", time="Time"):
    rest = [c for c in df.columns if c not in (ts, date, time)]
    return df.select(F.date_format(ts, "yyyy-MM-dd").alias(date), F.date_format(ts, "HH:mm:ss").alias(time), *rest)


def strip_quotes(df):
    """Quotes around headers and text cells go."""
    text = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    return df.select(*[
        (P.strip_quotes(F.col(f"`{c}`")) if c in text else F.col(f"`{c}`")).alias(c.strip('"')) for c in df.columns])


def missing_columns(columns, aliases=BOOKING_ALIASES, required=BOOKING_REQUIRED):
    """Required columns that no variant among ``columns`` stands for."""
    return [n for n in required if not {n, *aliases.get(n, ())} & set(columns)]


def lacks_booking_columns(columns):
    """Whether a booking header lacks a column; the date may also come in parts."""
    columns = [c.strip('"') for c in columns]
    dated = {"Année", "Mois", "Jour"} <= set(columns)
    return bool(missing_columns(columns, required=[c for c in BOOKING_REQUIRED if c != "Date" or not dated]))


def canonical(df, aliases=BOOKING_ALIASES, required=BOOKING_REQUIRED):
    """Rename the first present variant of each column; raise if a required one is missing."""
    present, renames = set(df.columns), {}
    for name, variants in aliases.items():
        found = next((v for v in variants if v in present), None)
        if found is not None:
            renames[found] = name
    df = df.withColumnsRenamed(renames)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def canonical_mixed(df, aliases=BOOKING_ALIASES):
    """Same over the union of files with different headers: the first filled variant wins."""
    out, used = {}, set()
    for name, variants in aliases.items():
        found = [v for v in variants if v in df.columns]
        if found:
            out[name] = F.coalesce(*[F.col(f"`{v}`") for v in found])
            used.update(found)
    rest = [F.col(f"`{c}`") for c in df.columns if c not in used and c not in out]
    return df.select(*[v.alias(n) for n, v in out.items()], *rest)


def booking_dates(df, year=None, file=None, order=()):
    """DATE from French text, other date text or its parts; ``year`` replaces the year if given.

    The first row of each file decides whether the file is French. Rows whose date
    does not parse are dropped; the text stays in ``Date_original``.
    """
    if {"Année", "Mois", "Jour"} <= set(df.columns):
        parts = P.iso(P.date_from_parts(F.lit(str(year)) if year else F.col("Année"), F.col("Mois"), F.col("Jour")))
        df = df.withColumn("Date", F.coalesce("Date", parts) if "Date" in df.columns else parts)
    auto = F.coalesce(F.try_to_timestamp(F.col("Date")).cast("date"),
                      F.try_to_timestamp(F.col("Date"), F.lit("M/d/yyyy")).cast("date"))
    if year:
        auto = P.force_year(auto, year)
    df = file_sample(df, "Date", file, order) if file else df.withColumn("_sample", F.col("Date"))
    is_french = F.size(F.split(F.trim("_sample"), r"\s+")) == 3
    date = F.when(is_french, P.parse_fr_date(F.col("Date"), year)).otherwise(auto)
    out = df.withColumn("Date_original", F.col("Date")).withColumn("Date", date).drop("_sample")
    return drop_null_keys(out, ["Date"])


def prefix_filter(df, col="room_name", prefix=ROOM_PREFIX):
    return df.filter(F.col(col).startswith(prefix))


def _items(c):
    """Trimmed non-empty items of a comma list; NULL is one NULL item."""
    trimmed = F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(c.isNull(), F.array(F.lit(None).cast("string"))).otherwise(trimmed)


def explode_pairs(df, a="class", b="professor"):
    """One row per pair of items of the two comma lists of a row.

    A row with an empty list has no pair and goes, unless no row at all has one:
    then the rows stay as they are.
    """
    lists = df.withColumns({"_a": _items(F.col(a)), "_b": _items(F.col(b))})
    has_pair = (F.size("_a") > 0) & (F.size("_b") > 0)
    any_pair = lists.agg(F.coalesce(F.max(has_pair.cast("int")), F.lit(0))).scalar()
    keep = F.array(F.struct(F.col(a).alias("x"), F.col(b).alias("y")))
    pairs = F.flatten(F.transform("_a", lambda x: F.transform("_b", lambda y: F.struct(x.alias("x"), y.alias("y")))))
    out = lists.withColumn("_pair", F.explode(F.when(any_pair == 0, keep).otherwise(pairs)))
    return out.withColumns({a: F.col("_pair.x"), b: F.col("_pair.y")}).drop("_a", "_b", "_pair")


def clean_bookings(df, prefix=ROOM_PREFIX, year=None, file=None, order=()):
    """Raw booking rows to normal form, one row per class and professor."""
    df = strip_quotes(df)
    missing = missing_columns(df.columns, required=[c for c in BOOKING_REQUIRED if c != "Date"])
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    out = canonical_mixed(df)
    out = booking_dates(out, year, file, order)
    out = drop_if_present(prefix_filter(out, prefix=prefix))
    if "class" in out.columns and "professor" in out.columns:
        out = explode_pairs(out)
    return blank_to_null(out)


def blank_to_null(df):
    """Empty text cells are missing values."""
    return df.withColumns({f.name: F.nullif(F.col(f.name), F.lit("")) for f in df.schema.fields
                           if f.dataType.typeName() == "string"})


def rename_weather(df):
    """Lower-case names, then the weather names; failing all, guess by the words in the names."""
    df = df.toDF(*[c.lower() for c in df.columns]).withColumnsRenamed(WEATHER_NAMES)
    if any(n in df.columns for n in WEATHER_NAMES.values()):
        return df
    for name, words in WEATHER_WORDS.items():
        match = next((c for c in df.columns if any(w in c for w in words)), None)
        if match:
            df = df.withColumn(name, F.col(match))
    return df


def clean_meteo(df, names, order, file=None, sites=SITES):
    """Long forecast rows to one row per (Date, Time, Site, Prediction)."""
    out = filter_sites(replace_sentinel(df), sites, header="header" if "header" in df.columns else None)
    index = [c for c in (file, "Site", "Prediction", "Time") if c in df.columns]
    optional = ["Site"] if "header" in df.columns else []
    out = pivot_first(out, index, "Measurement", "Value", names, order, optional)
    out = split_ts(out.withColumn("_ts", F.try_to_timestamp("Time")).drop("Time"), "_ts")
    first = [c for c in ("Date", "Time", "Site", "Prediction") if c in out.columns]
    return out.select(*first, *[c for c in out.columns if c not in first]).orderBy(*first)
