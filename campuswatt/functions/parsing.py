"""Column functions that parse and format text, dates and times.

All are built-in expressions; text that does not parse becomes NULL.
"""

from pyspark.sql import functions as F

# French month abbreviations.
FRENCH_MONTHS = {
    "janv.": "01", "févr.": "02", "mars": "03", "avr.": "04", "mai": "05", "juin": "06",
    "juil.": "07", "août": "08", "sept.": "09", "oct.": "10", "nov.": "11", "déc.": "12",
}

# Date patterns looked for in file and folder names, in this order.
NAME_DATE_PATTERNS = [
    (r"(\d{4}-\d{2}-\d{2})", "yyyy-MM-dd"),
    (r"(\d{2}-\d{2}-\d{4})", "dd-MM-yyyy"),
    (r"(\d{8})", "yyyyMMdd"),
    (r"(\d{4}_\d{2}_\d{2})", "yyyy_MM_dd"),
]


def _try_date(c, fmt):
    return F.try_to_timestamp(c, F.lit(fmt)).cast("date")


def iso(date_col):
    return F.date_format(date_col, "yyyy-MM-dd")


def norm_date(c, sample=None):
    """ISO date text. The sample (first value of the file) picks the dotted format."""
    sample = c if sample is None else sample
    dotted = F.size(F.split(sample, r"\.")) == 3
    short_year = F.length(F.element_at(F.split(sample, r"\."), -1)) == 2
    auto = F.coalesce(
        F.try_to_timestamp(c).cast("date"),
        _try_date(c, "M/d/yyyy"),
    )
    parsed = (F.when(dotted & short_year, _try_date(c, "d.M.yy"))
              .when(dotted, _try_date(c, "d.M.yyyy"))
              .otherwise(auto))
    return iso(parsed)


def norm_time(c):
    """HH:mm:ss text from H:m:s."""
    t = F.try_to_timestamp(F.concat(F.lit("2000-01-01 "), c), F.lit("yyyy-MM-dd H:m:s"))
    return F.date_format(t, "HH:mm:ss")


def name_date(c):
    """Date found in a file or folder name."""
    found = []
    for pattern, fmt in NAME_DATE_PATTERNS:
        found.append(_try_date(F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")), fmt))
    return F.coalesce(*found)


def date_from_parts(year, month, day):
    text = F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"),
                       F.lpad(day.cast("string"), 2, "0"))
    complete = year.isNotNull() & month.isNotNull() & day.isNotNull()
    return F.when(complete, _try_date(text, "yyyy-MM-dd"))


def parse_fr_date(c, year=None):
    """Date from ``8 janv. 2023``: exactly three words, a known month."""
    words = F.split(F.trim(F.regexp_replace(c, r"\s+", " ")), " ")
    months = F.create_map(*[F.lit(x) for pair in FRENCH_MONTHS.items() for x in pair])
    y = F.lit(str(year)) if year else F.get(words, F.lit(2))
    text = F.concat(y, F.lit("-"), F.try_element_at(months, F.get(words, F.lit(1))), F.lit("-"),
                    F.lpad(F.get(words, F.lit(0)), 2, "0"))
    return F.when(F.size(words) == 3, _try_date(text, "yyyy-MM-dd"))


def force_year(d, year):
    """Same day and month in ``year``; 29 February has no twin in a common year."""
    return _try_date(F.concat(F.lit(f"{year:04d}"), F.date_format(d, "-MM-dd")), "yyyy-MM-dd")


def complete_time(c):
    """``HH:MM`` gets its seconds; other text stays."""
    return F.when(F.size(F.split(c, ":")) == 2, F.concat(c, F.lit(":00"))).otherwise(c)


def time_parts(c):
    """(hour, minute) of ``H:M`` or ``H:M:S``, NULL if it is no clock time; the time dimension has no seconds."""
    return clock_parts(F.split(c, ":"))


def clock_parts(words):
    """:func:`time_parts` of a text that is split at its colons already."""
    hour, minute, second = (F.get(words, F.lit(i)).try_cast("int") for i in range(3))
    clock = (hour.between(0, 23) & minute.between(0, 59)
             & ((F.size(words) == 2) | ((F.size(words) == 3) & second.between(0, 59))))
    return F.when(clock, hour), F.when(clock, minute)


def decimal_hour(c):
    """``HH:MM`` or a plain number as hours; anything else, also ``HH:MM:SS``, is NULL."""
    parts = F.split(c, ":")
    hour = F.get(parts, F.lit(0)).try_cast("int")
    minute = F.get(parts, F.lit(1)).try_cast("int")
    return (F.when(F.size(parts) == 2, hour + minute / F.lit(60.0))
            .when(F.size(parts) == 1, F.trim(c).try_cast("double")))


def slug(c):
    return F.translate(F.lower(c), " éèà", "_eea")


def strip_quotes(c):
    return F.btrim(c, F.lit('"'))


def none_to_null(c):
    return F.when(~F.lower(c).isin("", "none"), c)


def clip_round(c, lo=0.0, digits=2):
    return F.round(F.when(c < lo, F.lit(lo)).otherwise(c), digits)


def fmt_date(c):
    return F.date_format(c, "dd.MM.yyyy")


def fmt_hour(c):
    return F.date_format(c, "HH:mm")


def number(df, name):
    """Double or NULL: text that is no number and NaN both become NULL."""
    kind = df.schema[name].dataType.typeName()
    if kind in ("integer", "long", "short", "byte"):
        return F.col(name).cast("double")
    d = F.col(name) if kind == "double" else F.col(name).try_cast("double")
    return F.when(~F.isnan(d), d)
