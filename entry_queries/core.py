"""Registry: every query has a column spec, a Spark side and (where SQL can say it) an oracle.

Column spec: ``name:type`` words; i = whole number, f = double to 4 places,
s = text, d = date, t = timestamp. Both sides select by the same spec.
"""

import re
from dataclasses import dataclass

from pyspark.sql import functions as F

from entry_queries.views import SQL_VIEWS, Views

QUERIES = {}

# Exact halves of the 4th place round differently in the two engines; a nudge far
# below that place puts them on the same side in both.
NUDGE = 0.0000003


@dataclass
class Query:
    name: str
    spec: str
    build: callable
    sql: str | None

    def run(self, spark, sf_dir):
        return output(self.build(Views(spark, sf_dir)), self.spec)

    def oracle(self):
        return None if self.sql is None else oracle(self.sql, self.spec)


def query(name, spec, sql=None):
    def register(build):
        QUERIES[name] = Query(name, spec, build, sql)
        return build
    return register


def _columns(spec):
    return [c.split(":") for c in spec.split()]


def output(df, spec):
    as_type = {
        "i": lambda c: c.cast("bigint"),
        "f": lambda c: F.round(c.cast("double") + F.lit(NUDGE), 4) + F.lit(0.0),
        "s": lambda c: c.cast("string"),
        "d": lambda c: F.date_format(c, "yyyy-MM-dd"),
        "t": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss"),
    }
    return df.select(*[as_type[kind](F.col(name)).alias(name) for name, kind in _columns(spec)])


def oracle(sql, spec):
    as_type = {
        "i": 'CAST("{0}" AS BIGINT)',
        "f": 'round(CAST("{0}" AS DOUBLE) + ' + str(NUDGE) + ', 4) + 0.0',
        "s": 'CAST("{0}" AS VARCHAR)',
        "d": "strftime(CAST(\"{0}\" AS DATE), '%Y-%m-%d')",
        "t": "strftime(CAST(\"{0}\" AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')",
    }
    cols = ", ".join(as_type[kind].format(name) + f' AS "{name}"' for name, kind in _columns(spec))
    parts = [f"{name} AS ({SQL_VIEWS[name]})" for name in _needed(sql)]
    body = sql.strip()
    if body.upper().startswith("WITH "):
        parts.append(body[5:].rsplit("\nSELECT ", 1)[0].rstrip())
        body = "SELECT " + body.rsplit("\nSELECT ", 1)[1]
    parts.append(f"result AS ({body})")
    return "WITH " + ",\n".join(parts) + f"\nSELECT {cols} FROM result"


def _needed(sql):
    """Views a query uses, directly or through other views, in definition order."""
    used, todo = set(), [sql]
    while todo:
        text = todo.pop()
        for name in SQL_VIEWS:
            if name not in used and re.search(rf"\b{name}\b", text):
                used.add(name)
                todo.append(SQL_VIEWS[name])
    return [n for n in SQL_VIEWS if n in used]
