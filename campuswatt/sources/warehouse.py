"""Warehouse tables as versions of Parquet folders; facts are partitioned by month."""

import threading

from pyspark.sql import functions as F, types as T

from campuswatt.schemas import DIMENSIONS, TABLES
from campuswatt.session import cut_lineage, empty_table
from campuswatt.sources import manifest as M


WHOLE = "all"           # the one part of a dimension
MOST_FOLDERS = 32       # folders of a part before an append writes it anew

_REJECTING = threading.Lock()    # facts that load at once share the table of rejects

REJECTS = T.StructType([T.StructField(n, T.StringType()) for n in ("table", "reason", "row")])


class Warehouse:
    """Tables of the galaxy schema under one root folder (shared storage on a cluster).

    Every write is a new version of its table (see :mod:`campuswatt.sources.manifest`): it becomes visible as a
    whole or not at all. ``stream`` and ``batch`` name the micro-batch the writes of this object belong to.
    """

    def __init__(self, spark, root, stream=None, batch=None):
        self.spark, self.root = spark, root.rstrip("/")
        self.stream, self.batch = stream, batch

    def path(self, table):
        return f"{self.root}/{table}"

    def of_batch(self, stream, batch):
        """The same warehouse, for the writes of one micro-batch."""
        return Warehouse(self.spark, self.root, stream, batch)

    def last_batch(self, table, stream):
        """(batch, counters) of the last batch of a stream that reached the table, or (-1, None)."""
        found = M.latest(self.spark, self.path(table)).batches.get(stream)
        return (found["batch"], found["stats"]) if found else (-1, None)

    def create_tables(self):
        """Create missing tables, empty."""
        for name in TABLES:
            if not M.latest(self.spark, self.path(name)).number:
                M.commit(self.spark, self.path(name), M.Manifest())

    def _empty(self, name):
        return empty_table(self.spark, TABLES[name])

    def _rows(self, table, manifest, parts):
        """Rows of some parts of a version. Only their folders are listed."""
        folders = sorted({f"{self.path(table)}/{folder}" + (f"/{part}" if part != WHOLE else "")
                          for part in parts for folder in manifest.parts.get(part, ())})
        if not folders:
            return self._empty(table)
        rows = self.spark.read.schema(TABLES[table]).option("basePath", self.path(table)).parquet(*folders)
        return rows.select(*TABLES[table].names)

    def read(self, table):
        """Rows of a table. A new table has no files yet, so the schema comes from the code."""
        manifest = M.latest(self.spark, self.path(table))
        return self._rows(table, manifest, manifest.parts)

    def months(self, table, months):
        """Rows of the given months only."""
        return self._rows(table, M.latest(self.spark, self.path(table)), [f"ym={m}" for m in months])

    def _store(self, table, df, replace, stats):
        """Write the rows to a version of their own, then switch. Rebalancing by month keeps the files few and
        even, also when one month has most rows."""
        manifest = M.latest(self.spark, self.path(table))
        version = M.new_version(manifest)
        folder = f"{self.path(table)}/{version}"
        rows = df.select(*TABLES[table].names)
        if table in DIMENSIONS:
            rows.write.parquet(folder)
            written = [WHOLE]
        else:
            rows.hint("rebalance", "ym").write.partitionBy("ym").parquet(folder)
            written = [f"ym={m}" for m in M.parts_of(self.spark, folder, "ym")]
        counters = stats() if stats else None
        for part in written:
            manifest.parts[part] = [version] if replace else [*manifest.parts.get(part, []), version]
        if self.stream is not None:
            manifest.batches[self.stream] = {"batch": self.batch, "stats": counters}
        M.commit(self.spark, self.path(table), manifest)
        M.tidy(self.spark, self.path(table))
        return counters

    def write(self, table, df, stats=None):
        """Replace a dimension, or the months of a fact that ``df`` contains, in one step.

        The rows usually derive from the table itself; the files they are read from stay. ``stats`` gives the
        counters of the rows once they are written; they are returned, and kept with the batch.
        """
        return self._store(table, df, True, stats)

    def append(self, table, df, stats=None):
        """Add rows; stored files stay as they are, until a part has ``MOST_FOLDERS`` and is written anew."""
        parts = M.latest(self.spark, self.path(table)).parts
        full = [part for part, folders in parts.items() if len(folders) >= MOST_FOLDERS]
        if not full:
            return self._store(table, df, False, stats)
        if table in DIMENSIONS:
            return self._store(table, self.read(table).unionByName(df.select(*TABLES[table].names)), True, stats)
        df = df.select(*TABLES[table].names)
        months = sorted({*touched(df, "ym"), *(int(p[3:]) for p in full)})
        return self._store(table, self.months(table, months).unionByName(df), True, stats)

    def reject(self, table, rows):
        """Keep rejected rows as JSON with their reason; a row that is there already is not added again."""
        rest = [c for c in rows.columns if c != "reason"]
        kept = rows.select(F.lit(table).alias("table"), "reason", F.to_json(F.struct(*rest)).alias("row")).distinct()
        with _REJECTING:
            empty_table(self.spark, REJECTS).write.mode("ignore").parquet(self.path("rejects"))
            fresh = cut_lineage(kept.join(self.rejects(), REJECTS.names, "left_anti"))
            fresh.write.mode("append").parquet(self.path("rejects"))

    def rejects(self):
        return self.spark.read.schema(REJECTS).parquet(self.path("rejects"))

    def read_jdbc(self, url, table, key, lower, upper, partitions, **options):
        """The same table in a database, read in parallel key ranges."""
        return (self.spark.read.format("jdbc").options(
            url=url, dbtable=table, partitionColumn=key, lowerBound=lower, upperBound=upper,
            numPartitions=partitions, **options).load())


def month_key(date):
    """yyyymm of a DATE or timestamp column."""
    return (F.year(date) * 100 + F.month(date)).cast("int")


def touched(batch, ym):
    """Different months of a column or expression: one small number per calendar month."""
    return sorted(r[0] for r in batch.select(ym).distinct().dropna().collect())


def touched_months(batch, date="date"):
    """Months of a batch."""
    return touched(batch, month_key(F.col(date)))
