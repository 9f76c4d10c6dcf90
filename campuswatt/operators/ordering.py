"""Order-dependent building blocks that stay parallel when one key is hot.

Spark rows have no order of their own, so every operator that says "first",
"last" or "previous" takes the columns that define the order.
"""

from pyspark.sql import Window as W, functions as F

from campuswatt.session import cut_lineage


def _as_cols(order):
    return [F.col(o) if isinstance(o, str) else o for o in order]


def dedup_first(df, keys, order):
    """First row per key.

    ``row_number() = 1`` is planned with a partial group limit before the
    shuffle: every task sends at most one row per key, however hot the key is.
    """
    w = W.partitionBy(*keys).orderBy(*_as_cols(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def dedup_last(df, keys, order):
    """Last row per key; ``order`` are column names."""
    return dedup_first(df, keys, [F.col(o).desc() for o in order])


def top_n(df, col, n, tie=()):
    return df.orderBy(F.col(col).desc(), *tie).limit(n)


FEW_ROWS = 200_000      # rows that one task sorts and numbers
RUN_ROWS = 1_000_000    # rows of a run beyond that
FEW_RUNS = 100_000      # offsets, one a run, that are broadcast


def _tie(rows):
    """A number of the whole row, so that rows with equal order columns can lie in several runs."""
    kinds = [f.dataType.simpleString() for f in rows.schema.fields]
    return F.xxhash64(*[F.col(f"`{c}`") for c, kind in zip(rows.columns, kinds) if "map<" not in kind and "variant" not in kind])


def _in_runs(rows, keys, n, run_rows):
    """The ``n`` rows with ``_run`` and ``_at``, their run and place in it: sorted ranges of all order columns, written once.

    Ranges are cut in the order columns and then in the tie, so a value of many rows is spread over runs. Rows
    that are equal in everything lie together; which of them is first makes no difference.
    """
    ranges = -(-n // run_rows)
    by = [*keys, "_tie"]
    placed = (rows.withColumn("_tie", _tie(rows)).repartitionByRange(ranges, *by).sortWithinPartitions(*by)
              .withColumns({"_run": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))
    return cut_lineage(placed.withColumn("_at", F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_tie")), ranges


def _with_offsets(rows, ranges, total):
    """Add ``_offset``: the total of all runs before."""
    before = W.orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    offsets = (rows.groupBy("_run").agg(total.alias("_sum"))
               .select("_run", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset")))
    return rows.join(F.broadcast(offsets) if ranges <= FEW_RUNS else offsets, "_run")


def _keyed(df, order):
    keys = {f"_key{i}": c for i, c in enumerate(_as_cols(order))}
    return df.withColumns(keys), list(keys)


def running_total(df, order, weight, into="_total", few=FEW_ROWS, run_rows=RUN_ROWS):
    """Sum of ``weight`` over all rows up to and including each one; rows with equal order come in any order.

    The rows are counted first. A few are summed in one sort. More are cut into runs, as many as their number
    needs, and each run sums up its rows on top of the total of the runs before it.
    """
    rows, keys = _keyed(df, order)
    n = df.count()
    if n <= few:
        within = W.orderBy(*keys).rowsBetween(W.unboundedPreceding, 0)
        return rows.withColumn(into, F.sum(weight).over(within)).drop(*keys)
    runs, ranges = _in_runs(rows, keys, n, run_rows)
    within = W.partitionBy("_run").orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    return (_with_offsets(runs, ranges, F.sum(weight)).withColumn(into, F.col("_offset") + F.sum(weight).over(within))
            .drop("_run", "_at", "_offset", *keys))


def global_position(df, order, into="_pos", few=FEW_ROWS, run_rows=RUN_ROWS):
    """Dense 0-based position of each row in the total order; rows with equal order come in any order.

    The rows are counted first. A few are numbered in one sort. More are sorted into runs, as many as their
    number needs; a row's position is its place in the run behind the rows of the runs before it.
    """
    rows, keys = _keyed(df, order)
    n = df.count()
    if n <= few:
        return rows.withColumn(into, F.row_number().over(W.orderBy(*keys)) - 1).drop(*keys)
    runs, ranges = _in_runs(rows, keys, n, run_rows)
    placed = _with_offsets(runs, ranges, F.count("*"))
    return placed.withColumn(into, F.col("_offset") + F.col("_at")).drop("_run", "_at", "_offset", *keys)


# --- regular series -------------------------------------------------------------

def regular(df, keys, ts, order):
    """One row per series and timestamp (the first): the contract of the series operators."""
    return dedup_first(df, [*keys, ts], order)


def bucketed(df, ts, bucket="month"):
    """Cut series into calendar buckets; a bucket of a regular series is bounded by its grid."""
    return df.withColumn("_bucket", F.date_trunc(bucket, F.col(ts)))


def cell(*columns):
    """One join key of several columns. Structs with the same NULL fields are equal, so no row gets lost."""
    return F.struct(*columns)


def series_position(df, keys, ts, bucket="month", into="_pos"):
    """Dense 0-based position of each row in its series, without a window over the series.

    The rows come out partitioned by series and bucket: the explicit shuffle keeps an
    input partitioned by series from pinning a long series to one task.
    """
    df = bucketed(df, ts, bucket).withColumn("_cell", cell(*keys, "_bucket"))
    before = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (df.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
               .select(cell(*keys, "_bucket").alias("_cell"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    rank = F.row_number().over(W.partitionBy("_cell").orderBy(ts)) - 1
    return (df.repartition("_cell").withColumn("_rank", rank).join(offsets, "_cell")
            .withColumn(into, F.col("_offset") + F.col("_rank")).drop("_rank", "_offset", "_cell"))


def with_halo(df, keys, pos, before, chunk=4096):
    """Chunks of a positioned series, each preceded by copies of the ``before`` rows left of it.

    Windows that look back at most ``before`` rows can then run per chunk.
    """
    if before >= chunk:
        chunk = before + 1
    own = F.floor(F.col(pos) / chunk).cast("long")
    lends = F.col(pos) % chunk >= chunk - before
    copies = F.when(lends, F.array(own, own + 1)).otherwise(F.array(own))
    return (df.withColumn("_chunk", F.explode(copies))
            .withColumn("_halo", F.col("_chunk") != own))
