"""What the operators share: reading tables, settled intermediate tables, packed numbers, components."""

import numpy as np
from pyspark.sql import functions as F, types as T

from campuswatt.session import cut_lineage


BATCH_ROWS = 2000     # texts may be long: few of them go between Spark and Python at a time


def bound_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark, sf_dir, name):
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df):
    """Write ``df`` to the shared checkpoint folder; later reads agree and survive lost executors."""
    return cut_lineage(df)


def row_key(*columns):
    """Identity of a row: 16 bytes of the SHA-256 of its columns, nulls told apart."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.substring(F.unhex(F.sha2(F.concat_ws("\x1f", *parts).cast("binary"), 256)), 1, 16)


def own_name(df, name):
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while f"_{name}" in taken:
        name = f"_{name}"
    return f"_{name}"


def with_columns(schema, **kinds):
    """The schema and further columns."""
    return T.StructType(schema.fields + [T.StructField(n, T.DataType.fromDDL(k)) for n, k in kinds.items()])


def partitions(spark, rows=0, per=1):
    """Partitions for ``rows`` rows at ``per`` a partition, the session's number at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(rows) // per))


def pack(values, width):
    """The low ``width`` bytes of 64-bit numbers, byte plane by byte plane (planes that repeat compress)."""
    raw = np.ascontiguousarray(values, dtype="<u8").view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(raw[:, :width].T).tobytes()


def unpack(blob, width):
    planes = np.frombuffer(blob, dtype=np.uint8).reshape(width, -1)
    raw = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    raw[:, :width] = planes.T
    return raw.view("<u8").ravel()


def runs(sorted_values):
    """Start of every run of equal values, with the total length at the end."""
    if len(sorted_values) == 0:
        return np.zeros(1, dtype=np.int64)
    change = np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1
    return np.concatenate([[0], change, [len(sorted_values)]])


def components(edges):
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node it reaches.

    Large-star and small-star steps in turn: each hangs neighbours on the smallest one seen,
    so chains shrink by about half a round. Every round is written out; nothing but a count of
    changed links reaches the driver. A node's neighbours only meet in a minimum.
    """
    edges = settle(edges.select("a", "b").filter("a <> b").distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        low = low.select("a", F.least("a", "low").alias("low"))
        # large star: every larger neighbour of a node hangs on the smallest of its neighbours
        large = (both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
                 .filter("a <> b").distinct())
        # small star: the smaller neighbours of a node hang on the smallest of them
        down = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (large.join(down, "a")
                 .select(F.explode(F.array(F.struct(F.col("a"), F.col("low").alias("b")),
                                           F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
                 .select("e.a", "e.b").filter("a <> b").distinct())
        after = settle(small)
        # done when every node has one link and no target has one itself
        state = after.groupBy("a").agg(F.count("*").alias("n"))
        open_nodes = (state.filter("n > 1").select("a")
                      .unionByName(after.select(F.col("b").alias("a")).join(state.select("a"), "a", "left_semi")))
        edges = after
        if open_nodes.isEmpty():
            break
    roots = edges.select(F.col("b").alias("node")).distinct()
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(roots.select("node", F.col("node").alias("root"))))
