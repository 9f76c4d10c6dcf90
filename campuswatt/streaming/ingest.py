"""Incremental loads with Structured Streaming.

The checkpoint is the ledger: a file enters a batch once, and each run takes what is new (``availableNow``). Late
and corrected rows need no watermark, because the merges compare with the stored state. Files come as lines, and
every batch reads its files like the batch jobs do: by their own headers and encodings.
"""

import hashlib

from pyspark.sql import functions as F

from campuswatt.schemas import FEEDS
from campuswatt.sources import readers as R


def _glob(feed):
    """File pattern of a feed's names; letters may be of either case."""
    any_case = lambda text: "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in text)
    return "{" + ",".join(f"*{any_case(t)}*" for t in FEEDS[feed]) + "}.csv"


def read_drops(spark, folder, feed, files_per_batch=1000):
    """Stream of the lines of a feed's files as stored, with file and folder."""
    return R.located(spark.readStream.option("pathGlobFilter", _glob(feed)).option("recursiveFileLookup", "true")
                     .option("maxFilesPerTrigger", files_per_batch).text(folder), numbered=False)


def numbered(batch):
    """Lines of a micro-batch with their order."""
    return batch.withColumn("row", F.monotonically_increasing_id())


def ingest_stream(stream, clean, path, checkpoint, load_date=None):
    """Write the cleaned rows of every micro-batch (``clean(lines)``) to a Parquet folder, exactly once.

    A batch has a partition of its own, named after the checkpoint and the batch; a repeated batch replaces it.
    """
    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def apply(batch, batch_id):
        rows = clean(numbered(batch)).withColumn("batch", F.lit(f"{name}-{batch_id}"))
        if load_date is not None:
            rows = rows.withColumn("load_date", F.lit(load_date).cast("date"))
        parts = ["load_date", "batch"] if load_date is not None else ["batch"]
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(apply).start()


def load_once(wh, table, name, load):
    """A function of (batch, batch_id) that loads a micro-batch exactly once.

    ``load(lines, wh)`` merges the batch into ``table``. The merge and the number of the batch become visible in
    one step, so a batch that comes again, after a failure or a restart, is known and left out. Dimensions and
    rejects, which are written before, do not change when a failed batch is repeated.
    """
    def apply(batch, batch_id):
        if wh.last_batch(table, name)[0] < batch_id:
            load(numbered(batch), wh.of_batch(name, batch_id))

    return apply


def merge_stream(stream, wh, table, name, load, checkpoint):
    """Load every micro-batch of a stream into a table, exactly once. ``name`` and the checkpoint belong together."""
    return (stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
            .foreachBatch(load_once(wh, table, name, load)).start())
