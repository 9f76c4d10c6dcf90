"""Session settings the library relies on."""

import tempfile
import uuid

from pyspark.sql import SparkSession, functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app="campuswatt", master=None, **extra):
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark):
    """The cluster's shared checkpoint folder; a folder of our own only on a local master."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="campuswatt-"))
    return sc.getCheckpointDir()


def cut_lineage(df):
    """Write ``df`` to the shared checkpoint folder and go on from there.

    All later reads agree and survive lost executors. Parquet, so that they also
    prune columns and know the size of what they read.
    """
    spark = df.sparkSession
    folder = f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def empty_table(spark, schema):
    """No rows of the schema."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
