"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators count on: adaptive plans, skewed joins split even where
# that costs another shuffle, hash joins where every shuffled part of a side is small,
# no sort before a task writes its one bucket, and per-partition overwrite for the sinks.
SETTINGS = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "2",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# What Spark has where nothing is set; other values were chosen and are left alone.
DEFAULTS = {
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0b",
    "spark.sql.maxConcurrentOutputFileWriters": "0",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
    "spark.sql.sources.partitionOverwriteMode": "STATIC",
    "spark.sql.execution.arrow.pyspark.enabled": "false",
}


def build_session(app: str = "dropsieve", master: str | None = None, **extra: str) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**SETTINGS, **extra}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """The settings for a session that is given; what it has set itself stays."""
    for k, v in SETTINGS.items():
        if spark.conf.isModifiable(k) and spark.conf.get(k, None) in (None, DEFAULTS.get(k)):
            spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A session in one process, as in tests, gets a temporary one without the
    setting. On a cluster, a local one included, such a folder would be lost
    with its machine, so there it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    made = tempfile.mkdtemp(prefix="dropsieve-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def store_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, dealt: bool = False) -> DataFrame:
    """Writes ``df`` as a table in the shared folder, bucketed by ``keys``.

    Windows, sums and joins on the keys then read it without a shuffle. ``dealt`` tells that ``df`` comes
    out of ``repartition(buckets, *keys)`` and needs no other.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    (
        (df if dealt else df.repartition(buckets, *keys))
        .write.bucketBy(buckets, *keys)
        .option("path", f"{shared_dir(spark)}/{table}")
        .saveAsTable(table)
    )
    return spark.table(table)


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts the lineage of ``df`` with a reliable checkpoint."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


class Scratch:
    """Tables of one run of an iteration, written to the shared folder and read again.

    A checkpoint keeps the size that was estimated for its plan, and every join multiplies sizes: after
    some rounds the numbers alone take minutes. A written table has the size of its files.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.n = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.folder}/{self.n}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self, but: int = 0) -> None:
        """Deletes the tables but the last ``but``."""
        sc = self.spark.sparkContext
        for i in range(1, self.n + 1 - but):
            at = sc._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{i}")
            at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)
