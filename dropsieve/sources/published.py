"""Publishing in two phases: a failed or half-finished write is never read.

``publish`` writes its rows to a folder of its own run. Only when that is done, a commit says for each
sample of the run that its rows are there now; the commits of a run are one file, which appears at once
or not at all. Readers take each sample from the run that was committed last. Until then, and after a
write that failed, they see what was there before.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropsieve.functions.scalars import SAMPLE
from dropsieve.functions.sizing import fits_broadcast

COMMITS = f"{SAMPLE} string, run string, seq long"


def publish(df: DataFrame, path: str) -> str:
    """Replaces the samples that ``df`` has under ``path``; the others stay. Returns the run's name.

    Rows of a null sample are refused: no reader could ask for them.
    """
    spark, run = df.sparkSession, uuid.uuid4().hex
    named = F.when(F.col(SAMPLE).isNull(), F.raise_error(F.lit("a row without a sample")).cast("string"))
    rows = df.withColumn(SAMPLE, named.otherwise(F.col(SAMPLE).cast("string")))
    at = f"{path}/runs/run={run}"
    rows.hint("rebalance", SAMPLE).write.partitionBy(SAMPLE).parquet(at)
    samples = spark.read.schema(rows.schema).parquet(at).select(SAMPLE).distinct()
    commit = samples.withColumns({"run": F.lit(run), "seq": F.lit(time.time_ns())})
    commit.coalesce(1).write.mode("append").parquet(f"{path}/commits")
    return run


def current_runs(spark: SparkSession, path: str) -> DataFrame:
    """The run that each sample is read from: ``sample_id, run``."""
    commits = spark.read.schema(COMMITS).parquet(f"{path}/commits")
    return commits.groupBy(SAMPLE).agg(F.max_by("run", F.struct("seq", "run")).alias("run"))


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The rows committed last for every sample.

    Samples are folders, so only the files of the runs asked for are read.
    """
    found = spark.read.parquet(f"{path}/runs").schema
    # Names of samples such as 007 stay as they are.
    text = [T.StructField(f.name, T.StringType()) if f.name in (SAMPLE, "run") else f for f in found]
    rows = spark.read.schema(T.StructType(text)).parquet(f"{path}/runs")
    now = current_runs(spark, path)
    return rows.join(F.broadcast(now) if fits_broadcast(now) else now, [SAMPLE, "run"], "left_semi").drop("run")


def drop_superseded(spark: SparkSession, path: str) -> list[str]:
    """Deletes the runs that no sample is read from; not while a ``publish`` is under way."""
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(f"{path}/runs")
    fs = folder.getFileSystem(sc._jsc.hadoopConfiguration())
    # One name a run, not a row or a sample.
    used = {r["run"] for r in current_runs(spark, path).select("run").distinct().collect()}
    gone = []
    for entry in fs.listStatus(folder):
        run = entry.getPath().getName().removeprefix("run=")
        if run not in used:
            fs.delete(entry.getPath(), True)
            gone.append(run)
    return gone
