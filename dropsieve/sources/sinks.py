"""Writing results, one partition per sample.

Every writer replaces only the samples it is given, so runs over some samples
leave the others in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropsieve.functions.scalars import SAMPLE
from dropsieve.operators.multimodal import GEX, PEAKS, require_both


def _writer(df: DataFrame, *partitions: str):
    # Rows of a partition come together first, else every task writes a file to each; one that is
    # very large is split again.
    df = df.hint("rebalance", *partitions)
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions)


def write_metric_csv(df: DataFrame, path: str) -> None:
    _writer(df, SAMPLE).option("header", True).option("nullValue", "NA").csv(path)


def write_qc_tables(flagged: DataFrame, path: str) -> None:
    """The cell table once, with its ``keep`` flag; pre and post are reads of it."""
    _writer(flagged, SAMPLE).parquet(path)


def read_qc_tables(spark, path: str) -> tuple[DataFrame, DataFrame]:
    """The pre-QC and the post-QC cells."""
    pre = spark.read.parquet(path)
    return pre, pre.where("keep")


def write_counts(counts: DataFrame, path: str) -> None:
    """Triplets by modality and sample, each file sorted by barcode.

    Sorted files give narrow barcode ranges per row group and let the per-cell
    sums combine before the shuffle.
    """
    ordered = counts.hint("rebalance", "modality", SAMPLE).sortWithinPartitions(SAMPLE, "barcode")
    (
        ordered.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("modality", SAMPLE)
        .parquet(path)
    )


def write_modalities(counts: DataFrame, path: str) -> None:
    """Expression and peaks apart; stops when a sample lacks one of them."""
    require_both(counts)
    write_counts(counts.where(F.col("modality").isin(GEX, PEAKS)), path)


def write_bucketed_counts(counts: DataFrame, table: str, buckets: int) -> None:
    """Triplets as a table bucketed by cell.

    Sums per cell and joins to cells then need no shuffle of the triplets.
    """
    (
        counts.write.mode("overwrite")
        .bucketBy(buckets, SAMPLE, "barcode")
        .sortBy(SAMPLE, "barcode")
        .saveAsTable(table)
    )


def to_metric_rows(summary: DataFrame) -> DataFrame:
    """A one-row-per-sample summary as rows ``(sample_id, metric, value)``."""
    names = [c for c in summary.columns if c != SAMPLE]
    rows = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in names]
    return summary.select(SAMPLE, F.inline(F.array(*rows)))


def write_summary(summary: DataFrame, path: str) -> None:
    write_metric_csv(to_metric_rows(summary), path)
