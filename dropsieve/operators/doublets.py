"""Summaries of doublet scores and classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dropsieve.functions.quantiles import exact_median
from dropsieve.functions.scalars import SAMPLE, percent


def doublet_summary(metrics: DataFrame) -> DataFrame:
    """Totals, rate, mean and median score per sample."""
    doublets = F.count_if(F.col("doublet_class") == "doublet")
    stats = metrics.groupBy(SAMPLE).agg(
        F.count("*").alias("total_cells"),
        F.count_if(F.col("doublet_class") == "singlet").alias("singlets"),
        doublets.alias("doublets"),
        F.bround(percent(doublets, F.count("*")), 2).alias("doublet_rate"),
        F.avg("doublet_score").alias("mean_score"),
    )
    med = exact_median(metrics, [SAMPLE], "doublet_score", "median_score")
    return stats.join(med, SAMPLE, "left")


def class_counts(cells: DataFrame, column: str = "doublet_class") -> DataFrame:
    """Frequency and percentage of each class per sample; NULLs are left out."""
    n = cells.where(F.col(column).isNotNull()).groupBy(SAMPLE, column).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(SAMPLE))
    return n.withColumn("pct", F.bround(percent(F.col("n"), total), 1))


def class_line(cells: DataFrame, column: str = "doublet_class") -> DataFrame:
    """The class table of a sample as one line, ``a: 1, b: 2``."""
    n = cells.where(F.col(column).isNotNull()).groupBy(SAMPLE, column).agg(F.count("*").alias("n"))
    item = n.withColumn("item", F.concat_ws(": ", F.col(column), F.col("n").cast("string")))
    line = F.expr(f"listagg(item, ', ') WITHIN GROUP (ORDER BY {column})")
    return item.groupBy(SAMPLE).agg(line.alias("classes"))
