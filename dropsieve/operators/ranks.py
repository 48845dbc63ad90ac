"""Dense descending positions within groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dropsieve.functions.scalars import SAMPLE


def distributed_rank(
    df: DataFrame, value: str, ord_col: str = "ord", out: str = "rank", run: int = 65_536, then: tuple = ()
) -> DataFrame:
    """Positions 1..N per sample by ``value`` descending, ties by ``ord_col`` and ``then``.

    One window per sample would sort a whole sample in one task. Instead rows
    are numbered inside runs of equal value and at most ``run`` consecutive
    ordinals, and each run is shifted by the rows before it. The shift comes
    from a histogram over the distinct counts of a sample, of which there are
    at most ``sqrt(2 * total count)``, and from the runs of a single value.
    """
    run_col = F.floor(F.col(ord_col) / F.lit(run)).alias("_run")
    rows = df.withColumn("_run", run_col)
    hist = rows.groupBy(SAMPLE, value, "_run").agg(F.count("*").alias("_n"))
    before = (Window.unboundedPreceding, -1)
    by_value = hist.groupBy(SAMPLE, value).agg(F.sum("_n").alias("_nv"))
    w_value = Window.partitionBy(SAMPLE).orderBy(F.desc(value)).rowsBetween(*before)
    higher = by_value.select(
        SAMPLE, value, F.coalesce(F.sum("_nv").over(w_value), F.lit(0)).alias("_higher")
    )
    w_run = Window.partitionBy(SAMPLE, value).orderBy("_run").rowsBetween(*before)
    earlier = hist.select(
        SAMPLE, value, "_run", F.coalesce(F.sum("_n").over(w_run), F.lit(0)).alias("_earlier")
    )
    shift = earlier.join(higher, [SAMPLE, value]).select(
        SAMPLE, value, "_run", (F.col("_higher") + F.col("_earlier")).alias("_shift")
    )
    w_in = Window.partitionBy(SAMPLE, value, "_run").orderBy(ord_col, *then)
    return (
        rows.join(shift, [SAMPLE, value, "_run"])
        .withColumn(out, F.col("_shift") + F.row_number().over(w_in))
        .drop("_run", "_shift")
    )
