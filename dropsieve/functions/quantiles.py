"""Exact quantiles of groups too large for one task.

The built-in exact ``percentile`` keeps every distinct value of a group in one
map. That is fine for counts, whose distinct values are few, but not for a
double metric over a sample with billions of cells. Here a sketch first finds a
narrow value window around each wanted quantile; values outside all windows are
collapsed to the window edge below them, which keeps their order. The exact
aggregate then runs on ``(value, frequency)`` pairs and its state is a small
share of the group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropsieve.functions.sizing import sized


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    accuracy: int = 10_000,
    out: str = "q",
) -> DataFrame:
    """Array ``out`` of linearly interpolated quantiles of ``value`` per ``keys``.

    NULLs are ignored. Groups of up to ``accuracy`` rows need no windows. Those of
    larger groups are four times as wide as the sketch's error bound. Their coverage is still checked: should a window miss its quantile,
    the query fails instead of giving a wrong number.
    """
    src = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    eps = 4.0 / accuracy
    wanted = [min(max(p + d, 0.0), 1.0) for p in probs for d in (-eps, eps)]
    edges = src.groupBy(*keys).agg(
        F.percentile_approx("_v", wanted, accuracy).alias("_e"), F.count("*").alias("_size")
    )
    lo = [F.col("_e")[2 * i] for i in range(len(probs))]
    hi = [F.col("_e")[2 * i + 1] for i in range(len(probs))]

    inside = F.col("_size") <= accuracy
    for a, b in zip(lo, hi):
        inside = inside | F.col("_v").between(a, b)
    below = F.greatest(
        F.lit(float("-inf")), *[F.when(b < F.col("_v"), b) for b in hi]
    )
    freq = (
        src.join(sized(edges), list(keys))
        .withColumn("_gap", ~inside)
        .withColumn("_f", F.when(F.col("_gap"), below).otherwise(F.col("_v")))
        .groupBy(*keys, "_f", "_gap")
        .agg(F.count("*").alias("_n"), F.first("_e").alias("_e"), F.first("_size").alias("_size"))
    )
    checks = []
    for i in range(len(probs)):
        under = F.sum(F.when(F.col("_f") < lo[i], F.col("_n")).otherwise(0))
        upto = F.sum(
            F.when(
                (F.col("_f") < hi[i]) | ((F.col("_f") == hi[i]) & ~F.col("_gap")), F.col("_n")
            ).otherwise(0)
        )
        checks += [under.alias(f"_u{i}"), upto.alias(f"_t{i}")]
    plist = ", ".join(repr(float(p)) + "D" for p in probs)
    agg = freq.groupBy(*keys).agg(
        F.expr(f"percentile(_f, array({plist}), _n)").alias("_q"),
        F.first("_size").alias("_all"),
        *checks,
    )
    covered = F.lit(True)
    for i, p in enumerate(probs):
        pos = (F.col("_all") - 1) * F.lit(float(p))
        covered = covered & (F.col(f"_u{i}") <= F.floor(pos)) & (F.col(f"_t{i}") > F.ceil(pos))
    covered = covered | (F.col("_all") <= accuracy)
    return agg.select(
        *keys,
        F.when(covered, F.col("_q"))
        .otherwise(F.raise_error(F.lit("quantile window missed its rank; raise accuracy")))
        .alias(out),
    )


def exact_median(df, keys, value, out: str = "median", accuracy: int = 10_000) -> DataFrame:
    q = exact_quantiles(df, keys, value, [0.5], accuracy, out="_m")
    return q.select(*keys, F.col("_m")[0].alias(out))
