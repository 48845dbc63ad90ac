"""Per-sample overview, feature totals and the tables behind the report plots."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dropsieve.functions.quantiles import exact_quantiles
from dropsieve.functions.scalars import SAMPLE, percent, present
from dropsieve.functions.sizing import sized

QC_METRICS = ("n_feature", "n_count", "pct_mt", "nuclear_fraction", "doublet_score")
# Metrics with a natural range; the others are scaled to the data.
FIXED_RANGES = {"pct_mt": (0.0, 100.0), "nuclear_fraction": (0.0, 1.0), "doublet_score": (0.0, 1.0)}


def unpivot(cells: DataFrame, metrics: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form ``(sample_id, metric, value)`` of the metrics that exist."""
    rows = [
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
        for m in present(cells, metrics)
    ]
    return cells.select(SAMPLE, *keep, F.inline(F.array(*rows)))


def sample_overview(cells: DataFrame, kept: DataFrame) -> DataFrame:
    """One row per sample. ``kept`` lists the features left after the load filters.

    Medians are over counts, whose few distinct values keep the exact median's
    state small.
    """
    cols = set(cells.columns)
    aggs = [
        F.count("*").alias("total_cells"),
        F.median("n_count").alias("median_umi"),
        F.median("n_feature").alias("median_features"),
        F.avg("n_count").alias("mean_umi"),
        F.avg("n_feature").alias("mean_features"),
        F.avg("pct_mt").alias("mean_mt_pct"),
        F.avg("pct_rb").alias("mean_rb_pct"),
    ]
    if "nuclear_fraction" in cols:
        aggs.append(F.avg("nuclear_fraction").alias("mean_nuclear_fraction"))
    if "doublet_class" in cols:
        is_doublet = (F.col("doublet_class") == "doublet").cast("int")
        aggs.append((F.avg(is_doublet) * 100).alias("doublet_rate_pct"))
    if "keep" in cols:
        aggs += [
            F.count_if("keep").alias("cells_post"),
            percent(F.count_if("keep"), F.count("*")).alias("pct_retained"),
        ]
    features = kept.groupBy(SAMPLE).agg(F.count("*").alias("total_features"))
    return cells.groupBy(SAMPLE).agg(*aggs).join(features, SAMPLE, "left")


def feature_totals(counts: DataFrame) -> DataFrame:
    """Total count of each feature and its share of the sample, in percent."""
    totals = counts.groupBy(SAMPLE, "feature_id").agg(F.sum("n").alias("total"))
    whole = F.sum("total").over(Window.partitionBy(SAMPLE))
    return totals.withColumn("pct", percent(F.col("total"), whole))


def top_features(totals: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` largest features per sample, in order."""
    w = Window.partitionBy(SAMPLE).orderBy(F.desc("total"), "feature_id")
    return totals.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_features_overall(counts: DataFrame, k: int = 10) -> DataFrame:
    totals = counts.groupBy("feature_id").agg(F.sum("n").alias("total"))
    return totals.orderBy(F.desc("total"), "feature_id").limit(k)


def recommended_thresholds(cells: DataFrame) -> DataFrame:
    """Cut-offs from the 1st and 99th percentile of features and the 95th of mt percent."""
    features = cells.groupBy(SAMPLE).agg(
        F.expr("percentile(n_feature, array(0.01D, 0.99D))").alias("_f")
    )
    mito = exact_quantiles(cells, [SAMPLE], "pct_mt", [0.95], out="_m")
    return features.join(mito, SAMPLE, "left").select(
        SAMPLE,
        F.bround(F.col("_f")[0], 0).alias("min_features"),
        F.bround(F.col("_f")[1], 0).alias("max_features"),
        F.bround(F.col("_m")[0], 1).alias("max_mt_pct"),
    )


def metric_summary(cells: DataFrame, metrics: Sequence[str] = QC_METRICS) -> DataFrame:
    """Min, quartiles, mean and max of each existing metric, NULLs ignored."""
    keys = [SAMPLE, "metric"]
    x = unpivot(cells, metrics)
    base = x.groupBy(*keys).agg(
        F.min("value").alias("min"), F.avg("value").alias("mean"), F.max("value").alias("max")
    )
    q = exact_quantiles(x, keys, "value", [0.25, 0.5, 0.75])
    return base.join(q, keys, "left").select(
        *keys,
        "min",
        F.col("q")[0].alias("q1"),
        F.col("q")[1].alias("median"),
        "mean",
        F.col("q")[2].alias("q3"),
        "max",
    )


def metric_distribution(
    cells: DataFrame,
    metrics: Sequence[str] = QC_METRICS,
    probs: Sequence[float] = (0.05, 0.25, 0.5, 0.75, 0.95),
) -> DataFrame:
    """Quantile grid of each metric per sample, long form."""
    q = exact_quantiles(unpivot(cells, metrics), [SAMPLE, "metric"], "value", probs)
    grid = F.array(*[F.lit(float(p)) for p in probs])
    pairs = F.inline(F.arrays_zip(grid.alias("prob"), F.col("q").alias("value")))
    return q.select(SAMPLE, "metric", pairs)


def _binned(x: DataFrame, keys: Sequence[str], bins: int) -> DataFrame:
    """Adds ``bin`` in 1..bins over the range of each key group."""
    limits = x.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = F.col("hi") - F.col("lo")
    pos = F.floor(F.try_divide(F.col("value") - F.col("lo"), width) * bins) + 1
    inner = F.least(F.coalesce(pos, F.lit(1)), F.lit(bins)).cast("int")
    return x.join(sized(limits), list(keys)).withColumn("bin", inner)


def metric_histogram(
    cells: DataFrame,
    metrics: Sequence[str],
    bins: int = 50,
    log10: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """Counts in ``bins`` equal bins per sample and metric, optionally split by class.

    On the log scale values of 0 and below have no place and are left out.
    """
    x = unpivot(cells, metrics, by).where(F.col("value").isNotNull())
    if log10:
        x = x.where(F.col("value") > 0).withColumn("value", F.log10("value"))
    return (
        _binned(x, [SAMPLE, "metric"], bins)
        .groupBy(SAMPLE, "metric", *by, "bin")
        .agg(F.count("*").alias("n"), F.min("lo").alias("lo"), F.min("hi").alias("hi"))
    )


def metric_trend(cells: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` for each pair of existing metrics."""
    have = set(cells.columns)
    used = [(x, y) for x, y in pairs if x in have and y in have]
    aggs = []
    for x, y in used:
        a, b = F.col(y).cast("double"), F.col(x).cast("double")
        name = f"{x}__{y}"
        aggs += [
            F.regr_slope(a, b).alias(f"{name}__s"),
            F.regr_intercept(a, b).alias(f"{name}__i"),
            F.regr_r2(a, b).alias(f"{name}__r"),
        ]
    wide = cells.groupBy(SAMPLE).agg(*aggs)
    rows = [
        F.struct(
            F.lit(x).alias("x"),
            F.lit(y).alias("y"),
            F.col(f"{x}__{y}__s").alias("slope"),
            F.col(f"{x}__{y}__i").alias("intercept"),
            F.col(f"{x}__{y}__r").alias("r2"),
        )
        for x, y in used
    ]
    return wide.select(SAMPLE, F.inline(F.array(*rows)))


def metric_correlation(cells: DataFrame, metrics: Sequence[str] = QC_METRICS) -> DataFrame:
    """Pearson correlation of every pair of existing metrics, long form."""
    pairs = list(combinations(present(cells, metrics), 2))
    aggs = [
        F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}")
        for a, b in pairs
    ]
    wide = cells.groupBy(SAMPLE).agg(*aggs)
    rows = [
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"{a}__{b}").alias("r"))
        for a, b in pairs
    ]
    return wide.select(SAMPLE, F.inline(F.array(*rows)))


def axis_ranges(cells: DataFrame, metrics: Sequence[str] = QC_METRICS) -> DataFrame:
    """Plot range per metric: fixed where natural, else data range with 5 % padding."""
    names = present(cells, metrics)
    aggs = []
    for m in names:
        if m not in FIXED_RANGES:
            x = F.col(m).cast("double")
            aggs += [F.min(x).alias(f"{m}_a"), F.max(x).alias(f"{m}_b")]
    wide = cells.groupBy(SAMPLE).agg(F.count("*").alias("_n"), *aggs)
    rows = []
    for m in names:
        if m in FIXED_RANGES:
            lo, hi = (F.lit(v) for v in FIXED_RANGES[m])
        else:
            pad = (F.col(f"{m}_b") - F.col(f"{m}_a")) * 0.05
            lo, hi = F.greatest(F.lit(0.0), F.col(f"{m}_a") - pad), F.col(f"{m}_b") + pad
        rows.append(F.struct(F.lit(m).alias("metric"), lo.alias("lo"), hi.alias("hi")))
    return wide.select(SAMPLE, F.inline(F.array(*rows)))


def assessment(overview: DataFrame) -> DataFrame:
    """Status of a sample's cell count, depth, complexity and mt percent, long form."""
    deep = F.col("median_umi") > 1000
    clean = F.col("mean_mt_pct") < 20

    def row(aspect, value, ok, good, bad):
        status = F.when(ok, F.lit(good)).otherwise(F.lit(bad))
        return F.struct(
            F.lit(aspect).alias("aspect"), value.cast("double").alias("value"), status.alias("status")
        )

    quality = F.when(deep & clean, F.lit(1)).otherwise(F.lit(0))
    rows = F.array(
        row("cell_count", F.col("total_cells"), F.col("total_cells") > 500, "Adequate", "Low"),
        row("median_umi", F.col("median_umi"), deep, "Good", "Low"),
        row("median_features", F.col("median_features"), F.col("median_features") > 500, "Good", "Low"),
        row("mean_mt_pct", F.col("mean_mt_pct"), clean, "Good", "High"),
        row("data_quality", quality, deep & clean, "High", "Moderate"),
    )
    return overview.select(SAMPLE, F.inline(rows))
