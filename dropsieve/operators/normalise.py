"""Log-normalisation, variable features and scaling, all on sparse triplets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropsieve.functions.scalars import CELL, SAMPLE
from dropsieve.functions.sizing import fits_broadcast
from dropsieve.functions.sizing import sized
from dropsieve.params import EmbedParams
from dropsieve.session import checkpoint

FEATURE = [SAMPLE, "feature_id"]


def log_normalise(counts: DataFrame, cells: DataFrame, p: EmbedParams) -> DataFrame:
    """``ln(1 + n / total * scale)`` per triplet; zeros stay absent.

    Triplets meet a hash of their cells; those of a table bucketed by cell are neither shuffled nor sorted.
    """
    totals = cells.select(*CELL, "n_count")
    x = F.log1p(F.try_divide(F.col("n") * p.scale_factor, F.col("n_count")))
    return counts.join(totals.hint("shuffle_hash"), CELL).select(*CELL, "feature_id", "n", x.alias("x"))


def cells_per_sample(cells: DataFrame) -> DataFrame:
    return cells.groupBy(SAMPLE).agg(F.count("*").alias("n_all"))


def feature_moments(triplets: DataFrame, cells: DataFrame, value: str) -> DataFrame:
    """Mean and variance of ``value`` per feature over all cells, zeros included."""
    v = F.col(value).cast("double")
    sums = triplets.groupBy(*FEATURE).agg(
        F.sum(v).alias("_s"), F.sum(v * v).alias("_ss"), F.count("*").alias("n_cells")
    )
    n = F.col("n_all")
    mean = F.col("_s") / n
    var = F.greatest(F.try_divide(F.col("_ss") - n * mean * mean, n - 1), F.lit(0.0))
    return sums.join(cells_per_sample(cells), SAMPLE).select(
        *FEATURE, "n_all", "n_cells", mean.alias("mean"), var.alias("var")
    )


def local_trend(x: np.ndarray, y: np.ndarray, span: float, knots: int = 200) -> np.ndarray:
    """Local quadratic regression of ``y`` on ``x`` with tricube weights.

    Fitted at quantile knots and interpolated linearly between them.
    """
    return np.interp(x, *trend_knots(x, y, span, knots))


def trend_knots(x: np.ndarray, y: np.ndarray, span: float, knots: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """The knots of ``local_trend`` and the values there.

    The nearest points of a knot are neighbours in order, so each fit reads its own window only.
    """
    n = len(x)
    if n < 4:
        return np.zeros(1), np.full(1, y.mean() if n else 0.0)
    near = min(n, max(4, int(np.ceil(span * n))))
    at = np.unique(np.quantile(x, np.linspace(0, 1, min(knots, n))))
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    ends = x[near:] + x[: n - near]
    fit = np.empty(len(at))
    for i, x0 in enumerate(at):
        low = np.searchsorted(ends, 2 * x0)
        h = max(x0 - x[low], x[low + near - 1] - x0)
        if h > 0:
            own = slice(low, low + near)
            u = (x[own] - x0) / h
            w = np.abs(u)
            w = 1 - np.minimum(w * w * w, 1)
            w = w * w * w
        else:
            own = slice(*(np.searchsorted(x, x0, side) for side in ("left", "right")))
            u, w = np.zeros(own.stop - own.start), np.ones(own.stop - own.start)
        wu = w * u
        wuu = wu * u
        s = [w.sum(), wu.sum(), wuu.sum(), wuu @ u, wuu @ (u * u)]
        m = np.array([s[0:3], s[1:4], s[2:5]])
        if np.linalg.cond(m) < 1e10:
            fit[i] = np.linalg.solve(m, [w @ y[own], wu @ y[own], wuu @ y[own]])[0]
            continue
        # Too few different points for a parabola.
        d = x[own] - x0
        r = np.sqrt(w)
        basis = np.stack([np.ones(len(d)), d, d * d], axis=1) * r[:, None]
        fit[i] = np.linalg.lstsq(basis, y[own] * r, rcond=None)[0][0]
    return at, fit


def expected_variance(moments: DataFrame, p: EmbedParams) -> DataFrame:
    """Adds the variance expected at a feature's mean, ``var_expected``.

    The fit needs the two logarithms of one sample's features together; that group is as large as
    the feature axis, whatever the number of cells. Its knots, at most 200 a sample, go to all tasks.
    ``moments`` is read twice and should be a stored table.
    """
    span = p.loess_span
    usable = (F.col("var") > 0) & (F.col("mean") > 0)
    points = moments.where(usable).select(SAMPLE, F.log10("mean").alias("x"), F.log10("var").alias("y"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        at, value = trend_knots(pdf["x"].to_numpy(), pdf["y"].to_numpy(), span)
        return pd.DataFrame({SAMPLE: [pdf[SAMPLE].iloc[0]], "at": [at], "fit": [value]})

    n_samples = points.select(SAMPLE).distinct().count()
    dealt = points.repartition(min(max(2 * n_samples, 1), 2000), SAMPLE).groupBy(SAMPLE)
    found = dealt.applyInPandas(fit, f"{SAMPLE} string, at array<double>, fit array<double>").collect()
    knots = {r[SAMPLE]: (np.array(r["at"]), np.array(r["fit"])) for r in found}

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = np.zeros(len(pdf))
            ok = ((pdf["var"] > 0) & (pdf["mean"] > 0)).to_numpy()
            x = np.log10(pdf["mean"].to_numpy(), where=ok, out=np.zeros(len(pdf)))
            for sample, rows in pdf.loc[ok].groupby(SAMPLE).indices.items():
                at = np.flatnonzero(ok)[rows]
                out[at] = 10.0 ** np.interp(x[at], *knots[sample])
            yield pdf.assign(var_expected=out)

    schema = T.StructType([*moments.schema.fields, T.StructField("var_expected", T.DoubleType())])
    return moments.mapInPandas(apply, schema)


def variable_features(counts: DataFrame, cells: DataFrame, p: EmbedParams) -> DataFrame:
    """The features with the largest variance after standardising by the trend.

    Standardised values are clipped at the square root of the cell count. Cells
    without the feature all have the same value, so they enter by arithmetic.
    """
    trend = expected_variance(checkpoint(feature_moments(counts, cells, "n")), p)
    sd = F.sqrt("var_expected")
    top = F.sqrt(F.col("n_all").cast("double"))
    z = F.least(F.try_divide(F.col("n") - F.col("mean"), sd), top)
    z0 = F.try_divide(-F.col("mean"), sd)
    stats = (
        counts.join(trend.select(*FEATURE, "n_all", "mean", "var_expected"), FEATURE)
        .groupBy(*FEATURE)
        .agg(
            F.sum(z * z).alias("_ss"),
            F.count("*").alias("_c"),
            F.first("n_all").alias("n_all"),
            F.first(z0).alias("_z0"),
        )
    )
    zeros = (F.col("n_all") - F.col("_c")) * F.col("_z0") * F.col("_z0")
    ranked = stats.select(
        *FEATURE, F.coalesce((F.col("_ss") + zeros) / (F.col("n_all") - 1), F.lit(0.0)).alias("var_std")
    )
    w = Window.partitionBy(SAMPLE).orderBy(F.desc("var_std"), "feature_id")
    return ranked.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= p.n_variable)


def restrict_features(triplets: DataFrame, features: DataFrame) -> DataFrame:
    return triplets.join(sized(features.select(*FEATURE)), FEATURE, "left_semi")


def scale_background(normalised: DataFrame, cells: DataFrame, p: EmbedParams) -> DataFrame:
    """Mean, standard deviation and the scaled value of a zero, per feature."""
    m = feature_moments(normalised, cells, "x")
    sd = F.sqrt("var")
    z0 = F.coalesce(F.try_divide(-F.col("mean"), sd), F.lit(0.0))
    return m.select(*FEATURE, "n_all", "mean", sd.alias("sd"), z0.alias("z0"))


def scale_entries(normalised: DataFrame, background: DataFrame, p: EmbedParams) -> DataFrame:
    """Clipped z-score of each non-zero entry.

    Together with ``z0`` of the background, which holds for every absent entry,
    this is the whole dense matrix without storing it.
    """
    z = F.coalesce(F.try_divide(F.col("x") - F.col("mean"), F.col("sd")), F.lit(0.0))
    return normalised.join(background.select(*FEATURE, "mean", "sd", "z0"), FEATURE).select(
        *CELL, "feature_id", F.least(z, F.lit(p.clip)).alias("z"), "z0"
    )


def marker_expression(cells: DataFrame, normalised: DataFrame, features: DataFrame, name: str) -> DataFrame:
    """Expression of one named feature in every cell.

    ``found`` tells whether the sample's feature axis has it; where it has not,
    the expression is NULL. Of several features of that name the first on the
    axis counts, by ``ord`` or else by id.
    """
    keys = [c for c in (SAMPLE, "feature_id") if c in features.columns]
    place = F.col("ord") if "ord" in features.columns else F.col("feature_id")
    named = features.where(F.col("feature_name") == name).select(*keys, place.alias("_place"))
    axis = normalised.select(*FEATURE).join(sized(named), keys).distinct()
    first = F.min_by("feature_id", F.struct("_place", "feature_id")).alias("feature_id")
    known = axis.groupBy(SAMPLE).agg(first)
    values = normalised.join(F.broadcast(known) if fits_broadcast(known) else known, FEATURE)
    values = values.select(*CELL, F.col("x").alias("_x"))
    found = F.col("_found").isNotNull()
    return (
        cells.select(*CELL)
        .join(values, CELL, "left")
        .join(known.select(SAMPLE, F.lit(1).alias("_found")), SAMPLE, "left")
        .select(
            *CELL,
            F.lit(name).alias("feature_name"),
            found.alias("found"),
            F.when(found, F.coalesce("_x", F.lit(0.0))).alias("x"),
        )
    )
