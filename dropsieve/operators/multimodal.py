"""Modality selection and the join of two modalities on cleaned barcodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropsieve.functions.scalars import CELL, SAMPLE, clean_barcode
from dropsieve.functions.sizing import sized

GEX = "Gene Expression"
PEAKS = "Peaks"


class MissingModality(ValueError):
    """A sample lacks a modality that the run needs."""


def modalities(counts: DataFrame) -> DataFrame:
    """Number of modalities per sample and whether expression and peaks are among them.

    The first modality is that of the feature of lowest ``ord``, where there is such a column, and
    else the first by name.
    """
    m = F.col("modality")
    place = F.min("ord") if "ord" in counts.columns else F.lit(0)
    per = counts.groupBy(SAMPLE, m).agg(place.alias("_place"))
    return per.groupBy(SAMPLE).agg(
        F.count("*").alias("n_modalities"),
        F.max(m == GEX).alias("has_gex"),
        F.max(m == PEAKS).alias("has_peaks"),
        F.min_by(m, F.struct("_place", m)).alias("first_modality"),
    )


def require_both(counts: DataFrame) -> None:
    """Stops when a sample has a single modality or lacks expression or peaks."""
    bad = modalities(counts).where("n_modalities < 2 or not has_gex or not has_peaks")
    _stop_if_any(bad, "expected Gene Expression and Peaks")


def _stop_if_any(bad: DataFrame, why: str) -> None:
    row = bad.select(SAMPLE).head()
    if row is not None:
        raise MissingModality(f"sample {row[0]}: {why}")


def select_modality(counts: DataFrame, rule: str = "gex_or_first") -> DataFrame:
    """One modality per sample.

    ``gex_strict``: samples with several modalities must have expression, single
    ones pass as they are. ``gex_if_multi``: likewise; a sample of several
    modalities without expression is an error that names it. ``gex_or_first``:
    expression, else the first modality.
    """
    info = modalities(counts)
    multi = F.col("n_modalities") > 1
    first = F.col("first_modality")
    if rule in ("gex_strict", "gex_if_multi"):
        _stop_if_any(info.where(multi & ~F.col("has_gex")), "no Gene Expression modality")
    if rule in ("gex_strict", "gex_if_multi"):
        pick = F.when(multi, F.lit(GEX)).otherwise(first)
    elif rule == "gex_or_first":
        pick = F.when(F.col("has_gex"), F.lit(GEX)).otherwise(first)
    else:
        raise ValueError(f"unknown rule {rule}")
    chosen = sized(info.select(SAMPLE, pick.alias("modality")))
    return counts.join(chosen, [SAMPLE, "modality"], "left_semi")


def modality_inventory(features: DataFrame, barcodes: DataFrame) -> DataFrame:
    """Features by barcodes per modality, from the two axis tables."""
    key = [SAMPLE, "modality"]
    nf = features.select(*key, "feature_id").distinct().groupBy(*key).agg(F.count("*").alias("n_features"))
    nb = barcodes.select(*key, "barcode").distinct().groupBy(*key).agg(F.count("*").alias("n_barcodes"))
    return nf.join(nb, key, "left").na.fill(0, ["n_barcodes"])


def _first_by_clean(cells: DataFrame, out: str) -> DataFrame:
    return cells.groupBy(SAMPLE, clean_barcode(F.col("barcode")).alias("bc_clean")).agg(
        F.min_by("barcode", "ord").alias(out)
    )


def common_barcodes(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct cleaned barcodes that both sides have."""

    def clean(df):
        return df.select(SAMPLE, clean_barcode(F.col("barcode")).alias("bc_clean"))

    return clean(left).intersect(clean(right))


def cross_modality(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of barcodes that share a cleaned form, the first of each side.

    Both sides have ``sample_id, barcode, ord``. The result maps the right
    barcode to the left name it takes.
    """
    a, b = _first_by_clean(left, "barcode"), _first_by_clean(right, "right_barcode")
    return a.join(b, [SAMPLE, "bc_clean"]).select(*CELL, "right_barcode")


def rename_right(right_counts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Right triplets of matched cells under their left barcode."""
    named = pairs.select(SAMPLE, F.col("right_barcode"), F.col("barcode").alias("_left"))
    return (
        right_counts.withColumnRenamed("barcode", "right_barcode")
        .join(named, [SAMPLE, "right_barcode"])
        .withColumnRenamed("_left", "barcode")
        .drop("right_barcode")
    )


def restrict_left(cells: DataFrame, pairs: DataFrame) -> DataFrame:
    """Left cells that have a partner."""
    return cells.join(pairs.select(*CELL), CELL, "left_semi")


def restrict_right(right: DataFrame, cells: DataFrame) -> DataFrame:
    """Right cells whose cleaned barcode one of the left ``cells`` has."""
    clean = clean_barcode(F.col("barcode")).alias("bc_clean")
    kept = cells.select(SAMPLE, clean)
    return right.withColumn("bc_clean", clean_barcode(F.col("barcode"))).join(kept, [SAMPLE, "bc_clean"], "left_semi").drop("bc_clean")
