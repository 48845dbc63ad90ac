"""Attaching per-cell metrics and sample metadata to the cell table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropsieve.functions.scalars import SAMPLE, clean_barcode, present
from dropsieve.functions.sizing import sized

# Accepted names of the barcode column of a metric table, in order of preference.
BARCODE_NAMES = ("cell_barcode", "barcode")


def barcode_column(df: DataFrame) -> str | None:
    names = present(df, BARCODE_NAMES)
    return names[0] if names else None


def first_match(metrics: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per cleaned barcode: the one that came first in its file.

    ``min_by`` combines before the shuffle, so a barcode repeated very often is
    no hot key.
    """
    bc = barcode_column(metrics)
    picked = F.min_by(F.struct(*columns), F.col("ord")).alias("_m")
    return (
        metrics.groupBy(SAMPLE, clean_barcode(F.col(bc)).alias("bc_clean"))
        .agg(picked)
        .select(SAMPLE, "bc_clean", *[F.col(f"_m.{c}").alias(c) for c in columns])
    )


def attach_metrics(cells: DataFrame, metrics: DataFrame | None, columns: Sequence[str]) -> DataFrame:
    """Left join of ``columns`` by cleaned barcode; unmatched cells get NULL.

    A missing table, barcode column or value column adds nothing.
    """
    if metrics is None or barcode_column(metrics) is None:
        return cells
    have = present(metrics, columns)
    if not have:
        return cells
    keyed = cells.withColumn("bc_clean", clean_barcode(F.col("barcode")))
    return keyed.join(first_match(metrics, have), [SAMPLE, "bc_clean"], "left").drop("bc_clean")


def match_coverage(cells: DataFrame, metrics: DataFrame) -> DataFrame:
    """Cells per sample and how many of them found a row in ``metrics``."""
    bc = barcode_column(metrics)
    keys = metrics.select(SAMPLE, clean_barcode(F.col(bc)).alias("bc_clean")).distinct()
    keyed = cells.select(SAMPLE, clean_barcode(F.col("barcode")).alias("bc_clean"))
    return (
        keyed.join(keys.withColumn("_hit", F.lit(1)), [SAMPLE, "bc_clean"], "left")
        .groupBy(SAMPLE)
        .agg(F.count("*").alias("n_cells"), F.count("_hit").alias("n_matched"))
    )


def attach_metadata(cells: DataFrame, metadata: DataFrame | None, key: str = "sampleid") -> DataFrame:
    """Repeat a sample's metadata row over its cells, if exactly one row matches."""
    if metadata is None or key not in metadata.columns:
        return cells
    fields = [c for c in metadata.columns if c != key]
    single = (
        metadata.groupBy(F.col(key).alias(SAMPLE))
        .agg(F.count("*").alias("_rows"), *[F.first(c).alias(c) for c in fields])
        .where("_rows = 1")
        .drop("_rows")
    )
    return cells.drop(*fields).join(sized(single), SAMPLE, "left")
