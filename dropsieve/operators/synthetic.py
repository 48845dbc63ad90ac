"""Doublet scores from synthetic doublets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dropsieve.functions.scalars import CELL, SAMPLE
from dropsieve.functions.sizing import sized
from dropsieve.operators.embed import pca
from dropsieve.operators.neighbours import nearest_neighbours
from dropsieve.operators.ranks import distributed_rank
from dropsieve.params import EmbedParams
from dropsieve.session import checkpoint

PREFIX = "synthetic:"


def pair_cells(cells: DataFrame, seed: int, bucket_rows: int = 256) -> DataFrame:
    """Every cell with another one of its sample, chosen by a seeded hash.

    Cells fall into buckets of about ``bucket_rows`` by hash; within a bucket
    each is paired with the next, the last with the first.
    """
    n = cells.groupBy(SAMPLE).agg(F.count("*").alias("_n"))
    h = F.xxhash64("barcode", F.lit(seed))
    placed = (
        cells.select(*CELL)
        .join(sized(n), SAMPLE)
        .withColumn("_h", h)
        .withColumn("_b", F.pmod("_h", F.ceil(F.col("_n") / bucket_rows)))
    )
    w = Window.partitionBy(SAMPLE, "_b").orderBy("_h", "barcode")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    other = F.coalesce(F.lead("barcode").over(w), F.first("barcode").over(whole))
    return (
        placed.withColumn("other", other)
        .where(F.col("other") != F.col("barcode"))
        .select(SAMPLE, F.col("barcode").alias("first"), "other")
    )


def synthesise(counts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Triplets of synthetic doublets: the summed counts of both parents."""
    name = F.concat(F.lit(PREFIX), F.col("first"), F.lit("+"), F.col("other"))
    parents = pairs.select(SAMPLE, name.alias("name"), F.explode(F.array("first", "other")).alias("barcode"))
    return (
        counts.join(parents, CELL)
        .groupBy(SAMPLE, F.col("name").alias("barcode"), "feature_id")
        .agg(F.sum("n").alias("n"))
    )


def doublet_scores(
    counts: DataFrame, p: EmbedParams, expected_rate: float | None = None
) -> DataFrame:
    """Share of synthetic doublets among each cell's neighbours, and its class.

    As many cells as expected are doublets, by default one percent per thousand
    cells of the sample: those of highest score, ties by the mean distance to
    their synthetic neighbours and then by a hash. A cell without any synthetic
    neighbour is never one.
    """
    triplets = counts.select(*CELL, "feature_id", "n")
    pairs = pair_cells(triplets.select(*CELL).distinct(), p.seed)
    both = checkpoint(triplets.unionByName(synthesise(triplets, pairs)))
    cells = checkpoint(both.groupBy(*CELL).agg(F.sum("n").alias("n_count")))
    embedded = checkpoint(pca(both, cells, p))
    near = nearest_neighbours(embedded, p.k, id_col="barcode", vec_col="pca")
    real = ~F.col("src").startswith(PREFIX)
    synthetic = F.col("dst").startswith(PREFIX)
    scored = checkpoint(
        near.where(real)
        .groupBy(SAMPLE, F.col("src").alias("barcode"))
        .agg(
            F.avg(synthetic.cast("double")).alias("doublet_score"),
            F.avg(F.when(synthetic, F.col("dist"))).alias("_dist"),
        )
        .withColumn("_hash", F.xxhash64("barcode", F.lit(p.seed)))
    )
    n = F.count("*").alias("_cells")
    sample = scored.groupBy(SAMPLE).agg(n, F.max("_dist").alias("_far"))
    # The distance in 2 ** 30 steps of a sample's largest one: a run has 2 ** 18 of them.
    step = F.floor(F.coalesce(F.try_divide(F.col("_dist"), F.col("_far")), F.lit(0.0)) * (1 << 30))
    placed = scored.join(sized(sample), SAMPLE).withColumn("ord", step)
    ranked = distributed_rank(
        placed, "doublet_score", run=1 << 18, then=("_dist", "_hash", "barcode")
    )
    n = F.col("_cells")
    rate = F.lit(expected_rate) if expected_rate is not None else F.lit(0.01) * n / 1000.0
    top = (F.col("rank") <= F.ceil(rate * n)) & (F.col("doublet_score") > 0)
    return ranked.select(
        SAMPLE,
        F.col("barcode").alias("cell_barcode"),
        "doublet_score",
        F.when(top, "doublet").otherwise("singlet").alias("doublet_class"),
    )
