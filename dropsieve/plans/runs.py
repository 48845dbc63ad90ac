"""The runs: standard, paired modalities, and the cross-sample overview."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropsieve.functions.scalars import CELL, SAMPLE
from dropsieve.operators import annotate, atac, cells, cluster, embed, multimodal, neighbours, overview, qc
from dropsieve.params import AtacParams, EmbedParams, QCParams
from dropsieve.session import checkpoint
from dropsieve.sources import resolve


@dataclass
class RunInputs:
    """Tables of a run; optional ones may be missing."""

    counts: DataFrame
    features: DataFrame
    barcodes: DataFrame | None = None
    nuclear: DataFrame | None = None
    doublets: DataFrame | None = None
    metadata: DataFrame | None = None


def run_counts(x: RunInputs, p: QCParams) -> DataFrame:
    """Expression triplets of the barcodes that the run mode calls cells."""
    counts = x.counts
    if "modality" in counts.columns:
        counts = multimodal.select_modality(counts, resolve.resolve(p).modality_rule)
    if x.barcodes is not None:
        counts = resolve.restrict_to_called(counts, x.barcodes, p)
    return counts


def cell_table(x: RunInputs, p: QCParams, axis: DataFrame | None = None) -> DataFrame:
    """Load filters, metrics, attached columns and the keep flag. ``axis`` is ``cells.feature_axis`` of the counts."""
    counts = run_counts(x, p)
    axis = cells.feature_axis(counts, p) if axis is None else axis
    c = cells.cell_metrics(counts, x.features, p, axis)
    c = annotate.attach_metrics(c, x.nuclear, ["nuclear_fraction"])
    c = annotate.attach_metrics(c, x.doublets, ["doublet_score", "doublet_class"])
    c = annotate.attach_metadata(c, x.metadata)
    return qc.flag_keep(c, p)


def combined_overview(x: RunInputs, p: QCParams, axis: DataFrame | None = None) -> DataFrame:
    """One row per sample over all samples. ``axis`` is as in ``cell_table``."""
    counts = run_counts(x, p)
    axis = cells.feature_axis(counts, p) if axis is None else axis
    return overview.sample_overview(cell_table(x, p, axis), cells.kept_features(counts, p, axis))


@dataclass
class PairedRun:
    cells: DataFrame
    peak_counts: DataFrame


def paired_cells(
    x: RunInputs,
    peak_triplets: DataFrame,
    left_axis: DataFrame,
    right_axis: DataFrame,
    p: QCParams,
    axis: DataFrame | None = None,
) -> PairedRun:
    """Cells with both modalities; peak triplets take the expression barcodes.

    The axis tables ``sample_id, barcode, ord`` fix which barcode is the first
    of those with the same cleaned form. ``axis`` is as in ``cell_table``.
    """
    table = cell_table(x, p, axis)
    left = left_axis.join(table.select("sample_id", "barcode"), ["sample_id", "barcode"], "left_semi")
    pairs = multimodal.cross_modality(left, right_axis)
    renamed = multimodal.rename_right(peak_triplets, pairs)
    both = multimodal.restrict_left(table, pairs)
    return PairedRun(both, renamed)


def chromatin_report(
    fragments: DataFrame, peaks: DataFrame, blacklist: DataFrame, tss: DataFrame, p: AtacParams
) -> DataFrame:
    """Chromatin metrics and pass flags per cell."""
    triplets = atac.peak_counts(fragments, peaks)
    bad = atac.blacklisted_peaks(peaks, blacklist)
    return atac.pass_flags(atac.chromatin_cells(fragments, triplets, bad, tss, p), p)


def cell_graph(counts: DataFrame, table: DataFrame, p: EmbedParams) -> tuple[DataFrame, DataFrame]:
    """Adjacency of the cells of ``table`` and their labels at a local optimum, cells alike as units of ``m``.

    The whole chain on real cells: normalise, choose features, scale, components, neighbours, shared
    neighbours, clusters. ``counts`` are the triplets of these cells.
    """
    at = checkpoint(embed.pca(counts, table, p))
    near = checkpoint(neighbours.nearest_neighbours(at, p.k, "barcode", "pca"))
    member = checkpoint(neighbours.list_classes(near, at.select(SAMPLE, F.col("barcode").alias("id"))))
    one = member.where("id = cls").select(SAMPLE, F.col("id").alias("src"))
    pairs = neighbours.shared_neighbours(near.join(one, [SAMPLE, "src"], "left_semi"), p.k, p.prune)
    member = member.withColumn("inner", F.when(F.col("inner") >= p.prune, F.col("inner")).otherwise(0.0))
    return cluster.class_labels(pairs, member, p.resolution, p.seed)


def both_sides(counts: DataFrame, table: DataFrame, p: EmbedParams) -> dict[str, tuple[DataFrame, DataFrame]]:
    """``cell_graph`` of all cells, and again of those that QC keeps, for which everything is computed anew."""
    kept = table.where("keep")
    after = checkpoint(counts.join(kept.select(*CELL), CELL, "left_semi"))
    return {"pre": cell_graph(counts, table, p), "post": cell_graph(after, kept, p)}


def cluster_numbers(sides: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``n_clusters_pre`` and ``n_clusters_post`` per sample; 0 where no cell is left."""
    per = [
        found.groupBy(SAMPLE).agg(F.count_distinct("c").alias(f"n_clusters_{side}"))
        for side, (_, found) in sides.items()
    ]
    return per[0].join(per[1], SAMPLE, "left").na.fill(0)
