"""The queries over the provided tables, by name."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dropsieve.functions.scalars import CELL, SAMPLE
from dropsieve.operators import (
    annotate,
    atac,
    cells,
    cluster,
    doublets,
    droplets,
    embed,
    multimodal,
    neighbours,
    normalise,
    nuclear,
    overview,
    qc,
    synthetic,
)
from dropsieve.plans import runs
from dropsieve.plans.views import ATAC, EMBED, QC, Views
from dropsieve.session import checkpoint, configure, shared_dir
from dropsieve.sources import published, readers, sinks

DIGITS = 6
_ALL: dict[str, Callable[[Views], DataFrame]] = {}


def query(fn: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    _ALL[fn.__name__] = fn
    return fn


def tidy(df: DataFrame) -> DataFrame:
    """Doubles rounded and integers widened, so that engines compare equal."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind == "double":
            # Adding 0.0 turns a negative zero into a plain one.
            out.append((F.round(f.name, DIGITS) + F.lit(0.0)).alias(f.name))
        elif kind in ("integer", "short", "byte"):
            out.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return tidy(fn(Views(configure(spark), folder)))

        run.__name__ = fn.__name__
        return run

    return {name: bind(fn) for name, fn in _ALL.items()}


# Cells and features


@query
def sample_overview(v):
    return runs.combined_overview(v.inputs, QC, v.axis)


@query
def cell_metrics(v):
    return v.plain_cells


@query
def gene_detection(v):
    return cells.kept_features(v.counts, QC)


@query
def kept_counts(v):
    return v.kept_counts


@query
def feature_classes(v):
    return cells.feature_classes(v.features, QC)


@query
def denoised_cells(v):
    """The cell table of a run on the denoised call set, without attached metrics."""
    x = runs.RunInputs(v.counts, v.features, barcodes=v.barcodes)
    return runs.cell_table(x, replace(QC, denoised=True)).select(
        *CELL, "n_count", "n_feature", "pct_mt", "keep"
    )


# Written and read back


def _fresh(v, name):
    return f"{shared_dir(v.spark)}/{name}-{uuid.uuid4().hex}"


@query
def stored_qc_tables(v):
    path = _fresh(v, "qc")
    sinks.write_qc_tables(v.cells, path)
    pre, post = sinks.read_qc_tables(v.spark, path)

    def size(df, name):
        return df.groupBy(F.col(SAMPLE).cast("string").alias(SAMPLE)).agg(F.count("*").alias(name))

    return size(pre, "cells_pre").join(size(post, "cells_post"), SAMPLE)


@query
def stored_metric_csv(v):
    path = _fresh(v, "doublets")
    sinks.write_metric_csv(v.doublet_metrics.drop("ord"), path)
    return doublets.doublet_summary(readers.read_metric_csv(v.spark, path))


@query
def mixed_metric_csv(v):
    """Files of some samples have their columns in another order."""
    path = _fresh(v, "mixed")
    rows = v.doublet_metrics.drop("ord")
    turned = F.pmod(F.crc32(F.col(SAMPLE).cast("binary")), F.lit(2)) == 0
    sinks.write_metric_csv(rows.where(~turned), path)
    sinks.write_metric_csv(rows.where(turned).select(*reversed(rows.columns)), path)
    return doublets.doublet_summary(readers.read_metric_csv(v.spark, path))


@query
def republished_doublets(v):
    """Three writes to one place: all samples, some of them anew, and one that fails halfway."""
    path = _fresh(v, "published")
    right = v.doublet_metrics.drop("ord")
    wrong = right.withColumn("doublet_score", F.lit(9.0))
    turned = F.pmod(F.crc32(F.col(SAMPLE).cast("binary")), F.lit(2)) == 0
    published.publish(right.where(~turned).unionByName(wrong.where(turned)), path)
    published.publish(right.where(turned), path)
    broken = F.when(F.col("cell_barcode").endswith("9-1"), F.raise_error(F.lit("on purpose")).cast("double"))
    try:
        published.publish(wrong.withColumn("doublet_score", broken.otherwise(F.col("doublet_score"))), path)
    except PySparkException:
        return doublets.doublet_summary(published.read_published(v.spark, path))
    raise RuntimeError("the third write was to fail")


@query
def stored_modalities(v):
    path = _fresh(v, "counts")
    sinks.write_counts(_both_modalities(v), path)
    back = readers.read_counts(v.spark, path, multimodal.PEAKS)
    return back.groupBy(SAMPLE, "modality").agg(F.count("*").alias("entries"), F.sum("n").alias("n"))


# Nuclear fraction and doublets


@query
def nuclear_fraction(v):
    return v.nuclear_fractions


@query
def nuclear_summary(v):
    return nuclear.nuclear_summary(v.stored_nuclear)


@query
def nuclear_summary_rows(v):
    return sinks.to_metric_rows(nuclear.nuclear_summary(v.stored_nuclear))


@query
def doublet_summary(v):
    return doublets.doublet_summary(v.doublet_metrics)


@query
def doublet_class_counts(v):
    return doublets.class_counts(v.cells)


@query
def doublet_class_line(v):
    return doublets.class_line(v.cells)


# Attaching


@query
def metric_attach_first_match(v):
    c = annotate.attach_metrics(v.plain_cells, v.nuclear_metrics, ["nuclear_fraction"])
    return c.select(*CELL, "nuclear_fraction")


@query
def match_coverage(v):
    return annotate.match_coverage(v.plain_cells, v.nuclear_metrics)


@query
def metadata_attach(v):
    return annotate.attach_metadata(v.plain_cells, v.metadata).select(*CELL, "batch")


@query
def sample_inputs(v):
    """Samples for which every input has rows, with the sizes of the inputs."""

    def size(df, name):
        return df.groupBy(SAMPLE).agg(F.count("*").alias(name))

    meta = v.metadata.withColumnRenamed("sampleid", SAMPLE)
    return (
        size(v.plain_cells, "n_cells")
        .join(size(v.nuclear_metrics, "n_nuclear"), SAMPLE)
        .join(size(v.doublet_metrics, "n_doublet"), SAMPLE)
        .join(size(meta, "n_metadata"), SAMPLE)
    )


# Filter and retention


@query
def qc_filter_keep(v):
    return qc.filter_cells(v.cells.drop("keep"), QC).select(
        *CELL, "n_count", "n_feature", "pct_mt", "nuclear_fraction", "doublet_class"
    )


@query
def retention(v):
    return qc.retention(v.cells)


@query
def qc_loss_breakdown(v):
    return qc.loss_breakdown(v.stored_cells)


@query
def pre_post_summary(v):
    return qc.pre_post_summary(v.cells)


@query
def pre_post_report(v):
    n = cells.kept_features(v.counts, QC).groupBy(SAMPLE).agg(F.count("*").alias("n_features"))
    return qc.pre_post_report(v.stored_cells, n)


@query
def pre_post_clusters(v):
    """Cells of both sides, those with a cluster, and those that would gain by another; there is none."""
    out = v.stored_cells.groupBy(SAMPLE).agg(F.count("*").alias("cells_pre"), F.count_if("keep").alias("cells_post"))
    for side, (adj, found) in runs.both_sides(v.stored_kept, v.stored_cells, EMBED).items():
        gain = cluster.move_gains(adj, found, EMBED.resolution).groupBy(SAMPLE, "u").agg(F.max("gain").alias("gain"))
        per = found.join(gain, [SAMPLE, "u"], "left").groupBy(SAMPLE).agg(
            F.sum(F.when(F.col("c").isNotNull(), F.col("m"))).alias(f"clustered_{side}"),
            F.sum(F.when(F.col("gain") > 0, F.col("m")).otherwise(0)).alias(f"gaining_{side}"),
        )
        out = out.join(per, SAMPLE, "left")
    return out.na.fill(0)


@query
def pre_post_report_clusters(v):
    """The pre/post table with the number of clusters of each side."""
    n = cells.kept_features(v.counts, QC).groupBy(SAMPLE).agg(F.count("*").alias("n_features"))
    sides = runs.both_sides(v.stored_kept, v.stored_cells, EMBED)
    return qc.pre_post_report(v.stored_cells, n, runs.cluster_numbers(sides))


# Called droplets


@query
def droplet_counts(v):
    return droplets.droplet_counts(v.barcodes)


@query
def called_comparison(v):
    return droplets.called_comparison(v.barcodes)


@query
def called_comparison_text(v):
    return droplets.called_comparison_text(v.barcodes)


@query
def difference_status(v):
    return droplets.difference_status(v.barcodes)


@query
def called_overlap(v):
    return droplets.called_overlap(v.barcodes)


@query
def umi_per_droplet(v):
    return droplets.umi_per_droplet(v.counts, v.barcodes)


@query
def knee_ranks(v):
    return droplets.knee_ranks(v.counts, v.barcodes)


@query
def knee_ranks_denoised(v):
    return droplets.knee_ranks(v.counts, v.barcodes, droplets.DENOISED)


# Report tables


@query
def feature_share(v):
    return overview.feature_totals(v.kept_counts)


@query
def top_features(v):
    return overview.top_features(overview.feature_totals(v.kept_counts))


@query
def top_features_overall(v):
    return overview.top_features_overall(v.kept_counts)


@query
def recommended_thresholds(v):
    return overview.recommended_thresholds(v.stored_cells)


@query
def metric_quantiles(v):
    return overview.metric_summary(v.stored_cells)


@query
def assessment(v):
    return overview.assessment(runs.combined_overview(v.inputs, QC, v.axis))


@query
def axis_ranges(v):
    return overview.axis_ranges(v.cells)


@query
def metric_histogram(v):
    return overview.metric_histogram(v.stored_cells, ["n_count", "n_feature"], log10=True)


@query
def score_histogram(v):
    return overview.metric_histogram(v.stored_cells, ["doublet_score"], by=["doublet_class"])


@query
def metric_distribution(v):
    return overview.metric_distribution(v.stored_cells)


@query
def metric_trend(v):
    pairs = [
        ("n_count", "n_feature"),
        ("n_count", "pct_mt"),
        ("n_count", "nuclear_fraction"),
        ("n_feature", "nuclear_fraction"),
    ]
    return overview.metric_trend(v.cells, pairs)


@query
def metric_correlation(v):
    return overview.metric_correlation(v.cells)


# Two modalities


def _both_modalities(v):
    gex = v.counts.select(
        *CELL, F.lit(multimodal.GEX).alias("modality"), F.col("feature_id").cast("string"), "n"
    )
    peaks = atac.peak_counts(v.paired_fragments, v.peaks)
    return gex.unionByName(peaks)


def _axes(v):
    left = v.plain_cells.join(v.donors, CELL).select(*CELL, F.col("c_custkey").alias("ord"))
    right = atac.fragment_totals(v.paired_fragments).select(*CELL, F.lit(0).alias("ord"))
    return left, right


@query
def modality_inventory(v):
    both = _both_modalities(v)
    return multimodal.modality_inventory(both, both)


@query
def modality_select(v):
    return multimodal.select_modality(_both_modalities(v), "gex_or_first")


@query
def common_barcodes(v):
    return multimodal.common_barcodes(*_axes(v))


@query
def cross_modality_join(v):
    return multimodal.cross_modality(*_axes(v))


@query
def paired_peak_totals(v):
    peaks = atac.peak_counts(v.paired_fragments, v.peaks)
    run = runs.paired_cells(v.inputs, peaks, *_axes(v), QC, v.axis)
    return run.cells.select(*CELL, "n_count", "keep").join(
        atac.peak_cell_totals(run.peak_counts, ATAC), CELL, "left"
    )


# Chromatin


@query
def fragment_counts(v):
    return atac.fragment_totals(v.fragments)


@query
def fragments_on_cells(v):
    droplets_ = v.donors.select(*CELL)
    return atac.attach_fragment_totals(droplets_, atac.fragment_totals(
        v.paired_fragments.withColumn("barcode", F.concat(F.lit("C"), "user_id", F.lit("-1")))
    ))


@query
def nucleosome_signal(v):
    return atac.nucleosome_signal(v.fragments, ATAC)


@query
def fragment_lengths(v):
    return atac.fragment_lengths(atac.in_region(v.fragments, "view", 0, 2_000_000))


@query
def peak_counts(v):
    return v.peak_triplets


@query
def peak_cell_totals(v):
    return atac.peak_cell_totals(v.peak_triplets, ATAC)


@query
def frip(v):
    totals = atac.peak_cell_totals(v.peak_triplets, ATAC)
    return atac.add_frip(atac.attach_fragment_totals(totals, atac.fragment_totals(v.fragments)))


@query
def blacklist_fraction(v):
    return atac.blacklist_fraction(v.peak_triplets, atac.blacklisted_peaks(v.peaks, v.blacklist))


@query
def tss_enrichment(v):
    return atac.tss_enrichment(v.fragments, v.tss, ATAC)


@query
def peak_counts_by_sample(v):
    return atac.peak_counts(v.fragments, v.sample_peaks)


@query
def blacklist_fraction_by_sample(v):
    """The share in blacklisted peaks where every sample has peaks of its own."""
    bad = atac.blacklisted_peaks(v.sample_peaks, v.blacklist)
    return atac.blacklist_fraction(atac.peak_counts(v.fragments, v.sample_peaks), bad)


@query
def tss_enrichment_stranded(v):
    return atac.tss_enrichment(v.fragments, v.tss_stranded, ATAC)


@query
def chromatin_cells(v):
    return atac.pass_flags(v.chromatin_cells, ATAC)


@query
def atac_pass(v):
    return atac.pass_summary(atac.pass_flags(v.chromatin_cells, ATAC))


@query
def atac_pass_post_qc(v):
    """Pass counts of the chromatin side over the cells that the expression side keeps."""
    report = runs.chromatin_report(v.paired_fragments, v.peaks, v.blacklist, v.tss, ATAC)
    return atac.pass_summary(multimodal.restrict_right(report, v.stored_cells.where("keep")))


@query
def atac_metric_summary(v):
    return overview.metric_summary(v.stored_chromatin, atac.ATAC_METRICS)


@query
def density_grid(v):
    return atac.density_grid(v.stored_chromatin, "n_count_atac", "tss_enrichment")


@query
def density_guides(v):
    return atac.density_guides(v.stored_chromatin, "n_count_atac", "tss_enrichment")


# Downstream analysis


@query
def log_normalised(v):
    return normalise.log_normalise(v.stored_kept, v.stored_plain, EMBED)


@query
def scale_background(v):
    norm = normalise.log_normalise(v.stored_kept, v.stored_plain, EMBED)
    return normalise.scale_background(norm, v.stored_plain, EMBED)


@query
def scaled(v):
    norm = normalise.log_normalise(v.stored_kept, v.stored_plain, EMBED)
    return normalise.scale_entries(norm, normalise.scale_background(norm, v.stored_plain, EMBED), EMBED)


@query
def marker_expression(v):
    norm = normalise.log_normalise(v.stored_kept, v.stored_plain, EMBED)
    return normalise.marker_expression(v.stored_plain, norm, v.features, "large ring")


@query
def feature_moments(v):
    return normalise.feature_moments(v.stored_kept, v.stored_plain, "n")


@query
def variable_features(v):
    return normalise.variable_features(v.stored_kept, v.stored_plain, EMBED)


def _pca(v):
    return embed.pca(v.stored_kept, v.stored_plain, EMBED)


@query
def pca(v):
    return _pca(v).select(*CELL, F.posexplode("pca").alias("component", "value"))


@query
def cell_coordinates(v):
    return embed.cell_coordinates(_pca(v), v.stored_cells)


@query
def knn(v):
    return neighbours.nearest_neighbours(v.vectors, EMBED.k)


@query
def shared_neighbours(v):
    near = neighbours.nearest_neighbours(v.vectors, EMBED.k)
    return neighbours.shared_neighbours(near, EMBED.k, EMBED.prune)


@query
def clusters(v):
    near = neighbours.nearest_neighbours(v.vectors, EMBED.k)
    edges = neighbours.shared_neighbours(near, EMBED.k, EMBED.prune)
    return cluster.clusters(edges, v.vectors, EMBED.resolution, EMBED.seed)


@query
def cluster_local_optimum(v):
    """Per sample: nodes, and those that would gain by moving from the labelling found; there is none."""
    near = neighbours.nearest_neighbours(v.vectors, EMBED.k)
    edges = checkpoint(neighbours.shared_neighbours(near, EMBED.k, EMBED.prune))
    adj, found = cluster.labels(edges, v.vectors, EMBED.resolution, EMBED.seed)
    gain = cluster.move_gains(adj, found, EMBED.resolution).groupBy(SAMPLE, "u").agg(F.max("gain").alias("gain"))
    size = found.join(gain, [SAMPLE, "u"], "left").groupBy(SAMPLE)
    return size.agg(F.count("*").alias("nodes"), F.count_if(F.col("gain") > 0).alias("gaining"))


@query
def cluster_counts(v):
    return cluster.count_clusters(v.vectors.withColumnRenamed("label", "cluster"))


@query
def doublet_scores(v):
    return synthetic.doublet_scores(v.stored_kept, EMBED)
