"""Chromatin metrics per cell from fragments and intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropsieve.functions.scalars import CELL, SAMPLE, peak_name, percent, ratio
from dropsieve.functions.sizing import sized
from dropsieve.operators.intervals import binned_overlap, steps
from dropsieve.operators.overview import metric_distribution
from dropsieve.params import AtacParams

ATAC_METRICS = (
    "n_count_atac",
    "n_feature_atac",
    "nucleosome_signal",
    "tss_enrichment",
    "fragments",
    "frip",
    "blacklist_fraction",
)


def fragment_totals(fragments: DataFrame) -> DataFrame:
    """Number of fragments per barcode."""
    return fragments.groupBy(*CELL).agg(F.count("*").alias("fragments"))


def attach_fragment_totals(cells: DataFrame, totals: DataFrame) -> DataFrame:
    """Totals by exact barcode; cells without fragments get NULL."""
    if "fragments" in cells.columns:
        return cells
    return cells.join(totals, CELL, "left")


def nucleosome_signal(fragments: DataFrame, p: AtacParams) -> DataFrame:
    """Fragments of one nucleosome's length over nucleosome-free ones."""
    size = F.col("end") - F.col("start")
    mono = F.count_if((size >= p.mono_lo) & (size <= p.mono_hi))
    free = F.count_if(size < p.mono_lo)
    return fragments.groupBy(*CELL).agg(
        mono.alias("n_mono"), free.alias("n_free"), ratio(mono, free).alias("nucleosome_signal")
    )


def in_region(fragments: DataFrame, chrom: str, start: int, end: int) -> DataFrame:
    """Fragments that touch the region; the comparisons reach the file scan."""
    c = F.col("chrom") == chrom
    return fragments.where(c & (F.col("start") < end) & (F.col("end") > start))


def fragment_lengths(fragments: DataFrame) -> DataFrame:
    """Histogram of fragment lengths per sample."""
    size = (F.col("end") - F.col("start")).alias("length")
    return fragments.groupBy(SAMPLE, size).agg(F.count("*").alias("n"))


def peak_counts(fragments: DataFrame, peaks: DataFrame, width: int = 10_000) -> DataFrame:
    """Triplets of the ``Peaks`` modality: overlapping fragments per barcode and peak.

    Peaks with a ``sample_id`` count for their sample only.
    """
    frag = fragments.select(SAMPLE, "barcode", "chrom", "start", "end")
    by = (SAMPLE,) if SAMPLE in peaks.columns else ()
    sites = peaks.select(*by, "chrom", F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    return (
        binned_overlap(frag, sites, width, by=by)
        .groupBy(SAMPLE, "barcode", "chrom", "r_start", "r_end")
        .agg(F.count("*").alias("n"))
        .select(
            SAMPLE,
            F.lit("Peaks").alias("modality"),
            "barcode",
            peak_name(F.col("chrom"), F.col("r_start"), F.col("r_end")).alias("feature_id"),
            "n",
        )
    )


def peak_cell_totals(peak_triplets: DataFrame, p: AtacParams) -> DataFrame:
    """Peak counts and detected peaks per cell, over peaks seen in enough cells."""
    seen = peak_triplets.where(F.col("n") > 0)
    if p.peak_min_cells > 1:
        key = [SAMPLE, "feature_id"]
        enough = seen.groupBy(*key).agg(F.count("*").alias("c")).where(F.col("c") >= p.peak_min_cells)
        seen = seen.join(enough.select(*key), key, "left_semi")
    return seen.groupBy(*CELL).agg(
        F.sum("n").alias("n_count_atac"), F.count("*").alias("n_feature_atac")
    )


def add_frip(cells: DataFrame) -> DataFrame:
    """Share of a cell's fragments that fall into peaks."""
    if "frip" in cells.columns or "fragments" not in cells.columns:
        return cells
    return cells.withColumn("frip", ratio(F.col("n_count_atac"), F.col("fragments")))


def blacklisted_peaks(peaks: DataFrame, blacklist: DataFrame, width: int = 10_000) -> DataFrame:
    """Names of the peaks that overlap a blacklist region, by sample if the peaks are."""
    bad = blacklist.select("chrom", F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    by = [SAMPLE] if SAMPLE in peaks.columns else []
    hits = binned_overlap(peaks.select(*by, "chrom", "start", "end"), bad, width)
    name = peak_name(F.col("chrom"), F.col("start"), F.col("end"))
    return hits.select(*by, name.alias("feature_id")).distinct()


def blacklist_fraction(peak_triplets: DataFrame, bad_peaks: DataFrame) -> DataFrame:
    """Share of a cell's peak counts in blacklisted peaks."""
    key = [c for c in (SAMPLE, "feature_id") if c in bad_peaks.columns]
    flagged = peak_triplets.join(sized(bad_peaks.withColumn("_bad", F.lit(True))), key, "left")
    return flagged.groupBy(*CELL).agg(
        ratio(F.sum(F.when(F.col("_bad"), F.col("n")).otherwise(0)), F.sum("n")).alias(
            "blacklist_fraction"
        )
    )


def tss_enrichment(fragments: DataFrame, tss: DataFrame, p: AtacParams) -> DataFrame:
    """Insertions around start sites, centre over flank, per cell.

    Both ends of a fragment count. Offsets run along the strand: on ``-`` they are mirrored; without a
    column ``strand`` all sites are on ``+``. A cell without flank insertions takes the mean flank of
    its sample. The sites' windows become disjoint steps first, so an insertion meets one step however
    densely sites lie; with steps of a checked size the ends are not shuffled, only the two sums per
    cell are.
    """
    pos, back = F.col("pos"), F.lit(False)
    if "strand" in tss.columns:
        back = F.coalesce(F.col("strand") == "-", back)

    def window(kind: str, lo: int, hi: int):
        start = F.when(back, pos - hi).otherwise(pos + lo)
        return F.struct(F.lit(kind).alias("kind"), start.alias("r_start"), (start + hi - lo + 1).alias("r_end"))

    windows = F.array(
        window("flank", -p.tss_window, -p.tss_window + p.tss_flank - 1),
        window("flank", p.tss_window - p.tss_flank + 1, p.tss_window),
        window("centre", p.tss_centre_lo, p.tss_centre_hi),
    )
    around = steps(tss.select("chrom", F.inline(windows)), ("flank", "centre"))
    ends = fragments.select(
        SAMPLE, "barcode", "chrom", F.explode(F.array("start", "end")).alias("start")
    ).withColumn("end", F.col("start") + 1)
    hits = (
        binned_overlap(ends, around, max(1000, p.tss_centre_hi - p.tss_centre_lo + 1))
        .groupBy(*CELL)
        .agg(F.sum("flank").alias("flank"), F.sum("centre").alias("centre"))
    )
    cells = fragments.select(*CELL).distinct().join(hits, CELL, "left").na.fill(0, ["flank", "centre"])
    flank_mean = F.col("flank") / (2.0 * p.tss_flank)
    centre_mean = F.col("centre") / float(p.tss_centre_hi - p.tss_centre_lo + 1)
    fallback = cells.groupBy(SAMPLE).agg(F.avg(flank_mean).alias("_mean_flank"))
    base = F.when(flank_mean > 0, flank_mean).otherwise(F.col("_mean_flank"))
    return cells.join(sized(fallback), SAMPLE).select(
        *CELL, "flank", "centre", F.try_divide(centre_mean, base).alias("tss_enrichment")
    )


def chromatin_cells(
    fragments: DataFrame,
    peak_triplets: DataFrame,
    bad_peaks: DataFrame,
    tss: DataFrame | None,
    p: AtacParams,
    cells: DataFrame | None = None,
) -> DataFrame:
    """All chromatin metrics of each cell. A column that ``cells`` already has is kept."""
    base = cells if cells is not None else peak_cell_totals(peak_triplets, p)
    if "n_count_atac" not in base.columns:
        base = base.join(peak_cell_totals(peak_triplets, p), CELL, "left")
    if "nucleosome_signal" not in base.columns:
        base = base.join(nucleosome_signal(fragments, p).select(*CELL, "nucleosome_signal"), CELL, "left")
    if "tss_enrichment" not in base.columns and tss is not None:
        base = base.join(tss_enrichment(fragments, tss, p).select(*CELL, "tss_enrichment"), CELL, "left")
    base = add_frip(attach_fragment_totals(base, fragment_totals(fragments)))
    if "blacklist_fraction" not in base.columns:
        base = base.join(blacklist_fraction(peak_triplets, bad_peaks), CELL, "left")
    return base


PASS_FLAGS = ("pass_counts", "pass_features", "pass_tss", "pass_nucleosome", "pass_blacklist")


def pass_flags(cells: DataFrame, p: AtacParams) -> DataFrame:
    """One flag per filter and their conjunction; a missing metric passes."""
    have = set(cells.columns)
    yes = F.lit(True)
    n = F.col("n_count_atac")
    out = (
        cells.withColumn("pass_counts", (n > p.min_count) & (n < p.max_count))
        .withColumn("pass_features", F.col("n_feature_atac") > p.min_features)
        .withColumn("pass_tss", F.col("tss_enrichment") > p.min_tss if "tss_enrichment" in have else yes)
        .withColumn(
            "pass_nucleosome",
            F.col("nucleosome_signal") < p.max_nucleosome if "nucleosome_signal" in have else yes,
        )
        .withColumn(
            "pass_blacklist",
            F.col("blacklist_fraction") < p.max_blacklist if "blacklist_fraction" in have else yes,
        )
    )
    every = F.lit(True)
    for f in PASS_FLAGS:
        every = every & F.col(f)
    return out.withColumn("pass_all", every)


def pass_summary(flagged: DataFrame) -> DataFrame:
    """Cells passing each filter and all of them; a NULL flag counts as a fail."""
    names = (*PASS_FLAGS, "pass_all")
    t = flagged.groupBy(SAMPLE).agg(
        F.count("*").alias("n_total"), *[F.count_if(f).alias(f) for f in names]
    )
    rows = [
        F.struct(
            F.lit(f).alias("filter"),
            F.col(f).alias("cells_passing"),
            F.bround(percent(F.col(f), F.col("n_total")), 1).alias("pct"),
        )
        for f in names
    ]
    return t.select(SAMPLE, "n_total", F.inline(F.array(*rows)))


def density_grid(cells: DataFrame, x: str, y: str, bins: int = 20) -> DataFrame:
    """Cells in a grid of log10 ``x`` against ``y``, per sample."""
    pts = cells.where((F.col(x) > 0) & F.col(y).isNotNull()).select(
        SAMPLE, F.log10(F.col(x).cast("double")).alias("gx"), F.col(y).cast("double").alias("gy")
    )
    limits = pts.groupBy(SAMPLE).agg(
        F.min("gx").alias("x_lo"),
        F.max("gx").alias("x_hi"),
        F.min("gy").alias("y_lo"),
        F.max("gy").alias("y_hi"),
    )

    def cell_of(v, lo, hi):
        pos = F.floor(F.try_divide(F.col(v) - F.col(lo), F.col(hi) - F.col(lo)) * bins) + 1
        return F.least(F.coalesce(pos, F.lit(1)), F.lit(bins)).cast("int")

    return (
        pts.join(sized(limits), SAMPLE)
        .groupBy(SAMPLE, cell_of("gx", "x_lo", "x_hi").alias("bin_x"), cell_of("gy", "y_lo", "y_hi").alias("bin_y"))
        .agg(F.count("*").alias("n"))
    )


def density_guides(cells: DataFrame, x: str, y: str, probs=(0.05, 0.1, 0.9, 0.95)) -> DataFrame:
    """Quantile guide lines of both axes of the grid."""
    return metric_distribution(cells, [x, y], probs)
