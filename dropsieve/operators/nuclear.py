"""Nuclear fraction per cell from region-tagged reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropsieve.functions.quantiles import exact_median
from dropsieve.functions.scalars import SAMPLE, ratio

# Region tags: intronic and exonic; intergenic reads do not count.
INTRONIC = "N"
EXONIC = "E"


def whitelist(alignments: DataFrame, called: DataFrame) -> DataFrame:
    """Reads whose barcode is among the called ones."""
    cb = called.select(SAMPLE, F.col("barcode").alias("cb"))
    return alignments.join(cb, [SAMPLE, "cb"], "left_semi")


def nuclear_fraction(alignments: DataFrame, called: DataFrame | None = None) -> DataFrame:
    """Intronic share of intronic and exonic reads per called barcode.

    Reads are summed per barcode before they meet the called set, so the join
    moves barcodes rather than reads. A row with a column ``reads`` stands for that many.
    """
    reads = F.col("reads") if "reads" in alignments.columns else F.lit(1)

    def of(tag: str):
        return F.sum(F.when(F.col("re") == tag, reads).otherwise(0))

    per_cb = alignments.groupBy(SAMPLE, "cb").agg(of(INTRONIC).alias("n_intronic"), of(EXONIC).alias("n_exonic"))
    if called is not None:
        per_cb = whitelist(per_cb, called)
    both = F.col("n_intronic") + F.col("n_exonic")
    return per_cb.select(
        SAMPLE,
        F.col("cb").alias("cell_barcode"),
        ratio(F.col("n_intronic"), both).alias("nuclear_fraction"),
    )


def nuclear_summary(metrics: DataFrame) -> DataFrame:
    """Per-sample statistics; the cell count includes cells without a value."""
    x = F.col("nuclear_fraction")
    stats = metrics.groupBy(SAMPLE).agg(
        F.count("*").alias("total_cells"),
        F.avg(x).alias("mean_nuclear_fraction"),
        F.stddev_samp(x).alias("sd_nuclear_fraction"),
        F.min(x).alias("min_nuclear_fraction"),
        F.max(x).alias("max_nuclear_fraction"),
    )
    med = exact_median(metrics, [SAMPLE], "nuclear_fraction", "median_nuclear_fraction")
    return stats.join(med, SAMPLE, "left")
