"""Comparison of called-droplet sets and the data of the knee plot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropsieve.functions.scalars import CELL, SAMPLE, percent, percent_text, with_thousands
from dropsieve.operators.ranks import distributed_rank
from dropsieve.params import OK_BAND, WARN_BAND

RAW, FILTERED, DENOISED = "raw", "filtered", "denoised"


def _set_sizes(barcodes: DataFrame) -> DataFrame:
    """Set sizes in one row per sample; an absent set has size NULL."""

    def size(name):
        n = F.count_if(F.col("call_set") == name)
        return F.when(n > 0, n)

    none = F.lit(0).cast("bigint")
    return barcodes.groupBy(SAMPLE).agg(
        F.coalesce(size(RAW), none).alias("n_raw"),
        F.coalesce(size(FILTERED), none).alias("n_filtered"),
        size(DENOISED).alias("n_denoised"),
    )


def droplet_counts(barcodes: DataFrame) -> DataFrame:
    """Three rows per sample: raw, called and denoised-called droplets."""
    raw = F.col("n_raw")

    def row(name, n):
        return F.struct(
            F.lit(name).alias("metric"),
            n.alias("count"),
            percent(n, raw).alias("percentage_of_raw"),
        )

    rows = F.array(
        row("total_raw_droplets", raw),
        row("called_cells", F.col("n_filtered")),
        row("denoised_called_cells", F.col("n_denoised")),
    )
    return _set_sizes(barcodes).select(SAMPLE, F.inline(rows))


def called_comparison(barcodes: DataFrame) -> DataFrame:
    """Base set, other set and their difference; one row when there is no other set."""
    raw, base, other = F.col("n_raw"), F.col("n_filtered"), F.col("n_denoised")
    nothing = F.lit(None).cast("double")

    def row(pos, method, n, of_base, of_raw):
        return F.struct(
            F.lit(pos).alias("pos"),
            F.lit(method).alias("method"),
            n.alias("cells_called"),
            of_base.alias("pct_of_base"),
            of_raw.alias("pct_of_raw"),
        )

    first = row(1, "called", base, F.when(other.isNotNull(), F.lit(100.0)), percent(base, raw))
    rows = F.array(
        first,
        row(2, "denoised", other, percent(other, base), percent(other, raw)),
        row(3, "difference", other - base, F.bround(percent(other - base, base), 2), nothing),
    )
    return _set_sizes(barcodes).select(
        SAMPLE, F.inline(F.when(other.isNotNull(), rows).otherwise(F.array(first)))
    )


def called_comparison_text(barcodes: DataFrame) -> DataFrame:
    """The comparison table as it is printed."""
    t = called_comparison(barcodes)
    signed = percent_text(F.col("pct_of_base"), signed=True)
    plain = percent_text(F.col("pct_of_base"))
    return t.select(
        SAMPLE,
        "pos",
        "method",
        with_thousands(F.col("cells_called")).alias("cells_called"),
        F.when(F.col("pct_of_base").isNull(), F.lit(None).cast("string"))
        .when(F.col("method") == "called", F.lit("100%"))
        .when(F.col("method") == "difference", signed)
        .otherwise(plain)
        .alias("pct_of_base"),
        F.when(F.col("method") == "difference", F.lit(""))
        .otherwise(percent_text(F.col("pct_of_raw")))
        .alias("pct_of_raw"),
    )


def difference_status(barcodes: DataFrame) -> DataFrame:
    """OK, Warning or Attention by the size of the difference; no row without both sets."""
    base, other = F.col("n_filtered"), F.col("n_denoised")
    d = F.abs(F.bround(percent(other - base, base), 2))
    return (
        _set_sizes(barcodes)
        .where(other.isNotNull() & (base > 0))
        .select(
            SAMPLE,
            d.alias("diff_pct"),
            F.when(d <= OK_BAND, "OK")
            .when(d <= WARN_BAND, "Warning")
            .otherwise("Attention")
            .alias("status"),
        )
    )


def called_overlap(barcodes: DataFrame) -> DataFrame:
    """Barcodes called by both sets, only the base and only the other."""
    called = barcodes.where(F.col("call_set").isin(FILTERED, DENOISED))
    per = called.groupBy(*CELL).agg(
        F.max(F.col("call_set") == FILTERED).alias("a"),
        F.max(F.col("call_set") == DENOISED).alias("b"),
    )
    return per.groupBy(SAMPLE).agg(
        F.count_if(F.expr("a and b")).alias("in_both"),
        F.count_if(F.expr("a and not b")).alias("only_filtered"),
        F.count_if(F.expr("b and not a")).alias("only_denoised"),
    )


def umi_per_droplet(counts: DataFrame, barcodes: DataFrame) -> DataFrame:
    """Total count of every raw droplet, 0 for those without a triplet."""
    totals = counts.groupBy(*CELL).agg(F.sum("n").alias("umi"))
    raw = barcodes.where(F.col("call_set") == RAW).select(*CELL, "ord")
    zero = F.lit(0).cast("bigint")
    return raw.join(totals, CELL, "left").withColumn("umi", F.coalesce("umi", zero))


def flag_called(droplets: DataFrame, barcodes: DataFrame, call_set: str, label: str) -> DataFrame:
    """``called`` is ``label`` for members of the set, else ``Background``."""
    members = barcodes.where(F.col("call_set") == call_set).select(*CELL).distinct()
    hit = F.when(F.col("_hit").isNotNull(), F.lit(label)).otherwise(F.lit("Background"))
    return (
        droplets.join(members.withColumn("_hit", F.lit(1)), CELL, "left")
        .withColumn("called", hit)
        .drop("_hit")
    )


def knee_ranks(counts: DataFrame, barcodes: DataFrame, call_set: str = FILTERED) -> DataFrame:
    """Descending rank of each raw droplet with its called flag."""
    droplets = flag_called(umi_per_droplet(counts, barcodes), barcodes, call_set, "Called")
    return distributed_rank(droplets, "umi")
