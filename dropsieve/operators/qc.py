"""The keep rule, retention and pre/post comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dropsieve.functions.scalars import SAMPLE, mean_sd_text, percent, plain_number, with_thousands
from dropsieve.functions.sizing import sized
from dropsieve.params import QCParams

DOUBLET = "doublet"


def keep_rule(columns, p: QCParams) -> Column:
    """Conjunction of the clauses whose column exists.

    An absent column skips its clause. A NULL in a present column makes the
    rule NULL, and such a cell is dropped.
    """
    clauses = {
        "n_feature": F.col("n_feature") >= p.min_features,
        "n_count": F.col("n_count") >= p.min_counts,
        "pct_mt": F.col("pct_mt") <= p.max_mito,
        "nuclear_fraction": F.col("nuclear_fraction") >= p.min_nuclear,
        "doublet_class": F.lower("doublet_class") != DOUBLET,
    }
    used = [rule for name, rule in clauses.items() if name in set(columns)]
    return reduce(lambda a, b: a & b, used, F.lit(True))


def flag_keep(cells: DataFrame, p: QCParams) -> DataFrame:
    """Cells with a ``keep`` flag: the pre and the post table in one."""
    return cells.withColumn("keep", F.coalesce(keep_rule(cells.columns, p), F.lit(False)))


def filter_cells(cells: DataFrame, p: QCParams) -> DataFrame:
    return cells.where(keep_rule(cells.columns, p))


def retention(flagged: DataFrame) -> DataFrame:
    """Cells before and after the rule, and the share kept and lost."""
    pre, post = F.count("*"), F.count_if("keep")
    t = flagged.groupBy(SAMPLE).agg(pre.alias("cells_pre"), post.alias("cells_post"))
    lost = F.col("cells_pre") - F.col("cells_post")
    return t.select(
        SAMPLE,
        "cells_pre",
        "cells_post",
        lost.alias("cells_lost"),
        F.bround(percent(F.col("cells_post"), F.col("cells_pre")), 2).alias("pct_retained"),
        F.bround(percent(lost, F.col("cells_pre")), 2).alias("pct_lost"),
    )


def observed_limits(flagged: DataFrame) -> DataFrame:
    """Extremes seen among kept cells, which stand in for the thresholds."""
    keep = F.col("keep")
    aggs = [F.max(F.when(keep, F.col("pct_mt"))).alias("max_mito_seen")]
    if "nuclear_fraction" in flagged.columns:
        aggs.append(F.min(F.when(keep, F.col("nuclear_fraction"))).alias("min_nuclear_seen"))
    return flagged.groupBy(SAMPLE).agg(*aggs)


def loss_breakdown(flagged: DataFrame) -> DataFrame:
    """Cells per overlapping loss class; a sample without kept cells has no limits."""
    cols = set(flagged.columns)
    x = flagged.join(sized(observed_limits(flagged)), SAMPLE)
    none = F.lit(0).cast("bigint")
    doublets = F.count_if(F.col("doublet_class") == DOUBLET) if "doublet_class" in cols else none
    nuclear = (
        F.count_if(F.col("nuclear_fraction") < F.col("min_nuclear_seen"))
        if "nuclear_fraction" in cols
        else none
    )
    mito = F.count_if(F.col("pct_mt") > F.col("max_mito_seen"))
    t = x.groupBy(SAMPLE).agg(
        F.count("*").alias("cells_pre"),
        doublets.alias("doublets_removed"),
        nuclear.alias("nuclear_removed"),
        mito.alias("mito_removed"),
    )
    classes = ("doublets_removed", "nuclear_removed", "mito_removed")
    return t.select(
        SAMPLE,
        "cells_pre",
        *classes,
        *[F.bround(percent(F.col(c), F.col("cells_pre")), 2).alias(f"{c}_pct") for c in classes],
    )


# Metrics of the pre/post table with the digits of their text form.
PRE_POST_METRICS = {
    "n_count": 0,
    "n_feature": 0,
    "pct_mt": 2,
    "nuclear_fraction": 3,
    "doublet_score": 3,
}


def pre_post_summary(flagged: DataFrame) -> DataFrame:
    """Mean and standard deviation of each metric before and after the rule."""
    metrics = [m for m in PRE_POST_METRICS if m in flagged.columns]
    aggs = [F.count("*").alias("cells_pre"), F.count_if("keep").alias("cells_post")]
    for m in metrics:
        x = F.col(m).cast("double")
        kept = F.when(F.col("keep"), x)
        aggs += [
            F.avg(x).alias(f"{m}_mean_pre"),
            F.stddev_samp(x).alias(f"{m}_sd_pre"),
            F.avg(kept).alias(f"{m}_mean_post"),
            F.stddev_samp(kept).alias(f"{m}_sd_post"),
        ]
    wide = flagged.groupBy(SAMPLE).agg(*aggs)
    rows = [
        F.struct(
            F.lit(m).alias("metric"),
            *[F.col(f"{m}_{s}").alias(s) for s in ("mean_pre", "sd_pre", "mean_post", "sd_post")],
        )
        for m in metrics
    ]
    return wide.select(SAMPLE, "cells_pre", "cells_post", F.inline(F.array(*rows)))


def pre_post_report(
    flagged: DataFrame, n_features: DataFrame, clusters: DataFrame | None = None
) -> DataFrame:
    """The pre/post table as text rows ``(sample_id, pos, metric, pre_qc, post_qc)``.

    ``n_features`` has one row per sample with the size of its feature axis.
    ``clusters``, if given, has ``n_clusters_pre`` and ``n_clusters_post``.
    """
    stats = pre_post_summary(flagged)

    def text(side):
        out = F.lit(None).cast("string")
        for m, d in PRE_POST_METRICS.items():
            shown = mean_sd_text(F.col(f"mean_{side}"), F.col(f"sd_{side}"), d)
            out = F.when(F.col("metric") == m, shown).otherwise(out)
        return out

    order = F.array_position(F.array(*[F.lit(m) for m in PRE_POST_METRICS]), F.col("metric"))
    body = stats.select(
        SAMPLE,
        (order + 7).cast("int").alias("pos"),
        F.concat(F.col("metric"), F.lit(" (mean ± sd)")).alias("metric"),
        text("pre").alias("pre_qc"),
        text("post").alias("post_qc"),
    )
    head = retention(flagged).join(n_features, SAMPLE, "left")
    if clusters is not None:
        head = head.join(clusters, SAMPLE, "left")

    def row(pos, name, pre, post):
        return F.struct(
            F.lit(pos).cast("int").alias("pos"),
            F.lit(name).alias("metric"),
            pre.cast("string").alias("pre_qc"),
            post.cast("string").alias("post_qc"),
        )

    nf = with_thousands(F.col("n_features"))
    rows = [
        row(1, "Sample Name", F.col(SAMPLE), F.col(SAMPLE)),
        row(2, "Total Cells", with_thousands(F.col("cells_pre")), with_thousands(F.col("cells_post"))),
        row(3, "Cells Lost", F.lit("0"), with_thousands(F.col("cells_lost"))),
        row(4, "Cells Retained (%)", F.lit("100%"), F.concat(plain_number(F.col("pct_retained"), 2), F.lit("%"))),
        row(5, "Cells Lost (%)", F.lit("0%"), F.concat(plain_number(F.col("pct_lost"), 2), F.lit("%"))),
        row(6, "Total Features", nf, nf),
    ]
    if clusters is not None:
        rows.append(row(7, "Number of Clusters", F.col("n_clusters_pre"), F.col("n_clusters_post")))
    out = head.select(SAMPLE, F.inline(F.array(*rows))).unionByName(body)
    if "doublet_class" in flagged.columns:
        out = out.unionByName(_class_rows(flagged))
    return out


def _class_rows(flagged: DataFrame) -> DataFrame:
    per = (
        flagged.where(F.col("doublet_class").isNotNull())
        .groupBy(SAMPLE, "doublet_class")
        .agg(F.count("*").alias("n_pre"), F.count_if("keep").alias("n_post"))
        .withColumn("pre", F.concat_ws(": ", "doublet_class", F.col("n_pre").cast("string")))
        .withColumn(
            "post",
            F.when(F.col("n_post") > 0, F.concat_ws(": ", "doublet_class", F.col("n_post").cast("string"))),
        )
    )
    line = "listagg({0}, ', ') WITHIN GROUP (ORDER BY doublet_class)"
    return per.groupBy(SAMPLE).agg(
        F.expr(line.format("pre")).alias("pre_qc"), F.expr(line.format("post")).alias("post_qc")
    ).select(
        SAMPLE,
        F.lit(len(PRE_POST_METRICS) + 8).cast("int").alias("pos"),
        F.lit("Doublet Classification").alias("metric"),
        "pre_qc",
        "post_qc",
    )
