"""Hand-computed cases and invariants of the operators."""

import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from dropsieve.functions.quantiles import exact_quantiles
from dropsieve.functions.scalars import clean_barcode, split_peak_name
from dropsieve.operators import (
    annotate,
    atac,
    cells,
    cluster,
    droplets,
    multimodal,
    neighbours,
    normalise,
    nuclear,
    overview,
    qc,
    synthetic,
)
from dropsieve.operators import intervals
from dropsieve.session import Scratch
from dropsieve.operators.intervals import binned_overlap
from dropsieve.operators.ranks import distributed_rank
from dropsieve.params import AtacParams, EmbedParams, QCParams


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_clean_barcode_cuts_at_the_first_dash(spark):
    df = spark.createDataFrame([("AC-1-2",), ("AC",), ("-1",)], "b string")
    assert rows(df.select(clean_barcode(F.col("b")))) == [("",), ("AC",), ("AC",)]


def test_peak_name_parts(spark):
    df = spark.createDataFrame([("chr1:10-25",)], "x string").select(*split_peak_name(F.col("x")))
    assert rows(df) == [("chr1", 10, 25)]


# Load filters


def small_counts(spark):
    data = []
    for i in range(6):
        for f in range(3):
            data.append(("s", f"c{i}", f"g{f}", 2))
    data += [("s", "c0", "rare", 5), ("s", "c1", "rare", 7), ("s", "poor", "g0", 9)]
    return spark.createDataFrame(data, "sample_id string, barcode string, feature_id string, n bigint")


def test_cells_are_filtered_before_features(spark):
    p = QCParams(load_min_features=3, load_min_cells=3, mt_pattern="^g0", rb_pattern="^rare")
    counts = small_counts(spark)
    feats = counts.select("feature_id", F.col("feature_id").alias("feature_name")).distinct()
    got = {r.barcode: r for r in cells.cell_metrics(counts, feats, p).collect()}
    assert set(got) == {f"c{i}" for i in range(6)}
    assert {(r.n_count, r.n_feature) for r in got.values()} == {(6, 3)}
    assert all(abs(r.pct_mt - 100 / 3) < 1e-9 and r.pct_rb == 0 for r in got.values())
    assert cells.kept_counts(counts, p).count() == 18
    # Seen in seven cells of the input, but "poor" is gone before features are counted.
    assert dict(cells.kept_features(counts, p).select("feature_id", "n_cells").collect())["g0"] == 6


def test_totals_equal_those_of_the_filtered_triplets(spark):
    rnd = random.Random(5)
    data = [
        (f"s{s}", f"c{c}", f, rnd.randint(1, 9))
        for s in range(2)
        for c in range(40)
        for f in rnd.sample(range(300), rnd.randint(3, 12))
    ]
    counts = spark.createDataFrame(data, "sample_id string, barcode string, feature_id int, n bigint")
    feats = spark.range(300).select(
        F.col("id").cast("int").alias("feature_id"),
        F.concat(F.when(F.col("id") % 5 == 0, "MT-").otherwise("X"), "id").alias("feature_name"),
    )
    p = QCParams(load_min_features=6, load_min_cells=3)
    want = (
        cells.cell_totals(cells.tag_classes(cells.kept_counts(counts, p), feats, p))
        .selectExpr("sample_id", "barcode", "n_count", "n_feature", "mt_count")
        .where("n_count > 0")
    )
    got = cells.cell_metrics(counts, feats, p).where("n_count > 0").selectExpr(
        "sample_id", "barcode", "n_count", "n_feature", "cast(round(pct_mt * n_count / 100) as bigint)"
    )
    assert rows(got) == rows(want)


def test_the_cell_shuffle_runs_once(spark):
    p = QCParams(load_min_features=3, load_min_cells=3)
    counts = small_counts(spark).repartition(4)
    feats = counts.select("feature_id", F.col("feature_id").alias("feature_name"))
    df = cells.cell_metrics(counts, feats, p)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan.split("== Initial Plan ==")[0]


def test_bucketed_counts_need_no_shuffle(spark):
    from dropsieve.sources.sinks import write_bucketed_counts

    write_bucketed_counts(small_counts(spark), "bucketed_counts_test", 4)
    table = spark.table("bucketed_counts_test")
    plan = cells.surviving_counts(table, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert cells.surviving_counts(table, 3).count() == 20


def test_bucketed_counts_meet_their_cells_and_rare_features_where_they_are(spark):
    from dropsieve.sources.sinks import write_bucketed_counts

    counts = small_counts(spark).union(spark.createDataFrame([("s", "c0", "zero", 0), ("s", "c1", None, 4)], "a string, b string, f string, n bigint"))
    write_bucketed_counts(counts, "bucketed_counts_rare", 4)
    table = spark.table("bucketed_counts_rare")
    p = QCParams(load_min_features=3, load_min_cells=3)
    axis = cells.feature_axis(table, p)
    kept = cells.kept_counts(table, p, axis)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Window" not in plan and "Exchange hashpartitioning" not in plan
    assert kept.count() == 18 and cells.kept_features(table, p, axis).count() == 3
    every = QCParams(load_min_features=3, load_min_cells=0)
    assert {r.feature_id for r in cells.kept_features(table, every).collect()} - {None} == {"g0", "g1", "g2", "rare"}
    assert cells.kept_counts(table, every, axis).count() == 20
    feats = table.select("feature_id", F.col("feature_id").alias("feature_name")).where("feature_id is not null").distinct()
    plan = normalise.log_normalise(table, cells.cell_metrics(table, feats, p, axis), EmbedParams())
    assert "SortMergeJoin" not in plan._jdf.queryExecution().executedPlan().toString()


def test_many_rare_features_are_not_broadcast(spark, monkeypatch):
    from dropsieve.functions import sizing

    p = QCParams(load_min_features=3, load_min_cells=3)
    want = rows(cells.kept_counts(small_counts(spark), p))
    axis = cells.feature_axis(small_counts(spark), p)
    monkeypatch.setattr(sizing, "fits_bytes", lambda df, max_bytes=0: False)
    kept = cells.kept_counts(small_counts(spark), p, axis)
    assert "BroadcastHashJoin" not in kept._jdf.queryExecution().executedPlan().toString()
    assert rows(kept) == want and len(want) == 18


def test_cell_sizes_are_taken_once_and_buckets_stay_small(spark):
    from dropsieve.functions.scalars import SAMPLE
    from dropsieve.plans.views import QC, Views

    v = Views(spark, "/root/testdata/sf0.001")
    for df in (v.barcodes, v.alignments):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "sizes_" in plan and "counts_" not in plan
    per_cell = v.counts.groupBy(SAMPLE, "barcode").agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("f"))
    got = v.sizes.select(SAMPLE, "barcode", "n", F.col("n_detected").alias("f"))
    assert rows(got) == rows(per_cell) and got.count() > 0
    assert rows(cells.feature_axis(v.counts, QC, v.sizes)) == rows(cells.feature_axis(v.counts, QC))
    large = Views(spark, "")
    large._tables["lineitem"] = spark.range(4_000_000)
    assert 4_000_000 // large.buckets <= 250_000


# Attaching


def metric_rows(spark, data):
    return spark.createDataFrame(
        data, "sample_id string, cell_barcode string, nuclear_fraction double, ord bigint"
    )


def cell_rows(spark, names):
    return spark.createDataFrame([("s", b) for b in names], "sample_id string, barcode string")


def test_first_match_wins_and_left_duplicates_share_it(spark):
    m = metric_rows(spark, [("s", "A-9", 0.9, 5), ("s", "A", 0.1, 2), ("t", "B", 0.7, 1)])
    c = cell_rows(spark, ["A-1", "A-2", "B-1"])
    got = annotate.attach_metrics(c, m, ["nuclear_fraction"])
    assert rows(got) == [("s", "A-1", 0.1), ("s", "A-2", 0.1), ("s", "B-1", None)]
    assert rows(annotate.match_coverage(c, m)) == [("s", 3, 2)]


def test_a_first_match_without_value_stays_null(spark):
    m = metric_rows(spark, [("s", "A", None, 1), ("s", "A-2", 0.4, 2)])
    got = annotate.attach_metrics(cell_rows(spark, ["A-1"]), m, ["nuclear_fraction"])
    assert rows(got) == [("s", "A-1", None)]


def test_missing_metric_tables_add_nothing(spark):
    c = cell_rows(spark, ["A-1"])
    assert annotate.attach_metrics(c, None, ["nuclear_fraction"]).columns == c.columns
    other = spark.createDataFrame([("s", "x", 1)], "sample_id string, name string, ord int")
    assert annotate.attach_metrics(c, other, ["nuclear_fraction"]).columns == c.columns


def test_metadata_needs_exactly_one_row(spark):
    c = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], "sample_id string, barcode string")
    meta = spark.createDataFrame([("a", 7), ("b", 8), ("b", 9)], "sampleid string, batch int")
    assert rows(annotate.attach_metadata(c, meta)) == [("a", "1", 7), ("b", "1", None), ("c", "1", None)]
    assert annotate.attach_metadata(c, meta.withColumnRenamed("sampleid", "x")).columns == c.columns


# Keep rule


def test_null_drops_a_cell_but_an_absent_column_does_not(spark):
    p = QCParams(min_features=2, min_counts=5, max_mito=20.0, min_nuclear=0.4)
    c = spark.createDataFrame(
        [("s", "ok", 2, 5, 20.0, 0.4, "singlet"), ("s", "null", 9, 9, 0.0, None, "singlet"),
         ("s", "dbl", 9, 9, 0.0, 0.9, "Doublet"), ("s", "noclass", 9, 9, 0.0, 0.9, None)],
        "sample_id string, barcode string, n_feature int, n_count int, pct_mt double, "
        "nuclear_fraction double, doublet_class string",
    )
    assert [r.barcode for r in qc.filter_cells(c, p).collect()] == ["ok"]
    assert qc.filter_cells(c.drop("nuclear_fraction", "doublet_class"), p).count() == 4
    flagged = qc.flag_keep(c, p)
    assert rows(qc.retention(flagged)) == [("s", 4, 1, 3, 25.0, 75.0)]


def test_losses_overlap_and_use_observed_limits(spark):
    c = spark.createDataFrame(
        [("s", 10.0, 0.5, "singlet", True), ("s", 15.0, 0.3, "doublet", False),
         ("s", 5.0, 0.45, "Doublet", False), ("e", 5.0, 0.1, None, False)],
        "sample_id string, pct_mt double, nuclear_fraction double, doublet_class string, keep boolean",
    )
    got = {r.sample_id: r for r in qc.loss_breakdown(c).collect()}
    assert (got["s"].doublets_removed, got["s"].nuclear_removed, got["s"].mito_removed) == (1, 2, 1)
    assert (got["e"].doublets_removed, got["e"].nuclear_removed, got["e"].mito_removed) == (0, 0, 0)


# Nuclear fraction and droplets


def test_nuclear_fraction_ignores_intergenic_reads(spark):
    a = spark.createDataFrame(
        [("s", "A", t) for t in "NNEI"] + [("s", "B", "I"), ("s", "X", "N")],
        "sample_id string, cb string, re string",
    )
    called = cell_rows(spark, ["A", "B"])
    got = dict(
        (r.cell_barcode, r.nuclear_fraction) for r in nuclear.nuclear_fraction(a, called).collect()
    )
    assert got["B"] is None and abs(got["A"] - 2 / 3) < 1e-12 and len(got) == 2


def barcode_rows(spark, sets):
    data = [("s", k, b, i) for k, names in sets.items() for i, b in enumerate(names)]
    return spark.createDataFrame(data, "sample_id string, call_set string, barcode string, ord bigint")


def test_reads_of_a_tag_may_come_as_numbers(spark):
    a = spark.createDataFrame(
        [("s", "a", "N", 3), ("s", "a", "E", 1), ("s", "a", "N", 0), ("s", "b", "I", 2), ("s", "c", "N", 0)],
        "sample_id string, cb string, re string, reads bigint",
    )
    got = {r.cell_barcode: r.nuclear_fraction for r in nuclear.nuclear_fraction(a).collect()}
    assert got == {"a": 0.75, "b": None, "c": None}


def test_droplet_counts_without_denoised_set(spark):
    b = barcode_rows(spark, {"raw": "abcd", "filtered": "a"})
    assert rows(droplets.droplet_counts(b)) == [
        ("s", "called_cells", 1, 25.0),
        ("s", "denoised_called_cells", None, None),
        ("s", "total_raw_droplets", 4, 100.0),
    ]
    assert droplets.called_comparison(b).count() == 1
    assert droplets.difference_status(b).count() == 0


@pytest.mark.parametrize("n,status", [(21, "OK"), (24, "Warning"), (25, "Attention")])
def test_difference_bands(spark, n, status):
    sets = {"raw": range(100), "filtered": range(20), "denoised": range(n)}
    b = barcode_rows(spark, {k: [str(x) for x in v] for k, v in sets.items()})
    assert droplets.difference_status(b).first().status == status


def test_empty_droplets_are_ranked_last(spark):
    b = barcode_rows(spark, {"raw": "abcd", "filtered": "b"})
    counts = spark.createDataFrame(
        [("s", "b", 1, 5), ("s", "c", 1, 9)], "sample_id string, barcode string, feature_id int, n bigint"
    )
    got = {r.barcode: (r.umi, r["rank"], r.called) for r in droplets.knee_ranks(counts, b).collect()}
    assert got == {
        "c": (9, 1, "Background"), "b": (5, 2, "Called"), "a": (0, 3, "Background"), "d": (0, 4, "Background"),
    }


def test_rank_is_a_permutation_and_stable(spark):
    df = spark.range(5000).select(
        F.concat(F.lit("s"), F.col("id") % 2).alias("sample_id"),
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") * 7 % 101).alias("umi"),
        F.col("id").alias("ord"),
    )
    got = distributed_rank(df, "umi", run=64).collect()
    for s in ("s0", "s1"):
        mine = sorted((r for r in got if r.sample_id == s), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 2501))
        assert [(-r.umi, r.ord) for r in mine] == sorted((-r.umi, r.ord) for r in mine)


# Quantiles


def test_quantiles_of_large_groups_are_exact(spark):
    rnd = random.Random(3)
    data = {"tied": [float(rnd.choice([1, 1, 1, 2, 5])) for _ in range(3000)],
            "wide": [rnd.gauss(0, 1) ** 5 for _ in range(3000)],
            "few": [1.0, 4.0]}
    flat = [(k, v) for k, vs in data.items() for v in vs] + [("few", None)]
    df = spark.createDataFrame(flat, "sample_id string, x double").repartition(8)
    probs = [0.0, 0.01, 0.25, 0.5, 0.95, 1.0]
    got = {r.sample_id: r.q for r in exact_quantiles(df, ["sample_id"], "x", probs, accuracy=200).collect()}
    for k, vs in data.items():
        assert np.allclose(got[k], np.quantile(vs, probs), rtol=0, atol=1e-12)


def test_histogram_covers_every_cell(spark):
    c = spark.createDataFrame([("s", float(v)) for v in range(1, 101)] + [("s", 0.0), ("s", None)],
                              "sample_id string, n_count double")
    h = overview.metric_histogram(c, ["n_count"], bins=10).collect()
    assert sum(r.n for r in h) == 101 and {r.bin for r in h} == set(range(1, 11))
    assert sum(r.n for r in overview.metric_histogram(c, ["n_count"], log10=True).collect()) == 100
    one = spark.createDataFrame([("s", 3.0)] * 4, "sample_id string, n_count double")
    assert [(r.bin, r.n) for r in overview.metric_histogram(one, ["n_count"]).collect()] == [(1, 4)]


def test_shares_sum_to_one_hundred(spark):
    t = overview.feature_totals(small_counts(spark))
    assert abs(t.agg(F.sum("pct")).first()[0] - 100) < 1e-9


# Intervals


@pytest.mark.parametrize("limit", [0, 10_000_000])
@pytest.mark.parametrize("width", [7, 50])
def test_binned_overlap_equals_the_plain_predicate(spark, limit, width):
    rnd = random.Random(11)
    spans = [(rnd.choice("ab"), a, a + rnd.randint(1, 90)) for a in (rnd.randint(0, 400) for _ in range(120))]
    hot = [("a", 100, 103)] * 60
    left = spark.createDataFrame(
        [(i, *s) for i, s in enumerate(spans[:60] + hot)], "i int, chrom string, start bigint, end bigint"
    )
    right = spark.createDataFrame(
        [(i, *s) for i, s in enumerate(spans[60:])], "j int, chrom string, r_start bigint, r_end bigint"
    )
    got = rows(binned_overlap(left, right, width, salts=4, max_broadcast_bytes=limit).select("i", "j"))
    want = sorted(
        (
            (i, j)
            for i, (c, s, e) in enumerate(spans[:60] + hot)
            for j, (d, t, f) in enumerate(spans[60:])
            if c == d and s < f and t < e
        ),
        key=repr,
    )
    assert got == want


def test_long_intervals_make_a_handful_of_rows(spark):
    one = spark.createDataFrame([("a", 5, 30_000_005)], "chrom string, start bigint, end bigint")
    levels = list(range(intervals.LEVELS))
    assert intervals._indexed(one, "start", "end", 1000, levels).count() <= 2 * intervals.LEVELS
    many = spark.range(3000).select(
        F.lit("a").alias("chrom"), (F.col("id") * 11_000).alias("r_start"), (F.col("id") * 11_000 + F.pow(3.0, F.col("id") % 16)).cast("bigint").alias("r_end")
    )
    want = many.where("r_start < 30000005 AND 5 < r_end").count()
    for limit in (0, 10_000_000):
        assert binned_overlap(one, many, 1000, salts=3, max_broadcast_bytes=limit).count() == want
        back = many.withColumnsRenamed({"r_start": "start", "r_end": "end"})
        assert binned_overlap(back, one.withColumnsRenamed({"start": "r_start", "end": "r_end"}), 1000, 3, limit).count() == want


def test_steps_are_disjoint_and_count_windows(spark):
    spans = [("a", 0, 10, "x"), ("a", 5, 12, "x"), ("a", 5, 7, "y"), ("a", 12, 20, "y"), ("b", 3, 4, "x")]
    df = spark.createDataFrame(spans, "chrom string, r_start bigint, r_end bigint, kind string")
    got = {(r.chrom, p): (r.x, r.y) for r in intervals.steps(df, ("x", "y")).collect() for p in range(r.r_start, r.r_end)}
    want = {}
    for c, s, e, k in spans:
        for p in range(s, e):
            x, y = want.get((c, p), (0, 0))
            want[c, p] = (x + (k == "x"), y + (k == "y"))
    assert got == want


def test_tss_offsets_are_mirrored_on_the_other_strand(spark):
    p = AtacParams()
    ends = [4499, 4500, 5499, 5500, 5501, 5502, 4000, 4100, 5900, 6000]
    frag = spark.createDataFrame(
        [("s", f"b{e}", "c", e, 10**6) for e in ends], "sample_id string, barcode string, chrom string, start bigint, end bigint"
    )
    for strand, way in (("+", 1), ("-", -1)):
        tss = spark.createDataFrame([("c", 5000, strand), ("c", 5000, strand)], "chrom string, pos bigint, strand string")
        got = {r.barcode: (r.flank, r.centre) for r in atac.tss_enrichment(frag, tss, p).collect()}
        for e in ends:
            off = way * (e - 5000)
            assert got[f"b{e}"] == (2 * (off < -900 or off > 900), 2 * (-501 <= off <= 499))


def test_overlap_by_sample(spark):
    left = spark.createDataFrame([("s", "a", 0, 10), ("t", "a", 0, 10)], "sample_id string, chrom string, start bigint, end bigint")
    right = spark.createDataFrame([("s", "a", 5, 20), ("u", "a", 5, 20)], "sample_id string, chrom string, r_start bigint, r_end bigint")
    assert binned_overlap(left, right, 10, by=("sample_id",)).count() == 1


def test_touching_intervals_do_not_overlap(spark):
    left = spark.createDataFrame([("a", 0, 10)], "chrom string, start bigint, end bigint")
    right = spark.createDataFrame([("a", 10, 20)], "chrom string, r_start bigint, r_end bigint")
    assert binned_overlap(left, right, 10).count() == 0


def test_tss_enrichment_of_known_insertions(spark):
    p = AtacParams()
    frag = spark.createDataFrame(
        [("s", "A", "c", 5000, 5950), ("s", "B", "c", 5001, 90000), ("s", "C", "c", 70000, 80000)],
        "sample_id string, barcode string, chrom string, start bigint, end bigint",
    )
    tss = spark.createDataFrame([("c", 5000)], "chrom string, pos bigint")
    got = {r.barcode: r for r in atac.tss_enrichment(frag, tss, p).collect()}
    assert (got["A"].flank, got["A"].centre) == (1, 1)
    assert abs(got["A"].tss_enrichment - (1 / 1001) / (1 / 200)) < 1e-12
    # Without own flank insertions the sample's mean flank is used.
    assert abs(got["B"].tss_enrichment - (1 / 1001) / (1 / 600)) < 1e-12
    assert got["C"].tss_enrichment == 0


def test_missing_chromatin_metrics_pass(spark):
    c = spark.createDataFrame([("s", 2000, 600), ("s", 1000, 600)], "sample_id string, n_count_atac int, n_feature_atac int")
    got = {r["filter"]: r.cells_passing for r in atac.pass_summary(atac.pass_flags(c, AtacParams())).collect()}
    assert got["pass_tss"] == 2 and got["pass_counts"] == 1 and got["pass_all"] == 1


# Two modalities


def modal(spark, data):
    return spark.createDataFrame(data, "sample_id string, modality string, barcode string, feature_id string, n bigint")


def test_modality_rules(spark):
    both = [("m", multimodal.GEX, "a", "g", 1), ("m", multimodal.PEAKS, "a", "p", 1)]
    single = [("x", "Antibody", "a", "t", 1)]
    df = modal(spark, both + single)
    assert rows(multimodal.select_modality(df, "gex_or_first").select("feature_id")) == [("g",), ("t",)]
    assert multimodal.select_modality(df, "gex_strict").count() == 2
    with pytest.raises(multimodal.MissingModality):
        multimodal.require_both(df)
    multimodal.require_both(modal(spark, both))
    bad = modal(spark, [("y", "Antibody", "a", "t", 1), ("y", multimodal.PEAKS, "a", "p", 1)])
    for rule in ("gex_strict", "gex_if_multi"):
        with pytest.raises(multimodal.MissingModality, match="sample y"):
            multimodal.select_modality(bad, rule)
    first = bad.withColumn("ord", F.when(F.col("modality") == multimodal.PEAKS, 0).otherwise(1))
    chosen = multimodal.select_modality(first, "gex_or_first").select("feature_id")
    assert rows(chosen) == [("p",)]


def test_cross_modality_takes_the_first_of_both_sides(spark):
    schema = "sample_id string, barcode string, ord int"
    left = spark.createDataFrame([("s", "A-2", 1), ("s", "A-1", 0), ("s", "B-1", 2)], schema)
    right = spark.createDataFrame([("s", "A-7", 4), ("s", "A-8", 3), ("s", "C-1", 0)], schema)
    pairs = multimodal.cross_modality(left, right)
    assert rows(pairs) == [("s", "A-1", "A-8")]
    peaks = modal(spark, [("s", "Peaks", "A-8", "p", 3), ("s", "Peaks", "A-7", "p", 5)])
    assert [(r.barcode, r.n) for r in multimodal.rename_right(peaks, pairs).collect()] == [("A-1", 3)]


# Downstream


def brute_neighbours(vec, k):
    d = np.sqrt(((vec[:, None, :] - vec[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    return [[int(j) for j in np.lexsort((np.arange(len(vec)), np.round(r**2, 9)))[:k]] for r in d]


@pytest.mark.parametrize("block", [16, 4096])
def test_neighbours_equal_brute_force(spark, block):
    rng = np.random.default_rng(4)
    vec = np.round(rng.normal(size=(90, 5)), 1)
    vec[10] = vec[11] = vec[12]
    df = spark.createDataFrame([("s", i, [float(x) for x in v]) for i, v in enumerate(vec)],
                               "sample_id string, id bigint, vec array<double>")
    got = neighbours.nearest_neighbours(df, 6, block_rows=block).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.src, r["rank"])):
        by.setdefault(r.src, []).append(r.dst)
    assert [by[i] for i in range(90)] == brute_neighbours(vec, 6)


def test_copies_are_not_met_pair_by_pair(spark, monkeypatch):
    rng = np.random.default_rng(5)
    vec = np.concatenate([np.zeros((300, 3)), np.ones((40, 3)), rng.normal(size=(60, 3)), np.zeros((20, 3))])
    df = spark.createDataFrame([("s", i, [float(x) for x in v]) for i, v in enumerate(vec)],
                               "sample_id string, id bigint, vec array<double>")
    searched = []
    search = neighbours._searched
    monkeypatch.setattr(neighbours, "_searched", lambda rows, *a: searched.append(rows.count()) or search(rows, *a))
    by = {}
    for r in sorted(neighbours.nearest_neighbours(df, 4, block_rows=32).collect(), key=lambda r: (r.src, r["rank"])):
        by.setdefault(r.src, []).append(r.dst)
    assert [by[i] for i in range(len(vec))] == brute_neighbours(vec, 4)
    assert searched == [5 + 5 + 60]


def test_shared_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    lists = {i: [int(x) for x in rng.choice([j for j in range(60) if j != i], 5, replace=False)] for i in range(60)}
    for i in range(1, 60):
        lists[i] = [0] + [x for x in lists[i] if x != 0][:4]
    knn = spark.createDataFrame(
        [("s", i, j) for i, js in lists.items() for j in js], "sample_id string, src bigint, dst bigint"
    )
    sets = {i: set(js) | {i} for i, js in lists.items()}
    for prune in (1 / 15, 0.3):
        want = {
            (i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j])
            for i in sets for j in sets if i < j and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= prune
        }
        got = {(r.src1, r.src2): r.weight for r in neighbours.shared_neighbours(knn, 5, prune).collect()}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_balls_skip_far_blocks_and_lose_nothing(spark):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(5, 4)) * 50
    vec = centre[rng.integers(0, 5, 400)] + rng.normal(size=(400, 4))
    df = spark.createDataFrame(
        [("s", i, [float(x) for x in v]) for i, v in enumerate(vec)] + [("t", 1000, [0.0] * 4)],
        "sample_id string, id bigint, vec array<double>",
    )
    blocks = neighbours.ball_blocks(df, block_rows=24)
    sizes = [r["count"] for r in blocks.where("sample_id = 's'").groupBy("ball", "part").count().collect()]
    assert sum(sizes) == 400 and max(sizes) < 4 * 24
    pairs = neighbours.block_pairs(blocks, neighbours._within(blocks, 5, "bigint"), 5).count()
    assert pairs < 0.7 * len(sizes) * (len(sizes) - 1) / 2
    got = neighbours.nearest_neighbours(df, 5, block_rows=24).orderBy("src", "rank").collect()
    by = {}
    for r in got:
        by.setdefault(r.src, []).append(r.dst)
    assert [by[i] for i in range(400)] == brute_neighbours(vec, 5) and 1000 not in by


def test_approximate_neighbours_recall(spark):
    rng = np.random.default_rng(2)
    vec = rng.normal(size=(8, 6))[rng.integers(0, 8, 600)] * 4 + rng.normal(size=(600, 6))
    vec[:200] = vec[0]  # a bucket of very many rows
    df = spark.createDataFrame(
        [("s", i, [float(x) for x in v]) for i, v in enumerate(vec)], "sample_id string, id bigint, vec array<double>"
    )
    want = {(i, j) for i, js in enumerate(brute_neighbours(vec, 5)) for j in js}
    got = neighbours.approximate_neighbours(df, 5, bucket_rows=16).collect()
    assert all(r.src != r.dst for r in got) and len({(r.src, r.dst) for r in got}) == len(got)
    assert len(want & {(r.src, r.dst) for r in got}) >= 0.9 * len(want)


def test_hub_parts_change_nothing(spark):
    rows = [("s", i, j) for i in range(1, 80) for j in (0, i % 7 + 100)] + [("s", 0, 1), ("s", 0, 2)]
    knn = spark.createDataFrame(rows, "sample_id string, src bigint, dst bigint")
    one, many = (
        sorted(map(tuple, neighbours.shared_neighbours(knn, 2, 0.2, hub_rows=n).collect())) for n in (10_000, 6)
    )
    assert one == many and len(one) > 1000


def two_groups(spark, size=8):
    pairs = [(a + o, b + o) for o in (0, size) for a in range(size) for b in range(a + 1, size)] + [(0, size)]
    edges = spark.createDataFrame([("s", a, b, 1.0) for a, b in pairs],
                                  "sample_id string, src1 bigint, src2 bigint, weight double")
    nodes = spark.range(2 * size + 1).select(F.lit("s").alias("sample_id"), "id")
    return edges, nodes


def test_clusters_find_separate_groups_and_modularity_never_falls(spark):
    edges, nodes = two_groups(spark)
    got = {r.id: r.cluster for r in cluster.clusters(edges, nodes, 0.5).collect()}
    assert len({got[i] for i in range(8)}) == 1 and len({got[i] for i in range(8, 16)}) == 1
    assert got[0] != got[8] and got[16] == 2 and len(got) == 17
    scratch = Scratch(spark, "test")
    adj = scratch.keep(cluster.adjacency(edges))
    now, q = scratch.keep(cluster._nodes(adj, nodes)), [-1.0]
    for salt in range(20):
        q.append(cluster.modularity(adj, now, 0.5).first().q)
        assert q[-1] > q[-2]
        if (now := cluster.moved(adj, now, 0.5, salt, scratch)) is None:
            break
    assert now is None


def plain_gains(edges, label, resolution):
    """Modularity of a labelling, and the best change by one node's move or one merge, by definition."""
    k, links = {}, {}
    for a, b, w in edges:
        for x, y in ((a, b), (b, a)):
            k[x] = k.get(x, 0) + w
            links[x, y] = links.get((x, y), 0) + w
    m2 = sum(k.values())

    def quality(lab):
        return sum(
            (links.get((x, y), 0) - resolution * k[x] * k[y] / m2) / m2 for x in k for y in k if lab[x] == lab[y]
        )

    now = quality(label)
    tries = [{**label, x: label[y]} for x, y in links if label[x] != label[y]]
    tries += [{x: d if c == b else c for x, c in label.items()} for b in {*label.values()} for d in {*label.values()} if b != d]
    return now, max([quality(t) - now for t in tries], default=0.0)


def test_clusters_are_a_local_optimum(spark):
    rng = np.random.default_rng(4)
    chain = [(i, i + 1, 1.0) for i in range(47)]
    random = [(int(a), int(b), float(w)) for a, b, w in zip(*rng.integers(0, 40, (2, 160)), rng.uniform(0.1, 1, 160)) if a < b]
    for edges, resolution, least in ((chain, 0.2, 0.706), (random, 1.0, 0.0)):
        df = spark.createDataFrame([("s", *e) for e in edges], "sample_id string, src1 bigint, src2 bigint, weight double")
        nodes = spark.range(48).select(F.lit("s").alias("sample_id"), "id")
        _, found = cluster.labels(df, nodes, resolution, 1000)
        label = {r.u: r.c for r in found.collect()}
        assert len(label) == 48
        q, gain = plain_gains(edges, label, resolution)
        assert gain <= 1e-9 and q >= least
        assert abs(cluster.modularity(cluster.adjacency(df), found, resolution).first().q - q) < 1e-9


def test_nodes_alike_are_clustered_by_one_of_them(spark):
    near = [("s", i, j) for i in range(21) for j in range(21) if i != j]
    near += [("s", i, j) for i in range(21, 400) for j in range(20)]
    near += [("s", i, j) for i in range(400, 430) for j in range(i % 7, i % 7 + 12)]
    knn = spark.createDataFrame(near, "sample_id string, src bigint, dst bigint")
    nodes = spark.range(431).select(F.lit("s").alias("sample_id"), "id")
    member = neighbours.list_classes(knn, nodes)
    one = member.where("id = cls").select("sample_id", F.col("id").alias("src"))
    pairs = neighbours.shared_neighbours(knn.join(one, ["sample_id", "src"], "left_semi"), 20, 1 / 15)
    assert one.count() == 21 + 1 + 7 + 1 and pairs.count() < 435
    adj, units = cluster.class_labels(pairs, member, 0.2, 1000)
    assert units.agg(F.sum("m")).first()[0] == 431
    cls = {r.id: r.cls for r in member.collect()}
    at = {r.u: r.c for r in units.collect()}
    found = spark.createDataFrame([("s", i, at[cls[i]]) for i in cls], "sample_id string, u bigint, c bigint")
    whole = cluster.adjacency(neighbours.shared_neighbours(knn, 20, 1 / 15))
    q = cluster.modularity(whole, found, 0.2).first().q
    assert abs(cluster.modularity(adj, units, 0.2).first().q - q) < 1e-9
    state = cluster._nodes(whole, nodes).drop("c").join(found, ["sample_id", "u"])
    assert cluster.move_gains(whole, state, 0.2).where("gain > 0").isEmpty()


def test_a_class_is_split_where_one_of_its_nodes_would_gain(spark):
    split = 0
    for resolution in (2.0,):
        pairs = [(9, i, 1.0) for i in range(10, 20)]
        member = [(i, 9, 20 / 22) for i in range(6, 10)] + [(i, i, 0.0) for i in range(10, 20)]
        alike = [i for i, c, _ in member if c == 9]
        edges = [(a, b, w) for i, b, w in pairs for a in (alike if i == 9 else [i])]
        edges += [(a, b, 20 / 22) for a in alike for b in alike if a < b]
        df = spark.createDataFrame([("s", *e) for e in pairs], "sample_id string, src1 bigint, src2 bigint, weight double")
        of = spark.createDataFrame([("s", *m) for m in member], "sample_id string, id bigint, cls bigint, inner double")
        _, units = cluster.class_labels(df, of, resolution, 1000)
        left, label = {c: [i for i, x, _ in member if x == c] for _, c, _ in member}, {}
        for u in units.collect():
            # Nodes of a class are alike, so any of them may stand for the unit's.
            own = left[9] if u.u in alike else left[u.u]
            label |= {own.pop(): u.c for _ in range(u.m)}
            split += u.u in alike and u.m < len(alike)
        q, gain = plain_gains(edges, label, resolution)
        assert gain <= 1e-9 and len(label) == len(member)
    assert split


def test_scaling_is_the_dense_z_score(spark):
    dense = np.array([[3, 0, 1], [0, 0, 4], [5, 2, 0], [1, 1, 1]], dtype=float)
    data = [("s", f"c{i}", j, int(dense[i, j])) for i in range(4) for j in range(3) if dense[i, j]]
    counts = spark.createDataFrame(data, "sample_id string, barcode string, feature_id int, n bigint")
    totals = counts.groupBy("sample_id", "barcode").agg(F.sum("n").alias("n_count"))
    p = EmbedParams()
    norm = normalise.log_normalise(counts, totals, p)
    back = normalise.scale_background(norm, totals, p)
    x = np.log1p(dense / dense.sum(axis=1, keepdims=True) * 1e4)
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    z0 = {r.feature_id: r.z0 for r in back.collect()}
    got = np.array([[z0[j] for j in range(3)] for _ in range(4)])
    for r in normalise.scale_entries(norm, back, p).collect():
        got[int(r.barcode[1:]), r.feature_id] = r.z
    assert np.allclose(got, z, atol=1e-9)


def test_components_equal_the_dense_ones(spark):
    from dropsieve.operators import embed

    rng = np.random.default_rng(1)
    dense = rng.poisson(1.5, size=(30, 12)).astype(float)
    dense[:, 0] += 1
    data = [("s", f"c{i:02d}", j, int(dense[i, j])) for i in range(30) for j in range(12) if dense[i, j]]
    counts = spark.createDataFrame(data, "sample_id string, barcode string, feature_id int, n bigint")
    totals = counts.groupBy("sample_id", "barcode").agg(F.sum("n").alias("n_count"))
    p = EmbedParams(n_variable=12, n_components=3)
    got = {r.barcode: r.pca for r in embed.pca(counts, totals, p).collect()}
    x = np.log1p(dense / dense.sum(axis=1, keepdims=True) * 1e4)
    z = np.minimum((x - x.mean(axis=0)) / x.std(axis=0, ddof=1), 10)
    values, vectors = np.linalg.eigh(z.T @ z)
    want = z @ vectors[:, np.argsort(values)[::-1][:3]]
    have = np.array([got[f"c{i:02d}"] for i in range(30)])
    assert np.allclose(np.abs(have), np.abs(want), atol=1e-7)


def test_registered_queries_use_the_defaults():
    from dropsieve.plans.views import EMBED

    assert (EMBED.n_variable, EMBED.n_components, EMBED.k) == (2000, 50, 20)


def test_variance_standardised_by_the_trend(spark):
    x = np.linspace(0, 3, 60)
    assert np.allclose(normalise.local_trend(x, 2 * x * x - x, 0.4, knots=60), 2 * x * x - x, atol=1e-8)


def test_synthetic_doublets_score_higher(spark):
    rnd = random.Random(2)
    data = []
    for c in range(120):
        kind = c % 2
        for f in range(40):
            mean = 8 if (f < 20) == (kind == 0) else 0
            n = sum(rnd.random() < mean / 10 for _ in range(10))
            if n:
                data.append(("s", f"c{c}", f, n))
    for c in range(8):
        for f in range(40):
            data.append(("s", f"mix{c}", f, rnd.randint(6, 10)))
    counts = spark.createDataFrame(data, "sample_id string, barcode string, feature_id int, n bigint")
    p = EmbedParams(n_variable=40, n_components=5, k=8)
    got = {r.cell_barcode: r for r in synthetic.doublet_scores(counts, p, 0.07).collect()}
    assert len(got) == 128
    mixed = statistics.mean(r.doublet_score for b, r in got.items() if b.startswith("mix"))
    plain = statistics.mean(r.doublet_score for b, r in got.items() if not b.startswith("mix"))
    assert mixed > plain
    assert sum(r.doublet_class == "doublet" for r in got.values()) <= math.ceil(0.07 * 128)
    again = {r.cell_barcode: r.doublet_score for r in synthetic.doublet_scores(counts, p, 0.07).collect()}
    assert again == {b: r.doublet_score for b, r in got.items()}


def test_as_many_doublets_as_expected_although_scores_tie(spark):
    rnd = random.Random(4)
    data = [("st"[c % 2], f"c{c}", f, rnd.randint(1, 9)) for c in range(160) for f in range(30) if rnd.random() < 0.7]
    counts = spark.createDataFrame(data, "sample_id string, barcode string, feature_id int, n bigint")
    p = EmbedParams(n_variable=30, n_components=5, k=4)
    got = synthetic.doublet_scores(counts, p, 0.03).collect()
    assert len(got) == 160
    for s in "st":
        own = [r for r in got if r.sample_id == s]
        called = [r.doublet_score for r in own if r.doublet_class == "doublet"]
        rest = [r.doublet_score for r in own if r.doublet_class != "doublet"]
        assert len(called) == math.ceil(0.03 * 80) and min(called) >= max(rest)


def test_pairs_are_of_one_sample_and_never_a_cell_with_itself(spark):
    c = spark.range(1000).select(F.concat(F.lit("s"), F.col("id") % 2).alias("sample_id"), F.col("id").cast("string").alias("barcode"))
    got = synthetic.pair_cells(c, 1, bucket_rows=16).collect()
    assert len(got) > 990 and all(r["first"] != r.other for r in got)
    assert all(int(r["first"]) % 2 == int(r.other) % 2 == int(r.sample_id[1]) for r in got)
