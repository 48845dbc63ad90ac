"""Readers, mode resolution and sinks."""

import gzip
import os

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from dropsieve.operators import multimodal
from dropsieve.params import QCParams
from dropsieve.sources import published, readers, resolve, sinks


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    if path.suffix == ".gz":
        with gzip.open(path, "wt") as f:
            f.write(text)
    else:
        path.write_text(text)
    return str(path)


@pytest.fixture
def manifest(spark, tmp_path):
    for s, shift in (("a", 0), ("b", 1)):
        d = tmp_path / s / "outs" / "filtered_feature_bc_matrix"
        write(d / "barcodes.tsv.gz", "AA-1\nCC-1\nGG-1\n")
        write(
            d / "features.tsv.gz",
            "id1\tMT-X\tGene Expression\nid2\tGENE\tGene Expression\nchr1:5-9\tchr1:5-9\tPeaks\n",
        )
        # The last entry has the position the size line has.
        write(
            d / "matrix.mtx.gz",
            f"%%MatrixMarket matrix coordinate integer general\n%meta\n3 3 4\n1 1 {2 + shift}\n2 1 5\n1 3 7\n3 3 4\n",
        )
    sheet = write(tmp_path / "samples.csv", f"samplename,path\na,{tmp_path}/a\nb,{tmp_path}/b/\n")
    return readers.read_manifest(spark, sheet)


def test_manifest(manifest):
    assert [r.sample_id for r in manifest.orderBy("sample_id").collect()] == ["a", "b"]


def test_matrix_directories(spark, manifest):
    places = resolve.sample_paths(manifest, QCParams())
    counts, features, barcodes = readers.read_matrix_dirs(spark, places)
    got = rows(counts.select("sample_id", "barcode", "feature_id", "n"))
    assert got == sorted(
        [("a", "AA-1", "id1", 2), ("b", "AA-1", "id1", 3)]
        + [(s, *e) for s in "ab" for e in (("AA-1", "id2", 5), ("GG-1", "id1", 7), ("GG-1", "chr1:5-9", 4))],
        key=repr,
    )
    assert rows(barcodes.where("sample_id = 'a'").select("barcode", "ord")) == [("AA-1", 0), ("CC-1", 1), ("GG-1", 2)]
    peak = features.where("modality = 'Peaks' and sample_id = 'b'").first()
    assert (peak.chrom, peak.start, peak.end, peak.ord) == ("chr1", 5, 9, 2)


def test_positions_hold_across_splits(spark, tmp_path):
    names = [f"B{i:05d}" for i in range(20000)]
    path = write(tmp_path / "list.csv", "\n".join(names) + "\n")
    samples = spark.createDataFrame([("s", path)], "sample_id string, p string")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = readers.read_barcodes(spark, samples, "p", "denoised")
        got = [r.barcode for r in df.orderBy("ord").collect()]
        assert spark.read.text(path).rdd.getNumPartitions() > 1
        assert rows(df.agg(F.min("ord"), F.max("ord"), F.count_distinct("ord"))) == [(0, 19999, 20000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == names


def test_metric_csv_is_optional(spark, tmp_path):
    assert readers.read_metric_csv(spark, str(tmp_path / "missing")) is None
    write(tmp_path / "x" / "sample_id=s" / "m.csv", "name,nuclear_fraction\nA,1\n")
    assert readers.read_metric_csv(spark, str(tmp_path / "x")) is None
    write(tmp_path / "y" / "sample_id=s" / "m.csv", "nuclear_fraction,barcode\n0.5,A-1\nNA,B\noops,C\n")
    df = readers.read_metric_csv(spark, str(tmp_path / "y"))
    assert rows(df.select("sample_id", "barcode", "nuclear_fraction")) == [
        ("s", "A-1", 0.5), ("s", "B", None), ("s", "C", None),
    ]


def test_metric_csv_headers_differ(spark, tmp_path):
    for sample, text in {
        "a": "cell_barcode,doublet_score,doublet_class\nA-1,0.5,singlet\n",
        "b": 'doublet_score,cell_barcode\n0.25,"B,2"\n\n',
        "c": "doublet_class,note,cell_barcode\ndoublet,NA,C\n",
    }.items():
        write(tmp_path / f"sample_id={sample}" / "m.csv", text)
    df = readers.read_metric_csv(spark, str(tmp_path))
    assert rows(df.select("sample_id", "cell_barcode", "doublet_score", "doublet_class", "note")) == [
        ("a", "A-1", 0.5, "singlet", None),
        ("b", "B,2", 0.25, None, None),
        ("c", "C", None, "doublet", None),
    ]


def test_metadata_needs_its_key(spark, tmp_path):
    good = write(tmp_path / "m.csv", "sampleid,age\na,30\n")
    assert dict(readers.read_metadata(spark, good).dtypes)["age"] == "int"
    assert readers.read_metadata(spark, write(tmp_path / "n.csv", "name,age\na,30\n")) is None
    assert readers.read_metadata(spark, str(tmp_path / "none.csv")) is None


def test_missing_required_input_stops(spark, tmp_path):
    with pytest.raises(AnalysisException):
        readers.read_counts(spark, str(tmp_path / "none"))
    with pytest.raises(AnalysisException):
        readers.read_alignments(spark, str(tmp_path / "none"))


def test_fragments_and_intervals(spark, tmp_path):
    path = write(tmp_path / "a" / "outs" / "atac_fragments.tsv.gz", "# head\nchr1\t5\t90\tAA-1\t2\n")
    samples = spark.createDataFrame([("a", path)], "sample_id string, fragments_path string")
    assert rows(readers.read_fragments(spark, samples)) == [("chr1", 5, 90, "AA-1", 2, "a")]
    bed = write(tmp_path / "p.bed", "# x\nchr1\t1\t9\n")
    assert rows(readers.read_intervals(spark, bed)) == [("chr1", 1, 9)]


def test_modes(spark):
    assert resolve.resolve(QCParams()).call_set == "filtered"
    multi = resolve.resolve(QCParams(denoised=True, multiome=True))
    assert multi.call_set == "denoised" and multi.alignments_file.startswith("gex_")
    m = spark.createDataFrame([("a", "/x/a/")], "sample_id string, path string")
    got = resolve.sample_paths(m, QCParams(multiome=True)).first()
    assert got.alignments_path == "/x/a/outs/gex_possorted_bam.parquet"
    assert got.fragments_path == "/x/a/outs/atac_fragments.tsv.gz"


def test_writing_one_sample_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("a", "x", 1.0), ("b", "y", 2.0)], "sample_id string, cell_barcode string, doublet_score double")
    sinks.write_metric_csv(df, path)
    sinks.write_metric_csv(df.where("sample_id = 'b'").withColumn("doublet_score", F.lit(9.0)), path)
    back = readers.read_metric_csv(spark, path)
    assert rows(back.select("sample_id", "doublet_score")) == [("a", 1.0), ("b", 9.0)]
    assert sorted(d for d in os.listdir(path) if "=" in d) == ["sample_id=a", "sample_id=b"]


def test_modalities_are_written_apart(spark, tmp_path):
    schema = "sample_id string, modality string, barcode string, feature_id string, n bigint"
    df = spark.createDataFrame([("a", m, "A", "f", 1) for m in (multimodal.GEX, multimodal.PEAKS)], schema)
    path = str(tmp_path / "m")
    sinks.write_modalities(df, path)
    peaks = readers.read_counts(spark, path, multimodal.PEAKS)
    assert peaks.count() == 1
    plan = peaks._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(modality" in plan
    with pytest.raises(multimodal.MissingModality):
        sinks.write_modalities(df.where("modality = 'Peaks'"), path)


def test_summary_rows(spark):
    df = spark.createDataFrame([("a", 1, 2.5)], "sample_id string, x int, y double")
    assert rows(sinks.to_metric_rows(df)) == [("a", "x", 1.0), ("a", "y", 2.5)]


def test_a_failed_write_leaves_what_was_published(spark, tmp_path):
    path = str(tmp_path / "cells")
    one = spark.createDataFrame([("007", "x", 1), ("7", "y", 2), ("b", "z", 3)], "sample_id string, barcode string, n int")
    first = published.publish(one, path)
    second = published.publish(one.where("sample_id = 'b'").withColumn("n", F.lit(30)), path)
    want = [("007", "x", 1), ("7", "y", 2), ("b", "z", 30)]
    read = lambda: rows(published.read_published(spark, path).select("sample_id", "barcode", "n"))
    assert read() == want
    bad = F.when(F.col("barcode") == "z", F.raise_error(F.lit("stop")).cast("int")).otherwise(F.lit(99))
    with pytest.raises(PySparkException):
        published.publish(one.repartition(3, "barcode").withColumn("n", bad), path)
    with pytest.raises(PySparkException, match="without a sample"):
        published.publish(one.withColumn("sample_id", F.lit(None).cast("string")), path)
    assert read() == want
    # Written to the end, but without a commit.
    one.withColumn("n", F.lit(5)).write.partitionBy("sample_id").parquet(f"{path}/runs/run=zz")
    assert read() == want
    assert "zz" in published.drop_superseded(spark, path) and read() == want
    third = published.publish(one.where("sample_id <> 'b'"), path)
    assert first in published.drop_superseded(spark, path) and read() == want
    assert {r.run for r in published.current_runs(spark, path).collect()} == {second, third}
    published.publish(one.limit(0), path)
    assert read() == want


def test_counts_dealt_by_cell_are_summed_and_stored_without_another_shuffle(spark):
    from dropsieve.session import store_bucketed

    rows = spark.range(4000).selectExpr("concat('s', id % 2) sample_id", "concat('b', id % 50) barcode", "id % 7 f", "id n")
    dealt = rows.repartition(5, "sample_id", "barcode").groupBy("sample_id", "barcode", "f").agg(F.sum("n").alias("n"))
    assert dealt._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    stored = store_bucketed(dealt, "dealt", ["sample_id", "barcode"], 5, dealt=True)
    assert len(stored.inputFiles()) <= 5
    per = stored.groupBy("sample_id", "barcode").agg(F.sum("n").alias("n"))
    assert "Exchange" not in per._jdf.queryExecution().executedPlan().toString()
    assert stored.count() == 350 and stored.agg(F.sum("n")).first()[0] == 4000 * 3999 // 2


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="provided tables not here")
def test_orders_meet_their_cells_before_the_lines(spark):
    from dropsieve.plans.views import Views

    plan = Views(spark, "/root/testdata/sf0.001").lines._jdf.queryExecution().optimizedPlan().toString().splitlines()
    top = next(x for x in plan if "Join" in x)
    assert "l_orderkey" in top and "c_custkey" not in top
