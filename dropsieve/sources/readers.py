"""Scans of the input files, all samples at once."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dropsieve import schemas
from dropsieve.functions.scalars import SAMPLE, split_peak_name
from dropsieve.functions.sizing import sized
from dropsieve.operators.annotate import BARCODE_NAMES

NUMBERS = ("nuclear_fraction", "doublet_score")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Sample sheet with the columns ``samplename`` and ``path``."""
    return spark.read.option("header", True).csv(path).selectExpr("samplename AS sample_id", "path")


def read_counts(spark: SparkSession, path: str, modality: str | None = None) -> DataFrame:
    """Count triplets; a modality filter reaches the file scan."""
    df = spark.read.parquet(path)
    return df.where(F.col("modality") == modality) if modality else df


def read_alignments(spark: SparkSession, path: str) -> DataFrame:
    """Cell barcode and region tag per read."""
    return spark.read.schema(schemas.ALIGNMENTS).parquet(path)


def plain_path(c) -> Column:
    """A file location without its scheme, so both spellings compare equal."""
    return F.regexp_replace(c, r"^[a-zA-Z0-9+.-]+:/+", "/")


def _with_place(df: DataFrame) -> DataFrame:
    """Adds the file, the offset of its split and the row's number within the split."""
    return df.select(
        "*",
        plain_path(F.col("_metadata.file_path")).alias("_file"),
        F.col("_metadata.file_block_start").alias("_at"),
        F.monotonically_increasing_id().alias("_id"),
    )


def _with_ordinal(df: DataFrame, out: str = "ord") -> DataFrame:
    """Adds the row's position in its file, from 0.

    Rows are counted per split and splits are shifted by those before them, so
    no task needs a whole file.
    """
    rows = _with_place(df)
    split = rows.groupBy("_file", "_at").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    w = Window.partitionBy("_file").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    split = split.withColumn("_shift", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    return (
        rows.join(split.select("_file", "_at", "_first", "_shift"), ["_file", "_at"])
        .withColumn(out, F.col("_shift") + F.col("_id") - F.col("_first"))
        .drop("_at", "_id", "_first", "_shift")
    )


def _by_sample(df: DataFrame, samples: DataFrame, path_col: str) -> DataFrame:
    """Replaces the file by the sample whose path it is."""
    key = samples.select(SAMPLE, plain_path(F.col(path_col)).alias("_file"))
    return df.join(key, "_file").drop("_file")


def _paths(samples: DataFrame, path_col: str) -> list[str]:
    """The paths themselves; the manifest is the one table the driver reads."""
    return [r[0] for r in samples.select(path_col).collect()]


def read_barcodes(
    spark: SparkSession, samples: DataFrame, path_col: str, call_set: str
) -> DataFrame:
    """Headerless barcode lists, one file per sample, with the position in the list."""
    lines = spark.read.text(_paths(samples, path_col))
    return _by_sample(_with_ordinal(lines), samples, path_col).select(
        SAMPLE, F.lit(call_set).alias("call_set"), F.trim("value").alias("barcode"), "ord"
    )


def read_features(spark: SparkSession, samples: DataFrame, path_col: str) -> DataFrame:
    """Feature lists; peaks get their interval from the name if the file has none."""
    lines = spark.read.schema(schemas.FEATURE_LINE).option("sep", "\t").csv(_paths(samples, path_col))
    named = _by_sample(_with_ordinal(lines), samples, path_col)
    chrom, start, end = split_peak_name(F.col("feature_name"))
    is_peak = F.col("modality") == "Peaks"
    return named.select(
        SAMPLE,
        F.coalesce("modality", F.lit("Gene Expression")).alias("modality"),
        "feature_id",
        "feature_name",
        F.coalesce("chrom", F.when(is_peak, chrom)).alias("chrom"),
        F.coalesce("start", F.when(is_peak, start)).alias("start"),
        F.coalesce("end", F.when(is_peak, end)).alias("end"),
        "ord",
    )


def read_matrix_dirs(
    spark: SparkSession, samples: DataFrame, dir_col: str = "matrix_dir", call_set: str = "filtered"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Matrix directories as ``(counts, features, barcodes)``.

    The first line after the comments of a matrix file gives its size and is
    not an entry. Entries name features and barcodes by position, from 1.
    """

    def at(name):
        return samples.select(SAMPLE, F.concat_ws("/", F.rtrim(F.col(dir_col), F.lit("/")), F.lit(name)).alias("p"))

    barcodes = read_barcodes(spark, at("barcodes.tsv.gz"), "p", call_set)
    features = read_features(spark, at("features.tsv.gz"), "p")
    reader = spark.read.schema(schemas.MATRIX_ENTRY).option("sep", " ").option("comment", "%")
    lines = _with_place(reader.csv(_paths(at("matrix.mtx.gz"), "p")))
    head = lines.groupBy("_file").agg(F.min(F.struct("_at", "_id")).alias("_head"))
    entries = lines.join(head, "_file").where(F.struct("_at", "_id") != F.col("_head"))
    counts = (
        _by_sample(entries.select("_file", "i", "j", "n"), at("matrix.mtx.gz"), "p")
        .join(features.withColumn("i", F.col("ord") + 1).drop("ord", "chrom", "start", "end"), [SAMPLE, "i"])
        .join(
            barcodes.select(SAMPLE, "barcode", (F.col("ord") + 1).alias("j")),
            [SAMPLE, "j"],
        )
        .select(SAMPLE, "modality", "barcode", "feature_id", "feature_name", "n")
    )
    return counts, features, barcodes


def _by_header(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> DataFrame:
    """Rows of CSV files with a header line each, columns by name whatever their order.

    Spark takes the header of one file for all. Here lines are read as text, a file's first line
    tells its header, and files of the same header are parsed together; there are few headers, and
    only they go to the driver. Columns that a file lacks are NULL. ``_place`` orders lines within
    a file.
    """
    lines = spark.read.text(path)
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    lines = lines.select("*", place.alias("_place"), F.col("_metadata.file_path").alias("_path"))
    heads = lines.groupBy("_path").agg(F.min_by("value", "_place").alias("_head"))
    heads = sized(heads)
    kinds = sorted(r[0] for r in heads.select("_head").distinct().collect())
    rows = lines.join(heads, "_path").where((F.col("value") != F.col("_head")) & (F.trim("value") != ""))
    others = [c for c in lines.columns if c not in ("value", "_place", "_path")]
    parts = []
    for head in kinds:
        names = next(csv.reader([head.lstrip("\ufeff")], delimiter=sep))
        kind = ", ".join(f"`{n}` STRING" for n in names)
        own = rows.where(F.col("_head") == head)
        parsed = F.from_csv("value", kind, {"sep": sep, "nullValue": "NA", "mode": "PERMISSIVE"})
        parts.append(own.select(*others, "_place", parsed.alias("_row")).select(*others, "_place", "_row.*"))
    if not parts:
        return lines.select(*others, "_place").limit(0)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def read_metric_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame | None:
    """Per-cell metric table, or None when it is missing or has no barcode column.

    Files lie under ``sample_id=...`` folders, which give the sample. Every file
    has a header of its own: order and choice of columns may differ. ``ord``
    orders rows within a file. Text that is no number reads as NULL.
    """
    try:
        df = _by_header(spark, path)
    except AnalysisException:
        return None
    names = [c for c in BARCODE_NAMES if c in df.columns]
    if not names or SAMPLE not in df.columns:
        return None
    cols = [
        F.expr(f"try_cast(`{c}` AS DOUBLE)").alias(c) if c in NUMBERS else F.col(c)
        for c in df.columns
        if c not in (SAMPLE, "_place")
    ]
    return df.select(F.col(SAMPLE).cast("string"), *cols, F.col("_place").alias("ord"))


def read_metadata(spark: SparkSession, path: str) -> DataFrame | None:
    """Sample metadata with inferred types, or None without a ``sampleid`` column."""
    try:
        df = spark.read.option("header", True).option("inferSchema", True).csv(path)
    except AnalysisException:
        return None
    return df if "sampleid" in df.columns else None


def read_fragments(spark: SparkSession, samples: DataFrame, path_col: str = "fragments_path") -> DataFrame:
    """Fragment files, tab-separated with ``#`` comments."""
    lines = (
        spark.read.schema(schemas.FRAGMENTS)
        .option("sep", "\t")
        .option("comment", "#")
        .csv(_paths(samples, path_col))
        .select("*", plain_path(F.col("_metadata.file_path")).alias("_file"))
    )
    return _by_sample(lines, samples, path_col)


def read_intervals(spark: SparkSession, path: str) -> DataFrame:
    """BED intervals, half-open from 0."""
    return (
        spark.read.schema(schemas.INTERVALS).option("sep", "\t").option("comment", "#").csv(path)
    )
