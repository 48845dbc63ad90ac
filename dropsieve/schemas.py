"""Schemas of the tables that are read from files, as DDL."""

ALIGNMENTS = "sample_id STRING, cb STRING, re STRING"
FRAGMENTS = "chrom STRING, start BIGINT, end BIGINT, barcode STRING, read_support BIGINT"
INTERVALS = "chrom STRING, start BIGINT, end BIGINT"
MATRIX_ENTRY = "i BIGINT, j BIGINT, n BIGINT"
FEATURE_LINE = (
    "feature_id STRING, feature_name STRING, modality STRING, chrom STRING, start BIGINT, end BIGINT"
)
