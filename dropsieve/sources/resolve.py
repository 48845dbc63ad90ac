"""Which inputs a run mode uses."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropsieve.params import QCParams

# Fixed layout of a sample's mapping folder.
OUTS = "outs"
FILTERED_DIR = "filtered_feature_bc_matrix"
RAW_DIR = "raw_feature_bc_matrix"
ALIGNMENTS_STANDARD = "possorted_genome_bam.parquet"
ALIGNMENTS_MULTIOME = "gex_possorted_bam.parquet"
FRAGMENTS_FILE = "atac_fragments.tsv.gz"
PEAKS_FILE = "atac_peaks.bed"


@dataclass(frozen=True)
class Inputs:
    """Choices that follow from the mode: call set, alignment file, modality rule."""

    call_set: str
    alignments_file: str
    modality_rule: str


def resolve(p: QCParams) -> Inputs:
    return Inputs(
        call_set="denoised" if p.denoised else "filtered",
        alignments_file=ALIGNMENTS_MULTIOME if p.multiome else ALIGNMENTS_STANDARD,
        modality_rule="gex_if_multi" if p.multiome else "gex_or_first",
    )


def sample_paths(manifest: DataFrame, p: QCParams) -> DataFrame:
    """Manifest with the location of every input of a sample."""
    inputs = resolve(p)

    def under(*parts):
        return F.concat_ws("/", F.rtrim("path", F.lit("/")), F.lit(OUTS), *[F.lit(x) for x in parts])

    return manifest.select(
        "sample_id",
        "path",
        under(FILTERED_DIR).alias("matrix_dir"),
        under(RAW_DIR).alias("raw_dir"),
        under(FILTERED_DIR, "barcodes.tsv.gz").alias("barcodes_path"),
        under(inputs.alignments_file).alias("alignments_path"),
        under(FRAGMENTS_FILE).alias("fragments_path"),
        under(PEAKS_FILE).alias("peaks_path"),
    )


def called_barcodes(barcodes: DataFrame, p: QCParams) -> DataFrame:
    """The call set of the mode: denoised after ambient removal, else filtered."""
    return barcodes.where(F.col("call_set") == resolve(p).call_set)


def restrict_to_called(counts: DataFrame, barcodes: DataFrame, p: QCParams) -> DataFrame:
    """Triplets of the barcodes that the mode calls cells."""
    key = ["sample_id", "barcode"]
    return counts.join(called_barcodes(barcodes, p).select(*key).hint("shuffle_hash"), key, "left_semi")
