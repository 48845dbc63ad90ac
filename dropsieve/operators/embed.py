"""Principal components of scaled expression, per sample, without a dense matrix."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dropsieve.functions.scalars import CELL, SAMPLE
from dropsieve.functions.sizing import MAX_BROADCAST_ROWS, sized
from dropsieve.operators import normalise
from dropsieve.params import EmbedParams
from dropsieve.session import checkpoint

# Cells whose products one task sums, in a sample with few; in a large one the chunks grow instead.
CHUNK_CELLS = 8_192
MOST_CHUNKS = 16


def _indexed(entries: DataFrame, background: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries and background with a feature position 0..G-1 per sample."""
    w = Window.partitionBy(SAMPLE).orderBy("feature_id")
    axis = background.withColumn("g", (F.row_number().over(w) - 1).cast("int"))
    size = axis.groupBy(SAMPLE).agg(F.count("*").cast("int").alias("n_g"))
    axis = sized(axis.join(size, SAMPLE))
    shifted = entries.join(axis.select(SAMPLE, "feature_id", "g", "n_g"), [SAMPLE, "feature_id"])
    return shifted.withColumn("s", F.col("z") - F.col("z0")), axis


def _add_products(part: pd.DataFrame, total: np.ndarray, plain: np.ndarray) -> None:
    """Adds the outer products of sparse rows to ``total``, by pairs of entries or, if dense, as a product."""
    size = np.array([len(x) for x in part["gs"]])
    g, s = np.concatenate(part["gs"].to_list()), np.concatenate(part["ss"].to_list())
    plain += np.bincount(g, s, len(plain))
    if 16 * int((size * size).sum()) < len(part) * len(plain):
        begin = np.repeat(np.cumsum(size) - size, size)
        pairs = np.repeat(size, size)
        one = np.repeat(np.arange(len(g)), pairs)
        other = np.arange(len(one)) - np.repeat(np.cumsum(pairs) - pairs - begin, pairs)
        np.add.at(total, (g[one], g[other]), s[one] * s[other])
        return
    dense = np.zeros((len(part), len(plain)))
    dense[np.repeat(np.arange(len(part)), size), g] = s
    total += dense.T @ dense


def _partial_products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums over each chunk of cells of the outer products of their sparse rows, in sorted batches."""
    key, total, plain = None, None, None

    def done() -> Iterator[pd.DataFrame]:
        for at in range(0, len(plain), 256):
            rows = range(at, min(at + 256, len(plain)))
            yield pd.DataFrame(
                {SAMPLE: key[0], "g": np.array(rows, "int32"), "s_sum": plain[at : at + 256], "products": [total[i] for i in rows]}
            )

    for pdf in batches:
        for now, part in pdf.groupby([SAMPLE, "chunk"]):
            if now != key:
                if key is not None:
                    yield from done()
                size = int(part["n_g"].iloc[0])
                key, total, plain = now, np.zeros((size, size)), np.zeros(size)
            for at in range(0, len(part), 1024):
                _add_products(part.iloc[at : at + 1024], total, plain)
    if key is not None:
        yield from done()


def _add_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds up runs of rows of the same sample and feature in sorted batches."""
    key, total, plain = None, None, 0.0
    for pdf in batches:
        done = []
        for sample, g, s_sum, row in zip(pdf[SAMPLE], pdf["g"], pdf["s_sum"], pdf["products"]):
            if key == (sample, g):
                total, plain = total + row, plain + s_sum
                continue
            if key is not None:
                done.append((*key, plain, total))
            key, total, plain = (sample, g), row, s_sum
        if done:
            yield pd.DataFrame(done, columns=[SAMPLE, "g", "s_sum", "products"])
    if key is not None:
        yield pd.DataFrame([(*key, plain, total)], columns=[SAMPLE, "g", "s_sum", "products"])


def principal_axes(entries: DataFrame, background: DataFrame, p: EmbedParams) -> DataFrame:
    """Loadings ``(sample_id, feature_id, z0, loading)``.

    With ``z = z0 + s``, where ``s`` is zero for absent entries, the matrix of
    products follows from the sums of ``s`` and of its outer products. Chunks
    of cells sum these in parallel as streams, and the sums of a feature are added
    up as another, so a sample may have any number of cells. Only the final
    step needs a sample's whole feature-by-feature matrix.
    """
    shifted, axis = _indexed(entries, background)
    rows = shifted.groupBy(*CELL).agg(
        F.collect_list(F.struct("g", "s")).alias("row"), F.first("n_g").alias("n_g")
    )
    sizes = axis.groupBy(SAMPLE).agg(F.first("n_all").alias("n_all"))
    n = F.col("n_all")
    chunks = F.least(F.ceil(n / CHUNK_CELLS), MOST_CHUNKS + F.ceil(n / (128 * CHUNK_CELLS)))
    # A number of its own for each: what is small to shuffle is not small to compute, and would be coalesced.
    dealt = sizes.agg(F.count("*"), F.sum(chunks)).first()
    n_samples, n_chunks = (min(max(int(x or 0), 1), 2000) for x in dealt)
    chunked = rows.join(sized(sizes), SAMPLE).withColumn(
        "chunk", F.pmod(F.xxhash64(*CELL), chunks).cast("bigint")
    )
    schema = f"{SAMPLE} string, g int, s_sum double, products array<double>"
    partial = (
        chunked.select(SAMPLE, "chunk", "n_g", F.col("row.g").alias("gs"), F.col("row.s").alias("ss"))
        .repartition(2 * n_chunks, SAMPLE, "chunk")
        .sortWithinPartitions(SAMPLE, "chunk")
        .mapInPandas(_partial_products, schema)
    )
    summed = (
        partial.repartition(SAMPLE, "g").sortWithinPartitions(SAMPLE, "g").mapInPandas(_add_rows, schema)
    )
    full = summed.join(axis.select(SAMPLE, "g", "feature_id", "z0", "n_all"), [SAMPLE, "g"])
    k = p.n_components

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("g")
        z0, s, n = pdf["z0"].to_numpy(), pdf["s_sum"].to_numpy(), float(pdf["n_all"].iloc[0])
        cross = np.outer(z0, s)
        m = np.stack(pdf["products"].to_list()) + cross + cross.T + n * np.outer(z0, z0)
        values, vectors = np.linalg.eigh(m)
        top = vectors[:, np.argsort(values)[::-1][:k]]
        sign = np.sign(top[np.abs(top).argmax(axis=0), np.arange(top.shape[1])])
        top = top * np.where(sign == 0, 1.0, sign)
        return pdf[[SAMPLE, "feature_id", "z0"]].assign(loading=list(top))

    id_type = entries.schema["feature_id"].dataType.simpleString()
    out = f"{SAMPLE} string, feature_id {id_type}, z0 double, loading array<double>"
    return full.repartition(2 * n_samples, SAMPLE).groupBy(SAMPLE).applyInPandas(solve, out)


def project(entries: DataFrame, axes: DataFrame, cells: DataFrame, p: EmbedParams) -> DataFrame:
    """Coordinates ``pca`` of every cell as sums over its entries, in the JVM."""
    k = p.n_components
    loads = sized(axes.select(SAMPLE, "feature_id", "loading"), MAX_BROADCAST_ROWS // 8)
    joined = entries.join(loads, [SAMPLE, "feature_id"])
    shift = F.col("z") - F.col("z0")
    sums = joined.groupBy(*CELL).agg(
        *[F.sum(shift * F.get("loading", F.lit(i))).alias(f"c{i}") for i in range(k)]
    )
    origin = axes.groupBy(SAMPLE).agg(
        *[F.sum(F.col("z0") * F.get("loading", F.lit(i))).alias(f"o{i}") for i in range(k)]
    )
    zero = F.lit(0.0)
    at = [F.coalesce(f"c{i}", zero) + F.col(f"o{i}") for i in range(k)]
    return (
        cells.select(*CELL)
        .join(sized(origin), SAMPLE)
        .join(sums, CELL, "left")
        .select(*CELL, F.filter(F.array(*at), lambda v: v.isNotNull()).alias("pca"))
    )


def scaled_variable(counts: DataFrame, cells: DataFrame, p: EmbedParams) -> tuple[DataFrame, DataFrame]:
    """Scaled entries and background of the variable features.

    The chosen features, their triplets and the background are each read several
    times and are stored. ``counts`` and ``cells`` should be stored tables too.
    """
    chosen = checkpoint(normalise.variable_features(counts, cells, p))
    few = normalise.restrict_features(counts, chosen)
    used = checkpoint(normalise.log_normalise(few, cells, p))
    background = checkpoint(normalise.scale_background(used, cells, p))
    return normalise.scale_entries(used, background, p), background


def pca(counts: DataFrame, cells: DataFrame, p: EmbedParams) -> DataFrame:
    """Normalise, choose variable features, scale and project."""
    entries, background = scaled_variable(counts, cells, p)
    axes = checkpoint(principal_axes(entries, background, p))
    return project(entries, axes, cells, p)


def cell_coordinates(embedded: DataFrame, cells: DataFrame) -> DataFrame:
    """First two components of each cell with its metrics."""
    at = embedded.select(
        *CELL, F.get("pca", F.lit(0)).alias("pc1"), F.get("pca", F.lit(1)).alias("pc2")
    )
    return cells.join(at, CELL)
