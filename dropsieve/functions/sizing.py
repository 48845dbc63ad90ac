"""Size checks that decide whether a side may be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropsieve.session import checkpoint

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 << 20


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; reads one row more than that at most."""
    return df.select(F.lit(1)).limit(max_rows + 1).count() <= max_rows


def sized(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` computed and stored, to be broadcast if it has at most ``max_rows`` rows.

    For tables with one row per sample or the like, which are joined to large
    ones. Spark cannot foresee their size and would shuffle the large side by
    sample, all of a large sample to one task. A table that turns out too large
    is joined by shuffle.
    """
    kept = checkpoint(df)
    return F.broadcast(kept) if fits_broadcast(kept, max_rows) else kept


def fits_bytes(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True when the rows of ``df``, as they are after all that is planned, take at most ``max_bytes``.

    Strings and arrays are measured, everything else counts as eight bytes, a row as sixteen more.
    Reads no more rows than could fit.
    """
    size = F.lit(16)
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        text = F.length(F.col(f.name).cast("string")) if kind in ("string", "array", "binary") else F.lit(0)
        size = size + 8 + F.coalesce(text, F.lit(0))
    few = df.limit(max_bytes // (16 + 8 * len(df.columns)) + 1)
    return (few.agg(F.sum(size)).first()[0] or 0) <= max_bytes


def broadcast_if_fits(df: DataFrame, otherwise: str | None = None, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` to be broadcast if it takes at most ``max_bytes``, else with the hint ``otherwise``.

    For the small side of a join with triplets, whose size Spark would learn only after it has shuffled them.
    """
    if fits_bytes(df, max_bytes):
        return F.broadcast(df)
    return df.hint(otherwise) if otherwise else df
