"""Overlap join of genomic intervals on a hierarchy of bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dropsieve.functions.sizing import MAX_BROADCAST_BYTES, fits_bytes

# A level's bins are this many times as wide as those of the level below.
FAN = 8
LEVELS = 12


def _level(start: Column, end: Column, width: int) -> Column:
    """The first level whose bins are no shorter than the interval."""
    size = F.greatest(end - start, F.lit(1))
    return sum((F.when(size > width * FAN**i, 1).otherwise(0) for i in range(LEVELS - 1)), F.lit(0))


def _width(level: Column, width: int) -> Column:
    return (F.lit(width) * F.pow(F.lit(float(FAN)), level)).cast("bigint")


def _bins(start: Column, end: Column, width: Column) -> Column:
    """At most two bins of a level no lower than the interval's own."""
    last = F.greatest(end - 1, start)
    return F.explode(F.sequence(F.floor(start / width), F.floor(last / width)))


def _indexed(df: DataFrame, start: str, end: str, width: int, levels: list[int]) -> DataFrame:
    """``df`` with its level ``_own`` and one row per bin it touches at this and every higher one of ``levels``."""
    a, b = F.col(start), F.col(end)
    own = df.withColumn("_own", _level(a, b, width))
    at = F.array(*(F.lit(x) for x in levels))
    higher = own.withColumn("_level", F.explode(F.filter(at, lambda x: x >= F.col("_own"))))
    return higher.withColumn("_bin", _bins(a, b, _width(F.col("_level"), width)))


def binned_overlap(
    left: DataFrame,
    right: DataFrame,
    width: int,
    salts: int = 32,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """All overlapping pairs of half-open intervals on the same ``chrom``, and equal in ``by``.

    ``left`` has ``chrom, start, end`` and any other columns, ``right`` has ``chrom, r_start, r_end``
    and others. An interval lies in the lowest level whose bins are as long as itself, from ``width``
    on, so it touches two bins at most. Two intervals are compared at the level of the longer one, in
    the bin that holds the larger of their starts: each pair comes out once, and an interval of any
    length makes at most two rows for each level that occurs.

    The indexed right side is broadcast if its measured bytes are within bounds, and the left side is
    not shuffled at all. A larger one is shuffled; then a bin with very many left rows is spread over
    ``salts`` tasks by a hash of the row.
    """
    keys = ["chrom", *by]
    found = left.select(_level(F.col("start"), F.col("end"), width).alias("l")).distinct()
    other = right.select(_level(F.col("r_start"), F.col("r_end"), width).alias("l")).distinct()
    # At most LEVELS numbers a side.
    levels = [sorted(r["l"] for r in x.collect()) for x in (found, other)]
    every = sorted({*levels[0], *levels[1]})
    lb = _indexed(left, "start", "end", width, every)
    rb = _indexed(right, "r_start", "r_end", width, every).withColumnRenamed("_own", "_r_own")
    keys += ["_level", "_bin"]
    if fits_bytes(rb, max_broadcast_bytes):
        rb = F.broadcast(rb)
    else:
        lb = lb.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
        rb = rb.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        keys.append("_salt")
    meets = (F.col("start") < F.col("r_end")) & (F.col("r_start") < F.col("end"))
    home = F.floor(F.greatest("start", "r_start") / _width(F.col("_level"), width))
    once = (F.col("_level") == F.greatest("_own", "_r_own")) & (F.col("_bin") == home)
    return lb.join(rb, keys).where(meets & once).drop("_level", "_bin", "_own", "_r_own", "_salt")


def steps(windows: DataFrame, names: tuple[str, ...], by: tuple[str, ...] = ()) -> DataFrame:
    """Disjoint intervals ``r_start, r_end`` with the number of windows of each kind over them.

    ``windows`` has ``chrom, r_start, r_end, kind``, ``kind`` one of ``names``, and the columns in
    ``by``. A sweep over the ends of windows: +1 where one opens, -1 where it closes, summed up along
    the chromosome. However many windows overlap, a position lies in one step only. Steps without a
    window are left out.
    """
    keys = ["chrom", *by]
    ends = windows.select(
        *keys,
        "kind",
        F.inline(
            F.array(
                F.struct(F.col("r_start").alias("pos"), F.lit(1).alias("d")),
                F.struct(F.col("r_end").alias("pos"), F.lit(-1).alias("d")),
            )
        ),
    )
    change = ends.groupBy(*keys, "pos").agg(*(F.sum(F.when(F.col("kind") == n, F.col("d")).otherwise(0)).alias(n) for n in names))
    along = Window.partitionBy(*keys).orderBy("pos")
    out = change.select(
        *keys,
        F.col("pos").alias("r_start"),
        F.lead("pos").over(along).alias("r_end"),
        *(F.sum(n).over(along).alias(n) for n in names),
    )
    return out.where("r_end IS NOT NULL AND " + "(" + " OR ".join(f"{n} > 0" for n in names) + ")")
