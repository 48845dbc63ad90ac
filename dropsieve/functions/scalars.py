"""Scalar column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SAMPLE = "sample_id"
CELL = [SAMPLE, "barcode"]


def clean_barcode(c) -> Column:
    """Barcode without everything from its first ``-`` on."""
    return F.substring_index(c, "-", 1)


def ratio(num, den) -> Column:
    """``num / den`` as a double, NULL when the divisor is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def percent(num, den) -> Column:
    """``100 * num / den``, NULL when the divisor is 0 or NULL."""
    return F.try_divide(F.lit(100.0) * num.cast("double"), den.cast("double"))


def peak_name(chrom, start, end) -> Column:
    return F.concat(chrom, F.lit(":"), start.cast("string"), F.lit("-"), end.cast("string"))


def split_peak_name(name) -> list[Column]:
    """``chrom:start-end`` as the three columns chrom, start, end."""
    span = F.split(F.substring_index(name, ":", -1), "-")
    return [
        F.substring_index(name, ":", 1).alias("chrom"),
        F.element_at(span, 1).cast("bigint").alias("start"),
        F.element_at(span, 2).cast("bigint").alias("end"),
    ]


def with_thousands(c, digits: int = 0) -> Column:
    """Number as text with a comma every three digits."""
    return F.format_number(F.bround(c.cast("double"), digits), digits)


def percent_text(c, signed: bool = False) -> Column:
    return F.format_string("%+.2f%%" if signed else "%.2f%%", c.cast("double"))


def plain_number(c, digits: int) -> Column:
    """Rounded number as text without trailing ``.0``."""
    return F.regexp_replace(F.bround(c.cast("double"), digits).cast("string"), r"\.0$", "")


def mean_sd_text(mean, sd, digits: int) -> Column:
    if digits == 0:
        return F.concat_ws(" ± ", with_thousands(mean), with_thousands(sd))
    return F.concat_ws(" ± ", plain_number(mean, digits), plain_number(sd, digits))


def present(df, names) -> list[str]:
    """The subset of ``names`` that ``df`` has, in the given order."""
    have = set(df.columns)
    return [n for n in names if n in have]
