"""Level-1 aggregates: one value a pixel and day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_valid(band: str, time: str = "time") -> Column:
    """The earliest value that is not missing; of equally early ones the least."""
    held = F.col(band).isNotNull() & F.col(time).isNotNull()
    return F.min(F.when(held, F.struct(F.col(time).alias("t"), F.col(band).alias("v"))))["v"].alias(band)


def any_of(flag: str) -> Column:
    return F.coalesce(F.bool_or(F.col(flag)), F.lit(False)).alias(flag)


def mean_int(band: str) -> Column:
    """Mean of what is not missing, rounded down."""
    return F.floor(F.avg(F.col(band))).alias(band)


def mean(band: str) -> Column:
    return F.avg(F.col(band)).alias(band)
