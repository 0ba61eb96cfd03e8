"""Numeric functions that Spark lacks."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


@F.pandas_udf(DoubleType())
def normal_sf(z: pd.Series) -> pd.Series:
    """Upper tail of the standard normal distribution; null for null."""
    return z.map(lambda v: None if v is None or math.isnan(v) else 0.5 * math.erfc(v / math.sqrt(2)))


def standardized(value: Column, *partition: str, population: bool = False) -> Column:
    """(value - mean) / standard deviation within a partition; null where there is no spread."""
    w = Window.partitionBy(*partition)
    return F.try_divide(value - F.avg(value).over(w), (F.stddev_pop if population else F.stddev_samp)(value).over(w))


def clipped(value: Column, low: float, high: float) -> Column:
    """A value held between two bounds; null stays null."""
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def half_even(value: Column) -> Column:
    """Rounding to whole numbers, halves to the even one."""
    return F.rint(value)
