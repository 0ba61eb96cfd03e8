"""Choosing rows and names: by exactly one pattern, by hash sample, by recoding, by first filled value."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def matches_one(label: Column, patterns: list[str]) -> Column:
    """Whether exactly one of the regular expressions is found in ``label``; false for null and without patterns."""
    hits = reduce(lambda n, p: n + F.coalesce(label.rlike(p), F.lit(False)).cast("int"), patterns, F.lit(0))
    return hits == 1


def recoded(name: Column, targets: list[str], other: str = "else") -> Column:
    """The last of ``targets`` that ``name`` contains, letter by letter, else ``other`` (null as well)."""
    return reduce(lambda out, t: F.when(name.contains(t), F.lit(t)).otherwise(out), targets, F.lit(other))


def sampled(rows: DataFrame, key: str, n: int, seed: int = 0, by: list[str] | None = None) -> DataFrame:
    """At most ``n`` rows (of each ``by``), those of smallest hash of ``key`` and seed, then of smallest key.

    The same rows whatever the partitioning; a sampling operator, so the limit is what it is for. Each task keeps its
    own first ``n`` before anything moves. Without ``by`` null keys may be drawn like others.
    """
    h = F.xxhash64(F.col(key), F.lit(seed))
    if not by:
        return rows.orderBy(h, F.col(key)).limit(n)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(h, F.col(key)))
    return rows.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def first_filled(rows: DataFrame, group: str, value: str, order: list[str]) -> DataFrame:
    """``group`` and its first ``value`` in ``order`` that is neither null nor blank, trimmed; groups without one go."""
    v = F.trim(F.col(value))
    return rows.where(F.coalesce(v != "", F.lit(False)) & F.col(group).isNotNull()).groupBy(group).agg(F.min_by(v, F.struct(*order, value)).alias(value))


def require_size(rows: DataFrame, min_rows: int, min_columns: int) -> DataFrame:
    """``rows`` as they are, or an error where they are too few or have too few columns."""
    if len(rows.columns) < min_columns:
        raise ValueError(f"{len(rows.columns)} columns, at least {min_columns} are needed")
    n = rows.limit(min_rows).count()
    if n < min_rows:
        raise ValueError(f"{n} rows, at least {min_rows} are needed")
    return rows
