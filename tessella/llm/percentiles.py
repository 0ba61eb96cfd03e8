"""Percentiles of very large numeric columns by a distributed sort, exact or from summaries that combine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.operators.order import order_statistics, percentiles, sorted_runs  # noqa: F401
from tessella.session import broadcast_if_small, materialize


def once(rows: DataFrame, key: str, most_bytes: int = 32 << 20) -> DataFrame:
    """Rows without repetitions of a key, moving little more than the repeated ones: of those, the smallest row is kept.

    The repeated keys are broadcast up to ``most_bytes``, beyond which rows are shuffled to meet them.
    """
    again = materialize(rows.groupBy(key).count().where("count > 1").select(key), "again")
    rest = [c for c in rows.columns if c != key]
    smallest = lambda df: df.groupBy(key).agg(F.min(F.struct(*rest)).alias("r")).select(key, "r.*")
    if again.isEmpty():
        return rows
    again = broadcast_if_small(again, most_bytes)
    return rows.join(again, key, "left_anti").unionByName(smallest(rows.join(again, key, "left_semi")))


def summaries(values: DataFrame, groups: list[str], part: str, value: str, points: int = 200) -> DataFrame:
    """A summary of bounded size for each group and part (a day, say): ``*groups, part, n, rank, v``.

    Holds the exact values at ``points + 1`` evenly spaced ranks, fewer where there are fewer values.
    """
    runs = sorted_runs(values, [*groups, part], value)
    ranks = F.transform(F.sequence(F.lit(0), F.lit(points)), lambda i: F.floor((F.col("total") - 1) * i / points))
    return order_statistics(runs, [*groups, part], ranks).withColumnRenamed("total", "n")


def combine(summary: DataFrame, groups: list[str], part: str, shares: list[float], points: int = 200) -> DataFrame:
    """Percentiles of all parts together from their summaries: ``*groups, n, share, value, rank_error``.

    Between two neighbouring points of a part lie at most n / points of its values, so a value of the combined
    result is at most ``rank_error`` = 1 / points of all values (and one per part) away from the rank asked for.
    Summaries of some parts can be kept and combined with later ones.
    """
    by = Window.partitionBy(*groups, part).orderBy("rank")
    # Each point stands for the values after the point before it, up to itself.
    weighed = summary.withColumn("weight", F.col("rank") - F.coalesce(F.lag("rank").over(by), F.lit(-1)))
    total = F.sum("weight").over(Window.partitionBy(*groups))
    upto = F.sum("weight").over(Window.partitionBy(*groups).orderBy("v", part, "rank"))
    parts = F.size(F.collect_set(part).over(Window.partitionBy(*groups)))
    ranked = weighed.withColumns({"total": total, "upto": upto, "parts": parts})
    asked = ranked.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares]))).where(F.col("upto") >= F.col("share") * F.col("total"))
    found = asked.groupBy(*groups, "total", "parts", "share").agg(F.min("v").alias("value"))
    return found.select(*groups, F.col("total").alias("n"), "share", "value", (F.lit(1.0 / points) + F.col("parts") / F.col("total")).alias("rank_error"))


def cluster_name(c: Column) -> Column:
    """A cluster's name in its usual spelling (``C1``, ``c01`` and ``C01`` are one); null where it is missing."""
    digits = F.regexp_extract(c, r"(?i)^\s*c\s*0*(\d+)\s*$", 1)
    return F.when(digits != "", F.concat(F.lit("C"), F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits)))


def marker_values(vectors: DataFrame, cells: DataFrame, features: DataFrame, key: str = "cell_key") -> DataFrame:
    """``cluster, position, run_day, v``: the values of every cell whose cluster is known, one row per marker."""
    of = cells.select(key, cluster_name(F.col("cluster")).alias("cluster")).where(F.col("cluster").isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.min("cluster").alias("cluster"))
    of = materialize(of, "clusters")
    e = once(vectors.select(key, "exprs", "run_day").where(F.col("exprs").isNotNull() & F.col(key).isNotNull()), key)
    joined = e.join(broadcast_if_small(of), key)
    return joined.select("cluster", "run_day", F.posexplode("exprs").alias("position", "v")).where(F.col("v").isNotNull())
