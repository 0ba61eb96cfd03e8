"""Order over whole tables without one task that sees them all: sorted runs, order statistics, running sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.operators.proximity import finite
from tessella.session import broadcast_if_small, materialize


def sorted_runs(values: DataFrame, groups: list[str], value: str, partitions: int | None = None) -> DataFrame:
    """Distinct finite values in order: ``*groups, v, n, part, start``.

    Equal values of a group are counted before anything moves, so a value that a third of all rows have is one row.
    The rest is sorted over all tasks by group and value; ``start`` is how many values of its group stand before a
    row in its partition ``part``. Written once, as counting and finding both read it.
    """
    v = values.select(*groups, F.col(f"`{value}`").cast("double").alias("v")).where(finite("v"))
    counted = v.select(*groups, (F.col("v") + 0.0).alias("v")).groupBy(*groups, "v").agg(F.count(F.lit(1)).alias("n"))
    order = [*groups, "v"]
    placed = (counted.repartitionByRange(partitions, *order) if partitions else counted.repartitionByRange(*order)).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema) + ", start long"

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, sofar = None, 0
        for pdf in batches:
            if not len(pdf):
                continue
            new = np.zeros(len(pdf), dtype=bool)
            for g in groups:
                c = pdf[g]
                new[1:] |= ((c.values[1:] != c.values[:-1]) & ~(c.isna().values[1:] & c.isna().values[:-1])).astype(bool)
            first = tuple(None if pd.isna(x) else x for x in pdf[groups].iloc[0])
            new[0] = first != last
            before = np.concatenate([[0], np.cumsum(pdf.n.to_numpy())])
            at = np.flatnonzero(new)
            run = np.cumsum(new)
            base = np.concatenate([[-sofar], before[at]])[run]
            start = before[:-1] - base
            last, sofar = tuple(None if pd.isna(x) else x for x in pdf[groups].iloc[-1]), int(start[-1] + pdf.n.iloc[-1])
            yield pdf.assign(start=start)

    return materialize(placed.mapInPandas(number, schema), "sorted")


def order_statistics(runs: DataFrame, groups: list[str], ranks: Column) -> DataFrame:
    """The values at given ranks of each group: ``*groups, total, rank, v``; ``ranks`` is an array made of ``total``.

    Counts by partition give each group's offset in each partition, and so the partition and row of every rank; the
    sorted values are read once more and only rows that hold a rank leave it.
    """
    counts = runs.groupBy(*groups, "part").agg(F.sum("n").alias("here"))  # groups + partitions rows
    by = Window.partitionBy(*groups)
    counts = counts.withColumns({"total": F.sum("here").over(by), "offset": F.sum("here").over(by.orderBy("part")) - F.col("here")})
    wanted = counts.withColumn("rank", F.explode(F.array_distinct(ranks))).where((F.col("rank") >= F.col("offset")) & (F.col("rank") < F.col("offset") + F.col("here")))
    wanted = materialize(wanted.select(*groups, "part", "total", "rank", (F.col("rank") - F.col("offset")).alias("local")), "ranks")
    a, b = runs.alias("a"), broadcast_if_small(wanted).alias("b")
    same = F.col("a.part") == F.col("b.part")
    for g in groups:
        same = same & F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}"))
    holds = (F.col("b.local") >= F.col("a.start")) & (F.col("b.local") < F.col("a.start") + F.col("a.n"))
    return a.join(b, same & holds).select(*[F.col(f"b.{g}").alias(g) for g in groups], "b.total", "b.rank", "a.v")


def percentiles(values: DataFrame, groups: list[str], value: str, shares: list[float], partitions: int | None = None) -> DataFrame:
    """Exact percentiles of each group: ``*groups, n, share, value``, interpolated between neighbouring values.

    Null, NaN and infinite values do not count; a null group is a group; groups without finite values and empty
    tables give no rows; equal values and single values are no special case.
    """
    runs = sorted_runs(values, groups, value, partitions)
    place = F.transform(F.array(*[F.lit(float(s)) for s in shares]), lambda s: (F.col("total") - 1) * s)
    ranks = F.flatten(F.transform(place, lambda h: F.array(F.floor(h), F.ceil(h))))
    at = order_statistics(runs, groups, ranks)
    want = at.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
    h = (F.col("total") - 1) * F.col("share")
    want = want.where((F.col("rank") == F.floor(h)) | (F.col("rank") == F.ceil(h)))
    low, high = F.min("v"), F.max("v")
    found = want.groupBy(*groups, "total", "share").agg(low.alias("low"), high.alias("high"))
    return found.select(*groups, F.col("total").alias("n"), "share", (F.col("low") + (F.col("high") - F.col("low")) * (h - F.floor(h))).alias("value"))


def running_sums(rows: DataFrame, order: list[str | Column], sums: list[str]) -> DataFrame:
    """``rows`` with ``upto_<column>`` for each of ``sums``: its sum over this and all earlier rows in ``order``.

    Rows are sorted over all tasks; each adds up its own part, and the parts' totals (one row a task) are what stands
    before the next one. ``order`` must tell all rows apart. An empty table stays empty.
    """
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = materialize(rows.repartitionByRange(*by).withColumn("part", F.spark_partition_id()), "ordered")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("part").agg(*[F.sum(c).alias(f"upto_{c}") for c in sums])
    before = totals.select("part", *[F.coalesce(F.sum(f"upto_{c}").over(earlier), F.lit(0)).alias(f"before_{c}") for c in sums])
    own = Window.partitionBy("part").orderBy(*by)
    upto = {f"upto_{c}": F.col(f"before_{c}") + F.sum(c).over(own) for c in sums}
    return placed.join(F.broadcast(before), "part").withColumns(upto).select(*rows.columns, *upto)  # one row a task
