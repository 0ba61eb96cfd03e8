"""Nearest neighbours of points on the plane, and graphs made of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.session import materialize

#: Points of a block, and the number of blocks up to which it stays so: beyond it blocks grow, so their list does not.
BLOCK, MOST_BLOCKS = 512, 1_000_000


def _spread_bits(c: Column) -> Column:
    """A number of 20 bits with a zero before every bit."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask))
    return c


def curve_place(x: Column, y: Column, box: dict[str, Column]) -> Column:
    """The place of a point on a Z-order curve through its group's bounding box."""

    def cell(v: Column, low: Column, high: Column) -> Column:
        return F.coalesce(F.least(F.floor(F.try_divide(v - low, high - low) * (1 << 20)), F.lit((1 << 20) - 1)), F.lit(0)).cast("bigint")

    return F.shiftleft(_spread_bits(cell(x, box["x0"], box["x1"])), 1).bitwiseOR(_spread_bits(cell(y, box["y0"], box["y1"])))


def closest(qx: np.ndarray, qy: np.ndarray, own: np.ndarray | None, x: np.ndarray, y: np.ndarray, keys: np.ndarray, k: int, most: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of the query, place of the point and distance of the ``k`` nearest points (ties by key), nearest first.

    ``own`` are the queries' places among the points, which do not count; ``most`` the farthest that counts.
    """
    rows, places, dist = [], [], []
    step = max(1, 1_000_000 // max(1, len(x)))
    for at in range(0, len(qx), step):
        dx, dy = qx[at : at + step, None] - x[None, :], qy[at : at + step, None] - y[None, :]
        d = np.sqrt(dx * dx + dy * dy)
        if own is not None:
            d[np.arange(len(d)), own[at : at + step]] = np.inf
        limit = np.partition(d, k - 1, axis=1)[:, k - 1] if len(x) > k else np.full(len(d), np.finfo(float).max)
        if most is not None:
            limit = np.minimum(limit, most[at : at + step])
        r, c = np.nonzero(d <= np.minimum(limit, np.finfo(float).max)[:, None])
        rows.append(r + at), places.append(c), dist.append(d[r, c])
    rows, places, dist = np.concatenate(rows), np.concatenate(places), np.concatenate(dist)
    order = np.lexsort((keys[places], dist, rows))
    rows, places, dist = rows[order], places[order], dist[order]
    start = np.searchsorted(rows, rows)
    first = np.arange(len(rows)) - start < k
    return rows[first], places[first], dist[first]


def _lists(n: int, rows: np.ndarray, values: np.ndarray) -> pd.Series:
    """The values of rows 0, 1, ..., ``n`` - 1, each an array."""
    return pd.Series(np.split(values, np.searchsorted(rows, np.arange(1, n))) if n else [], dtype=object)


def nearest(points: DataFrame, k: int, with_self: bool = False, block: int = BLOCK) -> DataFrame:
    """The ``k`` nearest points of the same group for every point: ``g, src, dst, d, rank`` (ties by ``dst``).

    ``points`` has ``g, k, x, y`` with unique keys and finite positions; a group of fewer points gives all others.
    Points are sorted over all tasks along a curve and cut into blocks of equal size, so neither a dense area nor a
    group of a third of all rows is one task's work. A point's neighbours within its block bound how far the true
    ones can lie; it asks just the blocks whose bounding box is that near, and most points ask none. Of blocks that are
    one position, as copies make them, only the first is asked. Only the bounding boxes of blocks are broadcast.
    """
    kind, group = points.schema["k"].dataType.simpleString(), points.schema["g"].dataType.simpleString()
    spark = points.sparkSession
    points = materialize(points.select("g", "k", "x", "y"), "points")  # read three times
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    box = points.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    placed = points.join(box, "g").select("g", "k", "x", "y", "n", curve_place(F.col("x"), F.col("y"), {c: F.col(c) for c in ("x0", "x1", "y0", "y1")}).alias("z"))
    placed = placed.repartitionByRange(tasks, "g", "z", "k").sortWithinPartitions("g", "z", "k").withColumn("part", F.spark_partition_id())
    every = max(block, 1 + points.count() // MOST_BLOCKS)

    def cut(pdf: pd.DataFrame, number: int) -> pd.DataFrame:
        x, y, keys = pdf.x.to_numpy(), pdf.y.to_numpy(), pdf.k.to_numpy()
        r, c, d = closest(x, y, None if with_self else np.arange(len(x)), x, y, keys, k)
        name = (int(pdf.part.iloc[0]) << 32) + number
        return pdf[["g", "k", "x", "y", "n"]].assign(block=name, dst=_lists(len(x), r, keys[c]).values, d=_lists(len(x), r, d).values)

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept, number = None, 0
        for pdf in batches:
            pdf = pdf if kept is None else pd.concat([kept, pdf], ignore_index=True)
            ends = np.flatnonzero((pdf.g.to_numpy()[1:] != pdf.g.to_numpy()[:-1])) + 1
            start = 0
            for end in [*ends, len(pdf)]:
                while end - start >= every or (end < len(pdf) and end > start):
                    upto = min(end, start + every)
                    yield cut(pdf.iloc[start:upto], number)
                    start, number = upto, number + 1
            kept = pdf.iloc[start:]
        if kept is not None and len(kept):
            yield cut(kept, number)

    base = materialize(placed.mapInPandas(blocks, f"g {group}, k {kind}, x double, y double, n bigint, block bigint, dst array<{kind}>, d array<double>"), "blocks")
    boxes = base.groupBy("g", "block").agg(F.count(F.lit(1)).alias("held"), F.first("n").alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.min("k").alias("first"))
    boxes = boxes.where("held < n").drop("n").toPandas()  # at most MOST_BLOCKS and one for each task
    shared = spark.sparkContext.broadcast({g: b.sort_values("first") for g, b in boxes.groupby("g")})

    def others(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf, to = pdf.reset_index(drop=True), [[] for _ in range(len(pdf))]
            reach = np.full(len(pdf), np.inf)
            for (g, own), at in pdf.groupby(["g", "block"]).indices.items():
                b = shared.value.get(g)
                if b is None:
                    continue
                x, y = pdf.x.to_numpy()[at], pdf.y.to_numpy()[at]
                far = np.array([v[-1] if len(v) >= k else np.inf for v in pdf.d.iloc[at]])
                # Points that lie far off have a wide reach: each kind is held against the boxes near enough for it.
                usual = 4 * np.median(far)
                for some in (np.flatnonzero(far <= usual), np.flatnonzero(~(far <= usual))):
                    for i in np.array_split(some, max(1, len(some) * len(b) // 4_000_000)):
                        if not len(i):
                            continue
                        c = b[(b.x0 <= (x[i] + far[i]).max()) & (b.x1 >= (x[i] - far[i]).min()) & (b.y0 <= (y[i] + far[i]).max()) & (b.y1 >= (y[i] - far[i]).min())]
                        px, py, cx0, cx1, cy0, cy1 = x[i, None], y[i, None], *(c[v].to_numpy()[None, :] for v in ("x0", "x1", "y0", "y1"))
                        dx, dy = np.maximum(np.maximum(cx0 - px, px - cx1), 0), np.maximum(np.maximum(cy0 - py, py - cy1), 0)
                        low = np.sqrt(dx * dx + dy * dy) * (1 - 1e-12)
                        ex, ey = np.maximum(np.abs(px - cx0), np.abs(px - cx1)), np.maximum(np.abs(py - cy0), np.abs(py - cy1))
                        high = np.where(c.held.to_numpy()[None, :] > k, np.sqrt(ex * ex + ey * ey) * (1 + 1e-12), np.inf)
                        reach[at[i]] = np.minimum(far[i], high.min(axis=1, initial=np.inf))
                        near = (low <= reach[at[i], None]) & (c.block.to_numpy() != own)[None, :]
                        same = near & (high == 0)
                        near &= ~same | (np.cumsum(same, axis=1) == 1)
                        for row, col in zip(*np.nonzero(near)):
                            to[at[i[row]]].append(int(c.block.iloc[col]))
            yield pdf[["k", "dst", "d", "g", "x", "y"]].assign(reach=reach, to=pd.Series(to, dtype=object))

    asked = materialize(base.select("g", "k", "x", "y", "block", "dst", "d").mapInPandas(others, f"k {kind}, dst array<{kind}>, d array<double>, g {group}, x double, y double, reach double, to array<bigint>"), "asked")
    queries = asked.where(F.size("to") > 0).select(F.explode("to").alias("block"), F.col("k").alias("src"), F.col("x").alias("qx"), F.col("y").alias("qy"), "reach")

    def answer(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        keys = held.k.to_numpy()
        r, c, d = closest(asking.qx.to_numpy(), asking.qy.to_numpy(), None, held.x.to_numpy(), held.y.to_numpy(), keys, k, asking.reach.to_numpy()) if len(asking) and len(held) else (np.zeros(0, int),) * 3
        some = np.unique(r)
        of = np.searchsorted(some, r)
        return pd.DataFrame({"k": asking.src.to_numpy()[some], "dst": _lists(len(some), of, keys[c]), "d": _lists(len(some), of, d)})

    near = queries.groupBy("block").cogroup(base.select("block", "k", "x", "y").groupBy("block")).applyInPandas(answer, f"k {kind}, dst array<{kind}>, d array<double>")
    found = F.arrays_zip("d", "dst")
    more = asked.where(F.size("to") > 0).select("k", "g", found.alias("near")).unionByName(near.select("k", F.lit(None).cast(group).alias("g"), found.alias("near")))
    merged = more.groupBy("k").agg(F.max("g").alias("g"), F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near"))  # k from each block asked
    every_list = asked.where(F.size("to") == 0).select("k", "g", found.alias("near")).unionByName(merged.select("k", "g", "near"))
    return every_list.select("g", F.col("k").alias("src"), F.posexplode("near").alias("at", "near")).select("g", "src", "near.dst", "near.d", (F.col("at") + 1).alias("rank"))


def shared_neighbour_edges(edges: DataFrame, k: int, symmetric: bool = False) -> DataFrame:
    """Edges weighted by the share of neighbours both ends have in common: ``g, src, dst, weight`` (above zero).

    Keeps an edge from the smaller key only, as a directed graph read in one direction does; ``symmetric`` also keeps
    those that just the larger key lists, each pair once.
    """
    lists = edges.groupBy("g", "src").agg(F.collect_set("dst").alias("nb"))  # k keys each
    pairs = edges.where(F.col("dst") > F.col("src")).select("g", "src", "dst")
    if symmetric:
        pairs = pairs.union(edges.where(F.col("dst") < F.col("src")).select("g", F.col("dst"), F.col("src"))).toDF("g", "src", "dst").distinct()
    both = pairs.join(lists, ["g", "src"]).join(lists.select("g", F.col("src").alias("dst"), F.col("nb").alias("nb2")), ["g", "dst"])
    weight = F.size(F.array_intersect("nb", "nb2")) / F.lit(float(k))
    return both.select("g", "src", "dst", weight.alias("weight")).where(F.col("weight") > 0)
