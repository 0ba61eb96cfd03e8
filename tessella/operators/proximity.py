"""Points near other points, and points inside regions, as equi-joins on grid cells."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.session import materialize


def finite(c: Column | str) -> Column:
    """True where a double is neither null, NaN nor infinite."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.abs(c) < float("inf"), F.lit(False))


def in_cells(points: DataFrame, radius: float, keep: list[str], cell_factor: float = 4.0) -> DataFrame:
    """``g, k, x, y``, ``keep`` and ``cx, cy, copy``: each point in its own grid cell, and copies in those before it within ``radius``."""
    side = float(cell_factor * radius)
    p = points.select("g", "k", "x", "y", *keep).withColumns({"cx": F.floor(F.col("x") / side), "cy": F.floor(F.col("y") / side)})
    # Slightly wider than the radius: rounding must not lose a copy; the join tests the distance itself.
    reach = radius * (1 + 1e-9) + 1e-9
    left = F.col("x") - F.col("cx") * side <= reach
    low = F.col("y") - F.col("cy") * side <= reach
    high = (F.col("cy") + 1) * side - F.col("y") <= reach

    def to(dx: int, dy: int, copy: int) -> Column:
        return F.struct((F.col("cx") + dx).alias("cx"), (F.col("cy") + dy).alias("cy"), F.lit(copy).cast("byte").alias("copy"))

    places = F.filter(
        F.array(to(0, 0, 0), F.when(left, to(-1, 0, 1)), F.when(low, to(0, -1, 1)), F.when(left & low, to(-1, -1, 1)), F.when(left & high, to(-1, 1, 1))),
        lambda c: c.isNotNull(),
    )
    return p.select("g", "k", "x", "y", *keep, F.explode(places).alias("c")).select("g", "k", "x", "y", *keep, "c.cx", "c.cy", "c.copy")


def pairs_within(points: DataFrame, radius: float, keep: list[str] | None = None, above: float | None = None, cell_factor: float = 4.0) -> DataFrame:
    """Pairs of points of one group at most ``radius`` apart, each once: ``k_1, k_2, d`` and both sides' ``keep``.

    ``points`` has ``g, k, x, y`` and the columns ``keep``, without nulls in the first four and with finite
    positions. With ``above``, only distances strictly between ``above`` and ``radius`` count. Every point goes to its
    own grid cell (side ``cell_factor * radius``) and, if it lies within ``radius`` of the border, as a copy to the
    cells before it, so each pair meets in exactly one cell: that of its earlier member. Own points and copies are one
    shuffle, which both sides of the self-join read. Which end is ``_1`` is not defined; repeated rows count once.
    """
    keep = keep or []
    placed = in_cells(points, radius, keep, cell_factor)
    # Partitioned by cell once; dropping repeated rows needs no further shuffle, and both sides reuse the exchange.
    placed = placed.repartition("g", "cx", "cy").dropDuplicates(["g", "cx", "cy", "k", "x", "y", "copy"])
    a, b = placed.alias("a"), placed.alias("b")
    # One expression over both sides, so that no part of it is pushed below the shared exchange.
    own_first = F.col("a.copy") + (1 - F.col("b.copy")) * (F.col("a.k") >= F.col("b.k")).cast("int") == 0
    d = F.sqrt((F.col("a.x") - F.col("b.x")) * (F.col("a.x") - F.col("b.x")) + (F.col("a.y") - F.col("b.y")) * (F.col("a.y") - F.col("b.y")))
    close = d <= radius if above is None else (d < radius) & (d > above)
    same = (F.col("a.g") == F.col("b.g")) & (F.col("a.cx") == F.col("b.cx")) & (F.col("a.cy") == F.col("b.cy"))
    pairs = a.join(b, same & own_first & close & (F.col("a.k") != F.col("b.k")))
    return pairs.select(F.col("a.g").alias("g"), F.col("a.k").alias("k_1"), F.col("b.k").alias("k_2"), d.alias("d"), *[F.col(f"a.{c}").alias(f"{c}_1") for c in keep], *[F.col(f"b.{c}").alias(f"{c}_2") for c in keep])


def located(points: DataFrame, key: str, x: str, y: str, group: str, keep: dict[str, str] | None = None) -> DataFrame:
    """``g, k, x, y`` and renamed ``keep`` columns of the rows with a key, a group and a finite position."""
    named = [F.col(f"`{c}`").alias(n) for n, c in (keep or {}).items()]
    p = points.select(F.col(f"`{group}`").alias("g"), F.col(f"`{key}`").alias("k"), F.col(f"`{x}`").cast("double").alias("x"), F.col(f"`{y}`").cast("double").alias("y"), *named)
    return p.where(F.col("g").isNotNull() & F.col("k").isNotNull() & finite("x") & finite("y"))


def near_pairs(points: DataFrame, key: str, x: str, y: str, group: str, radius: float) -> DataFrame:
    """Pairs of different points of one group whose positions are at most ``radius`` apart: ``key_1 < key_2``.

    Rows with a null key or group, or a null or non-finite position, take no part. Repeated rows count once; a key
    with several positions pairs by any of them, and may then give a pair more than once per pair of positions.
    Other columns are ignored, whatever their names; an empty table gives no pairs.
    """
    pairs = pairs_within(located(points, key, x, y, group), radius)
    return pairs.select(F.least("k_1", "k_2").alias("key_1"), F.greatest("k_1", "k_2").alias("key_2"))


def _cross(x0: float, y0: float, x1: float, y1: float, e: np.ndarray) -> bool:
    """Whether any edge (rows x1, y1, x2, y2) touches the rectangle; may say yes without need, never no."""
    m = (np.maximum(e[:, 0], e[:, 2]) >= x0) & (np.minimum(e[:, 0], e[:, 2]) <= x1) & (np.maximum(e[:, 1], e[:, 3]) >= y0) & (np.minimum(e[:, 1], e[:, 3]) <= y1)
    if not m.any():
        return False
    e = e[m]
    dx, dy = e[:, 2] - e[:, 0], e[:, 3] - e[:, 1]
    side = [dx * (cy - e[:, 1]) - dy * (cx - e[:, 0]) for cx in (x0, x1) for cy in (y0, y1)]
    eps = 1e-9 * (np.abs(dx) + np.abs(dy) + 1)
    return bool(((np.max(side, axis=0) >= -eps) & (np.min(side, axis=0) <= eps)).any())


def _inside(px: float, py: float, e: np.ndarray) -> bool:
    up = (e[:, 1] > py) != (e[:, 3] > py)
    e = e[up]
    return bool(np.sum(px < (e[:, 2] - e[:, 0]) * (py - e[:, 1]) / (e[:, 3] - e[:, 1]) + e[:, 0]) % 2) if len(e) else False


def cover_outline(xs: np.ndarray, ys: np.ndarray, depth: int = 4) -> list[tuple[int, int, int, bool]]:
    """Cells ``(level, cx, cy, interior)`` of side ``2**level`` that together hold an outline.

    Starts from the cells at least as large as the bounding box; cells that an edge crosses are split ``depth``
    times, others are kept whole if inside and left out if outside.
    """
    e = np.column_stack([xs, ys, np.roll(xs, -1), np.roll(ys, -1)])
    extent = max(xs.max() - xs.min(), ys.max() - ys.min())
    if not extent > 0:
        return []
    top = math.ceil(math.log2(extent))
    s = 2.0**top
    out, todo = [], [(top, cx, cy) for cx in range(math.floor(xs.min() / s), math.floor(xs.max() / s) + 1) for cy in range(math.floor(ys.min() / s), math.floor(ys.max() / s) + 1)]
    while todo:
        level, cx, cy = todo.pop()
        s = 2.0**level
        if _cross(cx * s, cy * s, (cx + 1) * s, (cy + 1) * s, e):
            if level > top - depth:
                todo += [(level - 1, 2 * cx + i, 2 * cy + j) for i in (0, 1) for j in (0, 1)]
            else:
                out.append((level, cx, cy, False))
        elif _inside((cx + 0.5) * s, (cy + 0.5) * s, e):
            out.append((level, cx, cy, True))
    return out


def region_cover(regions: DataFrame, key: str, group: str, vertices: str, depth: int = 4) -> DataFrame:
    """Adaptive coverage of each region: ``r, g, level, cx, cy, interior, edges`` (edges only for boundary cells).

    Regions with a null key, group or outline, fewer than three corners or a null or non-finite corner hold nothing.
    """
    v = F.col("v")
    corner = regions.select(F.col(f"`{key}`").alias("r"), F.col(f"`{group}`").alias("g"), F.col(f"`{vertices}`").alias("v")).where(
        F.col("r").isNotNull() & F.col("g").isNotNull() & (F.size(v) >= 3) & F.forall(v, lambda p: finite(p["x"]) & finite(p["y"]))
    )
    schema = f"r {corner.schema['r'].dataType.simpleString()}, g {corner.schema['g'].dataType.simpleString()}, level int, cx bigint, cy bigint, interior boolean, edges array<struct<x1:double,y1:double,x2:double,y2:double>>"

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r, g, outline in zip(pdf.r, pdf.g, pdf.v):
                xs, ys = np.array([p["x"] for p in outline], float), np.array([p["y"] for p in outline], float)
                edges = [(a, b, c, d) for a, b, c, d in zip(xs, ys, np.roll(xs, -1), np.roll(ys, -1)) if b != d]
                for level, cx, cy, inside in cover_outline(xs, ys, depth):
                    x0, y0, y1 = cx * 2.0**level, cy * 2.0**level, (cy + 1) * 2.0**level
                    # Of a boundary cell's test, only edges count that a ray to the right from the cell may meet.
                    met = [dict(zip(("x1", "y1", "x2", "y2"), e)) for e in edges if max(e[0], e[2]) >= x0 and max(e[1], e[3]) >= y0 and min(e[1], e[3]) <= y1]
                    rows.append((r, g, level, cx, cy, inside, None if inside else met))
            yield pd.DataFrame(rows, columns=["r", "g", "level", "cx", "cy", "interior", "edges"])

    # Outlines are few but take long: a small file must not leave them to one task.
    return corner.repartition(regions.sparkSession.sparkContext.defaultParallelism, "r").mapInPandas(cells, schema)


def points_in_regions(points: DataFrame, key: str, x: str, y: str, regions: DataFrame, region_key: str, group: str, vertices: str = "vertices", depth: int = 4, broadcast_rows: int = 200_000) -> DataFrame:
    """Each region with the points of its group that lie inside its outline (even-odd rule).

    Points join the coverage on (group, level, cell): cells wholly inside accept at once, only matches of boundary
    cells take the exact containment test. The coverage is broadcast if it has at most ``broadcast_rows`` rows, else
    both sides are shuffled. Points with a null key, group or position or a non-finite position take no part;
    repeated rows count once; other columns are ignored. Returns ``region, point``.
    """
    cover = materialize(region_cover(regions, region_key, group, vertices, depth), "cover")
    stats = cover.groupBy("level").count().collect()  # one row per power of two: a few
    levels = sorted(r["level"] for r in stats)
    p = located(points, key, x, y, group)
    side = F.pow(F.lit(2.0), F.col("level"))
    p = p.select("*", F.explode(F.array(*[F.lit(v) for v in levels]).cast("array<int>")).alias("level"))
    p = p.withColumns({"cx": F.floor(F.col("x") / side), "cy": F.floor(F.col("y") / side)})
    if sum(r["count"] for r in stats) <= broadcast_rows:
        cover = F.broadcast(cover)
    crossings = F.aggregate(
        "edges",
        F.lit(0),
        lambda n, e: n
        + F.when(
            ((e["y1"] > F.col("y")) != (e["y2"] > F.col("y"))) & (F.col("x") < (e["x2"] - e["x1"]) * (F.col("y") - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]),
            1,
        ).otherwise(0),
    )
    hit = p.join(cover, ["g", "level", "cx", "cy"]).where(F.col("interior") | (F.pmod(crossings, F.lit(2)) == 1))
    return hit.select(F.col("r").alias("region"), F.col("k").alias("point")).distinct()
