"""Cells painted as masks, and regions measured from label masks, as tables of pixels."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def disk_offsets(radius: int) -> list[tuple[int, int]]:
    """Pixels of a filled disk around the origin."""
    return [(dx, dy) for dx in range(-radius, radius + 1) for dy in range(-radius, radius + 1) if dx * dx + dy * dy <= radius * radius]


def ring_offsets(radius: int, points: int) -> list[tuple[int, int]]:
    """Pixels of a ring drawn at evenly spaced angles, truncated to whole pixels, with a diagonal through the centre."""
    ring = {(int(radius * math.cos(2 * math.pi * i / (points - 1))), int(radius * math.sin(2 * math.pi * i / (points - 1)))) for i in range(points)}
    return sorted(ring | {(i, i) for i in (-2, -1, 1, 2)})


def mask_pixels(cells: DataFrame, offsets: list[tuple[int, int]], by: list[str], width: int | None = None, height: int | None = None, min_cells: int = 2) -> DataFrame:
    """Distinct pixels ``*by, px, py`` covered by the cells of each group; positions are truncated to whole pixels.

    Pixels beyond ``width`` or ``height`` are held at the last one, those below zero are left out. Groups of fewer
    than ``min_cells`` cells are not painted. Pixels are made distinct within tasks before they move.
    """
    sizes = cells.groupBy(*by).agg(F.count(F.lit(1)).alias("cells")).where(F.col("cells") >= min_cells).drop("cells")
    at = cells.join(sizes, by, "left_semi").select(*by, F.col("x").cast("int").alias("cx"), F.col("y").cast("int").alias("cy"))
    o = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in offsets])).alias("o")
    p = at.select(*by, "cx", "cy", o).select(*by, (F.col("cx") + F.col("o.dx")).alias("px"), (F.col("cy") + F.col("o.dy")).alias("py"))
    if width is not None:
        p = p.withColumn("px", F.least("px", F.lit(width - 1)))
    if height is not None:
        p = p.withColumn("py", F.least("py", F.lit(height - 1)))
    return p.where((F.col("px") >= 0) & (F.col("py") >= 0)).distinct()


def region_properties(pixels: DataFrame, label: str, min_size: int = 1) -> DataFrame:
    """Centroid and area of each label of a mask ``label, px, py``; smaller objects than ``min_size`` go."""
    return pixels.groupBy(label).agg(F.avg("py").alias("y"), F.avg("px").alias("x"), F.count(F.lit(1)).alias("area")).where(F.col("area") >= min_size)


def paint_order(pixels: DataFrame, label: str = "label", area: str = "area") -> DataFrame:
    """One label per pixel where masks overlap: the smallest, as larger ones are painted first."""
    return pixels.groupBy("px", "py").agg(F.min_by(label, F.struct(F.col(area), F.col(label))).alias(label))


def crop_box(cells: DataFrame, by: list[str]) -> DataFrame:
    """Bounding box of each group; the upper bounds are exclusive."""
    return cells.groupBy(*by).agg(F.min("x").cast("int").alias("x0"), F.min("y").cast("int").alias("y0"), (F.max("x").cast("int") + 1).alias("x1"), (F.max("y").cast("int") + 1).alias("y1"))


def compression_factor(target: float, raw: float, masks: float) -> float:
    """By what factor both sides of an image shrink to reach a target size; 1 where none is needed."""
    return min(1.0, math.sqrt(target / (raw + masks)))
