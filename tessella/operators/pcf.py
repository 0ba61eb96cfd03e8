"""Inhomogeneous pair-correlation curves between types of cells, from one search for pairs per sample."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.operators.proximity import in_cells, pairs_within
from tessella.session import broadcast_if_small, materialize

GRID = 32
#: Distances measured at a time.
AT_A_TIME = 1_000_000


def windows(cells: DataFrame) -> DataFrame:
    """The rectangle around each sample's cells, one unit wider on every side."""
    return cells.groupBy("g").agg((F.min("x") - 1).alias("x0"), (F.max("x") + 1).alias("x1"), (F.min("y") - 1).alias("y0"), (F.max("y") + 1).alias("y1"))


def circle_inside(x: np.ndarray, y: np.ndarray, d: np.ndarray, box: tuple[float, float, float, float]) -> np.ndarray:
    """The share of a circle of radius ``d`` around a point that lies inside the window ``x0, x1, y0, y1``."""
    x0, x1, y0, y1 = box
    out = np.ones(len(d))
    some = np.flatnonzero(np.minimum(np.minimum(x - x0, x1 - x), np.minimum(y - y0, y1 - y)) < d)  # circles that cross the border
    x, y, d = x[some], y[some], d[some]
    sides = [x - x0, y1 - y, x1 - x, y - y0]
    half = [np.where(s < d, np.arccos(np.minimum(1.0, s / d)), 0.0) for s in sides]
    off = sum(np.where(sides[i] ** 2 + sides[(i + 1) % 4] ** 2 < d * d, math.pi / 2, half[i] + half[(i + 1) % 4]) for i in range(4))
    out[some] = np.maximum(0.05, 1 - off / (2 * math.pi))
    return out


def intensities(cells: DataFrame, box: DataFrame) -> DataFrame:
    """Kernel intensities where each type has cells: ``g, celltype, bx, by, n, lam, lam_all``, with rows of ``All`` types.

    A Gaussian kernel of an eighth of the window's shorter side over counts on a 32 x 32 grid, one axis after the
    other, divided by the kernel's mass inside the window; a cell takes its grid cell's value, of its own type and of all.
    """
    n = on_grid(cells, box).groupBy("g", "celltype", "bx", "by", "w", "h", "s").agg(F.count(F.lit(1)).alias("n"))
    grids = n.groupBy("g", "w", "h", "s").agg(*[F.collect_list(c).alias(c) for c in ("celltype", "bx", "by", "n")])  # at most 32 x 32 entries for each type
    kind = cells.schema["g"].dataType.simpleString()

    def smooth(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        apart = np.arange(GRID)[:, None] - np.arange(GRID)[None, :]
        for pdf in batches:
            for r in pdf.itertuples():
                across, up = np.exp(-0.5 * (apart * r.w / r.s) ** 2), np.exp(-0.5 * (apart * r.h / r.s) ** 2)
                mass = across.sum(1)[:, None] * up.sum(1)[None, :] * r.w * r.h
                bx, by, count, (names, of) = np.asarray(r.bx, int), np.asarray(r.by, int), np.asarray(r.n, int), np.unique(r.celltype, return_inverse=True)
                total = np.zeros((GRID, GRID))
                np.add.at(total, (bx, by), count)
                lam_all, out = (across @ total @ up) / mass, []
                for i, name in enumerate(names):
                    grid, at = np.zeros((GRID, GRID)), of == i
                    grid[bx[at], by[at]] = count[at]
                    out.append(pd.DataFrame({"celltype": name, "bx": bx[at], "by": by[at], "n": count[at], "lam": ((across @ grid @ up) / mass)[bx[at], by[at]]}))
                tx, ty = np.nonzero(total)
                out.append(pd.DataFrame({"celltype": "All", "bx": tx, "by": ty, "n": total[tx, ty].astype(int), "lam": lam_all[tx, ty]}))
                whole = pd.concat([x for x, name in zip(out, [*names, ""]) if name != "All"], ignore_index=True)
                yield whole.assign(g=r.g, lam_all=lam_all[whole.bx, whole.by])[["g", "celltype", "bx", "by", "n", "lam", "lam_all"]]

    return materialize(grids.mapInPandas(smooth, f"g {kind}, celltype string, bx bigint, by bigint, n bigint, lam double, lam_all double"), "intensities")


def on_grid(cells: DataFrame, box: DataFrame) -> DataFrame:
    """Cells with their window, its grid cells' size ``w, h``, the kernel's width ``s`` and the grid cell ``bx, by``."""
    b = box.withColumns({"w": (F.col("x1") - F.col("x0")) / GRID, "h": (F.col("y1") - F.col("y0")) / GRID, "s": F.least(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) / 8})
    return cells.join(F.broadcast(b), "g").withColumns({"bx": F.least(F.floor((F.col("x") - F.col("x0")) / F.col("w")), F.lit(GRID - 1)), "by": F.least(F.floor((F.col("y") - F.col("y0")) / F.col("h")), F.lit(GRID - 1))})  # one row per sample


def _pair_sums(own: DataFrame, box: DataFrame, r_max: float, steps: int) -> DataFrame:
    """``g, ref, query, w``: weights of the pairs of types by distance step, 0 to ``steps``, of some part of a sample in each row."""
    kind = own.schema["g"].dataType.simpleString()
    placed = in_cells(own.join(F.broadcast(box), "g"), r_max, ["celltype", "lam", "lam_all", "x0", "x1", "y0", "y1"])  # one row per sample
    # Some hundred cells of a sample to a task: few rows come out, and no large sample is one task's work.
    placed = placed.repartition("g", F.floor(F.col("cx") / 16), F.floor(F.col("cy") / 16)).sortWithinPartitions("g", "cx", "cy", "copy", "k", F.desc("celltype"))

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept, of, found = None, None, {}

        def rows() -> pd.DataFrame:
            return pd.DataFrame({"g": of, "ref": [r for r, _ in found], "query": [q for _, q in found], "w": list(found.values())})

        def add(pdf: pd.DataFrame, pairs: list[tuple[np.ndarray, np.ndarray]]) -> None:
            i, j = (np.concatenate(p) for p in zip(*pairs))
            x, y, k = pdf.x.to_numpy(), pdf.y.to_numpy(), pdf.k.to_numpy()
            d = np.sqrt((x[i] - x[j]) ** 2 + (y[i] - y[j]) ** 2)
            met = (d <= r_max) & (d > 0) & (k[i] != k[j])
            i, j, d = i[met], j[met], d[met]
            if not len(d):
                return
            window = tuple(pdf[c].iloc[i[0]] for c in ("x0", "x1", "y0", "y1"))
            e = (1 / circle_inside(x[i], y[i], d, window) + 1 / circle_inside(x[j], y[j], d, window)) / 2
            names, code = np.unique([*pdf.celltype, "All"], return_inverse=True)
            step, every = np.floor(d / (r_max / steps)).astype(int), code[-1]
            lam, lam_all = pdf.lam.to_numpy(), pdf.lam_all.to_numpy()
            # Ordered pairs: each end once as reference; (All, All) and same types get both directions.
            for (a, la), (b, lb) in ((("own", lam), ("own", lam)), (("own", lam), ("all", lam_all)), (("all", lam_all), ("own", lam)), (("all", lam_all), ("all", lam_all))):
                ta, tb = (code[i] if a == "own" else np.full(len(i), every)), (code[j] if b == "own" else np.full(len(j), every))
                w = np.where(ta == tb, 2.0, 1.0) * e / (la[i] * lb[j])
                both = np.minimum(ta, tb) * len(names) + np.maximum(ta, tb)
                there = np.flatnonzero(np.bincount(both, minlength=len(names) ** 2))
                place = np.zeros(len(names) ** 2, int)
                place[there] = np.arange(len(there))
                total = np.bincount(place[both] * (steps + 1) + step, w, len(there) * (steps + 1)).reshape(-1, steps + 1)
                for p, v in zip(there, total):
                    name = (names[p // len(names)], names[p % len(names)])
                    found[name] = found[name] + v if name in found else v

        for pdf in chain(batches, [None]):
            whole = kept if pdf is None else pdf if kept is None else pd.concat([kept, pdf], ignore_index=True)
            if whole is None or not len(whole):
                continue
            whole = whole[~whole.duplicated(["g", "cx", "cy", "copy", "k", "x", "y"])].reset_index(drop=True)  # repeated rows count once
            g, cx, cy, x, y = (whole[c].to_numpy() for c in ("g", "cx", "cy", "x", "y"))
            ends = [0, *(np.flatnonzero((g[1:] != g[:-1]) | (cx[1:] != cx[:-1]) | (cy[1:] != cy[:-1])) + 1), len(whole)]
            spans, own_ones = list(zip(ends[:-1], ends[1:])), np.concatenate([[0], np.cumsum(whole["copy"].to_numpy() == 0)])
            kept = None if pdf is None else whole.iloc[spans.pop()[0] :]  # a cell may go on in the next batch
            pairs, held = [], 0
            for a, b in spans:
                if g[a] != of:
                    if pairs:
                        add(whole, pairs)
                    if found:
                        yield rows()
                    of, found, pairs, held = g[a], {}, [], 0
                most = own_ones[b] - own_ones[a]
                for at in range(0, most, max(1, AT_A_TIME // (b - a))):
                    upto = min(most, at + max(1, AT_A_TIME // (b - a)))
                    dx, dy = x[a + at : a + upto, None] - x[None, a + at : b], y[a + at : a + upto, None] - y[None, a + at : b]
                    i, j = np.nonzero(dx * dx + dy * dy <= r_max * r_max * (1 + 1e-9))
                    later = j > i
                    pairs.append((i[later] + a + at, j[later] + a + at))
                    held += len(pairs[-1][0])
                    if held > AT_A_TIME:
                        add(whole, pairs)
                        pairs, held = [], 0
            if pairs:
                add(whole, pairs)
        if found:
            yield rows()

    return placed.mapInPandas(sums, f"g {kind}, ref string, query string, w array<double>")


def pair_curves(cells: DataFrame, r_max: float, steps: int = 500, min_count: int = 10) -> DataFrame:
    """``g, ref, query, n_ref, n_query, skipped, curve``: the pair-correlation curve of each unordered pair of types.

    All pairs of types share one search for pairs. Weights 1 / (lambda lambda share of circle) are added up per distance
    step where pairs are found, so that no row is made of a pair, then smoothed by an Epanechnikov kernel of Stoyan's
    bandwidth (0.15 / square root of intensity), so distances are rounded to a step. The value at distance zero is 0. Pairs with a type of fewer than ``min_count``
    cells have a row without a curve. ``All`` stands for all cells, whatever their type.
    """
    box = windows(cells)
    lam = intensities(cells, box)
    sizes = lam.groupBy("g", "celltype").agg(F.sum("n").alias("n"))
    own = on_grid(cells, box).select("g", "k", "x", "y", "celltype", "bx", "by").join(broadcast_if_small(lam.drop("n")), ["g", "celltype", "bx", "by"]).drop("bx", "by")
    step = r_max / steps
    summed = _pair_sums(own, box, r_max, steps).groupBy("g", "ref", "query").agg(F.collect_list("w").alias("w"))  # a row for each part of the sample
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    grid = sizes.select("g", F.col("celltype").alias("ref"), F.col("n").alias("n_ref")).join(sizes.select("g", F.col("celltype").alias("query"), F.col("n").alias("n_query")), "g").where(F.col("ref") <= F.col("query"))
    grid = grid.join(box.withColumn("area", area).select("g", "area"), "g")
    low = F.least(F.when(F.col("ref") == "All", F.lit(min_count)).otherwise(F.col("n_ref")), F.when(F.col("query") == "All", F.lit(min_count)).otherwise(F.col("n_query")))
    grid = grid.withColumns({"skipped": low < min_count, "h": F.greatest(F.lit(step), 0.15 / F.sqrt(F.sqrt(F.col("n_ref") * F.col("n_query")) / F.col("area")))})

    def smooth(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        apart = np.arange(-steps, steps + 1)  # a step of the curve less that of a pair
        for pdf in batches:
            curves = []
            for r in pdf.itertuples():
                if r.w is None:
                    curves.append(None if r.skipped else np.zeros(steps))
                    continue
                u = (apart - 0.5) * step / r.h
                kernel = np.where(np.abs(u) < 1, 0.75 * (1 - u * u) / r.h, 0.0)
                v = np.convolve(np.sum(np.stack(r.w), axis=0), kernel)[steps : 2 * steps]
                v[0] = 0.0
                v[1:] /= 2 * math.pi * np.arange(1, steps) * step * r.area
                curves.append(v)
            yield pdf[["g", "ref", "query", "n_ref", "n_query", "skipped"]].assign(curve=pd.Series(curves, dtype=object))

    whole = grid.join(summed, ["g", "ref", "query"], "left").select("g", "ref", "query", "n_ref", "n_query", "skipped", "h", "area", F.when(~F.col("skipped"), F.col("w")).alias("w"))
    return whole.mapInPandas(smooth, f"g {cells.schema['g'].dataType.simpleString()}, ref string, query string, n_ref bigint, n_query bigint, skipped boolean, curve array<double>")


def curves_long(curves: DataFrame, r_max: float, steps: int = 500) -> DataFrame:
    """One row per pair and distance: ``g, ref, query, r, value``."""
    return curves.select("g", "ref", "query", F.posexplode("curve").alias("i", "value")).select("g", "ref", "query", (F.col("i") * (r_max / steps)).alias("r"), "value")


def curve_spread(long: DataFrame) -> DataFrame:
    """Mean and variance of curves over samples at each distance; the variance of one sample is 0."""
    return long.groupBy("ref", "query", "r").agg(F.avg("value").alias("mean"), F.coalesce(F.var_samp("value"), F.lit(0.0)).alias("variance"), F.count(F.lit(1)).alias("samples"))


def distance_histogram(cells: DataFrame, r_max: float, bins: int) -> DataFrame:
    """Unordered pairs of types by distance step, strictly nearer than ``r_max``: ``g, ref, query, bin, pairs``."""
    p = pairs_within(cells, r_max, ["celltype"], above=0.0)
    b = F.floor(F.col("d") / (r_max / bins)).cast("int").alias("bin")
    return p.select("g", F.least("celltype_1", "celltype_2").alias("ref"), F.greatest("celltype_1", "celltype_2").alias("query"), b).groupBy("g", "ref", "query", "bin").agg(F.count(F.lit(1)).alias("pairs"))


def pair_effect_sizes(cells: DataFrame, r_max: float, bins: int) -> DataFrame:
    """One-sided Kolmogorov-Smirnov effect of each ordered pair of types: ``g, ref, query, pairs, effect``.

    How far the cumulative share of distances from a reference type to a query type runs above that of its distances
    to cells of any type, which is what randomly drawn cells expect. Distances up to ``r_max`` count, in ``bins``
    steps, so one pair join and counts of fixed size are enough. Pairs that are never met are not there.
    """
    h = distance_histogram(cells, r_max, bins)
    # Met once in each direction; pairs of one type twice in the same.
    both = h.unionByName(h.select("g", F.col("query").alias("ref"), F.col("ref").alias("query"), "bin", "pairs")).groupBy("g", "ref", "query", "bin").agg(F.sum("pairs").alias("pairs"))
    grid = both.groupBy("g", "ref", "query").agg(F.sum("pairs").alias("all")).withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    full = grid.join(both, ["g", "ref", "query", "bin"], "left").na.fill(0, ["pairs"])
    upto = Window.partitionBy("g", "ref", "query").orderBy("bin")  # one row a step
    any_type = both.groupBy("g", "ref", "bin").agg(F.sum("pairs").alias("any"))
    total = any_type.groupBy("g", "ref").agg(F.sum("any").alias("any_all"))
    steps = total.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))).join(any_type, ["g", "ref", "bin"], "left").na.fill(0, ["any"])
    steps = steps.withColumn("f", F.sum("any").over(Window.partitionBy("g", "ref").orderBy("bin")) / F.col("any_all")).select("g", "ref", "bin", "f")
    over = full.withColumn("own", F.sum("pairs").over(upto) / F.col("all")).join(steps, ["g", "ref", "bin"])
    return over.groupBy("g", "ref", "query").agg(F.max("all").alias("pairs"), F.greatest(F.max(F.col("own") - F.col("f")), F.lit(0.0)).alias("effect"))


def curve_summary(cells: DataFrame, curves: DataFrame) -> DataFrame:
    """Curves with ``pcf_sum, normalization, min_count``: one row for each pair of types, skipped ones with nulls.

    ``normalization`` is the product of both types' sums of 1 / intensity over the squared area of the cells' own
    rectangle; ``pcf_sum`` adds up the curve divided by it, which is the column ``norm_curve``.
    """
    inverse = intensities(cells, windows(cells)).groupBy("g", "celltype").agg(F.sum(F.col("n") / F.col("lam")).alias("inverse"))
    area = cells.groupBy("g").agg(((F.max("x") - F.min("x")) * (F.max("y") - F.min("y"))).alias("area"))
    side = lambda t: inverse.select("g", F.col("celltype").alias(t), F.col("inverse").alias(f"inverse_{t}"))
    n = curves.join(side("ref"), ["g", "ref"]).join(side("query"), ["g", "query"]).join(area, "g")
    n = n.withColumn("normalization", F.when(~F.col("skipped"), F.try_divide(F.col("inverse_ref") * F.col("inverse_query"), F.col("area") * F.col("area"))))
    n = n.withColumn("norm_curve", F.transform("curve", lambda v: F.try_divide(v, F.col("normalization"))))
    return n.select("g", "ref", "query", "n_ref", "n_query", F.least("n_ref", "n_query").alias("min_count"), "skipped", "normalization", F.aggregate("norm_curve", F.lit(0.0), lambda s, v: s + v).alias("pcf_sum"), "curve", "norm_curve")


def interaction_subset(summary: DataFrame, first: str, second: str, min_count: int = 0) -> DataFrame:
    """The rows of one unordered pair of types whose smaller count is above ``min_count``."""
    one = (F.col("ref") == first) & (F.col("query") == second)
    other = (F.col("ref") == second) & (F.col("query") == first)
    return summary.where((one | other) & (F.col("min_count") > min_count))


def auc_table(summary: DataFrame, ref: str, step: float) -> DataFrame:
    """``sample, r`` and a column for each type: the normalised curves of a reference type against all others.

    ``All`` is the baseline and cannot be the reference. Types without a curve in any sample have no column, samples
    without any curve no rows; a pair without a curve is null.
    """
    if ref == "All":
        raise ValueError("'All' is what the other types are compared with")
    of = summary.where(((F.col("ref") == ref) | (F.col("query") == ref)) & F.col("norm_curve").isNotNull() & ~((F.col("ref") == ref) & (F.col("query") == ref)))
    of = of.withColumn("other", F.when(F.col("ref") == ref, F.col("query")).otherwise(F.col("ref")))
    others = sorted((r[0] for r in of.select("other").distinct().collect()), key=lambda t: (t != "All", t))  # types of cells: a few
    if not others:
        raise ValueError(f"no curve of {ref} was computed; lower the least count or take a more abundant type")
    long = of.select("g", "other", F.posexplode("norm_curve").alias("i", "value"))
    sample = F.regexp_replace("g", "-vectra_cell_seg_data.*$", "").alias("sample")
    return long.groupBy(sample, ((F.col("i") + 1) * step).alias("r")).pivot("other", others).agg(F.first("value"))


def pair_grid(cells: DataFrame, min_count: int = 10) -> DataFrame:
    """Unordered pairs of types, ``All`` included, and whether a pair is skipped for too few cells."""
    sizes = cells.groupBy("g", "celltype").agg(F.count(F.lit(1)).alias("n"))
    every = sizes.withColumn("place", F.row_number().over(Window.partitionBy("g").orderBy("celltype"))).unionByName(sizes.groupBy("g").agg(F.lit("All").alias("celltype"), F.sum("n").alias("n")).withColumn("place", F.lit(0)))
    a = every.select("g", F.col("celltype").alias("ref"), F.col("n").alias("n_ref"), F.col("place").alias("pa"))
    b = every.select("g", F.col("celltype").alias("query"), F.col("n").alias("n_query"), F.col("place").alias("pb"))
    few = ((F.col("ref") != "All") & (F.col("n_ref") < min_count)) | ((F.col("query") != "All") & (F.col("n_query") < min_count))
    return a.join(b, "g").where(F.col("pa") <= F.col("pb")).select("g", "ref", "query", "n_ref", "n_query", few.alias("skipped"))
