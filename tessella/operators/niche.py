"""Neighbourhoods: what surrounds each cell, groups of surroundings, and how stable their number is."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.session import materialize


def composition(edges: DataFrame, cells: DataFrame) -> DataFrame:
    """Share of each type among a cell's neighbours: ``g, k, celltype, share`` (types that are there only)."""
    types = cells.select("g", F.col("k").alias("dst"), "celltype")
    n = edges.groupBy("g", "src").agg(F.count(F.lit(1)).alias("n"))
    met = edges.join(types, ["g", "dst"]).groupBy("g", "src", "celltype").agg(F.count(F.lit(1)).alias("c"))
    return met.join(n, ["g", "src"]).select("g", F.col("src").alias("k"), "celltype", (F.col("c") / F.col("n")).alias("share"))


def composition_matrix(shares: DataFrame, types: list[str]) -> DataFrame:
    """``g, k, features``: one array per cell, in the order of ``types``, zeros where a type is absent."""
    return shares.groupBy("g", "k").agg(F.array(*[F.coalesce(F.max(F.when(F.col("celltype") == t, F.col("share"))), F.lit(0.0)) for t in types]).alias("features"))


def fit_neighbourhoods(matrix: DataFrame, k: int, seed: int = 42) -> list[list[float]]:
    """Centres of ``k`` neighbourhoods, in the order of their coordinates, so that numbers do not depend on the start."""
    model = KMeans(k=k, seed=seed, featuresCol="v", maxIter=30).fit(matrix.select(array_to_vector("features").alias("v")))
    return sorted([[float(x) for x in c] for c in model.clusterCenters()])


def assign_nearest(matrix: DataFrame, centres: list[list[float]], column: str = "neighborhood") -> DataFrame:
    """The number (from 1) of the nearest centre, the first on ties (distances equal in 12 digits); ``k`` centres are a handful of literals."""
    d = [F.aggregate(F.zip_with("features", F.array(*[F.lit(x) for x in c]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x) for c in centres]
    ranked = F.array_min(F.array(*[F.struct(F.round(x, 12).alias("d"), F.lit(i).alias("i")) for i, x in enumerate(d, 1)]))
    return matrix.withColumn(column, ranked["i"])


def frequencies(assigned: DataFrame, cells: DataFrame, column: str = "neighborhood") -> DataFrame:
    """Share of each type within each neighbourhood: ``neighborhood, celltype, n, share``."""
    c = assigned.select("g", "k", column).join(cells.select("g", "k", "celltype"), ["g", "k"]).groupBy(column, "celltype").agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(column)))


def assignment_summary(assigned: DataFrame, column: str = "neighborhood") -> DataFrame:
    """Cells by sample and neighbourhood."""
    return assigned.groupBy("g", column).agg(F.count(F.lit(1)).alias("n_cells"))


def hold_out_folds(samples: list[str], mode: str = "count", amount: float = 1, max_folds: int = 20, seed: int = 42, groups: dict[str, str] | None = None) -> list[list[str]]:
    """Samples held out in each fold: a number of them, a percentage, or as many from each group."""
    import random

    rng = random.Random(seed)
    n, folds = len(samples), []
    for _ in range(min(n, max_folds)):
        if mode == "group":
            by: dict[str, list[str]] = {}
            for s in sorted(samples):
                by.setdefault((groups or {}).get(s, ""), []).append(s)
            if len(by) < 2:
                return []
            take = max(1, min(int(amount), min(map(len, by.values())) - 1))
            folds.append([x for v in by.values() for x in rng.sample(v, min(take, len(v)))])
        else:
            take = max(1, min(int(amount), n - 1)) if mode == "count" else max(1, int(n * amount / 100))
            folds.append(sorted(rng.sample(sorted(samples), min(take, n))))
    return folds


def stability_sweep(matrix: DataFrame, cells: DataFrame, ks: list[int], folds: list[list[str]], seed: int = 42) -> list[tuple[int, float]]:
    """How much the neighbourhoods' composition moves when samples are left out: ``(k, stability)``, smaller is better.

    Each fit is a distributed job over the cached matrix; only centres and frequency tables of k x types come back.
    """
    matrix = materialize(matrix, "niche")
    out = []
    for k in ks:
        whole = {(r[0], r[1]): r["share"] for r in frequencies(assign_nearest(matrix, fit_neighbourhoods(matrix, k, seed)), cells).collect()}
        moved = []
        for held in folds:
            train = matrix.where(~F.col("g").isin(held))
            if train.limit(k).count() < k:
                continue
            part = {(r[0], r[1]): r["share"] for r in frequencies(assign_nearest(train, fit_neighbourhoods(train, k, seed)), cells).collect()}
            keys = sorted(set(whole) | set(part))
            diffs = sorted(abs(whole.get(x, 0.0) - part.get(x, 0.0)) for x in keys)
            if diffs:
                m = len(diffs) // 2
                moved.append(diffs[m] if len(diffs) % 2 else (diffs[m - 1] + diffs[m]) / 2)
        out.append((k, sum(moved) / len(moved) if moved else float("nan")))
    return out
