"""Quality control, normalisation and summaries of cell by gene and cell by marker tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.numeric import clipped
from tessella.operators.order import percentiles


def qc_statistics(counts: DataFrame) -> DataFrame:
    """``cell, total, genes`` of a sparse table ``cell, gene, n``."""
    return counts.groupBy("cell").agg(F.sum("n").alias("total"), F.count_if(F.col("n") > 0).alias("genes"))


def qc_keep(stats: DataFrame, counts: tuple = (None, None), genes: tuple = (None, None), area: tuple = (None, None), max_density: float | None = None, max_negative: float | None = None) -> DataFrame:
    """Cells within all bounds (inclusive); a bound that is None or whose column is absent does not count.

    A cell with a null in a bounded column goes.
    """
    rules: list[Column] = []
    for name, (low, high) in {"total": counts, "genes": genes, "area": area}.items():
        if name in stats.columns:
            rules += [F.col(name) >= low] if low is not None else []
            rules += [F.col(name) <= high] if high is not None else []
    if max_density is not None and "area" in stats.columns:
        rules.append(F.col("total") / (F.col("area") + 1e-10) <= max_density)
    if max_negative is not None and "negative" in stats.columns:
        rules.append(F.col("negative") / (F.col("total") + 1e-10) <= max_negative)
    for r in rules:
        stats = stats.where(F.coalesce(r, F.lit(False)))
    return stats


def normalized(counts: DataFrame, method: str = "lognorm", volumes: DataFrame | None = None, theta: float = 100.0) -> DataFrame:
    """``cell, gene, n, value`` by ``lognorm``, ``cp10k``, ``cellvol``, ``none`` or ``pearson``.

    Absent counts are zeros: the first four leave them zero and absent; Pearson residuals need every cell with every
    gene, so ``pearson`` returns the dense table. Cells of no counts have no rows in a sparse table.
    """
    lib = counts.groupBy("cell").agg(F.sum("n").alias("lib"))
    if method == "none":
        return counts.withColumn("value", F.col("n"))
    if method == "cellvol" and volumes is not None:
        usable = volumes.select("cell", F.when(F.col("volume") > 0, F.col("volume")).otherwise(1e-6).alias("volume"))
        middle = percentiles(usable, [], "volume", [0.5]).agg(F.max("value").alias("middle"))
        v = counts.join(usable, "cell", "left").crossJoin(F.broadcast(middle)).withColumn("volume", F.coalesce("volume", F.lit(1e-6)))  # one row
        return v.select("cell", "gene", "n", F.log1p(F.col("n") / F.col("volume") * F.col("middle")).alias("value"))
    if method in ("lognorm", "cp10k", "cellvol"):
        scaled = F.col("n") / F.when(F.col("lib") == 0, 1.0).otherwise(F.col("lib")) * 1e4
        return counts.join(lib, "cell").select("cell", "gene", "n", (scaled if method == "cp10k" else F.log1p(scaled)).alias("value"))
    if method != "pearson":
        raise ValueError(f"unknown method {method}")
    genes = counts.groupBy("gene").agg(F.sum("n").alias("of_gene"))
    # The panel rides along as one array per cell: the dense table is the result asked for, not a search space.
    panel = genes.agg(F.sum("of_gene").alias("all"), F.collect_list(F.struct("gene", "of_gene")).alias("panel"))
    size = lib.agg(F.count(F.lit(1)).alias("cells"))
    grid = lib.crossJoin(F.broadcast(panel)).crossJoin(F.broadcast(size)).select("cell", "lib", "all", "cells", F.explode("panel").alias("p")).select("cell", "lib", "all", "cells", "p.gene", "p.of_gene")
    full = grid.join(counts, ["cell", "gene"], "left").withColumn("n", F.coalesce("n", F.lit(0.0)))
    mu = F.col("lib") * F.col("of_gene") / F.col("all")
    residual = F.try_divide(F.col("n") - mu, F.sqrt(mu + mu * mu / theta))
    bound = F.sqrt(F.col("cells"))
    return full.withColumn("r", residual).select("cell", "gene", "n", F.when(F.col("r") > bound, bound).when(F.col("r") < -bound, -bound).otherwise(F.col("r")).alias("value"))


def variable_genes(values: DataFrame, cells: int | Column, top: int) -> DataFrame:
    """The ``top`` genes of highest variance over all cells (absent values are zeros): ``gene, variance, rank``."""
    n = F.lit(cells) if isinstance(cells, int) else cells
    s = values.groupBy("gene").agg(F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("s2"))
    var = s.select("gene", ((F.col("s2") - F.col("s") * F.col("s") / n) / (n - 1)).alias("variance"))
    best = var.orderBy(F.desc("variance"), "gene").limit(top)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("variance"), "gene")))  # ``top`` rows


def marker_table(profiles: DataFrame, markers: DataFrame) -> DataFrame:
    """``k, g, cluster, marker, v`` from one array per cell; ``markers`` (``position, marker``) is the small panel."""
    long = profiles.select("k", "g", "cluster", F.posexplode("e").alias("position", "v"))
    return long.join(F.broadcast(markers), "position").drop("position")


def zscaled(long: DataFrame, *by: str) -> DataFrame:
    """``z``: each marker's value against all cells' mean and sample deviation; markers without spread go."""
    keys = [*by, "marker"]
    s = long.groupBy(*keys).agg(F.avg("v").alias("m"), F.stddev_samp("v").alias("s")).where(F.col("s") > 0)
    return long.join(F.broadcast(s), keys).withColumn("z", (F.col("v") - F.col("m")) / F.col("s")).drop("m", "s")  # one row per marker


def cluster_heatmap(long: DataFrame, limit: float = 5.0) -> DataFrame:
    """Median of each marker by cluster (mean where the medians are all zero), as z-scores across clusters, clipped."""
    median = percentiles(long, ["cluster", "marker"], "v", [0.5]).select("cluster", "marker", F.col("value").alias("median"))
    mean = long.groupBy("cluster", "marker").agg(F.avg("v").alias("mean"))
    c = mean.join(median, (mean["cluster"].eqNullSafe(median["cluster"])) & (mean["marker"] == median["marker"]), "left").select(mean["cluster"], mean["marker"], "median", "mean")
    w = Window.partitionBy("marker")
    c = c.withColumn("centre", F.when(F.max(F.abs("median")).over(w) == 0, F.col("mean")).otherwise(F.col("median")))
    z = F.try_divide(F.col("centre") - F.avg("centre").over(w), F.stddev_samp("centre").over(w))
    return c.select("cluster", "marker", "centre", clipped(z, -limit, limit).alias("z"))


def cluster_signal(profiles: DataFrame, above: float = 1.0) -> DataFrame:
    """Signal by cluster: mean of all markers, mean number of markers above a level, and their share of the panel."""
    mean = F.aggregate("e", F.lit(0.0), lambda s, x: s + x) / F.size("e")
    high = F.size(F.filter("e", lambda x: x > above))
    return profiles.groupBy("cluster").agg(F.round(F.avg(mean), 3).alias("signal"), F.round(F.avg(high), 2).alias("markers_high"), F.round(F.avg(high / F.size("e")), 3).alias("share_high"), F.count(F.lit(1)).alias("n"))


def cluster_sizes(cells: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Cells and share of each cluster."""
    c = cells.groupBy(F.col(cluster).alias("cluster")).agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))  # one row per cluster


def scale_kind(long: DataFrame) -> DataFrame:
    """Whether values look like z-scores, centred or transformed: one row, over all cells."""
    per = long.groupBy("marker").agg(F.avg("v").alias("m"), F.stddev_samp("v").alias("s"), F.min("v").alias("low"))
    z = (F.max(F.abs("m")) < 0.15) & (F.max(F.abs(F.col("s") - 1)) < 0.25)
    return per.agg(F.when(z, "z-scores").when(F.min("low") < -0.05, "centred").otherwise("transformed").alias("scale"))


def elevated_reduced(profile: DataFrame, min_z: float = 0.5, high: float = 0.9, low: float = 0.1, names: bool = False) -> DataFrame:
    """By cluster, markers above the 90th percentile of its profile and at least ``min_z``, and those below the 10th.

    ``profile`` has ``cluster, marker, z``; elevated ones come from the highest, reduced ones from the lowest.
    With ``names`` a further column ``up`` holds the elevated markers' names.
    """
    q = profile.groupBy("cluster").agg(F.percentile("z", F.array(F.lit(high), F.lit(low))).alias("q"))
    p = profile.join(q, "cluster")
    up = F.when((F.col("z") > F.col("q")[0]) & (F.col("z") >= min_z), F.struct((-F.col("z")).alias("by"), "marker", "z"))
    down = F.when(F.col("z") < F.col("q")[1], F.struct(F.col("z").alias("by"), "marker", "z"))
    out = p.groupBy("cluster").agg(F.sort_array(F.collect_list(up)).alias("up"), F.sort_array(F.collect_list(down)).alias("down"))  # a panel of markers each
    text = lambda c: F.array_join(F.transform(c, lambda m: F.concat(m["marker"], F.lit("="), F.format_string("%+.2f", m["z"]))), ", ")
    more = [F.transform("up", lambda m: m["marker"]).alias("up")] if names else []
    return out.select("cluster", text("up").alias("elevated"), text("down").alias("reduced"), *more)
