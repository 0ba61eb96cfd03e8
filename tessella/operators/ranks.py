"""Rank statistics: markers of groups, adjusted p-values, spatial autocorrelation, distribution distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.numeric import normal_sf
from tessella.operators.order import running_sums
from tessella.operators.proximity import finite


def adjusted(p: Column, *partition: str) -> Column:
    """Benjamini-Hochberg: the least p * n / rank of this or any later rank, at most 1."""
    w = Window.partitionBy(*partition)
    rank = F.row_number().over(w.orderBy(p))
    n = F.count(p).over(w)
    return F.least(F.lit(1.0), F.min(p * n / rank).over(w.orderBy(p).rowsBetween(Window.currentRow, Window.unboundedFollowing)))


def group_rank_sums(values: DataFrame, sizes: DataFrame, min_group: int = 3) -> DataFrame:
    """One-vs-rest Wilcoxon statistics of every gene and group over a sparse table.

    ``values`` has ``cell, grp, gene, value`` with absent rows being zeros; ``sizes`` has ``grp, n``. Values are
    ranked once per gene for all groups: distinct values and their counts by group are aggregated first, so ties and
    zeros are single rows and no group or gene is sorted cell by cell. Returns ``gene, grp, n1, n2, mean1, mean2,
    pct1, pct2, u, z``: ``u`` with mid-ranks, ``z`` with tie and continuity correction (null without spread).
    """
    s = sizes.withColumn("all", F.sum("n").over(Window.partitionBy()))
    per = values.where(F.col("value") != 0).groupBy("gene", "grp", "value").agg(F.count(F.lit(1)).alias("c"))
    genes = values.select("gene").distinct()
    some = per.groupBy("gene", "grp").agg(F.sum("c").alias("c"))
    zero = genes.crossJoin(F.broadcast(s)).join(some, ["gene", "grp"], "left").select("gene", "grp", F.lit(0.0).alias("value"), (F.col("n") - F.coalesce("c", F.lit(0))).alias("c"))
    runs = per.unionByName(zero.where(F.col("c") > 0))
    tied = runs.groupBy("gene", "value").agg(F.sum("c").alias("t"))
    # A gene's distinct values, in order: ranks before each.
    before = F.sum("t").over(Window.partitionBy("gene").orderBy("value")) - F.col("t")
    ranked = tied.withColumn("rank", before + (F.col("t") + 1) / 2.0)
    # Cubes of counts: a bigint holds those up to two million cells, a decimal those up to 10^12, and exactly.
    cube = lambda c: (t := F.col(c).cast("decimal(12,0)")) * t * t - t
    ties = ranked.groupBy("gene").agg(F.sum(cube("t")).alias("ties"))
    both = runs.join(ranked.select("gene", "value", "rank"), ["gene", "value"])
    g = both.groupBy("gene", "grp").agg(F.sum(F.col("c") * F.col("rank")).alias("r1"), F.sum(F.col("c") * F.col("value")).alias("s1"), F.sum(F.when(F.col("value") > 0, F.col("c")).otherwise(0)).alias("p1"))
    w = Window.partitionBy("gene")
    g = g.join(F.broadcast(s), "grp").join(ties, "gene").withColumns({"n1": F.col("n"), "n2": F.col("all") - F.col("n"), "st": F.sum("s1").over(w), "pt": F.sum("p1").over(w)})
    g = g.where((F.col("n1") >= min_group) & (F.col("n2") >= min_group))
    u = F.col("r1") - F.col("n1") * (F.col("n1") + 1) / 2.0
    n = F.col("all").cast("double")
    var = F.col("n1") * F.col("n2") / 12.0 * ((cube("all") - F.col("ties")).cast("double") / (n * (n - 1)))
    off = u - F.col("n1") * F.col("n2") / 2.0
    z = F.when(var > 0, (off - F.signum(off) * 0.5) / F.sqrt(var))
    return g.select(
        "gene", "grp", "n1", "n2",
        (F.col("s1") / F.col("n1")).alias("mean1"), ((F.col("st") - F.col("s1")) / F.col("n2")).alias("mean2"),
        (F.col("p1") / F.col("n1")).alias("pct1"), ((F.col("pt") - F.col("p1")) / F.col("n2")).alias("pct2"),
        u.alias("u"), z.alias("z"),
    )


def group_markers(values: DataFrame, sizes: DataFrame, min_group: int = 3) -> DataFrame:
    """Marker genes of every group: fold change of means, shares expressed, p-value and its adjustment by group.

    p-values are those of the normal approximation; the exact distribution of very small groups is not used.
    """
    r = group_rank_sums(values, sizes, min_group)
    p = F.coalesce(2 * normal_sf(F.abs("z")), F.lit(1.0))
    out = r.withColumn("avg_log2FC", F.log2(F.col("mean1") + 1e-9) - F.log2(F.col("mean2") + 1e-9)).withColumn("p_val", F.least(F.lit(1.0), p))
    return out.withColumn("p_adj", adjusted(F.col("p_val"), "grp"))


def morans_i(edges: DataFrame, values: DataFrame, cross_product: bool = False) -> DataFrame:
    """Spatial autocorrelation of every marker over a neighbour graph: ``g, marker, i, z, p``.

    ``values`` has ``g, k, marker, v`` for all cells of the graph; weights are 1 / (distance + 1e-6). By default the
    neighbours' deviations are summed as they are, ``cross_product`` multiplies them with the cell's own, which is
    Moran's I of the textbooks. A marker without variance has I = 0 and p = 1.
    """
    m = values.groupBy("g", "marker").agg(F.avg("v").alias("m"), F.sum(F.col("v") * F.col("v")).alias("s2"), F.count(F.lit(1)).alias("n"))
    m = m.withColumn("ss", F.col("s2") - F.col("n") * F.col("m") * F.col("m"))
    e = edges.select("g", "src", "dst", (1 / (F.col("d") + 1e-6)).alias("w"))
    total = e.groupBy("g").agg(F.sum("w").alias("total"))
    c = values.join(F.broadcast(m.select("g", "marker", "m")), ["g", "marker"]).select("g", "k", "marker", (F.col("v") - F.col("m")).alias("c"))
    if cross_product:
        lag = e.join(c.withColumnsRenamed({"k": "src", "c": "c1"}), ["g", "src"]).join(c.withColumnsRenamed({"k": "dst", "c": "c2"}), ["g", "dst", "marker"]).withColumn("c", F.col("c1") * F.col("c2"))
    else:
        # Only the weight that falls on each cell counts, so edges are added up before they meet the values.
        lag = e.groupBy("g", F.col("dst").alias("k")).agg(F.sum("w").alias("w")).join(c, ["g", "k"])
    sums = lag.groupBy("g", "marker").agg(F.sum(F.col("w") * F.col("c")).alias("num"))
    flat = F.col("ss") < 1e-15
    i = F.when(flat, 0.0).otherwise(F.try_divide(F.col("n") * F.col("num"), F.col("total") * F.col("ss")))
    out = m.join(sums, ["g", "marker"]).join(total, "g").withColumn("i", i).withColumn("z", (F.col("i") + 1.0 / (F.col("n") - 1)) / (0.5 / F.sqrt("n")))
    return out.select("g", "marker", "i", "z", F.when(flat, 1.0).otherwise(2 * normal_sf(F.abs("z"))).alias("p"))


def spatially_variable(edges: DataFrame, values: DataFrame, top: int = 200) -> DataFrame:
    """Autocorrelation of the ``top`` markers of highest variance in each sample, with adjusted p-values."""
    var = values.groupBy("g", "marker").agg(F.var_samp("v").alias("var"))
    kept = var.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("var"), "marker"))).where(F.col("r") <= top)
    found = morans_i(edges, values.join(F.broadcast(kept.select("g", "marker")), ["g", "marker"], "left_semi"))
    return found.withColumn("p_adj", adjusted(F.col("p"), "g"))


def distribution_distance(values: DataFrame, group: str, value: str, first: str, second: str) -> DataFrame:
    """Greatest excess of the first sample's cumulative share over the second's (one-sided two-sample D+).

    Equal values are counted first and the distinct ones summed up over all tasks in order. Null and non-finite values
    do not count; without values of one of the samples the distance is 0.
    """
    v = values.where(F.col(group).isin(first, second) & finite(value))
    steps = v.groupBy((F.col(value) + 0.0).alias("v")).agg(F.count_if(F.col(group) == first).alias("a"), F.count_if(F.col(group) == second).alias("b"))
    upto = running_sums(steps, ["v"], ["a", "b"])
    whole = upto.agg(F.max("upto_a").alias("all_a"), F.max("upto_b").alias("all_b"))
    excess = F.try_divide(F.col("upto_a"), F.col("all_a")) - F.try_divide(F.col("upto_b"), F.col("all_b"))
    return upto.crossJoin(F.broadcast(whole)).agg(F.coalesce(F.greatest(F.max(excess), F.lit(0.0)), F.lit(0.0)).alias("d_plus"))  # one row
