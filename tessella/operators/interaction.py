"""Which types of cells lie near which: annulus log-odds, circuits of several types, enrichment of neighbours."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.operators.order import percentiles
from tessella.operators.proximity import pairs_within
from tessella.session import materialize

NEG_INF = float("-inf")


def log_or_floor(x: Column) -> Column:
    """The natural logarithm, with minus infinity at zero and null where there is no value."""
    return F.when(x == 0, F.lit(NEG_INF)).otherwise(F.ln(x))


def annulus(resolution: float = 0.3774, inner: float = 3.0, outer: float = 30.0, outer_is_width: bool = True) -> tuple[float, float]:
    """Radii in pixels; the outer one is by default a width that is added to the inner radius."""
    return inner / resolution, (inner + outer if outer_is_width else outer) / resolution


def neighbours_by_type(cells: DataFrame, radii: tuple[float, float], types: list[str] | None = None) -> DataFrame:
    """``g, k, ref, query, n``: how many cells of each type lie in the annulus around each reference cell.

    ``cells`` has ``g, k, x, y, celltype``. Each pair is met once and counted for both ends; counts are added up per
    cell and type before they move. ``types`` limits the reference cells.
    """
    pairs = pairs_within(cells, radii[1], ["celltype"], above=radii[0])
    ends = F.array(
        F.struct(F.col("k_1").alias("k"), F.col("celltype_1").alias("ref"), F.col("celltype_2").alias("query")),
        F.struct(F.col("k_2").alias("k"), F.col("celltype_2").alias("ref"), F.col("celltype_1").alias("query")),
    )
    each = pairs.select("g", F.explode(ends).alias("e")).select("g", "e.*")
    if types:
        each = each.where(F.col("ref").isin(types))
    return each.groupBy("g", "k", "ref", "query").agg(F.count(F.lit(1)).alias("n"))


def pairwise_log_odds(cells: DataFrame, radii: tuple[float, float]) -> DataFrame:
    """For every ordered pair of types: ``g, ref, query, pairs, log_odds, probability``.

    ``log_odds`` compares the share of a query type among the neighbours of a reference type with its share among all
    cells (minus infinity if never met; null if the reference type has no neighbours), ``probability`` is the share of
    reference cells with at least one such neighbour. All pairs of types of a group are there.
    """
    sizes = cells.groupBy("g", "celltype").agg(F.count(F.lit(1)).alias("size"))
    sizes = sizes.withColumn("cells", F.sum("size").over(Window.partitionBy("g")))
    grid = sizes.select("g", F.col("celltype").alias("ref"), F.col("size").alias("n_ref")).join(sizes.select("g", F.col("celltype").alias("query"), F.col("size").alias("n_query"), "cells"), "g")
    met = neighbours_by_type(cells, radii).groupBy("g", "ref", "query").agg(F.sum("n").alias("pairs"), F.count(F.lit(1)).alias("with"))
    full = grid.join(met, ["g", "ref", "query"], "left").na.fill(0, ["pairs", "with"])
    around = F.sum("pairs").over(Window.partitionBy("g", "ref"))
    odds = F.try_divide(F.col("pairs"), around) / (F.col("n_query") / F.col("cells"))
    return full.withColumn("odds", odds).select("g", "ref", "query", "pairs", log_or_floor(F.col("odds")).alias("log_odds"), (F.col("with") / F.col("n_ref")).alias("probability"))


def circuit_counts(cells: DataFrame, radii: tuple[float, float], targets: list[str]) -> tuple[DataFrame, DataFrame]:
    """Neighbours of each target type, and the shares of types: the two tables a circuit's score is made of."""
    met = neighbours_by_type(cells, radii, targets).groupBy("g", "ref", "query").agg(F.sum("n").alias("pairs"))
    sizes = cells.groupBy("g", "celltype").agg(F.count(F.lit(1)).alias("size"))
    return met, sizes.withColumn("share", F.col("size") / F.sum("size").over(Window.partitionBy("g")))


def _expected(shares: list[Column]) -> Column:
    """Expected share of a neighbourhood of all but one of the targets, over the targets' share together."""
    each = [reduce(lambda a, b: a * b, [s for j, s in enumerate(shares) if j != i]) for i in range(len(shares))]
    return F.try_divide(reduce(lambda a, b: a + b, each), reduce(lambda a, b: a + b, shares))


def circuit_scores(cells: DataFrame, radii: tuple[float, float], targets: list[str]) -> DataFrame:
    """Score of a circuit of several types by group: ``g, empirical, theoretical, score`` (their difference).

    ``empirical``: of all neighbours of target cells, the share that is a target of another type.
    """
    met, sizes = circuit_counts(cells, radii, targets)
    inner = F.col("query").isin(targets) & (F.col("query") != F.col("ref"))
    e = met.groupBy("g").agg(F.try_divide(F.sum(F.when(inner, F.col("pairs")).otherwise(0)), F.sum("pairs")).alias("empirical"))
    shares = [F.coalesce(F.max(F.when(F.col("celltype") == t, F.col("share"))), F.lit(0.0)) for t in targets]
    t = sizes.groupBy("g").agg(_expected(shares).alias("theoretical"))
    return t.join(e, "g", "left").withColumn("score", F.col("empirical") - F.col("theoretical"))


def leave_one_out_deltas(cells: DataFrame, radii: tuple[float, float], targets: list[str]) -> DataFrame:
    """How a circuit's score changes without each type: ``g, celltype, delta, delta_z``.

    All scores come from one table of neighbour counts: what touches the type left out is subtracted, no pairs are
    met again. Without one of the targets the score is minus its expectation over what remains. ``delta_z`` uses the
    standard deviation of the population.
    """
    met, sizes = circuit_counts(cells, radii, targets)
    inner = F.col("query").isin(targets) & (F.col("query") != F.col("ref"))
    by = met.groupBy("g").agg(F.sum(F.when(inner, F.col("pairs")).otherwise(0)).alias("inner"), F.sum("pairs").alias("all"))
    # Of the counts, those that go when a type goes: as query of any target, and as reference.
    ends = F.array_distinct(F.array(F.col("ref"), F.col("query")))
    lost = met.select("g", F.explode(ends).alias("celltype"), "pairs", inner.cast("int").alias("i")).groupBy("g", "celltype").agg(F.sum(F.col("pairs") * F.col("i")).alias("lost_inner"), F.sum("pairs").alias("lost_all"))
    total = F.sum("size").over(Window.partitionBy("g"))
    of = [F.max(F.when(F.col("celltype") == t, F.col("size")).otherwise(0)).over(Window.partitionBy("g")) for t in targets]
    named = sizes.withColumns({"cells": total, **{f"t{i}": c for i, c in enumerate(of)}})
    rest = F.col("cells") - F.col("size")
    left = [F.when(F.col("celltype") == t, 0).otherwise(F.col(f"t{i}")) for i, t in enumerate(targets)]
    base = named.join(by, "g").join(lost, ["g", "celltype"], "left").na.fill(0, ["lost_inner", "lost_all"])
    full = F.try_divide("inner", "all") - _expected([F.col(f"t{i}") / F.col("cells") for i in range(len(targets))])
    theory = _expected([F.try_divide(c, rest) for c in left])
    without = F.when(F.col("celltype").isin(targets), -theory).otherwise(F.try_divide(F.col("inner") - F.col("lost_inner"), F.col("all") - F.col("lost_all")) - theory)
    d = base.select("g", "celltype", (full - without).alias("delta"))
    w = Window.partitionBy("g")
    return d.withColumn("delta_z", F.try_divide(F.col("delta") - F.avg("delta").over(w), F.stddev_pop("delta").over(w)))


def smooth(edges: DataFrame, values: DataFrame, value: str) -> DataFrame:
    """Mean of ``value`` over each point's neighbours: ``g, k`` and the mean; pass edges that include the point."""
    v = values.select("g", F.col("k").alias("dst"), F.col(value).alias("v"))
    return edges.join(v, ["g", "dst"]).groupBy("g", F.col("src").alias("k")).agg(F.avg("v").alias(value))


def threshold_objective(cells: DataFrame, thresholds: list[float], targets: list[str], min_cells: int = 100) -> DataFrame:
    """How well each threshold on the smoothed delta separates a neighbourhood: ``g, threshold, n, objective``.

    ``cells`` has ``g, celltype, delta_z, smooth``. A region is what lies above the quantile; it counts if it has
    ``min_cells`` cells and all target types. The objective is its share of target cells times the logarithm of the
    spread of both deltas, written as a sum so that nothing overflows.
    """
    cut = percentiles(cells, ["g"], "smooth", thresholds).select("g", F.col("share").alias("threshold"), F.col("value").alias("at"))
    region = materialize(cells.join(cut, "g").where(F.col("smooth") > F.col("at")), "regions")
    found = region.groupBy("g", "threshold").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("celltype").isin(targets)).alias("hits"),
        F.count_distinct(F.when(F.col("celltype").isin(targets), F.col("celltype"))).alias("kinds"),
    )
    for name, column in (("qd", "delta_z"), ("qs", "smooth")):
        q = percentiles(region, ["g", "threshold"], column, [0.25, 0.5, 0.75]).groupBy("g", "threshold")
        found = found.join(q.agg(F.array_sort(F.collect_list("value")).alias(name)), ["g", "threshold"])  # three values
    spread = lambda c: F.col(c)[1] / 2 + (F.col(c)[0] + F.col(c)[2]) / 4
    found = found.where((F.col("n") >= min_cells) & (F.col("kinds") == len(targets)))
    return found.select("g", "threshold", "n", (F.col("hits") / F.col("n") * (spread("qd") + spread("qs"))).alias("objective"))


def best_threshold(objectives: DataFrame) -> DataFrame:
    """The threshold of the highest objective by group; the smaller one on ties."""
    return objectives.groupBy("g").agg(F.max_by("threshold", F.struct("objective", -F.col("threshold"))).alias("threshold"))


def neighbour_enrichment(edges: DataFrame, cells: DataFrame) -> DataFrame:
    """Observed against expected neighbour types: ``g, src_type, dst_type, observed, expected, z``."""
    t = cells.select("g", "k", "celltype")
    both = edges.join(t.withColumnsRenamed({"k": "src", "celltype": "src_type"}), ["g", "src"]).join(t.withColumnsRenamed({"k": "dst", "celltype": "dst_type"}), ["g", "dst"])
    seen = both.groupBy("g", "src_type", "dst_type").agg(F.count(F.lit(1)).alias("observed"))
    sizes = t.groupBy("g", "celltype").agg(F.count(F.lit(1)).alias("size"))
    sizes = sizes.withColumn("cells", F.sum("size").over(Window.partitionBy("g")))
    grid = sizes.select("g", F.col("celltype").alias("src_type"), F.col("size").alias("n1"), "cells").join(sizes.select("g", F.col("celltype").alias("dst_type"), F.col("size").alias("n2")), "g")
    full = grid.join(seen, ["g", "src_type", "dst_type"], "left").na.fill(0, ["observed"])
    total = F.sum("observed").over(Window.partitionBy("g"))
    expected = F.col("n1") * F.col("n2") / (F.col("cells") * F.col("cells")) * total
    return full.withColumn("expected", expected).select("g", "src_type", "dst_type", "observed", "expected", ((F.col("observed") - F.col("expected")) / F.sqrt(F.col("expected") + 1e-10)).alias("z"))
