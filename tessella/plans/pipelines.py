"""Chains of operators: a sample's cells in, the tables of one analysis out."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.operators import annotation, communities, components, expression, gating, interaction, neighbours, niche, pcf, ranks
from tessella.session import materialize


@dataclass
class Dynamics:
    """Pairwise and circuit analysis; radii in micrometres, resolution in micrometres a pixel."""

    resolution: float = 0.3774
    inner: float = 3.0
    outer: float = 30.0
    targets: list[str] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=lambda: [0.5 + 0.05 * i for i in range(10)])
    min_cells: int = 100

    def __post_init__(self) -> None:
        if self.resolution <= 0 or self.inner < 0 or self.outer <= 0:
            raise ValueError("resolution and outer radius must be above zero, the inner radius not below")


def run_dynamics(cells: DataFrame, p: Dynamics) -> dict[str, DataFrame]:
    """Log-odds of all pairs of types; with targets, also their circuit's score, deltas and best threshold."""
    radii = interaction.annulus(p.resolution, p.inner, p.outer)
    out = {"pairs": interaction.pairwise_log_odds(cells, radii)}
    if p.targets:
        deltas = materialize(interaction.leave_one_out_deltas(cells, radii, p.targets), "deltas")
        valued = cells.join(deltas.select("g", "celltype", "delta_z"), ["g", "celltype"])
        smooth = interaction.smooth(neighbours.nearest(cells, 10, with_self=True), valued, "delta_z").withColumnRenamed("delta_z", "smooth")
        both = valued.select("g", "k", "celltype", "delta_z").join(smooth, ["g", "k"])
        objectives = interaction.threshold_objective(both, p.thresholds, p.targets, p.min_cells)
        out |= {"score": interaction.circuit_scores(cells, radii, p.targets), "deltas": deltas, "neighborhoods": both, "objectives": objectives, "threshold": interaction.best_threshold(objectives)}
    return out


@dataclass
class Niches:
    """Neighbourhood analysis; without ``k2`` the number of neighbourhoods is chosen by stability."""

    k1: int = 10
    k2: int | None = None
    k2_min: int = 3
    k2_max: int | None = None
    loo_mode: str = "count"
    loo_n: float = 1
    seed: int = 42

    def __post_init__(self) -> None:
        if self.loo_mode not in ("count", "pct", "group"):
            raise ValueError(f"unknown mode {self.loo_mode}")


def run_niches(cells: DataFrame, p: Niches, conditions: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Surroundings of every cell, neighbourhoods, their composition, and the sweep that chose their number."""
    spark = cells.sparkSession
    types = sorted(r[0] for r in cells.select("celltype").distinct().collect())
    shares = niche.composition(neighbours.nearest(cells, p.k1), cells)
    matrix = materialize(niche.composition_matrix(shares, types), "niche")
    k2, sweep = p.k2, []
    if k2 is None:
        top = max(p.k2_min, min(p.k2_max or len(types) - 1, len(types) - 1))
        folds = niche.hold_out_folds(sorted(r[0] for r in cells.select("g").distinct().collect()), p.loo_mode, p.loo_n, seed=p.seed, groups=conditions)
        sweep = niche.stability_sweep(matrix, cells, list(range(p.k2_min, top + 1)), folds, p.seed)
        valid = [(s, k) for k, s in sweep if s == s]
        k2 = min(valid)[1] if valid else p.k2_min
    assigned = niche.assign_nearest(matrix, niche.fit_neighbourhoods(matrix, k2, p.seed))
    return {"assigned": assigned.select("g", "k", "neighborhood"), "composition": niche.frequencies(assigned, cells), "summary": niche.assignment_summary(assigned), "sweep": spark.createDataFrame(sweep, "k int, stability double")}


@dataclass
class Transcripts:
    """Analysis of a cell by gene table."""

    counts: tuple = (10, 50_000)
    genes: tuple = (5, 2_000)
    method: str = "lognorm"
    top_genes: int = 2_000
    cluster_k: int = 15
    resolution: float = 0.8
    enrichment_k: int = 15
    components: int = 20
    objective: str = "modularity"
    probes: int | None = None
    spatial_k: int = 10
    spatial_genes: int = 200


def run_transcripts(counts: DataFrame, cells: DataFrame, p: Transcripts) -> dict[str, DataFrame]:
    """Quality control, normalisation, variable genes, clusters, enrichment, marker and spatially variable genes.

    Clusters are communities of the graph of neighbours shared in the space of component scores of the variable genes.

    ``cells`` has ``g, k, x, y`` with ``k`` the cell of ``counts``; cells without counts or position are left out.
    """
    stats = expression.qc_keep(expression.qc_statistics(counts), p.counts, p.genes)
    kept = materialize(cells.join(stats.select(F.col("cell").alias("k")), "k", "left_semi").select("g", "k", "x", "y"), "kept")
    c = counts.join(kept.select(F.col("k").alias("cell")), "cell", "left_semi")
    values = materialize(expression.normalized(c, p.method), "values")
    genes = materialize(expression.variable_genes(values, kept.count(), p.top_genes), "genes")
    scores, _ = components.pca_scores(components.gene_vectors(values, genes), p.components)
    edges = materialize(neighbours.shared_neighbour_edges(components.nearest_vectors(scores, p.cluster_k, p.probes).withColumn("g", F.lit(0)), p.cluster_k, symmetric=True).select("src", "dst", "weight"), "edges")
    found = communities.communities(edges, p.resolution, objective=p.objective)
    labelled = materialize(kept.join(found, "k", "left").withColumn("celltype", F.coalesce(F.col("community").cast("string"), F.lit("0"))), "labelled")
    # Absent values are zeros of the cells that are there.
    every = components.gene_vectors(values, genes).select("k", F.posexplode("e").alias("at", "v")).join(F.broadcast(genes.select("gene", (F.col("rank") - 1).alias("at"))), "at")
    dense = every.join(kept.select("k", "g"), "k").select("g", "k", F.col("gene").alias("marker"), "v")
    of_cell = labelled.select(F.col("k").alias("cell"), F.col("celltype").alias("grp"))
    sizes = of_cell.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    return {
        "qc": stats,
        "variable_genes": genes,
        "spatial_genes": ranks.spatially_variable(neighbours.nearest(kept, p.spatial_k), dense, p.spatial_genes),
        "clusters": labelled,
        "enrichment": interaction.neighbour_enrichment(neighbours.nearest(kept, p.enrichment_k), labelled),
        "markers": ranks.group_markers(values.join(of_cell, "cell").select("cell", "grp", "gene", "value"), sizes),
    }


def run_curves(cells: DataFrame, radius: float = 30.0, resolution: float = 0.377, min_count: int = 10, steps: int = 500) -> dict[str, DataFrame]:
    """Pair-correlation curves of all pairs of types, long and as means over samples."""
    r = radius / resolution
    curves = materialize(pcf.pair_curves(cells, r, steps, min_count), "curves")
    long = pcf.curves_long(curves.where("curve is not null"), r, steps)
    return {"summary": curves.drop("curve"), "curves": long, "spread": pcf.curve_spread(long)}


def run_phenotyping(profiles: DataFrame, panel: DataFrame, template: DataFrame | None = None, mixture: bool = True) -> dict[str, DataFrame]:
    """Heat map, signal and sizes of clusters and, with a template, the cell types its rules give them."""
    heat = materialize(expression.cluster_heatmap(expression.marker_table(profiles, panel)), "heat")
    out = {"heatmap": heat, "signal": expression.cluster_signal(profiles), "sizes": expression.cluster_sizes(profiles)}
    if template is not None:
        levels = gating.high_low(heat) if mixture else heat
        out["labels"] = gating.gate_clusters(levels.select("cluster", "marker", "z"), gating.parse_rules(template))
    return out


def run_annotation(profiles: DataFrame, panel: DataFrame, model: annotation.Model, tissue: str | None = None, retry: int = 1, votes: int = 0, min_agreement: float = 0.6) -> dict[str, DataFrame]:
    """Clusters labelled by a language model: prompts, answers with retries and votes, labels of all cells."""
    heat = expression.cluster_heatmap(expression.marker_table(profiles, panel)).select("cluster", "marker", "z")
    signal = expression.cluster_signal(profiles)
    described = materialize(expression.elevated_reduced(heat, names=True), "elevated")
    state = annotation.state_clause(described.select("cluster", F.explode("up").alias("marker")))
    asked = materialize(annotation.prompts(described.join(state, "cluster", "left").join(signal, "cluster"), tissue), "prompts")
    answers = materialize(annotation.retry_failed(annotation.ask(asked, model), model, retry), "answers")
    if votes:
        unsure = asked.join(answers.where(F.lower("cell_type").startswith("unclassif")).select("cluster"), "cluster", "left_semi")
        drawn = [annotation.ask(unsure, model, seed=100 + i) for i in range(votes)]
        every = drawn[0]
        for d in drawn[1:]:
            every = every.unionByName(d)
        answers = annotation.override_unclassified(answers, annotation.vote(every, ["cluster"], F.col("cell_type")), min_agreement)
    labels = answers.select("cluster", F.col("cell_type").alias("label"), "confidence", "error")
    return {"prompts": asked, "answers": labels.join(signal, "cluster", "left"), "cells": gating.broadcast_labels(profiles.drop("e"), labels)}
