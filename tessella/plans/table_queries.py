"""Queries of expression, rank, niche, gating, raster, curve, annotation and set operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.functions import names, numeric
from tessella.operators import annotation, communities, components, expression, gating, neighbours, niche, pcf, ranks, raster, selection
from tessella.operators.proximity import finite
from tessella.plans.bindings import CELLS, COUNTED_CELLS, COUNTS, PROFILES, cells, counted_cells, counts, markers, profiles
from tessella.plans.spatial_queries import RADII, _knn
from tessella.session import materialize, table

# Rules of a gating template.
TEMPLATE = [(1, "Helper T", "CD3+,CD4+,CD8-"), (2, "Cytotoxic T", "CD3+,CD8+,CD4-"), (3, "B", "CD20+,CD3-"), (4, "Macrophage", "CD68+,CD3-")]


def _round(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- counts and normalisation
def qc_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Counts and genes of each cell."""
    return expression.qc_statistics(counts(spark, sf))


def qc_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Cells that pass bounds on counts, genes and area."""
    s = expression.qc_statistics(counts(spark, sf)).join(counted_cells(spark, sf), "cell")
    return expression.qc_keep(s, (10, 250), (2, 7), (1000.0, 400000.0), max_density=0.01).select("cell", "total", "genes", "cluster")


def _values(df: DataFrame) -> DataFrame:
    return df.select("cell", "gene", F.round("value", 6).alias("value"))


def normalize_lognorm(spark: SparkSession, sf: str) -> DataFrame:
    """Log-normalised counts."""
    return _values(expression.normalized(counts(spark, sf), "lognorm"))


def normalize_cp10k(spark: SparkSession, sf: str) -> DataFrame:
    """Counts per ten thousand."""
    return _values(expression.normalized(counts(spark, sf), "cp10k"))


def normalize_cellvol(spark: SparkSession, sf: str) -> DataFrame:
    """Counts by cell volume."""
    v = counted_cells(spark, sf).select("cell", F.col("area").alias("volume"))
    return _values(expression.normalized(counts(spark, sf), "cellvol", v))


def normalize_pearson(spark: SparkSession, sf: str) -> DataFrame:
    """Pearson residuals of every cell and gene."""
    return _values(expression.normalized(counts(spark, sf), "pearson"))


def hvg_variance(spark: SparkSession, sf: str) -> DataFrame:
    """The twenty genes of highest variance: a top-k report."""
    c = expression.normalized(counts(spark, sf))
    n = c.agg(F.count_distinct("cell")).first()[0]
    return _round(expression.variable_genes(c, n, 20), 6, "variance")


# --- markers of cells
def _long(spark: SparkSession, sf: str) -> DataFrame:
    return expression.marker_table(profiles(spark, sf), markers(spark, sf))


def cluster_heatmap_z(spark: SparkSession, sf: str) -> DataFrame:
    """Median of each marker by cluster as z-scores across clusters."""
    return _round(expression.cluster_heatmap(_long(spark, sf)), 5, "centre", "z")


def cluster_signal_qc(spark: SparkSession, sf: str) -> DataFrame:
    """Signal of each cluster."""
    return expression.cluster_signal(profiles(spark, sf)).select("cluster", "n", (F.round("signal", 2) + 0.0).alias("signal"), F.round("markers_high", 1).alias("markers_high"))


def cluster_tabulation(spark: SparkSession, sf: str) -> DataFrame:
    """Cells and share of each cluster."""
    return _round(expression.cluster_sizes(profiles(spark, sf)), 6, "share")


def marker_zscale(spark: SparkSession, sf: str) -> DataFrame:
    """Each marker of each cell against all cells."""
    return _round(expression.zscaled(_long(spark, sf)).select("k", "marker", "z"), 5, "z")


def marker_de(spark: SparkSession, sf: str) -> DataFrame:
    """One-vs-rest rank statistics of genes by cluster."""
    c = counts(spark, sf).join(counted_cells(spark, sf).select("cell", F.col("cluster").alias("grp")), "cell").select("cell", "grp", "gene", F.col("n").alias("value"))
    sizes = c.select("cell", "grp").distinct().groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    r = ranks.group_rank_sums(c, sizes)
    return _round(r.select("gene", "grp", "n1", "n2", "mean1", "mean2", "pct1", "pct2", "u"), 6, "mean1", "mean2", "pct1", "pct2")


def marker_bh(spark: SparkSession, sf: str) -> DataFrame:
    """Marker genes with p-values and their adjustment (no normal distribution in SQL)."""
    c = counts(spark, sf).join(counted_cells(spark, sf).select("cell", F.col("cluster").alias("grp")), "cell").select("cell", "grp", "gene", F.col("n").alias("value"))
    sizes = c.select("cell", "grp").distinct().groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    return ranks.group_markers(c, sizes).select("gene", "grp", *[F.round(x, 6).alias(x) for x in ("avg_log2FC", "p_val", "p_adj")])


def bh_adjustment(spark: SparkSession, sf: str) -> DataFrame:
    """Benjamini-Hochberg over the model's doubts (one minus confidence), by cluster; some confidences are in percent."""
    c = F.when(F.col("confidence") > 1, F.col("confidence") / 100).otherwise(F.col("confidence"))
    p = table(spark, sf, "gemma_predictions").where(F.col("confidence").isNotNull()).groupBy("cluster_id", "prediction_id").agg(F.min(1 - c).alias("p"))
    return p.select("cluster_id", "prediction_id", F.round(ranks.adjusted(F.col("p"), "cluster_id"), 9).alias("p_adj"))


def _types(c: DataFrame) -> list[str]:
    return sorted(r[0] for r in c.select("celltype").distinct().collect())  # types of cells: a few


def morans_i(spark: SparkSession, sf: str) -> DataFrame:
    """Spatial autocorrelation of being each type of cell, over ten neighbours."""
    c = cells(spark, sf)
    v = c.select("g", "k", F.explode(F.array(*[F.struct(F.lit(t).alias("marker"), (F.col("celltype") == t).cast("double").alias("v")) for t in _types(c)])).alias("m")).select("g", "k", "m.marker", "m.v")
    r = ranks.morans_i(neighbours.nearest(c, 10), v)
    return r.select(F.col("g").alias("sample"), "marker", F.round("i", 5).alias("i"), F.round("z", 3).alias("z"))


def ks_dplus(spark: SparkSession, sf: str) -> DataFrame:
    """Excess of one type's positions over another's."""
    return _round(ranks.distribution_distance(cells(spark, sf), "celltype", "x", "B Cell", "Tumor Cell"), 6, "d_plus")


# --- gating and prompts
def _levels(spark: SparkSession, sf: str) -> DataFrame:
    return expression.cluster_heatmap(_long(spark, sf)).select("cluster", "marker", "z")


def template_gating(spark: SparkSession, sf: str) -> DataFrame:
    """Types of clusters by rules over z-scores."""
    return gating.gate_clusters(_levels(spark, sf), gating.parse_rules(spark.createDataFrame(TEMPLATE, "place int, celltype string, markers string")))


def template_gating_mixture(spark: SparkSession, sf: str) -> DataFrame:
    """Types of clusters by rules over a two-component mixture of each marker."""
    return gating.gate_clusters(gating.high_low(_levels(spark, sf)), gating.parse_rules(spark.createDataFrame(TEMPLATE, "place int, celltype string, markers string")))


def prompt_elevated_reduced(spark: SparkSession, sf: str) -> DataFrame:
    """Markers that stand out in each cluster's profile."""
    return expression.elevated_reduced(_levels(spark, sf))


def state_markers(spark: SparkSession, sf: str) -> DataFrame:
    """Elevated markers of each cluster that report a state, with their role."""
    up = expression.elevated_reduced(_levels(spark, sf), names=True).select("cluster", F.explode("up").alias("marker"))
    return annotation.state_clause(up)


def ontology_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """Prompts that list each cluster's mean of every marker, with rules still to be filled in."""
    panel = markers(spark, sf)
    names_ = [r["marker"] for r in panel.orderBy("position").collect()]  # one row per marker
    v = expression.marker_table(profiles(spark, sf), panel).join(F.broadcast(panel), "marker").withColumnRenamed("position", "place")
    return annotation.listing_prompts(v, "cluster", annotation.ontology_text(names_), "means")


def glossary_clause(spark: SparkSession, sf: str) -> DataFrame:
    """Glossary entries of each cluster's markers: the reference list's short names as a glossary."""
    g = table(spark, sf, "canonical_labels").where(F.col("short_label").isNotNull()).select(F.col("short_label").alias("marker"), F.col("label").alias("gloss"))
    p = table(spark, sf, "gemma_predictions").where(F.col("cluster_id").isNotNull() & F.col("Phenotype").isNotNull()).select(F.col("cluster_id").alias("cluster"), F.col("Phenotype").alias("marker"))
    return annotation.glossary_clause(p.where(names.marker_key(F.col("marker")) != ""), g.where(names.marker_key(F.col("marker")) != "")).select("cluster", F.length("clause").alias("chars"), "clause")


def cluster_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """The prompt of each cluster."""
    e = materialize(expression.elevated_reduced(_levels(spark, sf), names=True), "elevated")
    state = annotation.state_clause(e.select("cluster", F.explode("up").alias("marker")))
    e = e.join(state, "cluster", "left").join(expression.cluster_signal(profiles(spark, sf)), "cluster")
    return annotation.prompts(e, tissue="tonsil", scale="z-scores across clusters")


def annotated_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters annotated by a stand-in model that names the first elevated marker; failures are asked again."""

    def model(asked: list[str], seed: int) -> list[str | None]:
        import re

        out: list[str | None] = []
        for p in asked:
            m = re.search(r"profile: ([A-Za-z0-9_]+)=", p)
            out.append(None if m is None and seed == 0 else f'```json\n{{"cell_type": "{m.group(1) if m else "Unclassified"} cell", "confidence": 0.9}}\n```')
        return out

    return annotation.retry_failed(annotation.ask(cluster_prompts(spark, sf), model), model).select("cluster", "cell_type", "confidence", "error")


def _votes(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "gemma_predictions").where(F.col("sample_id").isNotNull() & F.col("cluster_id").isNotNull())
    return p.groupBy("prediction_id").agg(*[F.min(c).alias(c) for c in ("sample_id", "cluster_id", "Phenotype")])


def vote_mode(spark: SparkSession, sf: str) -> DataFrame:
    """The label most predictions of a cluster agree on."""
    v = annotation.vote(_votes(spark, sf), ["sample_id", "cluster_id"], F.col("Phenotype"))
    return v.select("sample_id", "cluster_id", "top", F.round("agreement", 6).alias("agreement"), "n", "detail")


def harmonize_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions by canonical name where their label is a short one."""
    m = table(spark, sf, "canonical_labels").where(F.col("short_label").isNotNull()).select(F.col("short_label").alias("raw"), F.col("label").alias("canonical"))
    h = annotation.harmonized(_votes(spark, sf).where(F.col("Phenotype").isNotNull()).select(F.trim("Phenotype").alias("label")), "label", m)
    return h.groupBy("harmonized").agg(F.count(F.lit(1)).alias("n"))


def json_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Fields of JSON properties, tolerant of what is no JSON."""
    v = F.expr("try_variant_get(try_parse_json(props), '$.k', 'bigint')")
    return table(spark, sf, "events").select("event_type", v.alias("v")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("with_k"), F.sum("v").alias("total"))


def label_join_signal(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions of each cluster beside the cluster's signal; clusters without signal stay."""
    v = table(spark, sf, "gemma_predictions").where(F.col("cluster_id").isNotNull()).groupBy(F.col("cluster_id").alias("cluster")).agg(F.count_distinct("prediction_id").alias("predictions"))
    return v.join(expression.cluster_signal(profiles(spark, sf)).select("cluster", F.col("n").alias("cells"), (F.round("signal", 2) + 0.0).alias("signal")), "cluster", "left")


# --- niches
def niche_composition(spark: SparkSession, sf: str) -> DataFrame:
    """Types among the ten nearest cells of every cell."""
    c = cells(spark, sf)
    return niche.composition(neighbours.nearest(c, 10), c).select(F.col("g").alias("sample"), "k", "celltype", F.round("share", 6).alias("share"))


def _assigned(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    c = cells(spark, sf)
    types = _types(c)
    m = niche.composition_matrix(niche.composition(neighbours.nearest(c, 10), c), types)
    return niche.assign_nearest(m, [[float(i == j) for i in range(len(types))] for j in range(len(types))]), c


def nearest_centroid(spark: SparkSession, sf: str) -> DataFrame:
    """The nearest of the centres that each are all of one type, for every cell's surroundings."""
    return _assigned(spark, sf)[0].select("k", "neighborhood")


def niche_frequency(spark: SparkSession, sf: str) -> DataFrame:
    """Types within each neighbourhood."""
    a, c = _assigned(spark, sf)
    return _round(niche.frequencies(a, c), 6, "share")


def assignment_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Cells by sample and neighbourhood."""
    return niche.assignment_summary(_assigned(spark, sf)[0]).withColumnRenamed("g", "sample")


def kmeans_neighborhoods(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbourhoods found by k-means over all cells' surroundings, of all types."""
    c = cells(spark, sf)
    m = materialize(niche.composition_matrix(niche.composition(neighbours.nearest(c, 10), c), _types(c)), "niche")
    return niche.assignment_summary(niche.assign_nearest(m, niche.fit_neighbourhoods(m, 4)))


def _scores(spark: SparkSession, sf: str, components_: int = 10) -> DataFrame:
    return components.pca_scores(profiles(spark, sf).select("k", "e"), components_)[0]


def pca_variance(spark: SparkSession, sf: str) -> DataFrame:
    """Variance of the cells' scores on each principal component, all of them, and their share."""
    v = _scores(spark, sf, 32).select(F.posexplode("v").alias("i", "s")).groupBy((F.col("i") + 1).alias("component")).agg(F.var_samp("s").alias("variance"))
    return _round(v.withColumn("share", F.col("variance") / F.sum("variance").over(Window.partitionBy())), 6, "variance", "share")  # one row a component


def pca_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Every cell's length in the space of all components: that of its standardized profile, whatever the axes are."""
    return _scores(spark, sf, 32).select("k", F.round(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)), 5).alias("length"))


def _expression_knn(spark: SparkSession, sf: str) -> DataFrame:
    return components.nearest_vectors(profiles(spark, sf).select("k", F.col("e").alias("v")), 10)


def expression_knn(spark: SparkSession, sf: str) -> DataFrame:
    """The ten cells of the most similar profile (Euclidean) for every cell, over all samples."""
    return _expression_knn(spark, sf).select("src", "dst", F.round("d", 6).alias("d"), "rank")


def expression_snn(spark: SparkSession, sf: str) -> DataFrame:
    """Edges between similar profiles, weighted by shared neighbours."""
    e = components.shared_neighbours(profiles(spark, sf).select("k", F.col("e").alias("v")), 10)
    return e.select("src", "dst", F.round("weight", 6).alias("weight"))


def leiden_communities(spark: SparkSession, sf: str) -> DataFrame:
    """Communities of the shared-neighbour graph of the cells' component scores, with the clusters they are made of."""
    e = components.shared_neighbours(_scores(spark, sf), 10, symmetric=True)
    found = communities.communities(e).join(profiles(spark, sf).select("k", "cluster"), "k")
    return found.groupBy("community", "cluster").agg(F.count(F.lit(1)).alias("n"))


def resolution_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """Communities at each resolution that finds more of them than the ones below it."""
    e = components.shared_neighbours(_scores(spark, sf), 10, symmetric=True)
    return communities.resolution_sweep(e, [0.25, 1.0])[0].groupBy("resolution", "community").agg(F.count(F.lit(1)).alias("n"))


# --- choosing rows
def single_type_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Deliveries whose phenotype names exactly one of the two lineages."""
    c = table(spark, sf, "cell_seg_data")
    return c.where(selection.matches_one(F.col("Phenotype"), ["T Cell", "CD8"])).select("cell_key", F.col("Phenotype").alias("phenotype"))


def recoded_types(spark: SparkSession, sf: str) -> DataFrame:
    """Cells by target type; those of none are counted as else."""
    t = selection.recoded(F.col("celltype"), ["T Cell", "CD8 T Cell", "Tumor"])
    return cells(spark, sf).groupBy(F.col("g").alias("sample"), t.alias("target")).agg(F.count(F.lit(1)).alias("n"))


def sample_conditions(spark: SparkSession, sf: str) -> DataFrame:
    """The first filled condition of each sample, by time of registration."""
    return selection.first_filled(table(spark, sf, "sample_manifest"), "sample_id", "condition", ["registered_at"])


# --- sets, pairs of types, curves
def shared_phenotypes(spark: SparkSession, sf: str) -> DataFrame:
    """Types found in every sample."""
    c = cells(spark, sf)
    n = c.select(F.count_distinct("g").alias("n"))
    return c.groupBy("celltype").agg(F.count_distinct("g").alias("samples")).crossJoin(F.broadcast(n)).where(F.col("samples") == F.col("n")).select("celltype", "samples")  # one row


def pair_grid_skips(spark: SparkSession, sf: str) -> DataFrame:
    """Unordered pairs of types, with those of too few cells."""
    return pcf.pair_grid(cells(spark, sf), 30).withColumnRenamed("g", "sample")


def pair_distance_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of types by distance."""
    return pcf.distance_histogram(cells(spark, sf), 80.0, 16).withColumnRenamed("g", "sample")


def pair_effect_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """How much nearer a type lies to a reference type than cells of any type do."""
    return _round(pcf.pair_effect_sizes(cells(spark, sf), 80.0, 40), 6, "effect").withColumnRenamed("g", "sample")


def pcf_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Sum, normalization and counts of every pair's curve (a kernel estimate: no SQL)."""
    c = materialize(cells(spark, sf), "cells")
    found = pcf.curve_summary(c, materialize(pcf.pair_curves(c, 80.0, 100), "curves"))
    return _round(found.select(F.col("g").alias("sample"), "ref", "query", "n_ref", "n_query", "min_count", "skipped", "normalization", "pcf_sum"), 4, "normalization", "pcf_sum")


def spatial_markers(spark: SparkSession, sf: str) -> DataFrame:
    """Spatial autocorrelation of the types of highest variance in each sample, with adjusted p-values (no normal distribution in SQL)."""
    c = cells(spark, sf)
    v = c.select("g", "k", F.explode(F.array(*[F.struct(F.lit(t).alias("marker"), (F.col("celltype") == t).cast("double").alias("v")) for t in _types(c)])).alias("m")).select("g", "k", "m.marker", "m.v")
    return _round(ranks.spatially_variable(neighbours.nearest(c, 10), v, 200).withColumnRenamed("g", "sample"), 6, "i", "z", "p", "p_adj")


def pcf_curves(spark: SparkSession, sf: str) -> DataFrame:
    """Mean pair-correlation curves over samples (a kernel estimate: no SQL)."""
    curves = pcf.pair_curves(cells(spark, sf), 80.0, 100)
    return _round(pcf.curve_spread(pcf.curves_long(curves.where("curve is not null"), 80.0, 100)), 6, "r", "mean", "variance")


def composition_by_condition(spark: SparkSession, sf: str) -> DataFrame:
    """Types by condition of the sample, from the manifest; samples it does not have are 'unknown'."""
    m = table(spark, sf, "sample_manifest").groupBy(F.col("sample_id").alias("g")).agg(F.min(F.lower(F.trim("condition"))).alias("condition"))
    c = cells(spark, sf).join(m, "g", "left").select(F.coalesce(F.when(F.col("condition") != "", F.col("condition")), F.lit("unknown")).alias("condition"), "celltype")
    return c.groupBy("condition", "celltype").agg(F.count(F.lit(1)).alias("n"))


def vocabulary_union(spark: SparkSession, sf: str) -> DataFrame:
    """Types of the cells and of the reference list, and where each is found."""
    a = cells(spark, sf).select("celltype").distinct().withColumn("side", F.lit("cells"))
    b = table(spark, sf, "canonical_labels").select(F.col("label").alias("celltype"), F.lit("list").alias("side"))
    return a.unionByName(b).groupBy("celltype").agg(F.array_join(F.array_sort(F.collect_set("side")), "+").alias("sides"))


# --- rasters
def mask_disk_pixels(spark: SparkSession, sf: str) -> DataFrame:
    """Pixels covered by each type's disks."""
    return raster.mask_pixels(cells(spark, sf), raster.disk_offsets(2), ["g", "celltype"]).withColumnRenamed("g", "sample")


def region_props(spark: SparkSession, sf: str) -> DataFrame:
    """Centroid and area of each type's mask."""
    p = raster.mask_pixels(cells(spark, sf), raster.disk_offsets(1), ["g", "celltype"]).withColumn("label", F.concat_ws("/", "g", "celltype"))
    return _round(raster.region_properties(p, "label", 5), 5, "y", "x")


def crop_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Bounding box of each sample's cells."""
    return raster.crop_box(cells(spark, sf), ["g"]).withColumnRenamed("g", "sample")


# --- scalar functions
def name_functions(spark: SparkSession, sf: str) -> DataFrame:
    """Names and numbers in their usual forms, for every cell of metadata_clusters."""
    m = table(spark, sf, "metadata_clusters").where(finite("x")).select("cell_key", "cell_area", "x", "cluster", "sample_id").distinct()
    return m.select("cell_key", names.cell_label(F.col("cell_key") % 100000).alias("label"), names.marker_key(F.col("sample_id")).alias("sample_key"), names.safe_name(F.coalesce("cluster", F.lit(" "))).alias("safe"), numeric.half_even(F.col("x")).alias("x_round"), F.round(numeric.clipped(F.col("cell_area"), 10.0, 200.0), 4).alias("area"))


QUERIES = {
    f.__name__: f
    for f in (
        single_type_rows, recoded_types, sample_conditions, qc_stats, qc_filter, normalize_lognorm, normalize_cp10k, normalize_cellvol, normalize_pearson, hvg_variance, cluster_heatmap_z, cluster_signal_qc, cluster_tabulation, marker_zscale, marker_de, marker_bh,
        bh_adjustment, morans_i, ks_dplus, template_gating, template_gating_mixture, prompt_elevated_reduced, state_markers, ontology_prompts, glossary_clause, cluster_prompts, annotated_clusters, vote_mode, harmonize_labels, json_extract, label_join_signal,
        niche_composition, nearest_centroid, niche_frequency, assignment_summary, kmeans_neighborhoods, pca_variance, pca_scores, expression_knn, expression_snn, leiden_communities, resolution_sweep, shared_phenotypes, pair_grid_skips, pair_distance_histogram, pair_effect_sizes, pcf_summary, spatial_markers, pcf_curves,
        composition_by_condition, vocabulary_union, mask_disk_pixels, region_props, crop_boxes, name_functions,
    )
}

_EACH = "select cell, gene, round(value, 6) as value from v"
_LONG = f"{PROFILES}, long as (select k, g, cluster, marker, v from (select k, g, cluster, unnest(e) as v, unnest(range(32)) as position from profiles) join features using (position))"
_HEAT = f"""{_LONG},
c0 as (select cluster, marker, median(v) as median, avg(v) as mean from long group by 1, 2),
c1 as (select cluster, marker, case when max(abs(median)) over (partition by marker) = 0 then mean else median end as centre from c0),
heat as (select cluster, marker, centre, greatest(-5, least(5, (centre - avg(centre) over (partition by marker)) / nullif(stddev_samp(centre) over (partition by marker), 0))) as z from c1)"""
_NICHE = f"""{CELLS}, {_knn(10)},
comp as (select n.g, n.src as k, c.celltype, count(*) / max(t.n)::double as share
  from knn n join cells c on c.k = n.dst join (select src, count(*) as n from knn group by 1) t on t.src = n.src group by 1, 2, 3),
types as (select celltype, row_number() over (order by celltype) as place from (select distinct celltype from cells)),
assigned as (select comp.g, k, arg_min(place, {{'a': -share, 'b': place}})::int as neighborhood from comp join types using (celltype) group by 1, 2)"""
_EKNN = """eknn as (
  select a.k as src, b.k as dst, list_distance(a.e, b.e) as d, row_number() over (partition by a.k order by list_distance(a.e, b.e), b.k) as rank
  from profiles a join profiles b on a.k <> b.k qualify rank <= 10)"""
_VOTES = "votes as (select prediction_id, min(sample_id) as sample_id, min(cluster_id) as cluster_id, min(\"Phenotype\") as label from gemma_predictions where sample_id is not null and cluster_id is not null group by 1)"
_DISK = lambda r: ", ".join(f"({x}, {y})" for x, y in raster.disk_offsets(r))
_PIXELS = lambda r: f"""{CELLS}, o(dx, dy) as (values {_DISK(r)}), big as (select g, celltype from cells group by 1, 2 having count(*) >= 2),
pix as (select distinct g, celltype, trunc(x)::int + dx as px, trunc(y)::int + dy as py from cells join big using (g, celltype), o where trunc(x)::int + dx >= 0 and trunc(y)::int + dy >= 0)"""  # noqa: E731
_RULES = "rules(place, celltype, marker, sign) as (values " + ", ".join(f"({p}, '{t}', '{m[:-1]}', '{m[-1]}')" for p, t, rs in TEMPLATE for m in rs.split(",")) + ")"

SQL = {
    "qc_stats": f"with {COUNTS} select cell, sum(n) as total, count(*) filter (where n > 0) as genes from counts group by cell",
    "qc_filter": f"""
with {COUNTS}, {COUNTED_CELLS}, s as (select cell, sum(n) as total, count(*) filter (where n > 0) as genes from counts group by cell)
select cell, total, genes, cluster from s join counted_cells using (cell)
where total between 10 and 250 and genes between 2 and 7 and area between 1000 and 400000 and total / (area + 1e-10) <= 0.01""",
    "normalize_lognorm": f"with {COUNTS}, v as (select cell, gene, ln(1 + n / (sum(n) over (partition by cell)) * 1e4) as value from counts) {_EACH}",
    "normalize_cp10k": f"with {COUNTS}, v as (select cell, gene, n / (sum(n) over (partition by cell)) * 1e4 as value from counts) {_EACH}",
    "normalize_cellvol": f"with {COUNTS}, {COUNTED_CELLS}, v as (select cell, gene, ln(1 + n / case when area > 0 then area else 1e-6 end * (select median(case when area > 0 then area else 1e-6 end) from counted_cells)) as value from counts join counted_cells using (cell)) {_EACH}",
    "normalize_pearson": f"""
with {COUNTS}, lib as (select cell, sum(n) as lib from counts group by 1), genes as (select gene, sum(n) as of_gene from counts group by 1),
grid as (select cell, gene, lib * of_gene / (select sum(n) from counts) as mu from lib, genes),
r as (select cell, gene, (coalesce(n, 0) - mu) / sqrt(mu + mu * mu / 100) as r, sqrt((select count(*) from lib)) as bound from grid left join counts using (cell, gene)),
v as (select cell, gene, greatest(-bound, least(bound, r)) as value from r) {_EACH}""",
    "hvg_variance": f"""
with {COUNTS}, v as (select cell, gene, ln(1 + n / (sum(n) over (partition by cell)) * 1e4) as value from counts), c as (select count(distinct cell) as n from counts),
s as (select gene, (sum(value * value) - sum(value) * sum(value) / (select n from c)) / ((select n from c) - 1) as variance from v group by 1)
select gene, round(variance, 6) as variance, (row_number() over (order by variance desc, gene))::int as rank from s order by variance desc, gene limit 20""",
    "cluster_heatmap_z": f"with {_HEAT} select cluster, marker, round(centre, 5) as centre, round(z, 5) as z from heat",
    "cluster_signal_qc": f"with {PROFILES} select cluster, count(*) as n, round(round(avg(list_avg(e)), 3), 2) + 0.0 as signal, round(round(avg(len(list_filter(e, lambda x: x > 1))), 2), 1) as markers_high from profiles group by 1",
    "cluster_tabulation": f"with {PROFILES} select cluster, count(*) as n, round(count(*) / sum(count(*)) over (), 6) as share from profiles group by 1",
    "marker_zscale": f"with {_LONG}, s as (select marker, avg(v) as m, stddev_samp(v) as s from long group by 1) select k, marker, round((v - m) / s, 5) as z from long join s using (marker) where s > 0",
    "marker_de": f"""
with {COUNTS}, {COUNTED_CELLS}, c as (select cell, cluster as grp, gene, n as value from counts join counted_cells using (cell)),
cl as (select distinct cell, grp from c), dense as (select cl.cell, cl.grp, g.gene, coalesce(c.value, 0) as value from cl cross join (select distinct gene from c) g left join c on c.cell = cl.cell and c.gene = g.gene),
r as (select *, rank() over (partition by gene order by value) + (count(*) over (partition by gene, value) - 1) / 2.0 as rk from dense),
a as (select gene, count(*) as n, sum(value) as s, sum((value > 0)::int) as p from r group by 1),
b as (select gene, grp, count(*) as n1, sum(value) as s1, sum((value > 0)::int) as p1, sum(rk) as r1 from r group by 1, 2)
select gene, grp, n1, n - n1 as n2, round(s1 / n1, 6) as mean1, round((s - s1) / (n - n1), 6) as mean2, round(p1 / n1, 6) as pct1, round((p - p1) / (n - n1), 6) as pct2, (r1 - n1 * (n1 + 1) / 2.0)::double as u
from b join a using (gene) where n1 >= 3 and n - n1 >= 3""",
    "bh_adjustment": """
with p as (select cluster_id, prediction_id, min(1 - case when confidence > 1 then confidence / 100 else confidence end) as p from gemma_predictions where confidence is not null group by 1, 2),
r as (select *, p * count(*) over (partition by cluster_id) / row_number() over (partition by cluster_id order by p) as q, row_number() over (partition by cluster_id order by p) as rk from p),
a as (select cluster_id, prediction_id, round(least(1.0, min(q) over (partition by cluster_id order by rk rows between current row and unbounded following)), 9) as p_adj from r)
select cluster_id, prediction_id, p_adj from a""",
    "morans_i": f"""
with {CELLS}, {_knn(10)}, m as (select distinct celltype as marker from cells),
v as (select g, k, marker, (celltype = marker)::int::double as v from cells, m),
s as (select g, marker, avg(v) as m, sum(v * v) - count(*) * avg(v) * avg(v) as ss, count(*) as n from v group by 1, 2),
e as (select g, src, dst, 1 / (d + 1e-6) as w from knn), t as (select g, sum(w) as total from e group by 1),
x as (select e.g, b.marker, sum(w * (b.v - s.m)) as num from e join v b on b.k = e.dst join s on s.g = e.g and s.marker = b.marker group by 1, 2),
i as (select s.g, s.marker, s.n, case when ss < 1e-15 then 0.0 else s.n * num / (total * ss) end as i from s join x on x.g = s.g and x.marker = s.marker join t on t.g = s.g)
select g as sample, marker, round(i, 5) as i, round((i + 1.0 / (n - 1)) / (0.5 / sqrt(n)), 3) as z from i""",
    "ks_dplus": f"""
with {CELLS}, s as (select x, count(*) filter (where celltype = 'B Cell') as a, count(*) filter (where celltype = 'Tumor Cell') as b from cells where celltype in ('B Cell', 'Tumor Cell') group by 1),
e as (select sum(a) over (order by x) / sum(a) over () - sum(b) over (order by x) / sum(b) over () as e from s) select round(greatest(max(e), 0.0), 6) as d_plus from e""",
    "template_gating": f"""
with {_HEAT}, {_RULES}, cl as (select distinct cluster from heat),
ok as (select c.cluster, r.place, r.celltype, bool_and(coalesce(case when r.sign = '+' then h.z > 0 else h.z < 0 end, false)) as ok from cl c cross join rules r left join heat h on h.cluster = c.cluster and h.marker = r.marker group by 1, 2, 3)
select c.cluster, coalesce(string_agg(ok.celltype, ',' order by ok.place) filter (where ok.ok), 'Unannotated') as label from cl c left join ok on ok.cluster = c.cluster group by 1""",
    "prompt_elevated_reduced": f"""
with {_HEAT}, q as (select cluster, quantile_cont(z, 0.9) as hi, quantile_cont(z, 0.1) as lo from heat group by 1)
select cluster, coalesce(string_agg(marker || '=' || printf('%+.2f', z), ', ' order by z desc, marker) filter (where z > hi and z >= 0.5), '') as elevated,
  coalesce(string_agg(marker || '=' || printf('%+.2f', z), ', ' order by z, marker) filter (where z < lo), '') as reduced
from heat join q using (cluster) group by 1""",
    "single_type_rows": """
select cell_key, "Phenotype" as phenotype from cell_seg_data where (contains("Phenotype", 'T Cell'))::int + (contains("Phenotype", 'CD8'))::int = 1""",
    "recoded_types": f"""
with {CELLS} select g as sample, case when contains(celltype, 'Tumor') then 'Tumor' when contains(celltype, 'CD8 T Cell') then 'CD8 T Cell' when contains(celltype, 'T Cell') then 'T Cell' else 'else' end as target, count(*) as n
from cells group by 1, 2""",
    "sample_conditions": """
select sample_id, arg_min(trim(condition), (registered_at, condition)) as condition from sample_manifest where trim(condition) <> '' and sample_id is not null group by 1""",
    "state_markers": f"""
with {_HEAT}, q as (select cluster, quantile_cont(z, 0.9) as hi from heat group by 1),
up as (select cluster, marker, upper(regexp_replace(marker, '[^A-Za-z0-9]', '', 'g')) as key from heat join q using (cluster) where z > hi and z >= 0.5),
roles as (select * from (values {", ".join(f"({i}, '{r}', '{m}')" for i, (r, of) in enumerate(annotation.STATE_ROLES.items()) for m in of)}) t(place, role, key))
select cluster, string_agg(marker || ' (' || role || ')', ', ' order by place, marker) as state from up join roles using (key) group by 1""",
    "ontology_prompts": f"""
with {PROFILES}, long as (select cluster, unnest(e) as v, unnest(range(32)) as position from profiles),
m as (select cluster, position, avg(v) as v from long group by 1, 2),
rules as (select string_agg(marker || '+ -> ?', ' | ' order by position) || ' | Other -> Other' as rules from features)
select cluster, 'Markers (means): ' || string_agg(marker || '=' || printf('%.3f', m.v), ', ' order by position) || '. Choose the type by these rules: ' || any_value(rules) || '.' as prompt
from m join features using (position) cross join rules group by 1""",
    "glossary_clause": """
with g as (select upper(regexp_replace(short_label, '[^A-Za-z0-9]', '', 'g')) as key, label as gloss from canonical_labels where short_label is not null),
p as (select distinct cluster_id as cluster, "Phenotype" as marker, upper(regexp_replace("Phenotype", '[^A-Za-z0-9]', '', 'g')) as key from gemma_predictions where cluster_id is not null and "Phenotype" is not null),
c as (select cluster, string_agg(marker || ': ' || gloss, '; ' order by marker || ': ' || gloss) as clause from p join g using (key) where key <> '' group by 1)
select cluster, length(clause)::int as chars, clause from c""",
    "vote_mode": f"""
with {_VOTES}, c as (select sample_id, cluster_id, lower(trim(label, ' ')) as l, count(*) as c from votes where trim(label, ' ') <> '' group by 1, 2, 3),
r as (select *, row_number() over (partition by sample_id, cluster_id order by c desc, l) as r, sum(c) over (partition by sample_id, cluster_id) as n from c)
select sample_id, cluster_id, max(case when r = 1 then l end) as top, round(max(case when r = 1 then c / n end), 6) as agreement, max(n)::bigint as n, string_agg(l || ':' || c, ', ' order by r) as detail from r group by 1, 2""",
    "harmonize_labels": f"with {_VOTES} select coalesce(c.label, trim(v.label, ' ')) as harmonized, count(*) as n from votes v left join canonical_labels c on c.short_label = trim(v.label, ' ') where v.label is not null group by 1",
    "json_extract": "select event_type, count(*) as n, count(try_cast(json_extract(props, '$.k') as bigint)) as with_k, sum(try_cast(json_extract(props, '$.k') as bigint))::bigint as total from events group by 1",
    "label_join_signal": f"""
with {PROFILES}, v as (select cluster_id as cluster, count(distinct prediction_id) as predictions from gemma_predictions where cluster_id is not null group by 1)
select v.cluster, predictions, cells, signal from v left join (select cluster, count(*) as cells, round(round(avg(list_avg(e)), 3), 2) + 0.0 as signal from profiles group by 1) p on p.cluster = v.cluster""",
    "niche_composition": f"with {_NICHE} select g as sample, k, celltype, round(share, 6) as share from comp",
    "nearest_centroid": f"with {_NICHE} select k, neighborhood from assigned",
    "niche_frequency": f"with {_NICHE}, f as (select neighborhood, celltype, count(*) as n from assigned join cells using (k) group by 1, 2) select neighborhood, celltype, n, round(n / sum(n) over (partition by neighborhood), 6) as share from f",
    "assignment_summary": f"with {_NICHE} select g as sample, neighborhood, count(*) as n_cells from assigned group by 1, 2",
    "pca_scores": f"with {_LONG}, z as (select k, (v - avg(v) over (partition by marker)) / nullif(stddev_samp(v) over (partition by marker), 0) as z from long) select k, round(sqrt(sum(coalesce(z, 0) * coalesce(z, 0))), 5) as length from z group by k",
    "expression_knn": f"with {PROFILES}, {_EKNN} select src, dst, round(d, 6) as d, rank::int as rank from eknn",
    "expression_snn": f"""
with {PROFILES}, {_EKNN}
select e.src, e.dst, round(count(*) / 10.0, 6) as weight from eknn e join eknn a on a.src = e.src join eknn b on b.src = e.dst and b.dst = a.dst where e.dst > e.src group by 1, 2""",
    "shared_phenotypes": f"with {CELLS} select celltype, count(distinct g) as samples from cells group by 1 having count(distinct g) = (select count(distinct g) from cells)",
    "pair_grid_skips": f"""
with {CELLS}, s as (select g, celltype, count(*) as n, row_number() over (partition by g order by celltype) as p from cells group by 1, 2), e as (select * from s union all select g, 'All', sum(n)::bigint, 0 from s group by g)
select a.g as sample, a.celltype as ref, b.celltype as query, a.n as n_ref, b.n as n_query, (a.p > 0 and a.n < 30) or (b.p > 0 and b.n < 30) as skipped from e a join e b on a.g = b.g and a.p <= b.p""",
    "pair_distance_histogram": f"""
with {CELLS}, p as (select a.g, least(a.celltype, b.celltype) as ref, greatest(a.celltype, b.celltype) as query, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) as d from cells a join cells b on a.g = b.g and a.k < b.k)
select g as sample, ref, query, floor(d / 5.0)::int as bin, count(*) as pairs from p where d > 0 and d < 80 group by 1, 2, 3, 4""",
    "pair_effect_sizes": f"""
with {CELLS}, p as (select a.g, a.celltype as ref, b.celltype as query, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) as d from cells a join cells b on a.g = b.g and a.k <> b.k),
h as (select g, ref, query, floor(d / 2.0)::int as bin, count(*) as pairs from p where d > 0 and d < 80 group by 1, 2, 3, 4),
s as (select g, ref, query, sum(pairs) as every from h group by 1, 2, 3), b as (select unnest(range(40)) as bin),
f as (select s.g, s.ref, s.query, b.bin, every, sum(coalesce(h.pairs, 0)) over (partition by s.g, s.ref, s.query order by b.bin) / every as own
  from s cross join b left join h on h.g = s.g and h.ref = s.ref and h.query = s.query and h.bin = b.bin),
t as (select g, ref, bin, sum(own * every) / sum(every) as f from f group by 1, 2, 3)
select f.g as sample, f.ref, f.query, max(every)::bigint as pairs, round(greatest(max(own - f), 0.0), 6) as effect from f join t on t.g = f.g and t.ref = f.ref and t.bin = f.bin group by 1, 2, 3""",
    "composition_by_condition": f"""
with {CELLS}, m as (select sample_id as g, min(lower(trim(condition, ' '))) as condition from sample_manifest group by 1)
select coalesce(case when condition <> '' then condition end, 'unknown') as condition, celltype, count(*) as n from cells left join m using (g) group by 1, 2""",
    "vocabulary_union": f"with {CELLS}, a as (select distinct celltype, 'cells' as side from cells union all select label, 'list' from canonical_labels) select celltype, string_agg(distinct side, '+' order by side) as sides from a group by 1",
    "mask_disk_pixels": f"with {_PIXELS(2)} select g as sample, celltype, px, py from pix",
    "region_props": f"with {_PIXELS(1)} select g || '/' || celltype as label, round(avg(py), 5) as y, round(avg(px), 5) as x, count(*) as area from pix group by 1 having count(*) >= 5",
    "crop_boxes": f"with {CELLS} select g as sample, trunc(min(x))::int as x0, trunc(min(y))::int as y0, trunc(max(x))::int + 1 as x1, trunc(max(y))::int + 1 as y1 from cells group by 1",
    "name_functions": """
with m as (select distinct cell_key, cell_area, x, cluster, sample_id from metadata_clusters where isfinite(x))
select cell_key, 'C' || lpad((cell_key % 100000)::varchar, 7, '0') as label, upper(regexp_replace(sample_id, '[^A-Za-z0-9]', '', 'g')) as sample_key, regexp_replace(coalesce(cluster, ' '), '[^A-Za-z0-9_.-]+', '_', 'g') as safe,
  round_even(x, 0) as x_round, round(case when cell_area < 10 then 10 when cell_area > 200 then 200 else cell_area end, 4) as area from m""",
}
