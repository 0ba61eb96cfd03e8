"""Queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import clusters, labels, leakage, packing, percentiles, quality, vectors
from tessella.llm.quality_examples import EXAMPLES
from tessella.llm.sql import SQL  # noqa: F401
from tessella.session import table


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """The entry of canonical_labels that each freely typed Phenotype means."""
    found = labels.map_to_list(table(spark, sf, "gemma_predictions"), "prediction_id", "Phenotype", table(spark, sf, "canonical_labels"), "label_id", ["label", "short_label"])
    return found.select(F.col("k").alias("prediction_id"), F.col("entry").alias("label_id"))


SHARES = [0.05, 0.25, 0.5, 0.75, 0.95]


def _named(spark: SparkSession, sf: str, found: DataFrame) -> DataFrame:
    return found.join(F.broadcast(table(spark, sf, "features")), "position").drop("position")  # one row per marker


def _values(spark: SparkSession, sf: str) -> DataFrame:
    return percentiles.marker_values(table(spark, sf, "normalized_expression"), table(spark, sf, "metadata_clusters"), table(spark, sf, "features"))


def p2_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    """Exact percentiles of exprs by cluster and marker."""
    found = percentiles.percentiles(_values(spark, sf), ["cluster", "position"], "v", SHARES)
    return _named(spark, sf, found).select("cluster", "marker", "n", "share", F.round("value", 6).alias("value"))


def p2_combined(spark: SparkSession, sf: str) -> DataFrame:
    """Percentiles of all days from the days' summaries, with their error bound."""
    days = percentiles.summaries(_values(spark, sf), ["cluster", "position"], "run_day", "v")
    return _named(spark, sf, percentiles.combine(days, ["cluster", "position"], "run_day", SHARES)).select("cluster", "marker", "n", "share", "value", "rank_error")


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of cells in one group of mutually similar exprs."""
    pairs = clusters.similar_pairs(table(spark, sf, "normalized_expression"), "cell_key", "exprs")
    return pairs.select(F.col("key_1").alias("cell_key_1"), F.col("key_2").alias("cell_key_2"))


def p3_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Every cell with its cluster, the cluster's size and stability, and the rank of its most typical cells."""
    found = clusters.describe_clusters(table(spark, sf, "normalized_expression"), "cell_key", "exprs")
    return found.select(F.col("k").alias("cell_key"), "cluster", "size", F.round("stability", 4).alias("stability"), "exemplar")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """The five cells with the most similar exprs for each probe cell."""
    near = vectors.most_similar(table(spark, sf, "normalized_expression"), "cell_key", "exprs", table(spark, sf, "probe_cells"), "cell_key")
    return near.select(F.least("query", "neighbour").alias("cell_key_1"), F.greatest("query", "neighbour").alias("cell_key_2")).distinct()


def p7_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Posts packed into containers of 2,048 tokens."""
    packed = packing.pack_documents(table(spark, sf, "documents"), "doc_id", "text")
    return packed.withColumnRenamed("doc", "doc_id")


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    """Posts that hold a stretch of an evaluation item's passage."""
    found = leakage.leaked_items(table(spark, sf, "documents"), "doc_id", "text", table(spark, sf, "eval_items"), "item_id", "passage")
    return found.select(F.col("item").alias("item_id"), F.col("doc").alias("doc_id"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    """Posts whose own text is mostly a list, a table or junk."""
    kinds = quality.classify(table(spark, sf, "documents"), "doc_id", "text", EXAMPLES)
    return kinds.where(F.col("kind") != "prose").select(F.col("doc").alias("doc_id"), "kind")


def p9_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """The statistics of every post's own text, with its kind."""
    return quality.classify(table(spark, sf, "documents"), "doc_id", "text", EXAMPLES).withColumnRenamed("doc", "doc_id")


QUERIES = {
    "p1_found": p1_found,
    "p2_percentiles": p2_percentiles,
    "p2_combined": p2_combined,
    "p3_found": p3_found,
    "p3_clusters": p3_clusters,
    "p5_found": p5_found,
    "p7_packing": p7_packing,
    "p8_found": p8_found,
    "p9_found": p9_found,
    "p9_statistics": p9_statistics,
}
