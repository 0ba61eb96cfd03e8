"""The test tables as tables of cells, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators.proximity import located
from tessella.session import table


def cells(spark: SparkSession, sf: str) -> DataFrame:
    """``g, k, x, y, celltype`` of cell_seg_data: one row per cell with a sample, a finite position and a phenotype."""
    c = located(table(spark, sf, "cell_seg_data"), "cell_key", "Cell X Position", "Cell Y Position", "Sample Name", {"celltype": "Phenotype"})
    c = c.withColumn("celltype", F.trim("celltype")).where(F.col("celltype") != "")
    return c.groupBy("k").agg(*[F.min(v).alias(v) for v in ("g", "x", "y", "celltype")]).select("g", "k", "x", "y", "celltype")


CELLS = """cells as (
  select cell_key as k, min("Sample Name") as g, min("Cell X Position") as x, min("Cell Y Position") as y, min(trim("Phenotype")) as celltype
  from cell_seg_data
  where "Sample Name" is not null and isfinite("Cell X Position") and isfinite("Cell Y Position") and trim("Phenotype") <> ''
  group by cell_key)"""


def counts(spark: SparkSession, sf: str) -> DataFrame:
    """``cell, gene, n``: a sparse matrix of counts, from order lines."""
    l = table(spark, sf, "lineitem")  # noqa: E741
    gene = F.concat(F.lit("g"), (F.col("l_partkey") % 64).cast("string"))
    return l.select(F.col("l_orderkey").alias("cell"), gene.alias("gene"), F.col("l_quantity").cast("double").alias("q")).groupBy("cell", "gene").agg(F.sum("q").alias("n"))


COUNTS = """counts as (
  select l_orderkey as cell, 'g' || (l_partkey % 64) as gene, sum(l_quantity::double) as n from lineitem group by 1, 2)"""


def counted_cells(spark: SparkSession, sf: str) -> DataFrame:
    """``cell, cluster, sample, area`` from orders; some have no counts."""
    o = table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("cell"), F.col("o_orderpriority").alias("cluster"), F.col("o_orderstatus").alias("sample"), F.col("o_totalprice").cast("double").alias("area"))


COUNTED_CELLS = """counted_cells as (
  select o_orderkey as cell, o_orderpriority as cluster, o_orderstatus as sample, o_totalprice::double as area from orders)"""


def cluster_label(c):
    """A cluster's name in its usual spelling; null where it is missing."""
    digits = F.regexp_extract(c, r"(?i)^\s*c0*(\d+)\s*$", 1)
    return F.when(digits != "", F.concat(F.lit("C"), F.lpad(digits, 2, "0")))


def profiles(spark: SparkSession, sf: str) -> DataFrame:
    """``k, g, cluster, e``: cells with a complete profile and a known cluster."""
    m = table(spark, sf, "metadata_clusters").select(F.col("cell_key").alias("k"), cluster_label(F.col("cluster")).alias("cluster"), F.col("sample_id").alias("g")).where(F.col("cluster").isNotNull() & F.col("g").isNotNull())
    m = m.groupBy("k").agg(F.min("cluster").alias("cluster"), F.min("g").alias("g"))
    e = table(spark, sf, "normalized_expression").select(F.col("cell_key").alias("k"), F.col("exprs").alias("e"))
    e = e.where((F.size("e") == 32) & F.forall("e", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))).groupBy("k").agg(F.min("e").alias("e"))
    return e.join(m, "k").select("k", "g", "cluster", "e")


PROFILES = """profiles as (
  select e.k, m.g, m.cluster, e.e from
    (select cell_key as k, min(exprs) as e from normalized_expression
     where len(exprs) = 32 and len(list_filter(exprs, lambda x: x is not null and isfinite(x))) = 32 group by 1) e
  join (select cell_key as k, min('C' || lpad(regexp_extract(upper(trim(cluster)), '^C0*([0-9]+)$', 1), 2, '0')) as cluster, min(sample_id) as g
     from metadata_clusters where regexp_matches(upper(trim(cluster)), '^C0*[0-9]+$') and sample_id is not null group by 1) m using (k))"""


def markers(spark: SparkSession, sf: str) -> DataFrame:
    """``position, marker``: the panel, one row per marker."""
    return table(spark, sf, "features").select("position", "marker")
