"""``python -m tessella.cli PIPELINE --cells PATH --out PATH``: a pipeline over a table of cells.

Cells are Parquet (``g, k, x, y, celltype``) or, for a path that names CSV files, a ``.txt`` list or a folder of them,
cell segmentation exports. ``transcripts`` also needs ``--counts`` (Parquet with ``cell, gene, n``), ``phenotyping``
``--panel`` (Parquet with ``position, marker``), and its cells are ``k, g, cluster, e``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.plans import pipelines
from tessella.session import get_spark
from tessella.sources import readers
from tessella.sources.writers import write_record


def vectra_cells(spark: SparkSession, given: str) -> DataFrame:
    """``g, k, x, y, celltype`` of segmentation exports; keys are given by sample and position and are the same in every run."""
    c = readers.read_vectra(spark, readers.expand_paths(spark, given))
    key = F.xxhash64("Sample Name", "Cell X Position", "Cell Y Position", "Phenotype")
    return c.select(F.col("Sample Name").alias("g"), key.alias("k"), F.col("Cell X Position").alias("x"), F.col("Cell Y Position").alias("y"), F.trim("Phenotype").alias("celltype")).dropDuplicates(["k"])


def main(argv: list[str] | None = None) -> None:
    a = argparse.ArgumentParser(prog="tessella")
    a.add_argument("pipeline", choices=["dynamics", "niches", "curves", "transcripts", "phenotyping"])
    a.add_argument("--cells", required=True, help="Parquet, or exports as CSV")
    a.add_argument("--out", required=True)
    a.add_argument("--counts", help="Parquet with cell, gene, n")
    a.add_argument("--panel", help="Parquet with position, marker")
    a.add_argument("--template", help="CSV with CELLTYPE, MARKERS")
    a.add_argument("--targets", default="", help="types of a circuit, separated by commas")
    a.add_argument("--resolution", type=float, default=0.3774)
    a.add_argument("--radius", type=float, default=30.0)
    a.add_argument("--k1", type=int, default=10)
    a.add_argument("--k2", type=int)
    o = a.parse_args(argv)
    spark = get_spark()
    cells = vectra_cells(spark, o.cells) if ".csv" in o.cells.lower() or o.cells.lower().endswith(".txt") else spark.read.parquet(o.cells)
    if o.pipeline == "dynamics":
        tables = pipelines.run_dynamics(cells, pipelines.Dynamics(resolution=o.resolution, outer=o.radius, targets=[t for t in o.targets.split(",") if t]))
    elif o.pipeline == "niches":
        tables = pipelines.run_niches(cells, pipelines.Niches(k1=o.k1, k2=o.k2))
    elif o.pipeline == "transcripts":
        if not o.counts:
            a.error("transcripts needs --counts")
        tables = pipelines.run_transcripts(spark.read.parquet(o.counts), cells, pipelines.Transcripts())
    elif o.pipeline == "phenotyping":
        if not o.panel:
            a.error("phenotyping needs --panel")
        tables = pipelines.run_phenotyping(cells, spark.read.parquet(o.panel), readers.read_template(spark, o.template) if o.template else None)
    else:
        tables = pipelines.run_curves(cells, o.radius, o.resolution)
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{o.out}/{name}")
    write_record(spark, f"{o.out}/runs", **vars(o))


if __name__ == "__main__":
    main()
