"""Writers: square matrices, cell tables by sample, run records."""

from __future__ import annotations

import datetime
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions.names import safe_name


def wide_matrix(pairs: DataFrame, value: str, ref: str = "ref", query: str = "query") -> DataFrame:
    """A square table of pairs of types: reference types as columns, query types as rows."""
    kinds = sorted(r[0] for r in pairs.select(ref).distinct().collect())  # types of cells: a few
    return pairs.groupBy(query).pivot(ref, kinds).agg(F.first(value)).orderBy(query)


def write_matrix(pairs: DataFrame, value: str, path: str) -> None:
    """The square table as one CSV file."""
    wide_matrix(pairs, value).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_vectra(cells: DataFrame, path: str) -> None:
    """Cells as CSV, a folder per sample; ``cells`` has the usual columns and ``Sample Name``."""
    named = cells.withColumn("sample", safe_name(F.col("Sample Name")))
    named.repartition("sample").write.mode("overwrite").partitionBy("sample").option("header", True).csv(path)


def write_cells(cells: DataFrame, features: DataFrame, path: str, sample: str = "g") -> None:
    """Cells (coordinates, labels, marker arrays) by sample, and the panel beside them, as Parquet."""
    cells.repartition(sample).write.mode("overwrite").partitionBy(sample).parquet(f"{path}/cells")
    features.coalesce(1).write.mode("overwrite").parquet(f"{path}/features")


def tissue_of(cells: DataFrame, fallback: str | None = None) -> DataFrame:
    """``tissue``: classifier label, else analysis region, else the fallback, else the sample, else ``Unknown``."""
    have = [F.col(c) for c in ("Classifier_Label", "Analysis_Region") if c in cells.columns]
    have += [F.lit(fallback)] if fallback else []
    have += [F.col("sample_id")] if "sample_id" in cells.columns else []
    return cells.withColumn("tissue", F.coalesce(*have, F.lit("Unknown")))


def write_record(spark, path: str, **values: object) -> None:
    """Settings and counts of a run as one JSON line, appended to a folder."""
    line = json.dumps({"at": datetime.datetime.now(datetime.timezone.utc).isoformat(), **values}, default=str)
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(path)
