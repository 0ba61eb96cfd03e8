"""Cell types from rules over markers, and mixtures that tell high from low."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def parse_rules(template: DataFrame) -> DataFrame:
    """``place, celltype, marker, sign`` of rules like ``CD3+,CD8-``; the order of the template is kept."""
    one = F.explode(F.split("markers", r"\s*,\s*")).alias("rule")
    r = template.select("place", "celltype", one).where(F.col("rule").rlike(r"[+-]\s*$"))
    return r.select("place", "celltype", F.trim(F.regexp_replace("rule", r"[+-]\s*$", "")).alias("marker"), F.regexp_extract("rule", r"([+-])\s*$", 1).alias("sign"))


def gate_clusters(levels: DataFrame, rules: DataFrame) -> DataFrame:
    """The types whose rules all hold for a cluster, joined by commas in template order, else ``Unannotated``.

    ``levels`` has ``cluster, marker, z``; ``+`` asks for z above 0 and ``-`` for z below 0. A rule for a marker that
    is not there does not hold.
    """
    clusters = levels.select("cluster").distinct()
    wanted = clusters.crossJoin(F.broadcast(rules))  # a template's rules for each cluster: both are small
    held = F.coalesce(F.when(F.col("sign") == "+", F.col("z") > 0).otherwise(F.col("z") < 0), F.lit(False))
    met = wanted.join(levels, ["cluster", "marker"], "left").groupBy("cluster", "place", "celltype").agg(F.bool_and(held).alias("ok"))
    named = met.where("ok").groupBy("cluster").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "celltype"))), lambda s: s["celltype"]), ",").alias("label"))
    return clusters.join(named, "cluster", "left").select("cluster", F.coalesce("label", F.lit("Unannotated")).alias("label"))


def two_components(x: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Whether each value belongs to the higher of two Gaussian components with one variance each."""
    x = np.asarray(x, float)
    if len(x) < 2 or np.ptp(x) == 0:
        return np.zeros(len(x), bool)
    mu = np.quantile(x, [0.25, 0.75])
    if mu[0] == mu[1]:
        mu = np.array([x.min(), x.max()])
    var, w = np.full(2, max(x.var() / 4, 1e-9)), np.full(2, 0.5)
    for _ in range(rounds):
        log = np.log(w) - 0.5 * np.log(var) - (x[:, None] - mu) ** 2 / (2 * var)
        r = np.exp(log - log.max(1, keepdims=True))
        r /= r.sum(1, keepdims=True)
        n = r.sum(0) + 1e-12
        mu = (r * x[:, None]).sum(0) / n
        var = np.maximum((r * (x[:, None] - mu) ** 2).sum(0) / n, 1e-6 * x.var())
        w = n / n.sum()
    return r[:, int(np.argmax(mu))] > 0.5


def high_low(levels: DataFrame) -> DataFrame:
    """``cluster, marker, z`` with ``z`` 1 or -1 by a two-component mixture over each marker's cluster medians."""

    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.assign(z=np.where(two_components(pdf.z.to_numpy()), 1.0, -1.0))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in levels.select("cluster", "marker", "z").schema)
    return levels.select("cluster", "marker", "z").groupBy("marker").applyInPandas(split, kinds)  # a value per cluster


def broadcast_labels(cells: DataFrame, labels: DataFrame, by: str = "cluster", label: str = "label") -> DataFrame:
    """Cells with the label of their cluster, and ``cluster-label``; the first of several labels wins."""
    first = labels.withColumn("r", F.row_number().over(Window.partitionBy(by).orderBy(label))).where("r = 1").drop("r")
    return cells.join(first, by, "left").withColumn("marked", F.concat(F.col(by).cast("string"), F.lit("-"), F.col(label)))
