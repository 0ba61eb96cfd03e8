"""Choosing rows, on small tables."""

import pytest
from pyspark.sql import functions as F

from tessella.operators import selection


def test_one_match_and_recoding(spark):
    df = spark.createDataFrame([("B Cell",), ("T Cell",), ("CD8 T Cell",), ("",), (None,)], "t string")
    rows = df.select("t", selection.matches_one(F.col("t"), ["^B", "T Cell$", "CD8"]).alias("one"), selection.recoded(F.col("t"), ["T Cell", "CD8", "+"]).alias("r")).collect()
    assert [(r["one"], r["r"]) for r in rows] == [(True, "else"), (True, "T Cell"), (False, "CD8"), (False, "else"), (False, "else")]
    assert not df.where(selection.matches_one(F.col("t"), [])).count()


def test_samples(spark):
    df = spark.range(200).withColumn("g", F.col("id") % 3)
    one = {r["id"] for r in selection.sampled(df.repartition(7), "id", 20, 1).collect()}
    assert one == {r["id"] for r in selection.sampled(df.coalesce(1), "id", 20, 1).collect()} and len(one) == 20
    assert one != {r["id"] for r in selection.sampled(df, "id", 20, 2).collect()}
    assert {r["g"]: r["count"] for r in selection.sampled(df, "id", 5, 0, ["g"]).groupBy("g").count().collect()} == {0: 5, 1: 5, 2: 5}
    assert selection.sampled(df, "id", 1000).count() == 200 and selection.sampled(df.limit(0), "id", 5).count() == 0


def test_first_filled(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, " "), ("a", 3, "y"), ("b", 1, None), (None, 1, "z"), ("c", 1, " q "), ("c", 1, " q ")], "s string, at int, v string")
    assert {tuple(r) for r in selection.first_filled(df, "s", "v", ["at"]).collect()} == {("a", "x"), ("c", "q")}


def test_size(spark):
    assert selection.require_size(spark.range(3), 3, 1).count() == 3
    for rows, columns in ((4, 1), (1, 2)):
        with pytest.raises(ValueError):
            selection.require_size(spark.range(3), rows, columns)
