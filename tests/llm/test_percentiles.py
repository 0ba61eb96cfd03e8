import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.llm import percentiles

SHARES = [0.0, 0.25, 0.5, 0.9, 1.0]


def table(spark, seed=0):
    rng = np.random.default_rng(seed)
    rows = [("a", int(d), float(v)) for d, v in zip(rng.integers(0, 4, 900), rng.normal(size=900).round(2))]
    rows += [("hot", 0, 7.0)] * 700 + [("hot", 1, 8.0)]  # one value has most of the rows
    rows += [("one", 2, 3.5), ("none", 1, float("nan")), ("none", 1, None), ("inf", 1, float("inf")), (None, 3, 1.0), (None, 3, 2.0), ("zero", 0, -0.0), ("zero", 0, 0.0)]
    return spark.createDataFrame(rows, "grp string, day int, value double").withColumn("n", F.lit("clash"))


def truth(df, shares):
    out = {}
    for g, part in df.toPandas().groupby("grp", dropna=False):
        v = part.value[np.isfinite(part.value)]
        if len(v):
            out[None if g != g else g] = np.quantile(v, shares)
    return out


@pytest.mark.parametrize("partitions", [1, 7])
def test_exact(spark, partitions):
    df = table(spark)
    want = truth(df, SHARES)
    got = {}
    for r in percentiles.percentiles(df, ["grp"], "value", SHARES, partitions).collect():
        got.setdefault(r["grp"], {})[r["share"]] = r["value"]
    assert set(got) == set(want)
    for g, q in want.items():
        assert [got[g][s] for s in SHARES] == pytest.approx(list(q))


def test_days_combine_within_the_bound(spark):
    df = table(spark, 1).where("grp = 'a'")
    days = percentiles.summaries(df, ["grp"], "day", "value", points=50)
    rows = percentiles.combine(days, ["grp"], "day", SHARES, points=50).collect()
    v = np.sort(df.toPandas().value)
    assert len(rows) == len(SHARES)
    for r in rows:
        low, high = np.searchsorted(v, r["value"], "left") / len(v), np.searchsorted(v, r["value"], "right") / len(v)
        assert r["n"] == len(v) and low - r["rank_error"] <= r["share"] <= high + r["rank_error"] and r["rank_error"] < 0.03


def test_nothing(spark):
    assert percentiles.percentiles(table(spark).limit(0), ["grp"], "value", SHARES).count() == 0


def test_rows_once(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "d"), (3, "c")], "k long, v string")
    for most in (100, 0):
        assert {tuple(r) for r in percentiles.once(df, "k", most).collect()} == {(1, "a"), (2, "b"), (3, "c")}


def test_cluster_names(spark):
    df = spark.createDataFrame([("C1",), ("c01",), (" C 12 ",), ("NA",), (None,), ("",), ("C123",)], "c string").select(percentiles.cluster_name(F.col("c")))
    assert [r[0] for r in df.collect()] == ["C01", "C01", "C12", None, None, None, "C123"]
