"""Ordered operators against numpy."""

import numpy as np

from tessella.operators import communities, order, ranks


def test_percentiles_of_groups_and_of_all(spark):
    rng = np.random.default_rng(4)
    rows = [(g, float(round(v, 1))) for g in ("a", "b", None) for v in rng.normal(size=101)] + [("a", float("nan")), ("b", None), ("c", float("inf")), ("d", 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    by: dict = {}
    for g, v in rows:
        if v is not None and np.isfinite(v):
            by.setdefault(g, []).append(v)
    got = {(r["g"], r["share"]): (r["n"], r["value"]) for r in order.percentiles(df, ["g"], "v", [0.1, 0.5], 7).collect()}
    assert set(got) == {(g, s) for g in by for s in (0.1, 0.5)}  # no row for a group without finite values
    assert all(n == len(by[g]) and abs(v - np.quantile(by[g], s)) < 1e-12 for (g, s), (n, v) in got.items())
    [row] = order.percentiles(df, [], "v", [0.5], 5).collect()
    assert abs(row["value"] - np.median([v for x in by.values() for v in x])) < 1e-12
    assert order.percentiles(df.limit(0), ["g"], "v", [0.5]).count() == 0


def test_running_sums(spark):
    rng = np.random.default_rng(6)
    n = rng.integers(0, 9, 500)
    df = spark.createDataFrame([(int(i), int(c)) for i, c in enumerate(n)], "k long, n long").repartition(6)
    got = {r["k"]: r["upto_n"] for r in order.running_sums(df, ["k"], ["n"]).collect()}
    assert [got[i] for i in range(500)] == list(np.cumsum(n))
    assert order.running_sums(df.limit(0), ["k"], ["n"]).count() == 0


def test_distribution_distance(spark):
    rng = np.random.default_rng(8)
    rows = [("a", float(round(v, 1))) for v in rng.normal(size=200)] + [("b", float(round(v, 1))) for v in rng.normal(0.4, 1, 150)] + [("a", None), ("b", float("nan")), ("c", 0.0)]
    df = spark.createDataFrame(rows, "t string, x double")
    a, b = (np.array([v for t, v in rows if t == g and v is not None and np.isfinite(v)]) for g in "ab")
    want = max(0.0, *((a <= v).mean() - (b <= v).mean() for v in np.concatenate([a, b])))
    assert abs(ranks.distribution_distance(df, "t", "x", "a", "b").first()[0] - want) < 1e-12
    assert ranks.distribution_distance(df, "t", "x", "a", "none").first()[0] == 0.0
    assert ranks.distribution_distance(df.limit(0), "t", "x", "a", "b").first()[0] == 0.0


def test_numbers_by_size(spark):
    df = spark.createDataFrame([(c, n) for c, n in zip(range(40), [3, 1, 1, 7] * 10)], "c long, n long")
    want = [c for _, c in sorted((-n, c) for c, n in zip(range(40), [3, 1, 1, 7] * 10))]
    got = {r["community"]: r["c"] for r in communities.numbered_by_size(df, "c").collect()}
    assert [got[i + 1] for i in range(40)] == want
