import json
import math
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.functions import names, numeric
from tessella.operators import annotation, communities, components, expression, gating, neighbours, niche, pcf, ranks, raster
from tessella.plans import table_queries


def test_normalisation(spark):
    m = [[1, 0, 3], [0, 0, 0], [4, 4, 2]]
    counts = spark.createDataFrame([(i, f"g{j}", float(v)) for i, r in enumerate(m) for j, v in enumerate(r) if v or i == 1], "cell int, gene string, n double")
    log = {(r["cell"], r["gene"]): r["value"] for r in expression.normalized(counts).collect()}
    assert log[0, "g0"] == pytest.approx(7.824446, abs=1e-5) and log[2, "g2"] == pytest.approx(7.601402, abs=1e-5) and log[1, "g0"] == 0
    p = {(r["cell"], r["gene"]): r["value"] for r in expression.normalized(counts, "pearson").collect()}
    assert [p[0, g] for g in ("g0", "g1", "g2")] == pytest.approx([-0.356034, -1.062988, 1.30546], abs=1e-5)
    assert p[1, "g0"] is None and p[2, "g2"] == pytest.approx(-0.817059, abs=1e-5)
    with pytest.raises(ValueError):
        expression.normalized(counts, "other")


def test_adjusted_p_values(spark):
    df = spark.createDataFrame([(0.01, "a"), (0.04, "a"), (0.03, "a"), (0.5, "a")], "p double, g string")
    got = {r["p"]: r["q"] for r in df.select("p", ranks.adjusted(F.col("p"), "g").alias("q")).collect()}
    assert got == {0.01: pytest.approx(0.04), 0.04: pytest.approx(0.0533333), 0.03: pytest.approx(0.0533333), 0.5: pytest.approx(0.5)}


def test_distribution_distance(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 2, 3)] + [("b", float(v)) for v in (2, 3, 4, 5)], "g string, v double")
    assert ranks.distribution_distance(df, "g", "v", "a", "b").first()[0] == pytest.approx(0.5)


def test_rank_sums_equal_dense_ranks(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 3, (30, 4)).astype(float)
    grp = np.array(["a", "b", "c"])[rng.integers(0, 3, 30)]
    rows = [(i, str(grp[i]), f"g{j}", float(x[i, j])) for i in range(30) for j in range(4) if x[i, j]]
    sizes = spark.createDataFrame([(str(g), int((grp == g).sum())) for g in np.unique(grp)], "grp string, n long")
    for r in ranks.group_rank_sums(spark.createDataFrame(rows, "cell int, grp string, gene string, value double"), sizes).collect():
        v, m = x[:, int(r["gene"][1:])], grp == r["grp"]
        u = sum((a > b) + 0.5 * (a == b) for a in v[m] for b in v[~m])
        assert r["u"] == pytest.approx(u) and r["mean1"] == pytest.approx(v[m].mean()) and r["pct2"] == pytest.approx((v[~m] > 0).mean())


def test_rank_sums_of_millions_of_zeros(spark):
    values = spark.createDataFrame([(1, "a", "g", 2.0), (2, "a", "g", 2.0), (3, "b", "g", 5.0), (4, "b", "flat", 0.0)], "cell long, grp string, gene string, value double")
    sizes = spark.createDataFrame([("a", 4_000_000), ("b", 5_000_000)], "grp string, n long")
    found = {(r["gene"], r["grp"]): r for r in ranks.group_rank_sums(values, sizes).collect()}
    n, n1, n2, zeros = 9_000_000, 4_000_000, 5_000_000, 8_999_997
    r1 = (n1 - 2) * (zeros + 1) / 2 + 2 * (zeros + 1.5)
    off = r1 - n1 * (n1 + 1) / 2 - n1 * n2 / 2
    spread = n**3 - n - (zeros**3 - zeros) - (2**3 - 2)
    assert found["g", "a"]["z"] == pytest.approx((off - math.copysign(0.5, off)) / math.sqrt(n1 * n2 / 12 * (spread / (n * (n - 1)))))
    assert found["g", "b"]["z"] == pytest.approx(-found["g", "a"]["z"]) and found["flat", "a"]["z"] is None


def test_elevated_and_reduced(spark):
    z = [3.4, 1.75, 1.2, 0.6, 0.1, -0.1, -0.2, -0.5, -0.9, -1.4]
    df = spark.createDataFrame([("c", f"m{i}", v) for i, v in enumerate(z)], "cluster string, marker string, z double")
    assert tuple(expression.elevated_reduced(df).first()) == ("c", "m0=+3.40", "m9=-1.40")


def test_gating_in_template_order(spark):
    rules = gating.parse_rules(spark.createDataFrame([(1, "B", "CD20+, CD3-"), (2, "any", "CD20+"), (3, "gone", "XX+")], "place int, celltype string, markers string"))
    levels = spark.createDataFrame([("c1", "CD20", 1.0), ("c1", "CD3", -1.0), ("c2", "CD20", -0.5), ("c2", "CD3", 0.0)], "cluster string, marker string, z double")
    assert {r["cluster"]: r["label"] for r in gating.gate_clusters(levels, rules).collect()} == {"c1": "B,any", "c2": "Unannotated"}
    assert gating.two_components(np.array([0.1, 0.2, 0.15, 5.0, 5.2])).tolist() == [False, False, False, True, True]
    assert not gating.two_components(np.array([1.0, 1.0])).any()


def test_disks_and_regions(spark):
    assert [len(raster.disk_offsets(r)) for r in (1, 2, 5, 10)] == [5, 13, 81, 317]
    assert raster.compression_factor(10, 10, 30) == 0.5
    cells = spark.createDataFrame([("a", 10.7, 10.2), ("a", 11.2, 10.0), ("b", 1.0, 1.0)], "g string, x double, y double")
    p = raster.mask_pixels(cells, raster.disk_offsets(1), ["g"])
    assert p.count() == 8 and p.select("g").distinct().count() == 1  # a group of one cell is not painted
    r = raster.region_properties(p, "g").first()
    assert (r["x"], r["y"], r["area"]) == (10.5, 10.0, 8)


def test_curve_of_random_points_is_flat(spark):
    rng = np.random.default_rng(1)
    rows = [("s", i, float(x), float(y), "A" if i % 2 else "B") for i, (x, y) in enumerate(rng.uniform(0, 400, (900, 2)))]
    curves = pcf.pair_curves(spark.createDataFrame(rows, "g string, k long, x double, y double, celltype string"), 60.0, 60)
    got = {(r["ref"], r["query"]): r for r in curves.collect()}
    assert set(got) == {("A", "A"), ("A", "All"), ("A", "B"), ("All", "All"), ("All", "B"), ("B", "B")}
    for r in got.values():
        assert r["curve"][0] == 0 and np.mean(r["curve"][15:]) == pytest.approx(1, abs=0.15)


def test_curves_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(pcf, "AT_A_TIME", 50)  # sums are made of several parts
    rng = np.random.default_rng(3)
    rows = [(g, i, float(x), float(y), "ABC"[i % 3]) for g in ("s", "t") for i, (x, y) in enumerate(rng.uniform(-90, 90, (80, 2)))]
    cells = spark.createDataFrame([*rows, rows[0]], "g string, k long, x double, y double, celltype string").repartition(3)
    plain = spark.createDataFrame(rows, cells.schema)
    box = {r["g"]: (r["x0"], r["x1"], r["y0"], r["y1"]) for r in pcf.windows(plain).collect()}
    lam = {(r["g"], r["celltype"], r["bx"], r["by"]): r for r in pcf.intensities(cells, pcf.windows(plain)).collect()}
    r_max, steps, want = 20.0, 10, {}
    for g, i, x, y, t in rows:
        x0, x1, y0, y1 = box[g]
        at = lambda u, v: (int((u - x0) / (x1 - x0) * 32), int((v - y0) / (y1 - y0) * 32))  # noqa: B023, E731
        for _, j, u, v, q in (r for r in rows if r[0] == g and r[1] > i):
            d = math.hypot(x - u, y - v)
            if d <= r_max:
                angle = np.linspace(0, 2 * np.pi, 20_000, endpoint=False)
                shares = [np.mean((a + d * np.cos(angle) > x0) & (a + d * np.cos(angle) < x1) & (b + d * np.sin(angle) > y0) & (b + d * np.sin(angle) < y1)) for a, b in ((x, y), (u, v))]
                one, two = lam[g, t, *at(x, y)], lam[g, q, *at(u, v)]
                for (a, la), (b, lb) in (((t, one["lam"]), (q, two["lam"])), ((t, one["lam"]), ("All", two["lam_all"])), (("All", one["lam_all"]), (q, two["lam"])), (("All", one["lam_all"]), ("All", two["lam_all"]))):
                    w = (1 + (a == b)) * (1 / shares[0] + 1 / shares[1]) / 2 / (la * lb)
                    want.setdefault((g, min(a, b), max(a, b)), np.zeros(steps + 1))[int(d / 2)] += w
    got = {(r["g"], r["ref"], r["query"]): r for r in pcf.pair_curves(cells, r_max, steps).collect()}
    assert set(want) <= set(got) and len(got) == 20
    for (g, ref, query), w in want.items():
        area, r = (box[g][1] - box[g][0]) * (box[g][3] - box[g][2]), got[g, ref, query]
        h = max(2.0, 0.15 / math.sqrt(math.sqrt((r["n_ref"]) * r["n_query"]) / area))
        curve = [sum(w[b] * max(0.0, 0.75 * (1 - ((i - b - 0.5) * 2 / h) ** 2) / h) for b in range(steps + 1)) / (2 * math.pi * i * 2 * area) for i in range(1, steps)]
        assert r["curve"][0] == 0 and r["curve"][1:] == pytest.approx(curve, rel=2e-3)  # the repeated row is in the counts, but has no pairs of its own


@pytest.mark.parametrize("block,rows", [(16, 200), (4096, 200), (16, 3)])
def test_nearest_vectors_equal_brute_force(spark, block, rows):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(0, 1, (rows // 2, 5)), rng.normal(6, 0.2, (rows - rows // 2, 5))])
    x[-2:] = x[-1]  # copies
    got = {}
    for r in components.nearest_vectors(spark.createDataFrame([(i, v.tolist(), "x") for i, v in enumerate(x)], "k long, v array<double>, d string"), 4, block=block).collect():
        got.setdefault(r["src"], {})[r["rank"]] = r["dst"]
    for i in range(len(x)):
        near = sorted((float(np.sqrt(((x[i] - x[j]) ** 2).sum())), j) for j in range(len(x)) if j != i)[:4]
        assert [got[i][p + 1] for p in range(len(near))] == [j for _, j in near]
    assert components.nearest_vectors(spark.createDataFrame([], "k long, v array<double>"), 4).count() == 0


def test_nearest_vectors_over_chunks_copies_and_names(spark):
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(300, 6)) * rng.choice([1, 3], 300)[:, None], 1)
    x[:15], x[15:18] = x[0], 1e7 + x[15:18]  # more copies than neighbours; some far off, where single precision tells nothing
    keys = [f"v{i:03}" for i in range(300)]
    df = spark.createDataFrame([(n, v.tolist()) for n, v in zip(keys, x)], "k string, v array<double>")
    got = {(r["src"], r["rank"]): (r["dst"], r["d"]) for r in components.nearest_vectors(df, 5, block=16, chunk_bytes=100 * 6 * 8).collect()}
    assert len(got) == 300 * 5
    for i in range(300):
        near = sorted((float(np.sqrt(((x[i] - x[j]) ** 2).sum())), keys[j]) for j in range(300) if j != i)[:5]
        assert [got[keys[i], p + 1] for p in range(5)] == [(j, d) for d, j in near]
    some = components.nearest_vectors(df, 5, block=16, chunk_bytes=100 * 6 * 8, probes=1).collect()
    assert 0 < sum(got[r["src"], r["rank"]] == (r["dst"], r["d"]) for r in some) < 300 * 5


def test_tiles_with_far_rows_rule_out_most_vectors():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(6000, 10)) * np.linspace(3, 0.3, 10)
    x[::50] *= 8  # in balls around centres, a few far rows widen every tile
    tree = components._Tree(x[::3], 5)
    leaf, parts = tree.leaves(x), []
    for i in range(32):
        rows = np.flatnonzero(leaf == i)
        parts += [rows[t] for t in tree.tiles(x[rows], 64)]
    assert sorted(np.concatenate(parts)) == list(range(6000)) and max(map(len, parts)) <= 64
    rows = np.concatenate(parts)
    tiles = components._Tiles(rows, x[rows], np.cumsum([0, *map(len, parts)]), np.zeros(len(parts), int)).prepare(tree)
    q, asked, balls = x[:200], 0, 0
    d, low = components._distances(q, x), tiles.least(q, tree)
    for t, part in enumerate(parts):
        assert (low[:, t] <= d[:, part].min(1) + 1e-9).all()  # never more than the nearest is away
        reach, middle = np.partition(d, 10, axis=1)[:, 10], x[part].mean(0)
        asked += (low[:, t] <= reach).sum() * len(part)
        balls += (np.sqrt(((q - middle) ** 2).sum(1)) - np.sqrt(((x[part] - middle) ** 2).sum(1).max()) <= reach).sum() * len(part)
    assert asked < 0.3 * 200 * 6000 and asked < 0.5 * balls
    q, keys, dist = tiles.x[:64], tiles.keys[:64], np.full((64, 4), np.inf)
    near = np.repeat(keys, 4).reshape(-1, 4)
    components._search(q, keys, dist, near, tiles, tree, None)
    for i, key in enumerate(keys):
        assert [j for _, j in sorted((float(np.sqrt(((q[i] - v) ** 2).sum())), j) for j, v in enumerate(x) if j != key)[:4]] == near[i].tolist()


def test_queries_of_many_tiles_ask_together():
    rng = np.random.default_rng(11)
    x = rng.normal(size=(5000, 6)) * rng.choice([1, 1, 5], 5000)[:, None]
    tree = components._Tree(x[::2], 4)
    leaf = tree.leaves(x)
    rows = np.concatenate([np.flatnonzero(leaf == i) for i in range(16)])
    ends = np.searchsorted(leaf[rows], np.arange(17)).tolist()
    tiles = components._Tiles(rows, x[rows], np.array(ends), np.arange(16)).prepare(tree)
    assert all((tiles.group_low[g] <= tiles.low[t]).all() and (tiles.group_high[g] >= tiles.high[t]).all() for g, ts in enumerate(tiles.groups) for t in ts)
    parts, dist = [slice(a, b) for a, b in zip(ends[:-1], ends[1:])], np.full((5000, 4), np.inf)
    near = np.repeat(rows, 4).reshape(-1, 4)
    components._search(tiles.x, rows, dist, near, tiles, tree, None, parts)
    for i in range(0, 5000, 50):
        d = np.sqrt(((x[rows[i]] - x) ** 2).sum(1))
        d[rows[i]] = np.inf
        assert near[i].tolist() == np.lexsort((np.arange(5000), d))[:4].tolist()


@pytest.mark.parametrize("symmetric,rows", [(False, 300), (True, 300), (True, 3)])
def test_shared_neighbours_equal_joined_lists(spark, symmetric, rows):
    x = np.random.default_rng(12).normal(size=(rows, 5))
    df = spark.createDataFrame([(7 * i, v.tolist()) for i, v in enumerate(x)], "k long, v array<double>")
    want = neighbours.shared_neighbour_edges(components.nearest_vectors(df, 5).withColumn("g", F.lit(0)), 5, symmetric)
    found = components.shared_neighbours(df, 5, symmetric, block=16, chunk_bytes=100 * 72)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    got = [tuple(r) for r in found.select("src", "dst", "weight").collect()]
    assert len(got) == len(set(got)) and set(got) == {(r["src"], r["dst"], r["weight"]) for r in want.collect()}
    assert components.shared_neighbours(df.limit(0), 5).count() == 0


def test_component_scores(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(50, 4)) @ rng.normal(size=(4, 4))
    scores, share = components.pca_scores(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "k long, e array<double>"), 2)
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    want = np.linalg.svd(z, full_matrices=False)[1] ** 2
    assert share == pytest.approx(want[:2] / want.sum())
    got = np.array([r["v"] for r in scores.orderBy("k").collect()])
    assert (got**2).sum(0) == pytest.approx(want[:2])


def test_connected_parts_and_objectives(spark):
    chain = spark.createDataFrame([(i, i + 1, 1.0) for i in range(9) if i != 4], "src long, dst long, weight double")
    one = spark.createDataFrame([(i, 0) for i in range(10)], "k long, c long")
    assert {(r["k"], r["c"]) for r in communities.connected_parts(chain, one).collect()} == {(i, 0 if i < 5 else 5) for i in range(10)}
    whole = communities.communities(chain, 0.01, objective="cpm")
    assert whole.select("community").distinct().count() == 2
    with pytest.raises(ValueError):
        communities.communities(chain, objective="other")


@pytest.mark.parametrize("objective,resolution", [("modularity", 1.0), ("cpm", 0.3)])
def test_communities_in_one_task_equal_distributed_ones(spark, objective, resolution):
    rng = np.random.default_rng(9)
    kind = rng.integers(0, 4, 60)
    rows = [(3 * i, 3 * j, float(rng.integers(1, 5)) / 4) for i in range(60) for j in range(i + 1, 60) if rng.random() < (0.3 if kind[i] == kind[j] else 0.02)]
    edges = spark.createDataFrame([*rows, (900, 901, 1.0)], "src long, dst long, weight double")
    local, spread = ({(r["k"], r["community"]) for r in communities.communities(edges, resolution, levels=3, objective=objective, most_local=m).collect()} for m in (1000, 0))
    assert local == spread and len({c for _, c in local}) > 2


def test_moves_of_some_nodes_at_a_time(monkeypatch):
    rng = np.random.default_rng(10)
    n, m = 20_000, 200_000
    edges, w, found = [rng.integers(0, n, m), rng.integers(0, n, m)], rng.integers(1, 5, m) / 4, []
    for most in (m * 2, m // 10):
        monkeypatch.setattr(communities, "AT_A_TIME", most)
        tracemalloc.start()
        found.append(communities._moves_of(*edges, w, np.arange(n) % 64, np.ones(n, int), 1.0, 12, "modularity"))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
    assert (found[0] == found[1]).all() and len(np.unique(found[0])) < n / 2
    assert peak < 130 * m


def test_moves_hold_few_bytes_an_edge():
    rng = np.random.default_rng(13)
    n, m = 50_000, 1_000_000
    edges, w = [rng.integers(0, n, m).astype("int32"), rng.integers(0, n, m).astype("int32")], rng.integers(1, 11, m) / 10
    tracemalloc.start()
    communities._moves_of(*edges, w, np.arange(n) % 64, np.ones(n, int), 1.0, 2, "modularity")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 75 * m  # 500,000 edges at a time take some of it


def test_communities_find_cliques(spark):
    cliques = [range(0, 6), range(10, 16), range(20, 26)]
    e = [(a, b, 1.0) for c in cliques for a in c for b in c if a < b] + [(5, 10, 0.1), (15, 20, 0.1)]
    edges = spark.createDataFrame(e, "src long, dst long, weight double")
    found = communities.communities(edges)
    by = {r["k"]: r["community"] for r in found.collect()}
    assert [len({by[k] for k in c}) for c in cliques] == [1, 1, 1] and len(set(by.values())) == 3
    assert communities.modularity(edges, found).first()[0] > 0.6


@pytest.mark.parametrize(
    "text,want",
    [
        ('{"cell_type": "B cell", "confidence": 0.8}', ("B cell", 0.8, None)),
        ('```json\n{"cell_type": "B cell"}\n```', ("B cell", 0.0, None)),
        ('<think>{hm}</think>{"cell_type": "B cell"}', ("B cell", 0.0, None)),
        ('Sure: {"cell_type": "T {CD4} cell", "confidence": "x"} done', ("T {CD4} cell", 0.0, None)),
        ('["B cell"]', ("unknown", 0.0, "parse_failure")),
        ('{"confidence": 1}', ("unknown", 0.0, "parse_failure")),
        (None, ("unknown", 0.0, "request_failure")),
    ],
)
def test_answers(text, want):
    assert annotation.parse_answer(text)[:3] == want


def test_asking_again_and_voting(spark):
    def model(prompts, seed):
        return [None if seed == 0 and "c1" in p else json.dumps({"cell_type": "B"}) for p in prompts]

    asked = spark.createDataFrame([("c1", "for c1"), ("c2", "for c2")], "cluster string, prompt string")
    first = annotation.ask(asked, model)
    assert first.where("error = 'request_failure'").count() == 1
    assert annotation.retry_failed(first, model).where("error is null").count() == 2
    v = spark.createDataFrame([("c", x) for x in ("B cell", "b cell ", "T cell", "t cell", None, " ")], "cluster string, label string")
    r = annotation.vote(v, ["cluster"], F.col("label")).first()
    assert (r["top"], r["agreement"], r["n"], r["detail"]) == ("b cell", 0.5, 4, "b cell:2, t cell:2")


def test_names(spark):
    df = spark.createDataFrame([(12, "CD3_Nucleus_Mean"), (123456789, "cd-8 a_cytoplasm x")], "n long, m string")
    got = df.select(names.cell_label(F.col("n")), names.marker_base(F.col("m")), names.marker_key(F.col("m")), names.safe_name(F.col("m"))).collect()
    assert tuple(got[0]) == ("C0000012", "CD3", "CD3NUCLEUSMEAN", "CD3_Nucleus_Mean")
    assert tuple(got[1]) == ("C123456789", "cd-8 a", "CD8ACYTOPLASMX", "cd-8_a_cytoplasm_x")
    assert names.is_unset("NA") and names.is_unset("0", zero=True) and not names.is_unset("0") and not names.is_unset("nan")
    p = spark.createDataFrame([(0.0,), (1.959964,), (None,)], "z double").select(numeric.normal_sf("z")).collect()
    assert [p[0][0], p[1][0]] == pytest.approx([0.5, 0.025], abs=1e-6) and p[2][0] is None


def test_folds_and_neighbourhoods(spark):
    assert [len(f) for f in niche.hold_out_folds(list("abcde"), "count", 2)] == [2] * 5
    assert niche.hold_out_folds(list("ab"), "group", 1) == []
    m = spark.createDataFrame([("s", i, [float(i % 2), 1.0 - i % 2]) for i in range(40)], "g string, k long, features array<double>")
    centres = niche.fit_neighbourhoods(m, 2)
    assert centres == [[0.0, 1.0], [1.0, 0.0]]
    by = {r["k"]: r["neighborhood"] for r in niche.assign_nearest(m, centres).collect()}
    assert all(by[i] == (1 if i % 2 == 0 else 2) for i in by)


def test_neighbourhoods_of_all_types(spark, tmp_path):
    types = ["Endothelial Cell", "Fibroblast", "Neutrophil", "other"]
    rows = [(12 * i + j, "s", 1000.0 * i + j, float(j % 3), t) for i, t in enumerate(types) for j in range(12)]
    spark.createDataFrame(rows, "cell_key long, `Sample Name` string, `Cell X Position` double, `Cell Y Position` double, Phenotype string").write.parquet(str(tmp_path / "cell_seg_data.parquet"))
    found = table_queries.kmeans_neighborhoods(spark, str(tmp_path)).collect()
    assert sorted(r["n_cells"] for r in found) == [12] * 4


def test_curve_summary_and_table(spark):
    rng = np.random.default_rng(8)
    rows = [(g, i, float(x), float(y), t) for g in ("s1", "s2") for i, (x, y, t) in enumerate(zip(rng.random(60) * 100, rng.random(60) * 100, ["A", "B", "C"] * 20))]
    rows += [("s1", 900, 5.0, 5.0, "rare")]
    c = spark.createDataFrame(rows, "g string, k long, x double, y double, celltype string")
    summary = pcf.curve_summary(c, pcf.pair_curves(c, 20.0, 10)).cache()
    by = {(r["g"], r["ref"], r["query"]): r for r in summary.collect()}
    assert by["s1", "A", "rare"]["skipped"] and by["s1", "A", "rare"]["pcf_sum"] is None and by["s1", "A", "rare"]["min_count"] == 1
    assert by["s1", "A", "B"]["pcf_sum"] == pytest.approx(sum(by["s1", "A", "B"]["curve"]) / by["s1", "A", "B"]["normalization"])
    assert pcf.interaction_subset(summary, "B", "A", 19).count() == 2 and pcf.interaction_subset(summary, "B", "A", 20).count() == 0
    table = pcf.auc_table(summary, "A", 2.0)
    assert table.columns == ["sample", "r", "All", "B", "C"] and table.count() == 20
    with pytest.raises(ValueError):
        pcf.auc_table(summary, "All", 2.0)
