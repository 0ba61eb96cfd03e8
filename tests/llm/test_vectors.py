import numpy as np

from tessella.llm import clusters, vectors

SCHEMA = "key long, vec array<double>, k string, cell int"


def data(seed, n=300, groups=12, size=6, dim=8):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for g in range(groups):
        base = x[g * size]
        for j in range(1, size - g % 3):
            x[g * size + j] = (base + rng.normal(size=dim) * 0.02) * rng.uniform(0.5, 2)
    return x


def frame(spark, x):
    rows = [(i, [float(a) for a in v], "clash", 1) for i, v in enumerate(x)]
    bad = [(9001, None, "", 0), (9002, [1.0], "", 0), (9003, [0.0] * x.shape[1], "", 0), (9004, [float("nan")] + [1.0] * (x.shape[1] - 1), "", 0), (9005, [None] + [1.0] * (x.shape[1] - 1), "", 0), (None, [1.0] * x.shape[1], "", 0), (9006, [float("inf")] + [1.0] * (x.shape[1] - 1), "", 0)]
    return spark.createDataFrame(rows + rows[:9] + bad, SCHEMA)


def cosines(x):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    return u @ u.T


def test_most_similar_equals_brute_force(spark):
    x = data(0)
    s = cosines(x)
    np.fill_diagonal(s, -2)
    q = spark.createDataFrame([(i,) for i in range(0, 300, 7)] + [(0,), (9001,), (None,)], "key long")
    df = frame(spark, x)
    exact = vectors.most_similar(df, "key", "vec", q, "key", k=5, dim=8, centroids=8, share=1.0, block=20)
    got = {(r["query"], r["neighbour"]) for r in exact.collect()}
    want = {(i, int(j)) for i in range(0, 300, 7) for j in np.argsort(-s[i], kind="stable")[:5]}
    assert got == want
    near = vectors.most_similar(df, "key", "vec", q, "key", k=5, dim=8, centroids=8, share=0.4)
    assert len({(r["query"], r["neighbour"]) for r in near.collect()} & want) >= 0.9 * len(want)


def test_few_or_no_vectors(spark):
    x = np.array([[1.0, 0, 0, 0], [0.9, 0.1, 0, 0], [0.9, 0.1, 0, 0]])
    q = spark.createDataFrame([(0,)], "key long")
    got = [(r["neighbour"], r["place"]) for r in vectors.most_similar(frame(spark, x), "key", "vec", q, "key", k=5, dim=4).orderBy("place").collect()]
    assert got == [(1, 1), (2, 2)]  # ties by key, fewer than five in all
    assert vectors.most_similar(frame(spark, x).limit(0), "key", "vec", q, "key", k=5, dim=4).count() == 0


def test_traversal_is_in_order_of_summed_distance():
    rng = np.random.default_rng(1)
    d1, d2, counts = rng.random(5), rng.random(6), np.ones(30, int)
    got = vectors.traverse(d1, d2, counts, 30, 1)
    assert got == sorted(range(30), key=lambda c: d1[c // 6] + d2[c % 6])
    counts[got[0]] = 0
    assert vectors.traverse(d1, d2, counts, 1, 1) == [got[1]]


def test_spanning_edges_equal_kruskal():
    x = data(3, 60, 6, 6)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    core = np.random.default_rng(0).random(60) * 0.05
    d = np.maximum(np.maximum(1 - u @ u.T, core[:, None]), core[None, :])
    parent = list(range(60))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    total = 0.0
    for w, a, b in sorted((d[a, b], a, b) for a in range(60) for b in range(a) if 1 - u[a] @ u[b] <= 0.3):
        if root(a) != root(b):
            parent[root(a)] = root(b)
            total += w
    assert abs(sum(w for *_, w in clusters.spanning_edges(u, core, 0.3)) - total) < 1e-9


def test_boruvka_equals_kruskal(spark):
    rng = np.random.default_rng(5)
    edges = sorted({(min(a, b), max(a, b)): float(round(w, 1)) for a, b, w in zip(rng.integers(0, 40, 90), rng.integers(0, 40, 90), rng.random(90)) if a != b}.items())
    tree, nodes = clusters.boruvka(spark.createDataFrame([(int(a), int(b), w) for (a, b), w in edges], "a long, b long, w double"))
    parent = {n: n for e, _ in edges for n in e}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    total = 0.0
    for (a, b), w in sorted(edges, key=lambda e: e[1]):
        if root(a) != root(b):
            parent[root(a)] = root(b)
            total += w
    rows = tree.collect()
    assert abs(sum(r["w"] for r in rows) - total) < 1e-9 and len(rows) == len(parent) - len({root(a) for a in parent})
    by = {r["k"]: r["c"] for r in nodes.collect()}
    assert all((by[a] == by[b]) == (root(a) == root(b)) for a in parent for b in parent)


def test_pairs_and_copies(spark):
    x = data(7, 200)
    x[150:156] = x[150]  # copies of one vector
    s = cosines(x)
    want = {(i, j) for i in range(200) for j in range(i + 1, 200) if s[i, j] >= 0.985}
    got = {(r["key_1"], r["key_2"]) for r in clusters.similar_pairs(frame(spark, x), "key", "vec", 8).collect()}
    assert got == want
    assert clusters.similar_pairs(frame(spark, x).limit(0), "key", "vec", 8).count() == 0


def test_clusters_by_stability(spark):
    rng = np.random.default_rng(2)
    base = np.eye(8)[:3]
    x = np.concatenate([base[g] + rng.normal(size=(9, 8)) * 0.03 for g in range(3)] + [rng.normal(size=(5, 8))])
    x[26] = x[25]
    rows = clusters.describe_clusters(frame(spark, x), "key", "vec", 8, least_cosine=0.9, min_size=3).collect()
    by = {r["k"]: r for r in rows}
    assert len(rows) == 32 and {by[i]["cluster"] for i in range(27, 32)} == {None}
    for g in range(3):
        assert len({by[i]["cluster"] for i in range(9 * g, 9 * g + 9)}) == 1 and by[9 * g]["size"] == 9
        assert sorted(by[i]["exemplar"] for i in range(9 * g, 9 * g + 9) if by[i]["exemplar"]) == [1, 2, 3]


def test_copies_count_in_clusters(spark):
    x = np.concatenate([np.eye(8)[[0] * 5 + [1] * 2 + [2] * 2], np.eye(8)[3:5], np.eye(8)[[6] * 2]])
    x[8] = x[8] + 0.05 * np.eye(8)[7]
    x = np.concatenate([x, x[8:9]])  # 7 once, 8 and 13 copies of a vector near it
    rows = clusters.describe_clusters(frame(spark, x), "key", "vec", 8, min_size=3).collect()
    by = {r["k"]: r for r in rows}
    assert len(rows) == len(by) == 14
    assert {(by[k]["cluster"], by[k]["size"]) for k in range(5)} == {(0, 5)}  # copies alone, no other vector near
    assert sorted(by[k]["exemplar"] for k in range(5) if by[k]["exemplar"]) == [1, 2, 3]
    assert {(by[k]["cluster"], by[k]["size"]) for k in (7, 8, 13)} == {(7, 3)}  # two vectors, three keys
    assert {by[k]["cluster"] for k in (5, 6, 9, 10, 11, 12)} == {None}  # two copies are too few samples


def by_recursion(keys, edges, most, floor, min_size):
    """Condensed clusters from the top down: the selected ones as sets of keys, with their stability."""

    def parts(of, below):
        left, out = set(of), []
        while left:
            todo, seen = [left.pop()], set()
            while todo:
                u = todo.pop()
                seen.add(u)
                for a, b, w in edges:
                    if w < below and u in (a, b):
                        v = b if u == a else a
                        if v in left:
                            left.discard(v)
                            todo.append(v)
            out.append(seen)
        return out

    def grow(of, birth):
        """Stability and best selection of a cluster that begins at distance ``birth`` with the keys ``of``."""
        own, now = 0.0, set(of)
        while True:
            inner = sorted({max(w, floor) for a, b, w in edges if a in now and b in now}, reverse=True)
            if not inner or inner[0] <= floor:
                return own + len(now) * (1 / floor - 1 / birth), None, of
            big = [p for p in parts(now, inner[0]) if len(p) >= min_size]
            if len(big) == 1:
                own += (len(now) - len(big[0])) * (1 / inner[0] - 1 / birth)
                now = big[0]
                continue
            own += len(now) * (1 / inner[0] - 1 / birth)
            return own, [grow(p, inner[0]) for p in big], of

    def pick(c):
        own, kids, of = c
        below = [pick(k) for k in kids or []]
        reach = sum(b for b, _ in below)
        return (own, [(frozenset(of), own)]) if own >= reach else (reach, [x for _, l in below for x in l])

    return {x for p in parts(keys, most + 1) if len(p) >= min_size for x in pick(grow(p, most))[1]}


def test_hierarchy_equals_recursion(spark):
    rng = np.random.default_rng(11)
    edges = [(int(rng.integers(0, b)), b, float(rng.uniform(0.001, 0.1))) for b in range(1, 120)]
    edges = [e for e in edges if e[2] < 0.095]  # several trees
    e = spark.createDataFrame(edges, "a long, b long, w double")
    _, found = clusters.boruvka(e)
    near = {k: min(w for a, b, w in edges if k in (a, b)) for k in {x for a, b, _ in edges for x in (a, b)}}
    nodes = found.join(spark.createDataFrame([(k, 1, w) for k, w in near.items()], "k long, n int, core double"), "k")
    for size, floor, task in ((2, 0.02, 10**6), (3, 0.004, 10**6), (3, 0.004, 15), (5, 0.001, 9)):
        want = {(s, round(own, 6)) for s, own in by_recursion(set(near), edges, 0.1, floor, size)}
        got: dict = {}
        for r in clusters.stable_clusters(e, nodes, 0.1, floor, size, task).collect():
            if r["cluster"] is not None:
                got.setdefault((r["cluster"], round(r["stability"], 6)), set()).add(r["k"])
        assert {(frozenset(v), s) for (_, s), v in got.items()} == want


def test_clusters_between_doublings(spark):
    """Two tight groups that join early, a third one soon after: each is seen, whatever the distances are."""
    turn = lambda deg, n: np.array([[np.cos(np.radians(deg + i * 0.2)), np.sin(np.radians(deg + i * 0.2)), 0, 0] for i in range(n)])
    x = np.concatenate([turn(0, 5), turn(14, 5), turn(32, 5)])
    by = {r["k"]: r["cluster"] for r in clusters.describe_clusters(frame(spark, x), "key", "vec", 4, least_cosine=0.9).collect()}
    assert [by[k] for k in range(15)] == [0] * 5 + [5] * 5 + [10] * 5
