"""Groups of mutually similar vectors by hierarchical density clustering over a distributed spanning forest."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.vectors import matrix, sample, unit_rows, usable
from tessella.session import materialize


def distinct_vectors(vectors: DataFrame, key: str, vector: str, dim: int, counted: bool = False) -> DataFrame:
    """The usable vectors, exact copies taken as one: ``k`` (smallest key), ``e``, ``last`` (largest key).

    ``counted`` adds ``n``, the number of keys that have the vector, which takes one more shuffle.
    """
    v, ends = usable(vectors, key, vector, dim), [F.min("k").alias("k"), F.max("k").alias("last")]
    return v.groupBy("e", "k").agg(F.lit(1).alias("one")).groupBy("e").agg(*ends, F.count("one").alias("n")) if counted else v.groupBy("e").agg(*ends)


def pivot_cells(vectors: DataFrame, pivots: np.ndarray, cells: int = 3) -> DataFrame:
    """Each vector with the ``cells`` pivots of highest cosine: ``cell, k, v`` (unit vector in single precision).

    Pivots are drawn from the data, so a dense part has many and even a third of all rows in one place is split.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(pivots.astype(np.float32))
    m = min(cells, len(pivots))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                u = unit_rows(matrix(part.column(1))).astype(np.float32)
                s, near = u @ p.T, np.empty((len(u), m), dtype=np.int32)
                for i in range(m):  # a few maxima of a row cost less than its partition
                    near[:, i] = s.argmax(1)
                    s[np.arange(len(s)), near[:, i]] = -2
                again = np.repeat(np.arange(len(u)), m)
                v = pa.ListArray.from_arrays(pa.array(np.arange(len(again) + 1, dtype=np.int32) * u.shape[1]), pa.array(u[again].ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(near.ravel()), part.column(0).take(pa.array(again)), v], names=["cell", "k", "v"])

    return vectors.select("k", "e").mapInArrow(place, f"cell int, k {vectors.schema['k'].dataType.simpleString()}, v array<float>")


def _close(x: np.ndarray, least: float, block: int = 2048) -> np.ndarray:
    """Which rows have another row of at least this cosine."""
    hit = np.zeros(len(x), dtype=bool)
    for at in range(0, len(x), block):
        s = x[at : at + block] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -2
        hit[at : at + block] = s.max(axis=1) >= least
    return hit


def spanning_edges(x: np.ndarray, core: np.ndarray, most: float) -> list[tuple[int, int, float]]:
    """A minimum spanning forest under mutual-reachability distance, of edges of cosine distance up to ``most``.

    Grown from one row at a time, so it needs memory for rows, not pairs.
    """
    n = len(x)
    best, source, todo, out = np.full(n, np.inf), np.full(n, -1), np.ones(n, dtype=bool), []
    for _ in range(n):
        u = int(np.argmin(np.where(todo, best, np.inf))) if np.isfinite(best[todo]).any() else int(np.flatnonzero(todo)[0])
        todo[u] = False
        if source[u] >= 0:
            out.append((int(source[u]), u, float(best[u])))
        d = np.maximum(0.0, 1.0 - x @ x[u])
        w = np.where(d <= most, np.maximum(np.maximum(d, core), core[u]), np.inf)
        nearer = todo & (w < best)
        best[nearer], source[nearer] = w[nearer], u
    return out


def core_distances(placed: DataFrame, reps: DataFrame, most: float, min_samples: int) -> DataFrame:
    """``k, core``: the distance within which a vector has ``min_samples`` keys, its own and its copies' counted.

    Every key of a vector (``n`` of ``reps``) is a sample, so a vector of enough copies has core distance 0. Vectors
    without so many samples up to ``most`` in the cells they share are not there. Takes one pass over the cells.
    """
    kind = placed.schema["k"].dataType.simpleString()

    def distances(of: pa.Table) -> pa.Table:
        x, k = matrix(of.column("v").combine_chunks()), of.column("k").to_numpy()
        m = min(min_samples - 1, len(x) - 1)
        rows = [(k[:0], k[:0], np.zeros(0))]
        for at in range(0, len(x), 2048):
            s = x[at : at + 2048] @ x.T
            s[np.arange(len(s)), np.arange(at, at + len(s))] = -2
            top = np.argpartition(s, len(x) - m, axis=1)[:, len(x) - m :] if m else np.zeros((len(s), 0), int)
            r, c = np.repeat(np.arange(len(s)), m), top.ravel()
            keep = s[r, c] >= 1 - most
            rows.append((k[at + r[keep]], k[c[keep]], np.maximum(0, 1 - s[r[keep], c[keep]]).astype(float)))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*rows)], names=["k", "other", "d"])

    copied = materialize(reps.where(F.col("n") > 1).select("k", "n"), "copied")
    near = placed.groupBy("cell").applyInArrow(distances, f"k {kind}, other {kind}, d double").groupBy("k", "other").agg(F.min("d").alias("d"))
    near = near.join(copied.select(F.col("k").alias("other"), F.col("n").alias("more")), "other", "left").join(copied, "k", "left")
    reached = F.coalesce("n", F.lit(1)) + F.sum(F.coalesce("more", F.lit(1))).over(Window.partitionBy("k").orderBy("d", "other").rowsBetween(Window.unboundedPreceding, 0))
    core = near.withColumn("reached", reached).where((F.coalesce("n", F.lit(1)) < min_samples) & (F.col("reached") >= min_samples)).groupBy("k").agg(F.min("d").alias("core"))
    return core.union(copied.where(F.col("n") >= min_samples).select("k", F.lit(0.0)))


def reachability_edges(placed: DataFrame, most: float, cores: DataFrame | None = None) -> DataFrame:
    """Edges ``a, b, w`` whose minimum spanning forest is that of the mutual-reachability graph within cells.

    The graph has an edge for every two vectors that share a cell and differ by at most ``most`` in cosine distance;
    its weight is the larger of that distance and both core distances (``cores``; without them two samples are meant,
    where a nearest neighbour is never farther than any other). Each cell sends its own forest only: an edge that is
    not in it is in no forest of the whole, so near copies never become all pairs.
    """
    kind = placed.schema["k"].dataType.simpleString()
    if cores is None:
        placed = placed.withColumn("core", F.lit(0.0))
    else:
        placed = placed.join(cores, "k", "left").withColumn("core", F.coalesce("core", F.lit(float("inf"))))

    def forest(of: pa.Table) -> pa.Table:
        x, core, k = matrix(of.column("v").combine_chunks()), of.column("core").to_numpy(), of.column("k").to_numpy()
        live = np.flatnonzero(_close(x, 1 - most) & np.isfinite(core)) if len(x) > 1 else np.zeros(0, int)
        edges = spanning_edges(x[live], core[live], most)
        i, j, w = (np.array(c) for c in zip(*edges)) if edges else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        a, b = k[live][i], k[live][j]
        return pa.table([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(w.astype(float))], names=["a", "b", "w"])

    return placed.groupBy("cell").applyInArrow(forest, f"a {kind}, b {kind}, w double").groupBy("a", "b").agg(F.min("w").alias("w"))


def boruvka(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Minimum spanning forest ``a, b, w`` of an edge list, and the component ``c`` of each node ``k`` in it.

    Every round each component takes its lightest edge (ties by the edge's ends, so choices never close a ring), the
    chosen edges are followed to one root per component, and the edges left are drawn between roots, the lightest of
    each two. Rounds at least halve the components. All tables stay distributed; each round is written once.
    """
    e = materialize(edges.where(F.col("a") != F.col("b")).select(F.col("a").alias("x"), F.col("b").alias("y"), F.struct("w", "a", "b").alias("edge")), "edges")
    nodes = materialize(e.select(F.col("x").alias("k")).union(e.select("y")).distinct().withColumn("c", F.col("k")), "nodes")
    forest = []
    while not e.isEmpty():
        ways = e.select(F.col("x").alias("c"), F.struct("edge", F.col("y").alias("to")).alias("way")).union(e.select("y", F.struct("edge", F.col("x").alias("to"))))
        chosen = materialize(ways.groupBy("c").agg(F.min("way").alias("way")).select("c", "way.edge", F.col("way.to").alias("p")), "chosen")
        forest.append(chosen.select("edge"))
        # Two components that chose each other share an edge: the smaller becomes the root.
        back = chosen.select(F.col("c").alias("p"), F.col("p").alias("pp"))
        up = chosen.select("c", "p").join(back, "p", "left").select("c", F.when((F.col("pp") == F.col("c")) & (F.col("c") < F.col("p")), F.col("c")).otherwise(F.col("p")).alias("p"))
        up = materialize(up, "up")
        while True:
            onward = up.select(F.col("c").alias("p"), F.col("p").alias("pp"))
            nxt = up.join(onward, "p", "left").select("c", F.col("pp").alias("q"), "p")
            jumped = materialize(nxt, "jump")
            if jumped.where(F.col("q") != F.col("p")).isEmpty():
                break
            up = jumped.select("c", F.col("q").alias("p"))
        roots = up.select(F.col("c"), F.col("p").alias("root"))
        nodes = nodes.join(roots, "c", "left").select("k", F.coalesce("root", "c").alias("c"))  # one small join a round, run at the end
        r1, r2 = roots.select(F.col("c").alias("x"), F.col("root").alias("rx")), roots.select(F.col("c").alias("y"), F.col("root").alias("ry"))
        e = materialize(
            e.join(r1, "x").join(r2, "y").where(F.col("rx") != F.col("ry")).groupBy(F.least("rx", "ry").alias("x"), F.greatest("rx", "ry").alias("y")).agg(F.min("edge").alias("edge")), "edges"
        )
    tree = edges.limit(0)
    if forest:
        parts = forest[0]
        for f in forest[1:]:
            parts = parts.union(f)
        tree = parts.distinct().select(F.col("edge.a").alias("a"), F.col("edge.b").alias("b"), F.col("edge.w").alias("w"))
    return tree, materialize(nodes, "nodes") if forest else nodes


def similarity_forest(vectors: DataFrame, key: str, vector: str, dim: int = 32, least_cosine: float = 0.985, min_samples: int = 2, cells: int = 3, max_pivots: int = 32_768, seed: int = 0, counted: bool = False, copies: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The distinct vectors, the spanning forest of their mutual-reachability graph, and its components.

    Pivots, about four times the square root of the number of vectors and at most ``max_pivots``, are a hash sample.
    More than two samples need ``counted``: copies count as samples, the components (``k, c, n, core``) also hold
    vectors that only their own copies are near to, and ``n`` and ``core`` are their keys and core distance. With two
    samples ``copies`` gives these columns too: a core distance is then that of the nearest vector, whose edge the
    forest always has, and 0 for a vector with copies.
    """
    if min_samples > 2 and not counted:
        raise ValueError("more than two samples to a core need counted copies")
    reps = materialize(distinct_vectors(vectors, key, vector, dim, counted or copies), "vectors")
    n = reps.count()
    fit, _ = sample(reps, min(max_pivots, max(16, int(4 * math.sqrt(n)))), seed)
    if not len(fit):
        none = reps.select("k").limit(0)
        nodes = none.withColumn("c", F.col("k"))
        return reps, none.select(F.col("k").alias("a"), F.col("k").alias("b"), F.lit(0.0).alias("w")), nodes.withColumns({"n": F.lit(0), "core": F.lit(0.0)}) if counted or copies else nodes
    placed = pivot_cells(reps, fit, cells)
    if not counted:
        tree, nodes = boruvka(reachability_edges(placed, 1 - least_cosine))
        if not copies:
            return reps, tree, nodes
        tree = materialize(tree, "tree")
        core = tree.select(F.explode(F.array("a", "b")).alias("k"), "w").groupBy("k").agg(F.min("w").alias("core"))
        many = reps.where(F.col("n") > 1).select("k", "n")
        every = nodes.join(core, "k").join(many, "k", "full").select("k", F.coalesce("c", "k").alias("c"), F.coalesce("n", F.lit(1)).alias("n"), F.when(F.col("n").isNotNull(), 0.0).otherwise(F.col("core")).alias("core"))
        return reps, tree, materialize(every, "weighted")
    placed = materialize(placed, "placed")
    cores = materialize(core_distances(placed, reps, 1 - least_cosine, min_samples), "cores")
    tree, nodes = boruvka(reachability_edges(placed, 1 - least_cosine, cores))
    # A vector alone has a core distance too, if its copies are samples enough.
    alone = cores.join(reps.where(F.col("n") > 1), "k", "left_semi").join(nodes, "k", "left_anti").select("k", F.col("k").alias("c"))
    return reps, tree, materialize(nodes.select("k", "c").union(alone).join(reps.select("k", "n"), "k").join(cores, "k"), "weighted")


def members(vectors: DataFrame, key: str, vector: str, dim: int, reps: DataFrame, nodes: DataFrame) -> DataFrame:
    """Every key with its component, exact copies with that of their representative: ``k, c, e``.

    Vectors without a component are alone; they form one only with exact copies of themselves.
    """
    labelled = reps.join(nodes, "k", "left").where(F.col("c").isNotNull() | (F.col("last") != F.col("k"))).select("e", F.coalesce("c", "k").alias("c"), "k", "last")
    single = labelled.where(F.col("k") == F.col("last")).select("k", "c", "e")
    # Copies find their group by the vector itself; only vectors that have copies are asked for.
    copied = labelled.where(F.col("k") != F.col("last")).select("e", "c")
    return single.union(usable(vectors, key, vector, dim).join(copied, "e").select("k", "c", "e").distinct())


def condense(nodes: pa.Table, edges: pa.Table, piece: int, min_size: int, floor: float) -> pa.Table:
    """One piece of the condensed hierarchy, from its finest edge upwards.

    ``nodes`` are ``label, n, core, total, sub, id``: single vectors or, with an ``id``, clusters that are open
    already; ``edges`` are ``a, b, w`` of a forest over them. Two clusters of at least ``min_size`` keys that meet are
    closed and a new one begins, anything smaller joins the cluster it meets; at distances up to ``floor`` nothing is
    divided. A closed cluster's stability ``own`` is the sum over its keys of 1 / distance at which each is in it, less
    that at which it meets its sibling; ``sub`` is the best that the clusters within it reach. Rows by ``kind``: 0 a
    node with its root, its part at ``floor`` and the first cluster it is in; 1 a root's state; 2 a closed cluster.
    """
    names, at = np.unique(np.concatenate([nodes.column("label").to_numpy(), edges.column("a").to_numpy(), edges.column("b").to_numpy()]), return_inverse=True)
    m, count = nodes.num_rows, edges.num_rows
    place = np.empty(len(names), dtype=np.int64)
    place[at[:m]] = np.arange(m)
    w = np.maximum(edges.column("w").to_numpy(), floor)
    order = np.argsort(w, kind="stable")
    steps = zip(w[order].tolist(), at[m : m + count][order].tolist(), at[m + count :][order].tolist())
    rows = nodes.select(["n", "core", "total", "sub", "id"]).take(pa.array(place)).to_pydict()
    n, total, sub, ids = rows["n"], rows["total"], rows["sub"], rows["id"]
    parent, loose = list(range(len(names))), [[i] if c is None else [] for i, c in enumerate(ids)]
    first: list[int | None] = [None] * len(names)
    lam: list[float | None] = [None] * len(names)
    part, closed, made = parent, [], piece << 40

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def enter(i: int, cluster: int, near: float) -> None:
        for leaf in loose[i]:
            first[leaf], lam[leaf] = cluster, near
        loose[i] = []

    def begin(i: int, near: float) -> None:
        nonlocal made
        made += 1
        ids[i], total[i] = made, n[i] * near
        enter(i, made, near)

    def open_clusters() -> None:
        for i in range(len(names)):
            if parent[i] == i and ids[i] is None and n[i] >= min_size:
                begin(i, 1 / (floor if len(loose[i]) > 1 else max(floor, rows["core"][i])))

    at_floor = True
    for d, a, b in steps:
        if at_floor and d > floor:
            at_floor, part = False, [root(i) for i in range(len(names))]
            open_clusters()
        a, b = sorted((root(a), root(b)))
        near = 1 / d
        parent[b] = a
        if at_floor:
            n[a], loose[a], loose[b] = n[a] + n[b], loose[a] + loose[b], []
            continue
        if ids[a] is not None and ids[b] is not None:
            made += 1
            best = 0.0
            for i in (a, b):
                own = total[i] - n[i] * near
                closed.append((ids[i], made, own, sub[i]))
                best += max(own, sub[i])
            n[a] += n[b]
            ids[a], total[a], sub[a] = made, n[a] * near, best
        elif ids[a] is None and ids[b] is None:
            n[a], loose[a], loose[b] = n[a] + n[b], loose[a] + loose[b], []
            if n[a] >= min_size:
                begin(a, near)
        else:
            has, small = (a, b) if ids[a] is not None else (b, a)
            enter(small, ids[has], near)
            ids[a], total[a], sub[a], n[a] = ids[has], total[has] + n[small] * near, sub[has], n[a] + n[b]
    if at_floor:
        part = [root(i) for i in range(len(names))]
        open_clusters()
    top = [root(i) for i in range(len(names))]
    ends = [i for i, r in enumerate(top) if i == r]
    kind = nodes.schema.field("label").type
    none: list = [None] * len(closed)
    shut = list(zip(*closed)) or [(), (), (), ()]
    lead = lambda i: pa.array(names[np.asarray(i, dtype=np.int64)], type=kind)
    gaps = [None] * len(names)
    return pa.table(
        {
            "kind": pa.array([0] * len(names) + [1] * len(ends) + [2] * len(closed), pa.int32()),
            "label": pa.concat_arrays([lead(range(len(names))), lead(ends), pa.array(none, kind)]),
            "root": pa.concat_arrays([lead(top), lead(ends), pa.array(none, kind)]),
            "part": pa.concat_arrays([lead(part), lead(ends), pa.array(none, kind)]),
            "id": pa.array(first + [ids[i] for i in ends] + list(shut[0]), pa.int64()),
            "up": pa.array(gaps + [None] * len(ends) + list(shut[1]), pa.int64()),
            "n": pa.array(gaps + [n[i] for i in ends] + none, pa.int64()),
            "lam": pa.array(lam + [None] * len(ends) + none, pa.float64()),
            "own": pa.array(gaps + [total[i] for i in ends] + list(shut[2]), pa.float64()),
            "sub": pa.array(gaps + [sub[i] for i in ends] + list(shut[3]), pa.float64()),
        }
    )


def stable_clusters(tree: DataFrame, nodes: DataFrame, most: float, floor: float, min_size: int, task_edges: int = 500_000) -> DataFrame:
    """The cluster of each node by stability: ``k, cluster, stability, lam, part`` (null cluster: noise).

    ``tree`` is the spanning forest ``a, b, w``, ``nodes`` its ``k, c, n, core``. The hierarchy is that of the forest's
    own merge distances from ``floor`` to ``most``. Components are dealt to tasks whole; where the largest has more
    than about ``task_edges`` edges, the forest is cut into steps of distance, and what a step has joined is one node
    of the next, which gives the same clusters. A cluster is selected if its stability is no less than what the
    clusters within it reach together and none above it is selected. ``lam``, 1 / distance from which a node is in a
    cluster at all, is its persistence; ``part`` names what is joined at ``floor``.
    """
    spark = tree.sparkSession
    kind = nodes.schema["k"].dataType.simpleString()
    largest, every = nodes.groupBy("c").agg(F.count(F.lit(1)).alias("here")).agg(F.max("here"), F.sum("here")).first()
    steps, buckets = max(1, -(-(largest or 0) // task_edges)), max(spark.sparkContext.defaultParallelism, 2 * -(-(every or 0) // task_edges))
    bucket = F.pmod(F.hash("c"), F.lit(buckets)).alias("bucket")
    edges = tree.join(nodes.select(F.col("k").alias("a"), "c"), "a").select("a", "b", "w", bucket)
    state = nodes.select(F.col("k").alias("label"), F.col("n").cast("long").alias("n"), "core", F.lit(0.0).alias("total"), F.lit(0.0).alias("sub"), F.lit(None).cast("long").alias("id"), bucket)
    cuts, points = [most], None
    if steps > 1:
        # Distances only deal out the work, so approximate ones will do. What lies at the floor is joined beforehand.
        edges = materialize(edges, "steps")
        inner = edges.where((F.col("w") > floor) & (F.col("w") < most))
        cuts = sorted({*(inner.agg(F.percentile_approx("w", [i / steps for i in range(1, steps)])).first()[0] or []), most})
        _, joined = boruvka(tree.where(F.col("w") <= floor))
        parts = nodes.select("k", "n", "core", bucket).join(joined, "k", "left").withColumn("part", F.coalesce("c", "k"))
        points = materialize(parts.select("k", "part", F.col("part").alias("label"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("double").alias("lam")), "points")
        state = parts.groupBy(F.col("part").alias("label"), "bucket").agg(F.sum("n").cast("long").alias("n"), F.when(F.count(F.lit(1)) > 1, F.lit(floor)).otherwise(F.min("core")).alias("core"))
        state = state.withColumns({"total": F.lit(0.0), "sub": F.lit(0.0), "id": F.lit(None).cast("long")})
    schema = f"bucket int, kind int, label {kind}, root {kind}, part {kind}, id long, up long, n long, lam double, own double, sub double"
    shut, below = [], floor if steps > 1 else -1.0
    for step, cut in enumerate(cuts):

        def piece(key: tuple, of: pa.Table, joins: pa.Table) -> pa.Table:
            b = key[0].as_py()
            out = condense(of, joins, step * buckets + b, min_size, floor)
            return out.add_column(0, "bucket", pa.array([b] * out.num_rows, pa.int32()))

        now = edges.where((F.col("w") > below) & (F.col("w") <= cut))
        if points is not None:
            ends = points.select("k", "label")
            now = now.join(ends.withColumnsRenamed({"k": "a", "label": "x"}), "a").join(ends.withColumnsRenamed({"k": "b", "label": "y"}), "b").select(F.col("x").alias("a"), F.col("y").alias("b"), "w", "bucket")
        out = materialize(state.groupBy("bucket").cogroup(now.groupBy("bucket")).applyInArrow(piece, schema), "condensed")
        leaf = out.where("kind = 0").select("label", "root", "part", "id", "lam")
        if points is None:
            points = leaf.select(F.col("label").alias("k"), "part", "id", "lam")
        else:
            to = leaf.select("label", "root", F.col("id").alias("first"), F.col("lam").alias("at"))
            points = materialize(points.join(to, "label").select("k", "part", F.col("root").alias("label"), F.coalesce("id", "first").alias("id"), F.coalesce("lam", "at").alias("lam")), "points")
        state = out.where("kind = 1").select("label", "n", F.lit(0.0).alias("core"), F.col("own").alias("total"), "sub", "id", "bucket")
        shut.append(out.where("kind = 2").select("id", "up", "own", "sub"))
        below = cut
    chosen = state.where(F.col("id").isNotNull()).select("id", F.lit(None).cast("long").alias("up"), (F.col("total") - F.col("n") / most).alias("own"), "sub")
    for s in shut:
        chosen = chosen.union(s)
    # The topmost cluster that is no worse than those within it, found by doubling the way up in every round.
    chosen = materialize(chosen.select("id", "up", F.when(F.col("own") >= F.col("sub"), F.struct(F.col("id").alias("cluster"), F.col("own").alias("stability"))).alias("pick")), "picked")
    while not chosen.where(F.col("up").isNotNull()).isEmpty():
        above = chosen.select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("pick").alias("held"))
        chosen = materialize(chosen.join(above, "up", "left").select("id", F.col("next").alias("up"), F.coalesce("held", "pick").alias("pick")), "picked")
    named = points.join(chosen.select("id", "pick"), "id", "left").select("k", "pick.cluster", "pick.stability", "lam", "part")
    return named


def similar_pairs(vectors: DataFrame, key: str, vector: str, dim: int = 32, least_cosine: float = 0.985, reach: float = 2.0) -> DataFrame:
    """Pairs of different keys in one cluster of the density hierarchy, as near as ``least_cosine``: ``key_1 < key_2, cosine``.

    The condensed hierarchy (two samples to a core, clusters of two keys and more) begins at that distance, below which
    no cluster is divided, and goes up to ``reach`` times it. Pairs are those of a cluster that stability selects, met
    within its parts at the lowest distance and checked exactly. Vectors that are null, of another length, all
    zero or not finite take no part, repeated rows count once, an empty table gives no pairs. Where groups of similar
    keys are very large ``describe_clusters`` names them without expanding their pairs.
    """
    floor = 1 - least_cosine
    reps, tree, nodes = similarity_forest(vectors, key, vector, dim, 1 - reach * floor, 2, copies=True)
    chosen = stable_clusters(tree, nodes, reach * floor, floor, 2).where(F.col("cluster").isNotNull())
    found = materialize(chosen.select("k", F.col("part").alias("c")), "found")
    m = materialize(members(vectors, key, vector, dim, reps, found), "members")
    norm = F.sqrt(F.aggregate("e", F.lit(0.0), lambda s, x: s + x * x))
    m = m.withColumn("u", F.transform("e", lambda x: x / norm)).select("k", "c", "u")
    a, b = m.select(F.col("k").alias("key_1"), "c", F.col("u").alias("u1")), m.select(F.col("k").alias("key_2"), "c", F.col("u").alias("u2"))
    cosine = F.aggregate(F.zip_with("u1", "u2", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return a.join(b, "c").where(F.col("key_1") < F.col("key_2")).select("key_1", "key_2", cosine.alias("cosine")).where(F.col("cosine") >= least_cosine - 1e-12)


def describe_clusters(vectors: DataFrame, key: str, vector: str, dim: int = 32, least_cosine: float = 0.9, min_samples: int = 3, min_size: int = 3, finest: float = 1e-3, exemplars: int = 3) -> DataFrame:
    """Each key with its cluster: ``k, cluster, size, stability, exemplar`` (1, 2, ... for the most typical members).

    Keys without a cluster are noise (null cluster) and are there too. The most persistent members, those that stay
    in their cluster down to the smallest distance, are its exemplars; the nearer to a neighbour the better, then the
    smaller key. The hierarchy is that of all merge distances down to ``finest``, below which nothing is told apart;
    a cluster is named by its smallest key. Copies of a vector are in the same cluster, and each counts as a sample and
    for the size, so copies alone can be one. Vectors that take no part (null, of another length, zero, not finite)
    give no row, repeated rows count once, an empty table gives no rows.
    """
    reps, tree, nodes = similarity_forest(vectors, key, vector, dim, least_cosine, min_samples, counted=True)
    tree = materialize(tree, "tree")
    found = stable_clusters(tree, nodes, 1 - least_cosine, finest, min_size)
    copies_near = nodes.where(F.col("n") > 1).select("k", F.col("core").alias("w"))
    nearest = tree.select(F.explode(F.array("a", "b")).alias("k"), "w").union(copies_near).groupBy("k").agg(F.min("w").alias("w"))
    of_rep = materialize(reps.join(found, "k", "left").join(nearest, "k", "left").select("e", F.col("k").alias("rep"), "last", "cluster", "stability", "lam", "w"), "found")
    shared = ["cluster", "stability", "lam", "w"]
    single = of_rep.where(F.col("rep") == F.col("last")).select(F.col("rep").alias("k"), *shared)
    copies = usable(vectors, key, vector, dim).join(of_rep.where(F.col("rep") != F.col("last")).select("e", *shared), "e").select("k", *shared).distinct()
    every = materialize(single.unionByName(copies), "every")
    sizes = every.where(F.col("cluster").isNotNull()).groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.min("k").alias("name"))
    order = Window.partitionBy("cluster").orderBy(F.desc("lam"), "w", "k")
    typical = every.where(F.col("cluster").isNotNull()).withColumn("exemplar", F.row_number().over(order)).where(F.col("exemplar") <= exemplars).select("k", "exemplar")
    return every.join(sizes, "cluster", "left").join(typical, "k", "left").select("k", F.col("name").alias("cluster"), "size", "stability", "exemplar")
