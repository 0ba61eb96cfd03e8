"""Communities of a weighted graph by distributed local moves, merging and splitting into connected parts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.operators.order import running_sums
from tessella.session import materialize


def _moves(edges: DataFrame, sizes: DataFrame, resolution: float, rounds: int, objective: str) -> DataFrame:
    """``k, c`` after rounds in which half of the nodes at a time move to the neighbouring community of most gain.

    Ends when neither half moves a node, or after ``rounds``.
    """
    both = edges.select("src", "dst", "weight").union(edges.where(F.col("src") != F.col("dst")).select("dst", "src", "weight"))
    if objective == "modularity":
        weight = both.groupBy(F.col("src").alias("k")).agg(F.sum(F.when(F.col("src") == F.col("dst"), 2 * F.col("weight")).otherwise(F.col("weight"))).alias("deg"))
    else:
        weight = both.select(F.col("src").alias("k")).distinct().join(sizes, "k").select("k", F.col("size").cast("double").alias("deg"))
    weight = materialize(weight, "degree")
    total = (weight.agg(F.sum("deg")).first()[0] or 1.0) if objective == "modularity" else 1.0
    both = materialize(both.where(F.col("src") != F.col("dst")), "links")
    labels, still = weight.select("k", F.col("k").alias("c"), "deg"), 0
    for i in range(rounds):
        size = labels.groupBy("c").agg(F.sum("deg").alias("tot"))
        near = both.join(labels.select(F.col("k").alias("dst"), "c"), "dst").groupBy(F.col("src").alias("k"), "c").agg(F.sum("weight").alias("into"))
        own = labels.select("k", F.col("c").alias("own"), "deg")
        scored = near.unionByName(labels.select("k", "c", F.lit(0.0).alias("into"))).groupBy("k", "c").agg(F.sum("into").alias("into")).join(own, "k").join(size, "c")
        rest = F.col("tot") - F.when(F.col("c") == F.col("own"), F.col("deg")).otherwise(0.0)
        gain = F.col("into") - resolution * F.col("deg") * rest / total
        best = scored.groupBy("k").agg(F.max_by("c", F.struct(F.round(gain, 12), (F.col("c") == F.col("own")), -F.col("c"))).alias("to"))
        moving = F.pmod(F.xxhash64("k", F.lit(i // 2)) + i, F.lit(2)) == 0  # two rounds let every node move once
        now = F.when(moving, F.coalesce("to", "c")).otherwise(F.col("c"))
        moved = materialize(labels.join(best, "k", "left").select("k", now.alias("c"), "deg", (now != F.col("c")).alias("moved")), "labels")
        still = 0 if not moved.where("moved").isEmpty() else still + 1
        labels = moved.drop("moved")
        if still == 2:
            break
    return labels.select("k", "c")


#: Edges up to which one task holds the graph and moves its nodes by itself; it takes about 60 bytes an edge where weights are few.
MOST_LOCAL = 20_000_000
#: Edges up to which parts are found in one task after moves in many, and graphs of a sweep are held side by side.
MOST_PARTS = 4_000_000
#: Edges of the nodes whose moves are found at a time, of those one task holds.
AT_A_TIME = 500_000
#: Resolutions of a sweep that are tried at the same time.
SIDE_BY_SIDE = 2


def _moves_of(src: np.ndarray, dst: np.ndarray, weight: np.ndarray, turn: np.ndarray, size: np.ndarray, resolution: float, rounds: int, objective: str) -> np.ndarray:
    """As ``_moves``, over nodes 0, 1, ...: each one's community. Bit ``i`` of ``turn`` is the half of a node in rounds 2 ``i`` and 2 ``i`` + 1."""
    n, values = len(size), np.unique(weight)
    few = len(values) <= 256  # then a byte tells an edge's weight
    w = np.searchsorted(values, weight).astype("uint8") if few else weight
    deg = size.astype(float)
    if objective == "modularity":
        deg = np.bincount(src, weight, n) + np.bincount(dst, weight, n)
    total = (deg.sum() or 1.0) if objective == "modularity" else 1.0
    apart = src != dst
    if not apart.all():
        src, dst, w = src[apart], dst[apart], w[apart]
    small = "int32" if n < 1 << 31 else "int64"
    a = np.concatenate([src, dst], dtype=small, casting="same_kind")
    starts = np.concatenate([[0], np.cumsum(np.bincount(a, minlength=n))])
    order = np.argsort(a, kind="stable")
    del a
    b, w = np.concatenate([dst, src], dtype=small, casting="same_kind")[order], np.concatenate([w, w])[order]
    del order
    ends = np.unique(np.concatenate([np.searchsorted(starts, np.arange(0, len(b), AT_A_TIME)), [0, n]]))
    own, still = np.arange(n), 0
    for i in range(rounds):
        moving = ((turn >> (i // 2)) + i) % 2 == 0
        tot, now = np.bincount(own, deg, n), own.copy()
        for low, high in zip(ends[:-1], ends[1:]):
            # Nodes move by the state before the round, so those of a stretch need no other's edges.
            at, nodes = slice(starts[low], starts[high]), low + np.flatnonzero(moving[low:high])
            if not len(nodes):
                continue
            a = np.repeat(np.arange(low, high), np.diff(starts[low : high + 1]))
            some = moving[a]
            a, into = a[some], w[at][some]
            # Weight into each neighbouring community, and none into the own one.
            key = np.concatenate([a * n + own[b[at][some]], nodes * n + own[nodes]])
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            into = np.add.reduceat(np.concatenate([values[into] if few else into, np.zeros(len(nodes))])[order], first)
            k, c = np.divmod(key[first], n)
            stays = c == own[k]
            gain = np.round(into - resolution * deg[k] * (tot[c] - np.where(stays, deg[k], 0.0)) / total, 12)
            begin = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            most = np.flatnonzero(gain == np.repeat(np.maximum.reduceat(gain, begin), np.diff([*begin, len(k)])))
            k, c, stays = k[most], c[most], stays[most]
            best = np.lexsort((-c, stays, k))
            last = best[np.concatenate([k[best][1:] != k[best][:-1], [True]])]
            now[k[last]] = c[last]
        still = 0 if (now != own).any() else still + 1
        own = now
        if still == 2:
            break
    return own


def _parts_of(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest node that is connected with each of 0, 1, ..., by edges in either direction."""
    name = np.arange(n)
    while True:
        before = name.copy()
        np.minimum.at(name, a, before[b])
        np.minimum.at(name, b, before[a])
        name = name[name]
        if (name == before).all():
            return name


def _in_one_task(edges: DataFrame, more: list[str], make: Callable[..., tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """``k, c`` that ``make`` finds of all edges in one task.

    It gets the keys in order, the columns ``more`` of edges, or by node those that are there as ``_s`` and ``_d`` for
    an edge's ends, and both ends' places among the keys.
    """
    kind = edges.schema["src"].dataType.simpleString()
    ends = [c[:-2] for c in more if c.endswith("_s")]
    each = [c for c in more if c[-2:] not in ("_s", "_d")]

    def named(pdfs: list[pd.DataFrame], keys: np.ndarray | None, of: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        held = [v for pdf in pdfs for v in (pdf.src.to_numpy(), pdf.dst.to_numpy())]
        keys, at = np.unique(np.concatenate([*([] if keys is None else [keys]), *held]), return_index=True)
        found = [np.concatenate([*(of[j : j + 1]), *(pdf[c + e].to_numpy() for pdf in pdfs for e in ("_s", "_d"))])[at] for j, c in enumerate(ends)]
        return keys, found

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Of the ends only keys are kept, what belongs to nodes is once for each; then places take half of the keys' memory.
        src, dst, values, waiting, rows, keys, of = [], [], [[] for _ in each], [], 0, None, []
        for pdf in batches:
            if len(pdf):
                src.append(pdf.src.to_numpy().copy()), dst.append(pdf.dst.to_numpy().copy()), waiting.append(pdf)
                for v, c in zip(values, each):
                    v.append(pdf[c].to_numpy().copy())
                rows += len(pdf)
                if rows >= 2_000_000:
                    (keys, of), waiting, rows = named(waiting, keys, of), [], 0
        if waiting:
            keys, of = named(waiting, keys, of)
            waiting = []
        if keys is not None:
            small = "int32" if len(keys) < 1 << 31 else "int64"
            for v in (src, dst):
                for i, x in enumerate(v):
                    v[i] = np.searchsorted(keys, x).astype(small)
            places = []
            for v in (src, dst, *values):
                places.append(np.concatenate(v))
                v.clear()
            k, c = make(keys, *places, *of)
            yield pd.DataFrame({"k": k, "c": c})

    return edges.select("src", "dst", *more).coalesce(1).mapInPandas(whole, f"k {kind}, c {kind}")


def _merged(s: np.ndarray, d: np.ndarray, weight: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of communities that edges join, as ``smaller * n + larger`` in order, and their summed weights; by stretches."""
    pairs, sums = [], []
    for at in range(0, len(s), 4 * AT_A_TIME):
        here = slice(at, at + 4 * AT_A_TIME)
        pair, back = np.unique(np.minimum(s[here], d[here]).astype("int64") * n + np.maximum(s[here], d[here]), return_inverse=True)
        pairs.append(pair), sums.append(np.bincount(back, weight[here], len(pair)))
    if len(pairs) == 1:
        return pairs[0], sums[0]
    pair, back = np.unique(np.concatenate(pairs), return_inverse=True)
    return pair, np.bincount(back, np.concatenate(sums), len(pair))


def _levels_in_one_task(graph: DataFrame, sizes: DataFrame, resolution: float, rounds: int, levels: int, objective: str, split: bool) -> DataFrame:
    """``k, c`` of all nodes after ``levels`` of moving and merging, in one task; with ``split``, connected parts of those."""

    def turn(c: str) -> Column:
        bits = [F.shiftleft(F.pmod(F.xxhash64(c, F.lit(i)), F.lit(2)), i) for i in range((rounds + 1) // 2)]
        return reduce(lambda x, y: x.bitwiseOR(y), bits, F.lit(0).cast("bigint"))

    g = graph.withColumns({"turn_s": turn("src"), "turn_d": turn("dst")})
    if objective == "modularity":
        g = g.withColumns({"size_s": F.lit(1), "size_d": F.lit(1)})
    else:
        g = g.join(sizes.select(F.col("k").alias("src"), F.col("size").alias("size_s")), "src").join(sizes.select(F.col("k").alias("dst"), F.col("size").alias("size_d")), "dst")

    def make(keys: np.ndarray, src: np.ndarray, dst: np.ndarray, weight: np.ndarray, turns: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found, node = np.arange(len(keys)), np.arange(len(keys))
        whole_src, whole_dst = src, dst
        for _ in range(levels):
            # ``node`` are the communities so far, by their place among all nodes; those of this level are numbered in order.
            moved = node[_moves_of(src, dst, weight, turns[node], size, resolution, rounds, objective)]
            found = moved[np.searchsorted(node, found)]
            if (moved == node).all():
                break
            nxt = np.unique(moved)
            to = np.searchsorted(nxt, moved).astype(src.dtype)
            pair, weight = _merged(to[src], to[dst], weight, len(nxt))
            size = np.bincount(to, size, len(nxt)).astype("int64")
            (src, dst), node = np.divmod(pair, len(nxt)), nxt
        if split:
            inside = found[whole_src] == found[whole_dst]
            found = _parts_of(whole_src[inside], whole_dst[inside], len(keys))
        return keys, keys[found]

    return _in_one_task(g, ["weight", "turn_s", "turn_d", "size_s", "size_d"], make)


def connected_parts(edges: DataFrame, labels: DataFrame, most_local: int = MOST_LOCAL) -> DataFrame:
    """``k, c``: communities split into their connected parts, each named by its smallest node.

    Every round a node takes the smallest name among itself and its neighbours of the same community; up to
    ``most_local`` edges that is one task's work.
    """
    a, b = labels.select(F.col("k").alias("src"), F.col("c").alias("s")), labels.select(F.col("k").alias("dst"), F.col("c").alias("d"))
    inside = edges.join(a, "src").join(b, "dst").where((F.col("s") == F.col("d")) & (F.col("src") != F.col("dst"))).select("src", "dst")
    inside = materialize(inside.union(inside.select("dst", "src")).distinct(), "inside")
    if inside.count() <= 2 * most_local:

        def make(keys: np.ndarray, src: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return keys, keys[_parts_of(src, dst, len(keys))]

        linked = _in_one_task(inside, [], make)
        return materialize(labels.select("k").join(linked, "k", "left").select("k", F.coalesce("c", "k").alias("c")), "names")
    names = labels.select("k", F.col("k").alias("c"))
    while True:
        seen = inside.join(names.select(F.col("k").alias("dst"), "c"), "dst").groupBy(F.col("src").alias("k")).agg(F.min("c").alias("near"))
        nxt = materialize(names.join(seen, "k", "left").select("k", F.least("c", F.coalesce("near", "c")).alias("c"), F.col("c").alias("before")), "names")
        # The name's own name is smaller still, if it has found one: long chains shorten by half.
        names = nxt.select("k", "c")
        names = materialize(names.join(names.select(F.col("k").alias("c"), F.col("c").alias("up")), "c").select("k", F.col("up").alias("c")), "names")
        if nxt.where(F.col("c") != F.col("before")).isEmpty():
            return names


def communities(edges: DataFrame, resolution: float = 1.0, rounds: int = 12, levels: int = 10, objective: str = "modularity", most_local: int = MOST_LOCAL) -> DataFrame:
    """``k, community`` of the nodes of ``src, dst, weight`` (keys are numbers), from 1 for the largest community.

    ``objective`` is ``modularity`` or ``cpm`` (constant Potts: a community's inner weight against ``resolution`` times
    its pairs of nodes). Nodes move in alternating halves, so neighbours do not swap for ever, until none gains or
    after ``rounds``; then communities become nodes and move again, until none joins another. What is not connected is split at the end. In
    contrast to the sequential algorithms of this family there is no randomized refinement between levels. Every
    step is a join and an aggregation, until a level has at most ``most_local`` edges: one task holds those and makes
    the same moves for the levels that are left. Nodes without edges are not there; an empty table gives no rows.
    """
    if objective not in ("modularity", "cpm"):
        raise ValueError(f"unknown objective {objective}")
    return _communities(_written(edges), resolution, rounds, levels, objective, most_local)


def _written(edges: DataFrame) -> DataFrame:
    return materialize(edges.select("src", "dst", F.col("weight").cast("double").alias("weight")), "edges")


def _communities(edges: DataFrame, resolution: float = 1.0, rounds: int = 12, levels: int = 10, objective: str = "modularity", most_local: int = MOST_LOCAL) -> DataFrame:
    found, graph = None, edges
    sizes = edges.select(F.col("src").alias("k")).union(edges.select("dst")).distinct().withColumn("size", F.lit(1))
    for level in range(levels):
        local = graph.count() <= most_local
        moved = materialize(_levels_in_one_task(graph, sizes, resolution, rounds, levels - level, objective, level == 0), "moved") if local else _moves(graph, sizes, resolution, rounds, objective)
        found = moved if found is None else found.select("k", F.col("c").alias("b")).join(moved.withColumnsRenamed({"k": "b", "c": "c"}), "b").select("k", "c")
        found = materialize(found, "found")
        if local or moved.where(F.col("k") != F.col("c")).isEmpty():
            break
        a, b = moved.select(F.col("k").alias("src"), F.col("c").alias("s")), moved.select(F.col("k").alias("dst"), F.col("c").alias("d"))
        graph = materialize(graph.join(a, "src").join(b, "dst").groupBy(F.least("s", "d").alias("src"), F.greatest("s", "d").alias("dst")).agg(F.sum("weight").alias("weight")), "graph")
        sizes = materialize(sizes.join(moved, "k").groupBy(F.col("c").alias("k")).agg(F.sum("size").alias("size")), "sizes")
    parts = found if local and level == 0 else connected_parts(edges, found, min(most_local, MOST_PARTS))
    counted = parts.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    return parts.join(numbered_by_size(counted, "c"), "c").select("k", "community")


def numbered_by_size(counted: DataFrame, name: str) -> DataFrame:
    """``name, community``: numbers from 1 for the largest ``n``, ties by name, without sorting all in one task."""
    upto = running_sums(counted.select("n", name, F.lit(1).alias("one")), [F.desc("n"), name], ["one"])
    return upto.select(name, F.col("upto_one").cast("int").alias("community"))


def resolution_sweep(edges: DataFrame, resolutions: list[float], most: int = 100, objective: str = "modularity") -> tuple[DataFrame, list[tuple[float, int]]]:
    """``resolution, k, community`` of those resolutions that give more communities than the ones kept before.

    Resolutions are tried in ascending order over one graph; the sweep ends with the first that gives more than
    ``most`` communities, which is not kept. Also returns each resolution tried with its number of communities.
    """
    if objective not in ("modularity", "cpm"):
        raise ValueError(f"unknown objective {objective}")
    graph, kept, tried, last = _written(edges), None, [], 0
    ordered = sorted(resolutions)
    ahead: list[DataFrame] = []
    side = SIDE_BY_SIDE if graph.count() <= MOST_PARTS else 1  # two tasks of one executor might hold the graph
    for i, r in enumerate(ordered):
        if not ahead:  # a few at a time: where a graph is one task's work, they do not wait for each other
            with ThreadPoolExecutor(side) as pool:
                ahead = list(pool.map(lambda x: materialize(_communities(graph, x, objective=objective), "swept"), ordered[i : i + side]))
        found = ahead.pop(0)
        n = found.agg(F.max("community")).first()[0] or 0
        tried.append((r, n))
        if n > most:
            break
        if n > last:
            rows = found.select(F.lit(float(r)).alias("resolution"), "k", "community")
            kept, last = rows if kept is None else kept.unionByName(rows), n
    return (kept if kept is not None else edges.sparkSession.createDataFrame([], "resolution double, k bigint, community int")), tried


def modularity(edges: DataFrame, labels: DataFrame, resolution: float = 1.0) -> DataFrame:
    """One row ``modularity`` of a partition ``k, community``."""
    a, b = labels.select(F.col("k").alias("src"), F.col("community").alias("s")), labels.select(F.col("k").alias("dst"), F.col("community").alias("d"))
    e = edges.join(a, "src").join(b, "dst")
    ends = e.select(F.explode(F.array(F.struct(F.col("s").alias("c"), "weight"), F.struct(F.col("d").alias("c"), "weight"))).alias("x")).groupBy("x.c").agg(F.sum("x.weight").alias("deg"))
    inside = e.groupBy(F.lit(1).alias("one")).agg(F.sum(F.when(F.col("s") == F.col("d"), F.col("weight")).otherwise(0.0)).alias("inside"), F.sum("weight").alias("m"))
    spread = ends.groupBy(F.lit(1).alias("one")).agg(F.sum(F.col("deg") * F.col("deg")).alias("sq"))
    return inside.join(spread, "one").select((F.col("inside") / F.col("m") - resolution * F.col("sq") / (4 * F.col("m") * F.col("m"))).alias("modularity"))
