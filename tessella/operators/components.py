"""Principal components of cells, and their nearest neighbours in a space of any dimension."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import parquet
from pyarrow.fs import FileSystem
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.session import drop, materialize

#: Longest directions along which tiles are cut, and along which their boxes are held against queries.
CUT_AXES, BOUND_AXES = 6, 12
#: Queries whose products with a tile are made at a time, so that they stay in the cache.
ROWS = 512
#: Tiles each tile of queries asks by itself at first, from the nearest on; tiles of a group; groups and queries then held against each other at a time.
FIRST, GROUP, TOGETHER, HELD = 16, 8, 64, 2048
#: Queries, of many tiles, that ask a tile together: most have few that need to.
MANY = 32_768


def gene_vectors(values: DataFrame, genes: DataFrame) -> DataFrame:
    """``k, e``: one array per cell over the listed genes (``gene, rank`` from 1 on), zeros where a value is absent."""
    size = genes.agg(F.max("rank")).first()[0] or 0
    held = values.join(F.broadcast(genes.select("gene", "rank")), "gene").groupBy(F.col("cell").alias("k")).agg(F.map_from_entries(F.collect_list(F.struct(F.col("rank").cast("int"), "value"))).alias("m"))  # a panel of genes
    return held.select("k", F.transform(F.sequence(F.lit(1), F.lit(int(size))), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0))).alias("e"))


def pca_scores(vectors: DataFrame, components: int, scale: bool = True) -> tuple[DataFrame, list[float]]:
    """``k, v``: each vector's scores on the first principal components, and the components' shares of variance.

    Columns are centred and, with ``scale``, divided by their standard deviation; constant columns become zeros. The
    covariance matrix is summed up by Spark; only that matrix, columns by columns, is decomposed on the driver.
    """
    vectors = materialize(vectors.select("k", "e"), "unscaled")  # read four times
    v = vectors.select("k", array_to_vector("e").alias("e"))
    scaled = StandardScaler(inputCol="e", outputCol="z", withMean=True, withStd=scale).fit(v).transform(v)
    width = len(vectors.select("e").first()[0])
    model = PCA(k=min(components, width), inputCol="z", outputCol="pc").fit(scaled)
    return model.transform(scaled).select("k", vector_to_array("pc").alias("v")), [float(s) for s in model.explainedVariance]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None, :], 0))


class _Tree:
    """Median cuts of a sample along its longest directions; every vector falls in one of ``2 ** depth`` leaves."""

    def __init__(self, x: np.ndarray, depth: int):
        self.mean = x.mean(0)
        y = (x - self.mean) / max(np.abs(x - self.mean).max(), 1e-300)
        # Rotated, distances stay the same: how far a box lies off along some of the axes is never more than the distance.
        self.axes = np.linalg.svd(np.linalg.qr(y, mode="r"))[2].T[:, :BOUND_AXES]
        self.depth, inner = depth, 2**depth - 1
        self.axis, self.cut, self.centres = np.zeros(inner, int), np.full(inner, np.inf), np.zeros((2 * inner + 1, x.shape[1]))
        y, at = self.turned(x), [np.arange(len(x))]
        for node in range(2 * inner + 1):
            rows = at[node]
            self.centres[node] = x[rows].mean(0) if len(rows) else self.centres[(node - 1) // 2]
            if node < inner:
                if len(rows):
                    self.axis[node] = _widest(y[rows])
                    self.cut[node] = np.median(y[rows, self.axis[node]])
                right = y[rows, self.axis[node]] > self.cut[node]
                at += [rows[~right], rows[right]]
        self.centres = self.centres[inner:]

    def turned(self, x: np.ndarray) -> np.ndarray:
        """Places along the longest directions."""
        return (x - self.mean) @ self.axes

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector; those next to each other have near numbers."""
        y, node = self.turned(x), np.zeros(len(x), int)
        for _ in range(self.depth):
            node = 2 * node + 1 + (y[np.arange(len(y)), self.axis[node]] > self.cut[node])
        return node - (2**self.depth - 1)

    def tiles(self, x: np.ndarray, most: int) -> list[np.ndarray]:
        """The rows of vectors, cut in halves until none has more than ``most``."""
        y, waiting, done = self.turned(x), [np.arange(len(x))], []
        while waiting:
            rows = waiting.pop()
            if len(rows) <= most:
                done.append(rows)
                continue
            rows = rows[np.argsort(y[rows, _widest(y[rows])], kind="stable")]
            waiting += [rows[len(rows) // 2 :], rows[: len(rows) // 2]]
        return done


def _widest(y: np.ndarray) -> int:
    """The axis among the first ones along which most rows spread farthest; a few far off do not count."""
    low, high = np.percentile(y[:, :CUT_AXES], [10, 90], axis=0)
    return int(np.argmax(high - low))


class _Tiles:
    """Vectors in tiles of near ones: row ``i`` of tile ``t`` stands at ``starts[t] + i``."""

    def __init__(self, keys: np.ndarray, x: np.ndarray, starts: np.ndarray, centres: np.ndarray):
        self.keys, self.x, self.starts, self.centres = keys, x, starts, centres

    def prepare(self, tree: _Tree) -> _Tiles:
        """Each tile's box along the tree's axes, and vectors in single precision, once in each process."""
        if not hasattr(self, "low"):
            spans, y = [slice(a, b) for a, b in zip(self.starts[:-1], self.starts[1:])], tree.turned(self.x)
            self.low, self.high = np.array([y[s].min(0) for s in spans]), np.array([y[s].max(0) for s in spans])
            near = np.argsort(self.centres, kind="stable")
            self.groups = np.array_split(near, -(-len(near) // GROUP))
            self.group_low, self.group_high = np.array([self.low[g].min(0) for g in self.groups]), np.array([self.high[g].max(0) for g in self.groups])
            self.far = len(tree.mean) * max(np.abs(self.x).max(), np.abs(tree.mean).max())
            self.shift = self.x.mean(0)
            self.narrow = []
            for s in spans:
                y = self.x[s] - self.shift
                n = (y * y).sum(1)
                self.narrow.append((np.ascontiguousarray(np.column_stack([y, n, np.ones(len(y))]).T.astype("float32")), n.max()))
        return self

    def least(self, q: np.ndarray, tree: _Tree, some: np.ndarray | slice = slice(None), single: bool = False, groups: bool = False) -> np.ndarray:
        """How near each tile's vectors, those of ``some`` tiles or of groups of tiles, can be to each of ``q`` at most."""
        least, most = (self.group_low, self.group_high) if groups else (self.low, self.high)
        y, low, high = (v.T.astype("float32" if single else "float64", order="C") for v in (tree.turned(q), least[some], most[some]))
        out, gap, other = (np.empty((low.shape[1], len(q)), y.dtype) for _ in range(3))
        out.fill(0)
        for i in range(len(y)):
            np.subtract(low[i, :, None], y[i], out=gap)
            np.subtract(y[i], high[i, :, None], out=other)
            np.maximum(gap, other, out=gap)
            np.maximum(gap, 0, out=gap)
            out += np.multiply(gap, gap, out=gap)
        return (np.sqrt(out, out=out) - y.dtype.type((1e6 if single else 1) * self._rounding(q))).T

    def beside(self, q: np.ndarray, tree: _Tree) -> tuple[np.ndarray, np.ndarray]:
        """How near each tile's vectors can be to any of ``q`` at most, and the tiles from the nearest on."""
        y = tree.turned(q)
        gap = np.maximum(np.maximum(self.low - y.max(0), y.min(0) - self.high), 0)
        least, between = np.sqrt((gap * gap).sum(1)) - self._rounding(q), (self.low + self.high) / 2 - y.mean(0)
        return least, np.lexsort(((between * between).sum(1), least))  # many boxes touch the queries' own

    def _rounding(self, q: np.ndarray) -> float:
        return 1e-12 * (self.far + q.shape[1] * np.abs(q).max())  # the rotation's own


@lru_cache(1)
def _read_tiles(files: tuple[str, ...], width: int) -> _Tiles:
    """The tiles in files of the scratch folder, in order; the last ones read stay in the process."""
    keys, x, centres = [], [], []
    for f in files:
        store, path = FileSystem.from_uri(f.replace("s3a://", "s3://", 1))
        t = parquet.read_table(path, filesystem=store)
        keys += [v.values.to_numpy(zero_copy_only=False) for v in t["keys"]]
        x += [v.values.to_numpy().reshape(-1, width) for v in t["v"]]
        centres.append(t["centre"].to_numpy())
    return _Tiles(np.concatenate(keys), np.concatenate(x), np.cumsum([0, *map(len, keys)]), np.concatenate(centres))


def _merged(dist: np.ndarray, near: np.ndarray, r: np.ndarray, d: np.ndarray, keys: np.ndarray) -> None:
    """Puts found rows, distances and keys into the lists of each row, which stay sorted by distance and key."""
    k, some = dist.shape[1], np.unique(r)
    rows, d, keys = np.concatenate([np.repeat(some, k), r]), np.concatenate([dist[some].ravel(), d]), np.concatenate([near[some].ravel(), keys])
    order = np.lexsort((keys, d))
    order = order[np.argsort(rows[order].astype("uint16" if some[-1] < 65536 else "int64"), kind="stable")]  # of few bits, as they are for tiles: not compared but counted
    rows = rows[order]
    order = order[np.arange(len(rows)) - np.searchsorted(rows, rows) < k]
    dist[some], near[some] = d[order].reshape(-1, k), keys[order].reshape(-1, k)


def _search(q: np.ndarray, qkeys: np.ndarray, dist: np.ndarray, near: np.ndarray, tiles: _Tiles, tree: _Tree, allowed: np.ndarray | None, parts: list[slice] | None = None) -> None:
    """Improves the nearest keys ``near`` and distances ``dist`` (infinite where there is none yet) of queries by the tiles' vectors.

    The queries of each of ``parts``, which lie near each other, ask the nearest tiles first; then all queries go through
    the tiles, and those ask whose neighbours may still be in the tile's box. Products are made in single precision;
    what they leave, with a margin for their rounding, is measured exactly. Where the margin would not be small against
    the distances, products are made in double precision.
    """
    k, y, parts = dist.shape[1], q - tiles.shift, parts or [slice(0, len(q))]
    norm = (y * y).sum(1)
    wide = np.column_stack([-2 * y, np.ones(len(y)), norm])
    with np.errstate(over="ignore"):
        slim = wide.astype("float32")
    widest = int(np.diff(tiles.starts).max())
    product, close = np.empty(ROWS * widest, "float32"), np.empty(ROWS * widest, bool)  # used again and again: fresh memory costs as much as the product
    reach, waiting = dist[:, -1] * (1 + 1e-9) + 1e-6, []

    def merge() -> None:
        if waiting:
            r = np.concatenate([w[0] for w in waiting])
            _merged(dist, near, r, *(np.concatenate([w[j] for w in waiting]) for j in (1, 2)))
            reach[r] = dist[r, -1] * (1 + 1e-9) + 1e-6
            waiting.clear()

    def ask(asking: np.ndarray, t: int) -> int:
        (other, most), x, keys = tiles.narrow[t], tiles.x[tiles.starts[t] : tiles.starts[t + 1]], tiles.keys[tiles.starts[t] : tiles.starts[t + 1]]
        held = 0
        for at in range(0, len(asking), ROWS):
            i = asking[at : at + ROWS]
            limit, size = dist[i, -1] ** 2, norm[i] + most
            exact = not (2e-5 * size.max() < 0.1 * limit.mean() and size.max() < 1e30)
            if exact:
                z = x - tiles.shift
                d = wide[i] @ np.column_stack([z, (z * z).sum(1), np.ones(len(z))]).T
            else:
                d = np.matmul(slim[i], other, out=product[: len(i) * len(keys)].reshape(len(i), -1))
            margin = (1e-12 if exact else 2e-5) * size
            if len(keys) > k + 1 and not np.isfinite(limit).all():
                limit = np.minimum(limit, np.partition(d, k, axis=1)[:, k])  # one of the k + 1 least may be the query itself
            limit = np.minimum(limit + margin, np.finfo(d.dtype).max).astype(d.dtype)
            some = np.flatnonzero(d.min(axis=1) <= limit)  # most tiles have nothing for most queries
            if 2 * len(some) < len(i):
                i, limit, d = i[some], limit[some], d[some]
            within = np.less_equal(d, limit[:, None], out=close[: d.size].reshape(d.shape))
            r, c = np.divmod(np.flatnonzero(within), len(keys))
            r = i[r]
            other_one = keys[c] != qkeys[r]
            r, c = r[other_one], c[other_one]
            if len(r):
                waiting.append((r, np.sqrt(((q[r] - x[c]) ** 2).sum(1)), keys[c]))
                held += len(r)
        return held

    of, done = np.repeat(np.arange(len(parts)), [part.stop - part.start for part in parts]), np.zeros((len(parts), len(tiles.low)), bool)
    beside = np.full(len(tiles.low), np.inf)
    for p, part in enumerate(parts):
        away, order = tiles.beside(q[part], tree)
        first, rows = order[:FIRST], np.arange(part.start, part.stop)
        low = tiles.least(q[part], tree, first)
        if allowed is not None:
            low[~allowed[part, first]] = np.inf
        for j in np.argsort(low.mean(0), kind="stable"):
            ask(rows[(low[:, j] <= reach[part]) & (low[:, j] < np.inf)], first[j])
            merge()
        done[p, first], beside = True, np.minimum(beside, away)
    known = reach[np.isfinite(reach)]
    single = len(known) > 0 and 1e6 * tiles._rounding(q) < 0.003 * np.median(known)  # its rounding is small against distances
    order, held = np.argsort([beside[g].min() for g in tiles.groups], kind="stable"), 0
    low = np.empty((TOGETHER, len(q)), "float32" if single else "float64")
    for at in range(0, len(order), TOGETHER):
        some = order[at : at + TOGETHER]
        for i in range(0, len(q), HELD):
            low[: len(some), i : i + HELD] = tiles.least(q[i : i + HELD], tree, some, single, True).T
        for j, group in enumerate(some):
            rows = np.flatnonzero(low[j] <= reach)
            if not len(rows):
                continue
            each = tiles.least(q[rows], tree, tiles.groups[group], single)
            for c, t in enumerate(tiles.groups[group]):
                may = (each[:, c] <= reach[rows]) & ~done[of[rows], t]
                asking = rows[may if allowed is None else may & allowed[rows, t]]
                if len(asking):
                    held += ask(asking, t)
                    if held > len(q) or held and np.isinf(dist[asking, -1]).any():
                        merge()
                        held = 0
    merge()


def _sample(vectors: DataFrame, n: int, count: int, seed: int) -> np.ndarray:
    """A hash sample of about ``count`` vectors, at least one."""
    x = vectors.where(F.pmod(F.xxhash64("k", F.lit(seed)), F.lit(max(1, n // count))) == 0).orderBy("k").toPandas().v.tolist()
    return np.array(x or [r["v"] for r in vectors.orderBy("k").limit(count).collect()], float)


def _nearest_lists(vectors: DataFrame, k: int, probes: int | None = None, block: int = 1024, most_centres: int = 4096, chunk_bytes: int = 128 << 20, seed: int = 0) -> DataFrame:
    """The ``k`` nearest other vectors (Euclidean) of each: ``src, near, d``, nearest first (ties by key).

    ``vectors`` has ``k, v`` with unique keys and finite values of one length. Vectors are filed by the leaves
    of a tree of median cuts (at most ``most_centres``) and packed in tiles of up to ``block`` rows. Tasks take tiles of
    queries, read the others in chunks of at most ``chunk_bytes`` and ask all tiles but those whose box is too far off,
    so the result is exact. Where dimensions are many, that can be half of the tiles, and the work is quadratic:
    ``probes`` asks just the tiles of so many leaves whose centres are nearest, with a recall to be measured.
    """
    spark, kind = vectors.sparkSession, vectors.schema["k"].dataType.simpleString()
    vectors = materialize(vectors.select("k", "v"), "vectors")
    n = vectors.count()
    if n < 2:
        return materialize(spark.createDataFrame([], f"src {kind}, near array<{kind}>, d array<double>"), "nearest")
    tasks = 4 * spark.sparkContext.defaultParallelism
    depth = max(0, math.ceil(math.log2(max(1, min(n / block, most_centres)))))
    cuts = spark.sparkContext.broadcast(_Tree(_sample(vectors, n, 20 * 2**depth, seed), depth))
    width = len(cuts.value.mean)

    def file(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(centre=cuts.value.leaves(np.array(pdf.v.tolist(), float)).astype("int32"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for pdf in chain(batches, [None]):
            whole = kept if pdf is None else pdf if kept is None else pd.concat([kept, pdf], ignore_index=True)
            if whole is None or not len(whole):
                continue
            ends = [0, *(np.flatnonzero(whole.centre.to_numpy()[1:] != whole.centre.to_numpy()[:-1]) + 1), len(whole)]
            spans = list(zip(ends[:-1], ends[1:]))
            # The last leaf may go on in the next batch; one of very many rows is cut as it comes.
            kept = None if pdf is None or len(whole) - ends[-2] > 64 * block else whole.iloc[spans.pop()[0] :]
            tiles = []
            for a, b in spans:
                keys, v = whole.k.to_numpy()[a:b], np.array(whole.v.iloc[a:b].tolist(), float)
                tiles += [(whole.centre.iloc[a], keys[rows], v[rows].ravel()) for rows in cuts.value.tiles(v, block)]
            if tiles:
                yield pd.DataFrame({"centre": [c for c, _, _ in tiles], "keys": pd.Series([x for _, x, _ in tiles], dtype=object), "v": pd.Series([x for _, _, x in tiles], dtype=object)})

    placed = vectors.mapInPandas(file, f"k {kind}, v array<double>, centre int").repartition(tasks, "centre").sortWithinPartitions("centre", "k")
    packed = materialize(placed.mapInPandas(pack, f"centre int, keys array<{kind}>, v array<double>"), "tiles")
    drop(vectors)
    # Scratch files are on a disk that all executors share: tasks read chunks of tiles from there, so nothing is broadcast.
    most, chunks, held, places = max(1, chunk_bytes // (8 * width)), [[]], 0, []
    listed = packed.select(F.input_file_name().alias("file"), F.size("keys").alias("rows"), F.monotonically_increasing_id().alias("at")).orderBy("file", "at").collect()  # centres + n / block rows
    for r in listed:
        if r["file"] not in chunks[-1]:
            if held and held + sum(x["rows"] for x in listed if x["file"] == r["file"]) > most:
                chunks.append([])
                held = 0
            chunks[-1].append(r["file"])
        held += r["rows"]
        places.append((r["file"], places[-1][1] + 1 if places and places[-1][0] == r["file"] else 0))

    def search(ids: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        mine = [places[i] for i in ids]
        asking, parts, rows = [], [], 0
        for f in dict.fromkeys(f for f, _ in mine):
            own = _read_tiles((f,), width)
            for i in (i for g, i in mine if g == f):
                at = slice(own.starts[i], own.starts[i + 1])
                parts.append((own.x[at], own.keys[at], own.centres[i]))
                rows += at.stop - at.start
                if rows >= MANY or (f, i) == mine[-1]:
                    q, keys, ends = np.concatenate([x for x, _, _ in parts]), np.concatenate([x for _, x, _ in parts]), np.cumsum([0, *(len(x) for _, x, _ in parts)]).tolist()
                    asking.append((np.repeat([c for _, _, c in parts], np.diff(ends)), q, keys, np.full((len(q), k), np.inf), np.repeat(keys, k).reshape(-1, k), [slice(a, b) for a, b in zip(ends[:-1], ends[1:])]))
                    parts, rows = [], 0
        for files in sorted(chunks, key=lambda files: mine[0][0] not in files if mine else 0):  # the own one has neighbours that are near already
            if asking:
                tiles = _read_tiles(tuple(files), width).prepare(cuts.value)
            for centres, q, keys, dist, near, slices in asking:
                allowed = None
                if probes is not None and probes < len(cuts.value.centres):
                    away = _distances(q, cuts.value.centres)
                    allowed = (away <= np.partition(away, probes - 1, axis=1)[:, probes - 1 : probes])[:, tiles.centres] | (tiles.centres == centres[:, None])
                _search(q, keys, dist, near, tiles, cuts.value, allowed, slices)
        for _, _, keys, dist, near, _ in asking:
            yield keys, near, dist

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, near, dist in search([i for batch in batches for i in batch["id"].to_pylist()]):
            there = np.isfinite(dist)
            ends = pa.array(np.cumsum([0, *there.sum(1)]), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.ListArray.from_arrays(ends, pa.array(near[there])), pa.ListArray.from_arrays(ends, pa.array(dist[there]))], ["src", "near", "d"])

    found = materialize(spark.range(0, len(places), 1, tasks).mapInArrow(lists, f"src {kind}, near array<{kind}>, d array<double>"), "nearest")  # searched once, however often it is read
    drop(packed)
    return found


def nearest_vectors(vectors: DataFrame, k: int, probes: int | None = None, block: int = 1024, most_centres: int = 4096, chunk_bytes: int = 128 << 20, seed: int = 0) -> DataFrame:
    """The ``k`` nearest other vectors (Euclidean) of each: ``src, dst, d, rank`` (ties by ``dst``), as ``_nearest_lists`` finds them."""
    found = _nearest_lists(vectors, k, probes, block, most_centres, chunk_bytes, seed)
    return found.select("src", F.posexplode(F.arrays_zip("near", "d")).alias("at", "x")).select("src", F.col("x.near").alias("dst"), F.col("x.d").alias("d"), (F.col("at") + 1).alias("rank"))


def shared_neighbours(vectors: DataFrame, k: int, symmetric: bool = False, probes: int | None = None, chunk_bytes: int = 128 << 20, **how: int) -> DataFrame:
    """``src, dst, weight``: edges as ``neighbours.shared_neighbour_edges`` makes them of ``nearest_vectors``, but without a shuffle.

    Tasks take files of neighbour lists and read those of their neighbours from the scratch folder, a chunk of files at a time.
    """
    spark, kind = vectors.sparkSession, vectors.schema["k"].dataType.simpleString()
    found, tasks = _nearest_lists(vectors, k, probes, chunk_bytes=chunk_bytes, **how), 4 * vectors.sparkSession.sparkContext.defaultParallelism
    chunks, held = [[]], 0
    for r in found.groupBy(F.input_file_name().alias("file")).count().orderBy("file").collect():  # a file for each task
        if held and held + r["count"] > chunk_bytes // (8 * (k + 4)):
            chunks.append([])
            held = 0
        chunks[-1].append(r["file"])
        held += r["count"]
    files = [f for c in chunks for f in c]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _read_tiles.cache_clear()  # workers are used again: what the search held would stay
        for own in (files[i] for batch in batches for i in batch["id"].to_pylist()):
            mine, near, size = _read_lists((own,), k)
            for chunk in chunks:
                keys, lists, sizes = _read_lists(tuple(chunk), k)
                for at in range(0, len(mine), ROWS * 8):
                    # Places of the listed keys among those of the chunk; each that is there is compared with the own list.
                    here = slice(at, at + ROWS * 8)
                    r, c = np.nonzero(np.arange(k) < size[here, None])
                    r += at
                    dst = near[r, c]
                    to = np.minimum(np.searchsorted(keys, dst), len(keys) - 1)
                    held = np.flatnonzero((keys[to] == dst) if len(keys) else np.zeros(len(dst), bool))
                    r, dst, to = r[held], dst[held], to[held]
                    src, some = mine[r], np.arange(k)
                    both = near[r][:, :, None] == lists[to][:, None, :]
                    both &= (some < size[r, None])[:, :, None] & (some < sizes[to, None])[:, None, :]
                    shared = both.any(2).sum(1)
                    keep = src < dst
                    if symmetric:  # those that only the larger key lists, too
                        keep |= ~((lists[to] == src[:, None]) & (some < sizes[to, None])).any(1)
                    keep &= shared > 0
                    src, dst = src[keep], dst[keep]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(src, dst)), pa.array(np.maximum(src, dst)), pa.array(shared[keep] / float(k))], ["src", "dst", "weight"])
        _read_lists.cache_clear()

    return spark.range(0, len(files), 1, max(1, min(tasks, len(files)))).mapInArrow(weigh, f"src {kind}, dst {kind}, weight double")


@lru_cache(1)
def _read_lists(files: tuple[str, ...], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys in order, their lists of neighbours filled up to ``k``, and the length of each."""
    keys, near, size = [], [], []
    for f in files:
        store, path = FileSystem.from_uri(f.replace("s3a://", "s3://", 1))
        for batch in parquet.ParquetFile(store.open_input_file(path)).iter_batches(columns=["src", "near"]):
            if len(batch):
                n, values = batch["near"].value_lengths().to_numpy(), batch["near"].flatten().to_numpy(zero_copy_only=False)
                filled = np.full((len(n), k), values[0] if len(values) else 0, values.dtype)
                filled[np.arange(k) < n[:, None]] = values
                keys.append(batch["src"].to_numpy(zero_copy_only=False)), near.append(filled), size.append(n)
    if not keys:
        return np.zeros(0, "int64"), np.zeros((0, k), "int64"), np.zeros(0, int)
    keys, size = np.concatenate(keys), np.concatenate(size)
    order = np.argsort(keys, kind="stable")
    whole = np.concatenate(near)
    near.clear()
    return keys[order], whole[order], size[order]
