"""Numeric vectors: which take part, and the most similar ones by an inverted multi-index."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.operators.proximity import finite
from tessella.session import materialize


def usable(vectors: DataFrame, key: str, vector: str, dim: int) -> DataFrame:
    """Rows ``k, e`` whose vector has ``dim`` finite values that are not all zero; null keys take no part."""
    v = vectors.select(F.col(f"`{key}`").alias("k"), F.col(f"`{vector}`").cast("array<double>").alias("e"))
    return v.where(F.col("k").isNotNull() & (F.size("e") == dim) & F.forall("e", lambda x: finite(x)) & F.exists("e", lambda x: x != 0))


def matrix(lists: pa.Array) -> np.ndarray:
    """A column of arrays of one length, without nulls, as the rows of a matrix."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; neither very large nor very small values overflow."""
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def unit(e: pd.Series, dtype: type = np.float64) -> np.ndarray:
    """A batch of vectors as rows of length one."""
    return unit_rows(np.array(e.tolist(), dtype=np.float64)).astype(dtype)


def sample(vectors: DataFrame, rows: int, seed: int = 0) -> tuple[np.ndarray, int]:
    """About ``rows`` of the vectors as unit rows, chosen by a hash of the key, and how many there are in all.

    A key that comes again is there once; were its hashes to give more than twice ``rows``, the step would be raised.
    """
    n, place = vectors.count(), F.xxhash64("k", F.lit(seed))
    step = max(1, n // max(1, rows))
    while step > 1 and vectors.where(F.pmod(place, F.lit(step)) == 0).groupBy("k").agg(F.min("e")).limit(2 * rows + 1).count() > 2 * rows:
        step *= 2
    part = vectors.where(F.pmod(place, F.lit(step)) == 0).groupBy("k").agg(F.min("e").alias("e")).toPandas()
    return (unit(part.sort_values("k").e) if len(part) else np.zeros((0, 1))), n


def k_means(x: np.ndarray, k: int, rounds: int = 10, seed: int = 0) -> np.ndarray:
    """Centroids of a bounded sample; clusters that run empty keep their place."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        nearest = np.argmin((c**2).sum(1) - 2 * x @ c.T, axis=1)
        size = np.bincount(nearest, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, nearest, x)
        c[size > 0] = total[size > 0] / size[size > 0, None]
    return c


def traverse(d1: np.ndarray, d2: np.ndarray, counts: np.ndarray, want: int, least_cells: int) -> list[int]:
    """Cells ``i * len(d2) + j`` in order of ``d1[i] + d2[j]`` until they hold ``want`` entries; empty ones are passed."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    heap, seen, out, got = [(d1[o1[0]] + d2[o2[0]], 0, 0)], {(0, 0)}, [], 0
    while heap and (got < want or len(out) < least_cells):
        _, a, b = heapq.heappop(heap)
        cell = int(o1[a]) * len(d2) + int(o2[b])
        if counts[cell]:
            out.append(cell)
            got += int(counts[cell])
        for nxt in ((a + 1, b), (a, b + 1)):
            if nxt[0] < len(o1) and nxt[1] < len(o2) and nxt not in seen:
                seen.add(nxt)
                heapq.heappush(heap, (d1[o1[nxt[0]]] + d2[o2[nxt[1]]], *nxt))
    return out


def most_similar(vectors: DataFrame, key: str, vector: str, queries: DataFrame, query_key: str, k: int = 5, dim: int = 32, centroids: int = 64, share: float = 0.01, least_cells: int = 16, sample_rows: int = 20_000, block: int = 50_000) -> DataFrame:
    """For each query the ``k`` other vectors of highest cosine: ``query, neighbour, cosine, place``.

    An inverted multi-index: both halves of the unit vectors are quantised on their own (``centroids`` each, fitted on
    about ``sample_rows`` vectors), every vector is filed under its pair of centroids, and a query visits pairs in
    order of their summed distance until they hold ``share`` of all vectors and ``least_cells`` pairs. What it visits
    is ranked by exact cosine. Full pairs are split into blocks of about ``block`` rows, so none becomes one task's
    work, and each block gives at most ``k`` rows per query. Recall depends on ``share`` only; nothing is capped.

    Queries are keys of ``vectors``; those whose vector takes no part give no rows, repeated rows count once, ties go
    to the smaller key, and fewer than ``k`` other vectors are all returned. Other columns are ignored.
    """
    spark = vectors.sparkSession
    valid = usable(vectors, key, vector, dim)
    kind = valid.schema["k"].dataType.simpleString()
    fit, n = sample(valid, sample_rows)
    half = dim // 2
    if not len(fit):
        return spark.createDataFrame([], f"query {kind}, neighbour {kind}, cosine double, place int")
    c1, c2 = k_means(fit[:, :half], centroids), k_means(fit[:, half:], centroids)
    shared = spark.sparkContext.broadcast((c1, c2))

    def file(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c1, c2 = shared.value
        for pdf in batches:
            if len(pdf):
                u = unit(pdf.e)
                i = np.argmin((c1**2).sum(1) - 2 * u[:, :half] @ c1.T, axis=1)
                j = np.argmin((c2**2).sum(1) - 2 * u[:, half:] @ c2.T, axis=1)
                yield pdf.assign(cell=(i * len(c2) + j).astype("int32"))

    entries = materialize(valid.mapInPandas(file, f"k {kind}, e array<double>, cell int"), "index")
    counts = np.zeros(len(c1) * len(c2), dtype=np.int64)
    for r in entries.groupBy("cell").count().collect():  # at most one row per pair of centroids
        counts[r["cell"]] = r["count"]
    sizes = spark.sparkContext.broadcast(counts)
    want = max(k + 1, int(share * n))

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c1, c2 = shared.value
        for pdf in batches:
            if len(pdf):
                u = unit(pdf.e)
                d1 = (c1**2).sum(1) - 2 * u[:, :half] @ c1.T
                d2 = (c2**2).sum(1) - 2 * u[:, half:] @ c2.T
                cells = [traverse(a, b, sizes.value, want, least_cells) for a, b in zip(d1, d2)]
                yield pd.DataFrame({"k": pdf.k, "e": pdf.e, "cell": cells})

    asked = queries.select(F.col(f"`{query_key}`").cast(kind).alias("k")).where(F.col("k").isNotNull()).distinct()
    found = entries.join(asked, "k", "left_semi").select("k", "e").groupBy("k").agg(F.min("e").alias("e"))
    # Cells of more than a block's rows are split by a hash; queries go to every part.
    big = {int(c): int(-(-counts[c] // block)) for c in np.flatnonzero(counts > block)}
    parts = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in big.items() for x in p]), F.col("cell")), F.lit(1)) if big else F.lit(1)
    visits = found.repartition("k").mapInPandas(visit, f"k {kind}, e array<double>, cell array<int>").select("k", "e", F.explode("cell").alias("cell"))
    visits = visits.select("k", "e", "cell", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    filed = entries.select("k", "e", "cell", F.pmod(F.xxhash64("k"), parts).cast("int").alias("part"))

    def rank(asked: pd.DataFrame, filed: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(filed):
            return pd.DataFrame({"query": asked.k[:0], "neighbour": asked.k[:0], "cosine": pd.Series(dtype="float64")})
        filed = filed.drop_duplicates("k").sort_values("k")
        keys, x, out = filed.k.to_numpy(), unit(filed.e), []
        step = max(1, 4_000_000 // len(filed))
        for at in range(0, len(asked), step):
            q = asked.iloc[at : at + step]
            own = q.k.to_numpy()
            s = unit(q.e) @ x.T
            s[own[:, None] == keys[None, :]] = -2
            m = min(k, len(keys))
            cut = np.partition(s, len(keys) - m, axis=1)[:, len(keys) - m]
            r, c = np.nonzero((s >= cut[:, None]) & (s > -2))
            out.append(pd.DataFrame({"query": own[r], "neighbour": keys[c], "cosine": s[r, c]}))
        ranked = pd.concat(out).sort_values(["query", "cosine", "neighbour"], ascending=[True, False, True])
        return ranked.groupby("query").head(k)

    near = visits.groupBy("cell", "part").cogroup(filed.groupBy("cell", "part")).applyInPandas(rank, f"query {kind}, neighbour {kind}, cosine double")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("cosine"), "neighbour"))
    best = near.groupBy("query", "neighbour").agg(F.max("cosine").alias("cosine"))
    return best.withColumn("place", place).where(F.col("place") <= k)
