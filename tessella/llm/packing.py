"""Texts packed into containers of a fixed number of tokens."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.session import materialize

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the byte-level vocabulary parts a text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def encoding(path: str = TOKENIZER):
    """The tokenizer of a rank file."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, key: str, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """``doc, n_tokens`` of every document that is neither null nor empty; a key that comes again counts once."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoding(tokenizer).encode_ordinary
        for pdf in batches:
            yield pd.DataFrame({"doc": pdf.doc, "n_tokens": [len(encode(t)) for t in pdf.t]})

    d = documents.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").alias("t")).where(F.col("doc").isNotNull() & (F.length("t") > 0))
    counted = d.mapInPandas(count, f"doc {d.schema['doc'].dataType.simpleString()}, n_tokens long")
    return counted.groupBy("doc").agg(F.max("n_tokens").alias("n_tokens")).where(F.col("n_tokens") > 0)


def first_fit(sizes: list[int], capacity: int) -> list[int]:
    """The container of each size, in the order given: the first one with room, found by a tournament tree.

    Leaves hold what is left in each container, inner nodes the most below them; the way down always takes the left
    child if it has room.
    """
    leaves = 1
    while leaves < max(1, len(sizes)):
        leaves *= 2
    most = [capacity] * (2 * leaves)
    out = []
    for size in sizes:
        at = 1
        while at < leaves:
            at *= 2
            if most[at] < size:
                at += 1
        out.append(at - leaves)
        most[at] -= size
        while at > 1:
            at //= 2
            left, right = most[2 * at], most[2 * at + 1]
            most[at] = left if left >= right else right
    return out


def pack(sizes: DataFrame, key: str, size: str, capacity: int = 2048, per_group: int = 20_000, seed: int = 0) -> DataFrame:
    """Items packed into containers: ``item, piece, size, group, bin``; a container is one ``bin`` of one ``group``.

    An item longer than the capacity is split into full pieces and a rest; no other item is split. Items are dealt to
    groups of about ``per_group`` by a hash, whatever their source or length, and each group is packed by first-fit
    decreasing, ties by key. Sizes that are null, zero or negative and null keys give no row. Pieces that fill a
    container by themselves need no search. Other columns are ignored.
    """
    s = sizes.select(F.col(f"`{key}`").alias("item"), F.col(f"`{size}`").cast("long").alias("whole")).where(F.col("item").isNotNull() & (F.col("whole") > 0))
    s = materialize(s, "sizes")
    pieces = s.select("item", F.explode(F.sequence(F.lit(0), F.ceil(F.col("whole") / capacity).cast("int") - 1)).alias("piece"), "whole")
    pieces = pieces.select("item", "piece", F.least(F.lit(capacity).cast("long"), F.col("whole") - F.col("piece") * capacity).alias("size"))
    groups = max(1, -(-pieces.where(F.col("size") < capacity).count() // per_group))
    pieces = pieces.withColumn("group", F.pmod(F.xxhash64("item", "piece", F.lit(seed)), F.lit(groups)).cast("int"))
    kind = s.schema["item"].dataType.simpleString()

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "item", "piece"], ascending=[False, True, True])
        return pdf.assign(bin=first_fit(pdf["size"].tolist(), capacity))

    packed = pieces.where(F.col("size") < capacity).groupBy("group").applyInPandas(fill, f"item {kind}, piece int, size long, group int, bin long")
    # Full pieces are containers of their own, numbered by what they hold.
    full = pieces.where(F.col("size") == capacity).select("item", "piece", "size", F.lit(-1).alias("group"), F.xxhash64("item", "piece").alias("bin"))
    return packed.unionByName(full)


def pack_documents(documents: DataFrame, key: str, text: str, capacity: int = 2048, tokenizer: str = TOKENIZER, per_group: int = 20_000) -> DataFrame:
    """Documents packed by their length in tokens: ``doc, piece, n_tokens, container``.

    Null and empty texts hold no tokens and give no row; very long texts are counted whole and split; repeated keys
    count once; an empty table gives no rows.
    """
    packed = pack(token_counts(documents, key, text, tokenizer), "doc", "n_tokens", capacity, per_group)
    return packed.select(F.col("item").alias("doc"), "piece", F.col("size").alias("n_tokens"), F.concat_ws("-", "group", "bin", F.when(F.col("group") < 0, F.col("item"))).alias("container"))
