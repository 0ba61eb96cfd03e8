"""Passages of evaluation items found in a corpus, by a prefix-filtered set join of word shingles."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.session import broadcast_if_small, materialize

SHINGLE = 5
#: A leaked stretch has at least so many words, and at most one in so many of them replaced or misspelt.
STRETCH, ERROR_EVERY = 15, 8
#: Stands for a word that was blanked out, so that those after it keep their place.
BLANK = ""

# Markup around words. Inline tags may stand inside a word; others part words.
INVISIBLE = r"[­​-‏⁠﻿]"
INLINE_TAG = r"(?i)</?(?:b|i|u|s|em|strong|span|font|a|sup|sub|tt|code)(?:\s[^<>]*)?>"
TAG = r"</?[A-Za-z][^<>]*>|&(?:#\d+|#x[0-9A-Fa-f]+|[A-Za-z]+);|\[/?[A-Za-z*]+(?:=[^\[\]]*)?\]"
BLANKED = r"\[(?:\s*|\.{2,}|…)\]|_{3,}"
#: A word parted at the end of a line, be the next line quoted or not.
PARTED = r"(\p{L})-[ \t]*\r?\n[\s>|]*(\p{Ll})"


def normal(text: Column) -> Column:
    """The words of a text, parted by single spaces: in lower case, without markup, quote marks, punctuation and invisible characters.

    Each replacement runs only where a text has what it looks for, which a plain search tells. The steps are bound to a
    variable each (an array of one), as their expressions would else be repeated in one another.
    """
    plain = lambda t: F.octet_length(t) == F.length(t)

    def where(signs: list[str], pattern: str, by: str) -> Callable[[Column], Column]:
        return lambda t: F.when(reduce(lambda x, y: x | y, [F.contains(t, F.lit(s)) for s in signs]), F.regexp_replace(t, pattern, by)).otherwise(t)

    steps = [
        lambda t: F.when(plain(t), t).otherwise(F.regexp_replace(t, INVISIBLE, "")),
        where(["<"], INLINE_TAG, ""),
        where(["<", "&", "["], TAG, " "),
        where(["[", "___"], BLANKED, f" {BLANK} "),
        where(["-\n", "-\r", "- ", "-\t"], PARTED, "$1$2"),
        F.lower,
        lambda t: F.trim(F.when(plain(t), F.regexp_replace(t, "[^a-z0-9]+", " ")).otherwise(F.regexp_replace(t, rf"[^\p{{L}}\p{{N}}{BLANK}]+", " "))),
    ]
    return F.element_at(reduce(F.transform, steps, F.array(text)), 1)


def shingles(texts: DataFrame, key: str, wanted: np.ndarray | None = None, n: int = SHINGLE) -> DataFrame:
    """``key, n, at, h``: the hash of every ``n`` consecutive words of a ``normal`` text ``t``, with the number of its words.

    With ``wanted`` (hashes) only those are kept; they are looked up before a row leaves the batch.
    """
    kind = texts.schema[key].dataType.simpleString()
    shared = None if wanted is None else texts.sparkSession.sparkContext.broadcast(np.sort(wanted))

    def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordered = None if shared is None else shared.value
        if ordered is not None:
            first = np.zeros(1 << 22, bool)  # a table over the leading bits leaves few to be searched for
            first[(ordered.view(np.uint64) >> np.uint64(42)).astype(np.int64)] = True
        for batch in batches:
            lists = pc.split_pattern(batch.column(1), " ")
            size, flat = pc.list_value_length(lists).to_numpy(zero_copy_only=False), lists.flatten().dictionary_encode()
            word = pd.util.hash_array(flat.dictionary.to_numpy(zero_copy_only=False), categorize=False)[flat.indices.to_numpy()] if len(flat) else np.zeros(0, np.uint64)
            places = max(0, len(word) - n + 1)
            h = np.zeros(places, np.uint64)
            for j in range(n):
                h = h * np.uint64(0x9E3779B97F4A7C15) + word[j : j + places]
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            end = np.cumsum(size)
            doc = np.repeat(np.arange(len(size)), size)[:places]
            held = np.arange(places) + n <= end[doc]
            if ordered is not None:
                held &= first[(h >> np.uint64(42)).astype(np.int64)]
                some = np.flatnonzero(held)
                at = np.minimum(np.searchsorted(ordered, h[some].view(np.int64)), len(ordered) - 1)
                held = some[ordered[at] == h[some].view(np.int64)] if len(ordered) else some[:0]
            else:
                held = np.flatnonzero(held)
            d = doc[held]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(d)), pa.array(size[d].astype(np.int32)), pa.array((held - (end - size)[d]).astype(np.int32)), pa.array(h[held].view(np.int64))],
                names=[key, "n", "at", "h"],
            )

    return texts.select(key, "t").mapInArrow(of_batch, f"{key} {kind}, n int, at int, h bigint")


def required_overlap(n: int = SHINGLE, stretch: int = STRETCH, error_every: int = ERROR_EVERY) -> tuple[int, int]:
    """The least number of shingles that any leaked stretch shares with its passage, and that stretch's length.

    Of a stretch of L words with E errors at least L - E - (n - 1)(E + 1) shingles stay whole; one at least always
    does, as E + 1 clean runs share L - E words.
    """
    whole = {length: max(1, length - length // error_every - (n - 1) * (length // error_every + 1)) for length in range(stretch, 4 * error_every)}
    length = min(whole, key=lambda k: (whole[k], k))
    return whole[length], length


def item_words(items: DataFrame, key: str, passage: str, common: int = 3) -> DataFrame:
    """``item, t``: the words of each passage, without a first sentence that opens at least ``common`` passages."""
    p = items.select(F.col(f"`{key}`").alias("item"), F.col(f"`{passage}`").alias("p")).where(F.col("item").isNotNull() & F.col("p").isNotNull()).dropDuplicates(["item"])
    first = F.regexp_extract("p", r"^\s*([^.!?]*[.!?])", 1)
    p = p.withColumn("first", normal(first))
    openers = p.where(F.col("first") != "").groupBy("first").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= common).select("first", F.lit(True).alias("opens"))
    rest = F.when(F.coalesce("opens", F.lit(False)), F.regexp_replace("p", r"^\s*[^.!?]*[.!?]", "")).otherwise(F.col("p"))
    return p.join(openers, "first", "left").select("item", normal(rest).alias("t"))


def stretches(same: np.ndarray, stretch: int = STRETCH, error_every: int = ERROR_EVERY) -> tuple[np.ndarray, int]:
    """Which places lie in some ``stretch`` or more consecutive ones that agree but for one in ``error_every``.

    Also returns the number of agreeing places of the best such stretch, 0 if there is none.
    """
    n = len(same)
    if n < stretch:
        return np.zeros(n, bool), 0
    run = np.concatenate([[0], np.cumsum(np.where(same, -1, error_every - 1))])  # not above its start: few enough errors
    # For each start, the furthest end at which the run is no higher: the least of what follows rises with the place.
    ends = np.searchsorted(np.minimum.accumulate(run[::-1])[::-1], run, side="right") - 1
    start = np.flatnonzero(ends - np.arange(n + 1) >= stretch)
    if not len(start):
        return np.zeros(n, bool), 0
    edge = np.zeros(n + 1, int)
    np.add.at(edge, start, 1)
    np.add.at(edge, ends[start], -1)
    agree = np.concatenate([[0], np.cumsum(same)])
    return np.cumsum(edge)[:n] > 0, int((agree[ends[start]] - agree[start]).max())


def rivals(found: pd.DataFrame, stretch: int = STRETCH, error_every: int = ERROR_EVERY, block: int = 256) -> list:
    """The items of a text's matches ``item, at, n, wrong`` that hold a stretch of their own.

    ``wrong`` are the places, counted from ``at``, that differ from the item. Matches are taken from the one with the
    most agreeing words on; a word in which a match differs is no replaced or misspelt one if it is the word of an
    item taken before: no stretch runs over it. So of items that share sentence patterns the one the text was taken
    from is kept, and any other only for what it has to itself or agrees with as well.
    """
    same = [np.ones(n, bool) for n in found.n]
    for s, wrong in zip(same, found.wrong):
        s[np.asarray(wrong, int)] = False
    best = [stretches(s, stretch, error_every)[1] for s in same]
    taken: dict[int, list] = {}
    out = []
    for m in sorted(range(len(found)), key=lambda m: (-best[m], found["at"].iloc[m], found["item"].iloc[m])):
        item, at, mine = found["item"].iloc[m], int(found["at"].iloc[m]), same[m]
        blocked = np.zeros(len(mine), bool)
        for other, start, theirs in {id(t): t for b in range(at // block, (at + len(mine)) // block + 1) for t in taken.get(b, ())}.values():
            low, high = max(at, start), min(at + len(mine), start + len(theirs))
            if other != item and low < high:
                blocked[low - at : high - at] |= theirs[low - start : high - start] & ~mine[low - at : high - at]
        held = np.zeros(len(mine), bool)
        cuts = np.concatenate([[-1], np.flatnonzero(blocked), [len(mine)]])
        for low, high in zip(cuts[:-1] + 1, cuts[1:]):
            held[low:high] = stretches(mine[low:high], stretch, error_every)[0]
        if held.any():
            out.append(item)
            entry = (item, at, held & mine)
            for b in range(at // block, (at + len(mine)) // block + 1):
                taken.setdefault(b, []).append(entry)
    return list(dict.fromkeys(out))


def leaked_items(documents: DataFrame, key: str, text: str, items: DataFrame, item_key: str, passage: str, common: int = 3, most_hashes: int = 2_000_000) -> DataFrame:
    """Documents that hold a stretch of an item's passage: ``item, doc``, one row for each.

    Shingles of the passages are ordered by how many documents hold them. In each window of the passage as long as
    the stretch that may share fewest shingles, all but the most common ones are necessary: they alone are joined
    with the documents' shingles. A match fixes how the passage lies on the text; where too few words of both overlap
    it is dropped, else all places are compared, exactly. Where several items match one text, ``rivals`` decides which
    of them it was taken from. The items' shingles and the matched document keys are broadcast when they have at most
    ``most_hashes`` rows (8 bytes each) and joined by shuffle beyond that.

    Null, empty or short texts and passages hold nothing; very long texts are read whole; repeated rows of a document
    or an item count once, texts of one document that differ each on their own; other columns are ignored.
    """
    it = materialize(item_words(items, item_key, passage, common), "items")
    of_items = materialize(shingles(it, "item").where(F.col("n") >= STRETCH).withColumnRenamed("n", "n_item"), "shingles")
    docs = documents.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").alias("t")).where(F.col("doc").isNotNull() & F.col("t").isNotNull())
    listed = of_items.select("h").distinct()
    wanted = [r["h"] for r in listed.limit(most_hashes + 1).collect()]
    known = len(wanted) <= most_hashes
    hits = shingles(docs.select("doc", normal(F.col("t")).alias("t")), "doc", np.array(wanted, np.int64) if known else None).where(F.col("n") >= STRETCH)
    hits = materialize((hits if known else hits.join(listed, "h", "left_semi")).select("doc", F.col("n").alias("n_doc"), F.col("at").alias("pos"), "h"), "hits")

    # Rarity over the whole corpus, then the necessary shingles of every window of every passage.
    held = hits.groupBy("h").agg(F.approx_count_distinct("doc").alias("n_docs"))
    need, length = required_overlap()
    span = length - SHINGLE + 1
    ranked = of_items.join(held, "h", "left").withColumn("n_docs", F.coalesce("n_docs", F.lit(0)))
    windows = ranked.select("*", F.explode(F.sequence(F.greatest(F.col("at") - span + 1, F.lit(0)), F.col("at"))).alias("start"))
    order = F.row_number().over(Window.partitionBy("item", "start").orderBy(F.desc("n_docs"), "h", "at"))
    size = F.count(F.lit(1)).over(Window.partitionBy("item", "start"))
    necessary = windows.withColumns({"r": order, "size": size}).where((F.col("r") > need - 1) | (F.col("size") < span)).select("item", "n_item", "at", "h").distinct()

    lies = hits.join(broadcast_if_small(necessary), "h").select("doc", "item", "n_doc", "n_item", (F.col("pos") - F.col("at")).alias("shift"))
    overlap = F.least(F.col("n_doc"), F.col("shift") + F.col("n_item")) - F.greatest(F.lit(0), F.col("shift"))
    lies = materialize(lies.where(overlap >= STRETCH).select("doc", "item", "shift").distinct(), "matches")

    @F.pandas_udf("array<int>")
    def differing(w: pd.Series, iw: pd.Series, shift: pd.Series) -> pd.Series:
        same = [np.array([a == b for a, b in zip(d, i[max(0, -s) :])], dtype=bool) for d, i, s in zip(w, iw, shift)]
        return pd.Series([np.flatnonzero(~x) if stretches(x)[1] else None for x in same])

    part = F.slice("w", F.greatest(F.col("shift"), F.lit(0)) + 1, F.size("iw"))
    texts = docs.join(broadcast_if_small(lies.select("doc").distinct()), "doc", "left_semi").distinct().select("doc", F.xxhash64("t").alias("copy"), F.split(normal(F.col("t")), " ").alias("w"))
    placed = texts.join(lies, "doc").join(broadcast_if_small(it.select("item", F.split("t", " ").alias("iw"))), "item").select("doc", "copy", "item", "shift", "iw", part.alias("w"))
    at = F.greatest(F.col("shift"), F.lit(0)).alias("at")
    n = F.least(F.size("w"), F.size("iw") - F.greatest(-F.col("shift"), F.lit(0))).alias("n")
    matched = placed.select("doc", "copy", "item", at, n, differing("w", "iw", "shift").alias("wrong")).where(F.col("wrong").isNotNull())
    kinds = ", ".join(f"{c} {matched.schema[c].dataType.simpleString()}" for c in ("item", "doc"))

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        own = rivals(pdf)
        return pd.DataFrame({"item": own, "doc": [pdf.doc.iloc[0]] * len(own)})

    return matched.groupBy("doc", "copy").applyInPandas(settle, kinds).distinct()
