"""Files whose fields come, go, change name or type: one consistent table, and a report of each change."""

from __future__ import annotations

import re
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASHES = 12


#: JSON types by the first character of a value's text; any other begins a number.
KINDS = {'"': "string", "[": "array", "{": "object", "t": "boolean", "f": "boolean"}


def _once(records: DataFrame, most_rows: int) -> DataFrame:
    """One row per file and record, placed by file: of several payloads of a record the smallest that is an object.

    Rows move once, as they came. Files of more than ``most_rows`` rows are spread over several tasks by record.
    """
    sizes = records.groupBy("file").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most_rows)  # at most all rows / most_rows
    salt = F.pmod(F.xxhash64("record"), F.coalesce(F.ceil(F.col("n") / most_rows), F.lit(1)))
    placed = records.join(F.broadcast(sizes), "file", "left").withColumn("salt", salt).drop("n").repartition("file", "salt")
    read = placed.withColumn("doc", F.expr("try_parse_json(payload)")).where(F.col("doc").isNotNull() & F.schema_of_variant("doc").startswith("OBJECT"))
    return read.groupBy("file", "salt", "record").agg(F.min("feed").alias("feed"), F.min("ord").alias("ord"), F.min_by("doc", "payload").alias("doc"))


def path_values(records: DataFrame, feed: str, file: str, order: str, record: str, payload: str, most_rows: int = 1_000_000) -> DataFrame:
    """One row per record and top-level field: ``feed, file, ord, record, path, kind, value``.

    ``kind`` is the JSON type (null for a JSON null), ``value`` the raw JSON text. Payloads that are null, cut off or
    no object give no row. A record delivered again counts once.
    """
    names = {"feed": feed, "file": file, "ord": order, "record": record, "payload": payload}
    r = _once(records.select(*[F.col(f"`{c}`").alias(n) for n, c in names.items()]), most_rows)
    fields = r.lateralJoin(r.sparkSession.tvf.variant_explode(F.col("doc").outer())).select("feed", "file", "ord", "record", F.col("key").alias("path"), F.to_json("value").alias("text"))
    first = F.substring("text", 1, 1)
    kind = F.when(F.col("text").isNotNull() & (first != "n"), F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair]), first), F.lit("number")))
    return fields.select("feed", "file", "ord", "record", "path", kind.alias("kind"), F.when(first != "n", F.col("text")).alias("value"))


def _scalar(value: Column) -> Column:
    """The value's text without the wrapping that a change of type adds: brackets, quotes, an object's key."""
    return F.lower(F.regexp_replace(F.regexp_replace(value, r'^\{"[^"]*":', ""), r'[\[\]{}"\s]', ""))


def path_statistics(values: DataFrame) -> DataFrame:
    """Per file and path: records with the key, non-null values by JSON type, and a bounded profile of the values.

    The profile (a MinHash of the scalar texts, a MinHash of their shapes, the middle of the numeric range) has a fixed size
    however many rows a file has; counts are combined before the shuffle.
    """
    scalar = _scalar(F.col("value"))
    number = F.expr("try_cast(replace(s, ',', '.') as double)")
    shape = F.regexp_replace(F.regexp_replace("s", r"\p{L}+", "a"), r"\d+", "9")
    v = values.withColumn("s", scalar).withColumns({"num": number, "hash": F.xxhash64("s"), "shape": F.when(F.col("s").rlike("[0-9]"), F.xxhash64(shape))})
    kinds = [F.count_if(F.col("kind") == k).alias(k) for k in ("number", "string", "boolean", "array", "object")]
    return v.groupBy("feed", "file", "ord", "path").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("kind").alias("n_valued"),
        *kinds,
        F.array(*[F.min(F.when(F.col("s").isNotNull(), F.xxhash64("hash", F.lit(i)))) for i in range(HASHES)]).alias("values_sketch"),
        F.array(*[F.min(F.when(F.col("shape").isNotNull(), F.xxhash64("shape", F.lit(i)))) for i in range(HASHES)]).alias("shape_sketch"),
        F.count("num").alias("n_num"),
        F.percentile_approx("num", [0.1, 0.9], 1000).alias("range"),  # single odd values must not widen it
        F.percentile_approx(F.length("s"), 0.5, 1000).alias("width"),
    )


def _squash(name: str) -> str:
    return re.sub(r"[^a-z0-9]", "", name.lower())


def likeness(a: dict, b: dict) -> float:
    """How likely field ``b`` carries on field ``a`` (0 to 1): the same name apart from spelling, else alike values."""
    if _squash(a["path"]) == _squash(b["path"]):
        return 1.0
    if not a["n_valued"] or not b["n_valued"]:
        return 0.0
    same = sum(x == y and x is not None for x, y in zip(a["values_sketch"], b["values_sketch"])) / HASHES
    numeric = a["n_num"] >= 0.9 * a["n_valued"] and b["n_num"] >= 0.9 * b["n_valued"]
    if numeric:
        (a_lo, a_hi), (b_lo, b_hi) = a["range"], b["range"]
        span, common = max(a_hi, b_hi) - min(a_lo, b_lo), min(a_hi, b_hi) - max(a_lo, b_lo)
        overlap = 1.0 if span == 0 else max(0.0, common / span)
        width = min(a["width"], b["width"]) / max(a["width"], b["width"], 1)
        return max(same, 0.95 * overlap * width)
    shapes = sum(x == y and x is not None for x, y in zip(a["shape_sketch"], b["shape_sketch"])) / HASHES
    return max(same, 0.5 * same + 0.4 * shapes)


def feed_changes(stats: pd.DataFrame, threshold: float = 0.3) -> list[tuple]:
    """Changes of each file of one feed against the file before it, from the files' path statistics."""
    known: dict[str, str | None] = {}
    left: dict[str, str | None] = {}
    before: dict[str, dict] = {}
    out: list[tuple] = []
    kinds = ["number", "string", "boolean", "array", "object"]
    rows = stats.sort_values(["ord", "file"]).to_dict("records")
    for k, ((_, file), part) in enumerate(groupby(rows, key=itemgetter("ord", "file"))):
        now = {r["path"]: r for r in part}
        kind = {p: max(kinds, key=lambda t: r[t]) if r["n_valued"] else None for p, r in now.items()}
        if k:
            gone, new = sorted(set(before) - set(now)), sorted(set(now) - set(before))
            scored = sorted(((likeness(before[g], now[n]), g, n) for g in gone for n in new), key=lambda s: (-s[0], s[1], s[2]))
            source: dict[str, str] = {}
            for score, g, n in scored:
                if score >= threshold and g not in source.values() and n not in source:
                    source[n] = g
                    out.append((file, "renamed", g, n))
            out += [(file, "removed", g, "") for g in gone if g not in source.values()]
            out += [(file, "added", "", n) for n in new if n not in source]
            # A field that comes back after an absence has the type it had when it went.
            left |= {_squash(g): known.get(g) for g in gone if g not in source.values()}
            carried = {n: known.get(source.get(n, n)) if n in source or n not in new else left.get(_squash(n)) for n in now}
            out += [(file, "retyped", n, n) for n in sorted(now) if kind[n] and carried[n] and kind[n] != carried[n]]
            known = {n: kind[n] or carried[n] for n in now}
        else:
            known = dict(kind)
        # A field's profile carries on through a file that holds only nulls in it.
        before = {n: r if r["n_valued"] or n not in before else {**before[n], "path": n} for n, r in now.items()}
    return out


def schema_changes(records: DataFrame, feed: str, file: str, order: str, record: str, payload: str, threshold: float = 0.3) -> DataFrame:
    """Each change of a file's fields against the file of the same feed exported just before it.

    Returns ``file, change, field_before, field_after`` with change ``renamed``, ``removed``, ``added`` or
    ``retyped``. Rows become path-value pairs with raw types, these are aggregated to statistics by file and path,
    and the statistics of a feed's files are compared in order. Only the statistics, whose size does not depend on
    the number of rows, meet in one task. Null feeds, files or export times take no part; an empty table gives none.
    """
    stats = path_statistics(path_values(records, feed, file, order, record, payload).where(F.col("feed").isNotNull() & F.col("file").isNotNull() & F.col("ord").isNotNull()))
    kind = stats.schema["file"].dataType.simpleString()

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(feed_changes(pdf, threshold), columns=["file", "change", "field_before", "field_after"])

    return stats.groupBy("feed").applyInPandas(compare, f"file {kind}, change string, field_before string, field_after string")


def project_fields(records: DataFrame, feed: str, file: str, order: str, record: str, payload: str, fields: dict[str, tuple[str, list[str]]]) -> tuple[DataFrame, DataFrame]:
    """One consistent table, and the values that its types could not hold.

    ``fields`` maps each column to its Spark type and the names it goes by, in order of preference. Values are
    unwrapped (a one-element array, an object's value, a decimal comma) and cast; the second frame reports per file
    and column how many non-null values failed, with one example.
    """
    v = path_values(records, feed, file, order, record, payload)
    names = [(n, c) for c, (_, spellings) in fields.items() for n in spellings]
    rank = {n: i for _, (_, spellings) in fields.items() for i, n in enumerate(spellings)}
    to = F.create_map(*[F.lit(x) for pair in names for x in pair])
    order_of = F.create_map(*[F.lit(x) for pair in rank.items() for x in pair])
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace("value", r'^\{"[^"]*":(.*)\}$', "$1"), r"^\[(.*)\]$", "$1"), r'^"(.*)"$', "$1")
    long = v.withColumns({"col": F.try_element_at(to, F.col("path")), "rank": F.try_element_at(order_of, F.col("path")), "plain": plain}).where(F.col("col").isNotNull())

    def cast(c: str, kind: str) -> Column:
        text = F.regexp_replace(c, r"^(-?\d+),(\d+)$", "$1.$2") if kind in ("double", "float") else F.col(c)
        return text.try_cast(kind)

    wide = long.groupBy("feed", "file", "ord", "record").agg(*[F.min_by(F.when(F.col("col") == c, F.col("plain")), F.when((F.col("col") == c) & F.col("plain").isNotNull(), F.col("rank"))).alias(c) for c in fields])
    wide = wide.select("feed", "file", "ord", "record", *[cast(c, kind).alias(c) for c, (kind, _) in fields.items()])
    failed = None
    for c, (kind, _) in fields.items():
        f = (F.col("col") == c) & F.col("plain").isNotNull() & cast("plain", kind).isNull()
        failed = f if failed is None else failed | f
    bad = long.where(failed).groupBy("file", "col").agg(F.count(F.lit(1)).alias("n_failed"), F.min("plain").alias("example"))
    return wide, bad
