"""Queries of the general problems: proximity (4) and drifting schemas (6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators import drift, proximity
from tessella.session import table

NEAR_RADIUS = 5.0


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """Near pairs of cell_seg_data, and the regions that hold each cell of metadata_clusters."""
    near = proximity.near_pairs(table(spark, sf, "cell_seg_data"), "cell_key", "Cell X Position", "Cell Y Position", "Sample Name", NEAR_RADIUS)
    inside = proximity.points_in_regions(table(spark, sf, "metadata_clusters"), "cell_key", "x", "y", table(spark, sf, "tissue_regions"), "region_id", "sample_id")
    return near.select(F.lit("near").alias("kind"), "key_1", "key_2").unionByName(inside.select(F.lit("inside").alias("kind"), F.col("region").alias("key_1"), F.col("point").alias("key_2")))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """Changes of each export file against the one before it in its feed."""
    changes = drift.schema_changes(table(spark, sf, "raw_records"), "feed_id", "file_id", "exported_at", "record_id", "payload")
    return changes.select(F.col("file").alias("file_id"), "change", "field_before", "field_after")


# The columns of the consistent table, their types, and the names they go by in the files.
FIELDS = {
    "sample_name": ("string", ["Sample_Name", "SampleName", "sample_name", "Specimen"]),
    "x": ("double", ["Cell X Position", "Cell_X_Position"]),
    "y": ("double", ["Cell Y Position", "Cell_Y_Position"]),
    "phenotype": ("string", ["Phenotype", "phenotype"]),
    "cell_id": ("bigint", ["Cell ID", "cell_id", "label"]),
    "area": ("double", ["cell_area", "Area"]),
    "confidence": ("double", ["Confidence"]),
    "stain_batch": ("string", ["stain_batch", "StainBatch"]),
}


def _projected(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return drift.project_fields(table(spark, sf, "raw_records"), "feed_id", "file_id", "exported_at", "record_id", "payload", FIELDS)


def p6_table(spark: SparkSession, sf: str) -> DataFrame:
    """Every record of all files in one table of typed columns."""
    return _projected(spark, sf)[0].select(F.col("file").alias("file_id"), F.col("record").alias("record_id"), *FIELDS)


def p6_failed(spark: SparkSession, sf: str) -> DataFrame:
    """Values by file and column that the column's type could not hold, with the smallest of them."""
    return _projected(spark, sf)[1].select(F.col("file").alias("file_id"), F.col("col").alias("field"), "n_failed", "example")


def _cast(c: str, kind: str) -> str:
    return f"try_cast({c} as {kind})" if kind != "double" else f"try_cast(regexp_replace({c}, '^(-?[0-9]+),([0-9]+)$', '\\1.\\2') as double)"


_PATHS = """docs as (
  select feed_id, file_id, record_id, min(payload) as payload from raw_records where json_valid(payload) and json_type(payload) = 'OBJECT' group by 1, 2, 3),
keys as (select file_id, record_id, payload, unnest(json_keys(payload)) as path from docs),
raw as (select file_id, record_id, path, json_extract(payload, '$."' || path || '"')::varchar as value from keys),
plain as (
  select file_id, record_id, path,
    regexp_replace(regexp_replace(regexp_replace(case when value <> 'null' then value end, '^\\{"[^"]*":(.*)\\}$', '\\1'), '^\\[(.*)\\]$', '\\1'), '^"(.*)"$', '\\1') as plain
  from raw),
names(path, col, place) as (values %s),
long as (select p.*, col, place from plain p join names using (path))""" % ", ".join(f"('{n}', '{c}', {i})" for c, (_, of) in FIELDS.items() for i, n in enumerate(of))  # fmt: skip

QUERIES = {"p4_found": p4_found, "p6_found": p6_found, "p6_table": p6_table, "p6_failed": p6_failed}
SQL: dict[str, str] = {
    "p4_found": f"""
with p as (
  select distinct cell_key as k, "Sample Name" as s, "Cell X Position" as x, "Cell Y Position" as y from cell_seg_data
  where cell_key is not null and "Sample Name" is not null and isfinite("Cell X Position") and isfinite("Cell Y Position")),
q as (select *, floor(x / 5) as cx, floor(y / 5) as cy from p),
around as (select q.*, cx + dx as ex, cy + dy as ey from q, (select unnest([-1, 0, 1]) as dx), (select unnest([-1, 0, 1]) as dy)),
near as (
  select distinct a.k as key_1, b.k as key_2 from q a join around b on a.s = b.s and a.cx = b.ex and a.cy = b.ey
  where a.k < b.k and sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= {NEAR_RADIUS}),
v as (select region_id, sample_id, vertices, unnest(range(len(vertices))) as i from tissue_regions where len(vertices) >= 3),
edges as (
  select region_id, sample_id, vertices[i + 1].x as x1, vertices[i + 1].y as y1, vertices[(i + 1) % len(vertices) + 1].x as x2, vertices[(i + 1) % len(vertices) + 1].y as y2 from v),
m as (select distinct cell_key as k, sample_id, x, y from metadata_clusters where cell_key is not null and sample_id is not null and isfinite(x) and isfinite(y)),
inside as (
  select region_id as key_1, k as key_2 from edges join m using (sample_id)
  where (y1 > y) <> (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
  group by region_id, k, x, y having count(*) % 2 = 1)
select 'near' as kind, key_1, key_2 from near union all select distinct 'inside', key_1, key_2 from inside
""",
    "p6_table": f"""
with {_PATHS}, first as (select file_id, record_id, col, arg_min(plain, place) as plain from long where plain is not null group by 1, 2, 3),
every as (select distinct file_id, record_id from long)
select e.file_id, e.record_id, {", ".join(f"max(case when col = '{c}' then {_cast('plain', kind)} end) as {c}" for c, (kind, _) in FIELDS.items())}
from every e left join first f on f.file_id = e.file_id and f.record_id = e.record_id group by 1, 2""",
    "p6_failed": f"""
with {_PATHS}
select file_id, col as field, count(*) as n_failed, min(plain) as example from long
where plain is not null and ({" or ".join(f"(col = '{c}' and {_cast('plain', kind)} is null)" for c, (kind, _) in FIELDS.items())})
group by 1, 2
""",
}
