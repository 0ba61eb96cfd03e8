"""SQL of those training-data queries that SQL can express on whole tables."""

_USABLE = """usable as (
  select cell_key, min(exprs) as e from normalized_expression
  where len(exprs) = 32 and len(list_filter(exprs, lambda x: x is not null and isfinite(x))) = 32 and len(list_filter(exprs, lambda x: x <> 0)) > 0
  group by cell_key)"""

SQL: dict[str, str] = {
    "p2_percentiles": """
with cells as (
  select cell_key, min('C' || lpad(regexp_extract(upper(trim(cluster)), '^C0*([0-9]+)$', 1), 2, '0')) as cluster
  from metadata_clusters where regexp_matches(upper(trim(cluster)), '^C0*[0-9]+$') group by cell_key),
e as (select cell_key, min(exprs) as exprs from normalized_expression where exprs is not null group by cell_key),
v as (select cluster, unnest(exprs) as v, unnest(range(len(exprs))) as position from e join cells using (cell_key)),
s as (select unnest([0.05, 0.25, 0.5, 0.75, 0.95])::double as share),
q as (
  select cluster, position, count(*) as n, quantile_cont(v, [0.05, 0.25, 0.5, 0.75, 0.95]) as qs
  from v where v is not null and isfinite(v) group by cluster, position)
select cluster, marker, n, unnest([0.05, 0.25, 0.5, 0.75, 0.95])::double as share, round(unnest(qs), 6) as value
from q join features using (position)
""",
    "p3_found": f"""
with {_USABLE}
select a.cell_key as cell_key_1, b.cell_key as cell_key_2
from usable a join usable b on a.cell_key < b.cell_key
where list_cosine_similarity(a.e, b.e) >= 0.985
""",
    "p5_found": f"""
with {_USABLE},
near as (
  select a.cell_key as k, b.cell_key as other, row_number() over (partition by a.cell_key order by list_cosine_similarity(a.e, b.e) desc, b.cell_key) as place
  from usable a join usable b on a.cell_key <> b.cell_key
  where a.cell_key in (select cell_key from probe_cells))
select distinct least(k, other) as cell_key_1, greatest(k, other) as cell_key_2 from near where place <= 5
""",
}
