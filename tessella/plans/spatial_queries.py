"""Queries of the spatial operators, with SQL that meets all pairs of a sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators import interaction, neighbours
from tessella.plans.bindings import CELLS, cells

RADII = interaction.annulus(0.3774, 3.0, 30.0)
TARGETS = ["B Cell", "CD4 T Cell", "CD8 T Cell"]
_IN = ", ".join(f"'{t}'" for t in TARGETS)


def pwlo_log_odds(spark: SparkSession, sf: str) -> DataFrame:
    """Log-odds and interaction probability of every ordered pair of types, by sample."""
    r = interaction.pairwise_log_odds(cells(spark, sf), RADII)
    return r.select(F.col("g").alias("sample"), "ref", "query", "pairs", F.round("log_odds", 6).alias("log_odds"), F.round("probability", 6).alias("probability"))


def pwlo_target_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbours of the target types by type."""
    met, _ = interaction.circuit_counts(cells(spark, sf), RADII, TARGETS)
    return met.withColumnRenamed("g", "sample")


def nsimplex_score(spark: SparkSession, sf: str) -> DataFrame:
    """Score of a circuit of three types, by sample."""
    r = interaction.circuit_scores(cells(spark, sf), RADII, TARGETS)
    return r.select(F.col("g").alias("sample"), *[F.round(c, 6).alias(c) for c in ("empirical", "theoretical", "score")])


def circuit_delta_z(spark: SparkSession, sf: str) -> DataFrame:
    """Change of the circuit's score without each type, as a z-score."""
    r = interaction.leave_one_out_deltas(cells(spark, sf), RADII, TARGETS)
    return r.select(F.col("g").alias("sample"), "celltype", F.round("delta", 6).alias("delta"), F.round("delta_z", 5).alias("delta_z"))


def _smoothed(spark: SparkSession, sf: str) -> DataFrame:
    c = cells(spark, sf)
    deltas = interaction.leave_one_out_deltas(c, RADII, TARGETS).select("g", "celltype", "delta_z")
    valued = c.join(F.broadcast(deltas), ["g", "celltype"])  # one row per sample and type
    edges = neighbours.nearest(c, 10, with_self=True)
    return valued.select("g", "k", "celltype", "delta_z").join(interaction.smooth(edges, valued, "delta_z").withColumnRenamed("delta_z", "smooth"), ["g", "k"])


def knn_smooth(spark: SparkSession, sf: str) -> DataFrame:
    """The circuit's z-score of each cell and its mean over the ten nearest cells, itself counted."""
    return _smoothed(spark, sf).select(F.col("g").alias("sample"), "k", F.round("smooth", 4).alias("smooth"))


def circuit_threshold_objective(spark: SparkSession, sf: str) -> DataFrame:
    """Best threshold on the smoothed z-score, by sample: rows only, as quantiles of tied floats are not stable."""
    o = interaction.threshold_objective(_smoothed(spark, sf), [0.5 + 0.05 * i for i in range(10)], TARGETS, 20)
    return o.select(F.col("g").alias("sample"), F.round("threshold", 2).alias("threshold"), "n", F.round("objective", 4).alias("objective"))


def knn_edges(spark: SparkSession, sf: str) -> DataFrame:
    """The ten nearest cells of every cell in its sample."""
    return neighbours.nearest(cells(spark, sf), 10).select(F.col("g").alias("sample"), "src", "dst", F.round("d", 6).alias("d"), "rank")


def snn_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Edges weighted by shared neighbours."""
    e = neighbours.shared_neighbour_edges(neighbours.nearest(cells(spark, sf), 10), 10)
    return e.select(F.col("g").alias("sample"), "src", "dst", F.round("weight", 6).alias("weight"))


def nh_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    """Enrichment of neighbour types over chance."""
    c = cells(spark, sf)
    r = interaction.neighbour_enrichment(neighbours.nearest(c, 15), c)
    return r.select(F.col("g").alias("sample"), "src_type", "dst_type", "observed", F.round("expected", 5).alias("expected"), F.round("z", 5).alias("z"))


_PAIRS = f"""{CELLS},
pairs as (
  select a.g, a.k, a.celltype as ref, b.celltype as query, count(*) as n
  from cells a join cells b on a.g = b.g and a.k <> b.k
  where sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) < {RADII[1]!r} and sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) > {RADII[0]!r}
  group by 1, 2, 3, 4),
sizes as (select g, celltype, count(*) as size, sum(count(*)) over (partition by g) as cells from cells group by 1, 2)"""


def _knn(k: int, with_self: bool = False) -> str:
    return f"""knn as (
  select a.g, a.k as src, b.k as dst, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) as d,
    row_number() over (partition by a.k order by sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), b.k) as rank
  from cells a join cells b on a.g = b.g{'' if with_self else ' and a.k <> b.k'} qualify rank <= {k})"""


_CIRCUIT = f"""{_PAIRS},
met as (select g, ref, query, sum(n) as pairs from pairs where ref in ({_IN}) group by 1, 2, 3),
whole as (select g, sum(case when query in ({_IN}) and query <> ref then pairs else 0 end) as inside, sum(pairs) as every from met group by 1),
t as (select g, max(cells) as cells, {", ".join(f"max(case when celltype = '{t}' then size else 0 end) as t{i}" for i, t in enumerate(TARGETS))} from sizes group by 1)"""


def _theory(shares: list[str]) -> str:
    each = [" * ".join(s for j, s in enumerate(shares) if j != i) for i in range(len(shares))]
    return f"(({' + '.join(each)}) / nullif({' + '.join(shares)}, 0))"


_DELTAS = f"""{_CIRCUIT},
deltas as (
  select s.g, s.celltype,
    inside / every - {_theory([f"(t{i} / t.cells)" for i in range(3)])}
    - case when s.celltype in ({_IN}) then -{_theory([f"((case when s.celltype = '{t}' then 0 else t{i} end) / (t.cells - s.size))" for i, t in enumerate(TARGETS)])}
      else (inside - coalesce(lost_inside, 0)) / nullif(every - coalesce(lost_every, 0), 0) - {_theory([f"(t{i} / (t.cells - s.size))" for i in range(3)])} end as delta
  from sizes s join t on s.g = t.g join whole w on s.g = w.g
  left join (
    select s.g, s.celltype, sum(case when query in ({_IN}) and query <> ref then pairs else 0 end) as lost_inside, sum(pairs) as lost_every
    from sizes s join met m on s.g = m.g and (m.ref = s.celltype or m.query = s.celltype) group by 1, 2) l on l.g = s.g and l.celltype = s.celltype),
zs as (select *, (delta - avg(delta) over (partition by g)) / nullif(stddev_pop(delta) over (partition by g), 0) as delta_z from deltas)"""

QUERIES = {f.__name__: f for f in (pwlo_log_odds, pwlo_target_counts, nsimplex_score, circuit_delta_z, knn_smooth, circuit_threshold_objective, knn_edges, snn_edges, nh_enrichment)}
SQL = {
    "pwlo_log_odds": f"""
with {_PAIRS},
met as (select g, ref, query, sum(n) as pairs, count(*) as held from pairs group by 1, 2, 3),
grid as (
  select a.g, a.celltype as ref, a.size as n_ref, b.celltype as query, b.size as n_query, a.cells, coalesce(pairs, 0) as pairs, coalesce(held, 0) as held
  from sizes a join sizes b on a.g = b.g left join met m on m.g = a.g and m.ref = a.celltype and m.query = b.celltype),
o as (select *, sum(pairs) over (partition by g, ref) as around from grid)
select g as sample, ref, query, pairs::bigint as pairs,
  case when around = 0 then null when pairs = 0 then '-inf'::double else round(ln((pairs / around) / (n_query / cells)), 6) end as log_odds,
  round(held / n_ref, 6) as probability
from o
""",
    "pwlo_target_counts": f"with {_CIRCUIT} select g as sample, ref, query, pairs::bigint as pairs from met",
    "nsimplex_score": f"""
with {_CIRCUIT}
select t.g as sample, round(inside / every, 6) as empirical, round({_theory([f"(t{i} / cells)" for i in range(3)])}, 6) as theoretical,
  round(inside / every - {_theory([f"(t{i} / cells)" for i in range(3)])}, 6) as score
from t left join whole on t.g = whole.g
""",
    "circuit_delta_z": f"with {_DELTAS} select g as sample, celltype, round(delta, 6) as delta, round(delta_z, 5) as delta_z from zs",
    "knn_smooth": f"""
with {_DELTAS}, {_knn(10, True)}
select n.g as sample, n.src as k, round(avg(z.delta_z), 4) as smooth from knn n join cells c on c.k = n.dst join zs z on z.g = n.g and z.celltype = c.celltype group by 1, 2
""",
    "knn_edges": f"with {CELLS}, {_knn(10)} select g as sample, src, dst, round(d, 6) as d, rank::int as rank from knn",
    "snn_edges": f"""
with {CELLS}, {_knn(10)}
select e.g as sample, e.src, e.dst, round(count(*) / 10.0, 6) as weight
from knn e join knn a on a.src = e.src join knn b on b.src = e.dst and b.dst = a.dst
where e.dst > e.src group by 1, 2, 3
""",
    "nh_enrichment": f"""
with {CELLS}, {_knn(15)},
sizes as (select g, celltype, count(*) as size, sum(count(*)) over (partition by g) as cells from cells group by 1, 2),
seen as (select n.g, a.celltype as s, b.celltype as d, count(*) as observed from knn n join cells a on a.k = n.src join cells b on b.k = n.dst group by 1, 2, 3),
grid as (
  select a.g, a.celltype as src_type, b.celltype as dst_type, coalesce(observed, 0) as observed, a.size * b.size / (a.cells * a.cells) as share
  from sizes a join sizes b on a.g = b.g left join seen on seen.g = a.g and seen.s = a.celltype and seen.d = b.celltype),
w as (select *, share * sum(observed) over (partition by g) as expected from grid)
select g as sample, src_type, dst_type, observed, round(expected, 5) as expected, round((observed - expected) / sqrt(expected + 1e-10), 5) as z from w
""",
}
