import math

import pytest

from tessella.operators import interaction, neighbours, niche, ranks

FIVE = [("s", 1, 0.0, 0.0, "A"), ("s", 2, 10.0, 0.0, "A"), ("s", 3, 0.0, 20.0, "B"), ("s", 4, 100.0, 100.0, "B"), ("s", 5, 3.0, 0.0, "C")]
RADII = interaction.annulus(1.0, 3.0, 30.0)


@pytest.fixture()
def five(spark):
    return spark.createDataFrame(FIVE, "g string, k long, x double, y double, celltype string")


def test_log_odds_of_five_cells(five):
    got = {(r["ref"], r["query"]): r for r in interaction.pairwise_log_odds(five, RADII).collect()}
    assert len(got) == 9
    counts = {"A": (2, 2, 1), "B": (2, 0, 1), "C": (1, 1, 0)}
    odds = {"A": (0, 0, 0), "B": (0.510826, -math.inf, 0.510826), "C": (0.223144, 0.223144, -math.inf)}
    share = {"A": (1, 1, 0.5), "B": (0.5, 0, 0.5), "C": (1, 1, 0)}
    for ref in "ABC":
        for i, query in enumerate("ABC"):
            r = got[ref, query]
            assert r["pairs"] == counts[ref][i]
            assert r["log_odds"] == pytest.approx(odds[ref][i], abs=1e-6)
            assert r["probability"] == pytest.approx(share[ref][i])


def test_log_odds_without_neighbours(spark):
    lone = spark.createDataFrame([("s", 1, 0.0, 0.0, "A"), ("s", 2, 900.0, 0.0, "B")], "g string, k long, x double, y double, celltype string")
    rows = interaction.pairwise_log_odds(lone, RADII).collect()
    assert len(rows) == 4 and all(r["log_odds"] is None and r["probability"] == 0 for r in rows)


def test_circuit_of_five_cells(five):
    r = interaction.circuit_scores(five, RADII, ["A", "B", "C"]).first()
    assert (r["empirical"], r["theoretical"], r["score"]) == pytest.approx((0.8, 0.32, 0.48))


def test_leaving_one_type_out_equals_counting_again(five):
    targets = ["A", "B"]
    full = interaction.circuit_scores(five, RADII, targets).first()["score"]
    got = {r["celltype"]: r["delta"] for r in interaction.leave_one_out_deltas(five, RADII, targets).collect()}
    without_c = interaction.circuit_scores(five.where("celltype <> 'C'"), RADII, targets).first()["score"]
    assert got["C"] == pytest.approx(full - without_c)
    assert got["A"] == pytest.approx(full + 1)  # without a target the score is minus its expectation, here 1


def test_niches_enrichment_and_autocorrelation(spark, five):
    edges = neighbours.nearest(five, 2)
    shares = {(r["k"], r["celltype"]): r["share"] for r in niche.composition(edges, five).collect()}
    assert shares == {(1, "A"): 0.5, (1, "C"): 0.5, (2, "A"): 0.5, (2, "C"): 0.5, (3, "A"): 0.5, (3, "C"): 0.5, (4, "A"): 0.5, (4, "B"): 0.5, (5, "A"): 1.0}
    z = {(r["src_type"], r["dst_type"]): r["z"] for r in interaction.neighbour_enrichment(edges, five).collect()}
    want = {"AA": 0.316228, "AB": -1.264911, "AC": 1.341641, "BA": 0.316228, "BB": -0.474342, "BC": 0.223607, "CA": 1.341641, "CB": -0.894427, "CC": -0.632456}
    assert {a + b: pytest.approx(v, abs=1e-5) for (a, b), v in z.items()} == want
    v = spark.createDataFrame([("s", i, "m", float(i)) for i in range(1, 6)], "g string, k long, marker string, v double")
    r = ranks.morans_i(edges, v).first()
    assert (r["i"], r["z"], r["p"]) == pytest.approx((-0.0653801, 0.825645, 0.409005), abs=1e-5)


def test_shared_neighbour_edges(spark):
    e = spark.createDataFrame([("s", a, b) for a, b in [(1, 2), (1, 3), (2, 1), (2, 3), (3, 1), (3, 2), (4, 1), (4, 2)]], "g string, src long, dst long")
    one = {(r["src"], r["dst"]): r["weight"] for r in neighbours.shared_neighbour_edges(e, 2).collect()}
    assert one == {(1, 2): 0.5, (1, 3): 0.5, (2, 3): 0.5}
    both = {(r["src"], r["dst"]): r["weight"] for r in neighbours.shared_neighbour_edges(e, 2, symmetric=True).collect()}
    assert both == {(1, 2): 0.5, (1, 3): 0.5, (2, 3): 0.5, (1, 4): 0.5, (2, 4): 0.5}


def test_autocorrelation_of_the_textbooks(spark):
    e = spark.createDataFrame([("s", a, b, 1.0) for a, b in [(1, 2), (2, 1), (3, 4), (4, 3)]], "g string, src long, dst long, d double")
    v = spark.createDataFrame([("s", k, m, x) for k, x in [(1, 1.0), (2, 1.0), (3, -1.0), (4, -1.0)] for m in ("m",)] + [("s", k, "flat", 2.0) for k in range(1, 5)], "g string, k long, marker string, v double")
    got = {r["marker"]: (r["i"], r["p"]) for r in ranks.morans_i(e, v, cross_product=True).collect()}
    assert got["m"][0] == pytest.approx(1.0) and got["flat"] == (0.0, 1.0)
    assert ranks.spatially_variable(e, v, 1).count() == 1
