"""Parts of prompts, on small tables."""

from tessella.operators import annotation


def test_state_clause(spark):
    up = spark.createDataFrame([("C1", "PD-1"), ("C1", "Ki_67"), ("C1", "ki67"), ("C1", "CD3"), ("C2", "CD20"), ("C3", None)], "cluster string, marker string")
    assert {tuple(r) for r in annotation.state_clause(up).collect()} == {("C1", "Ki_67 (proliferation), ki67 (proliferation), PD-1 (activation/checkpoint)")}
    assert annotation.state_clause(up, {"other": ["CD-20"]}).first()["state"] == "CD20 (other)"
    assert annotation.state_clause(up.limit(0)).count() == 0


def test_ontology_text():
    assert annotation.ontology_text(["CD3", "CD4", "CD3"]) == "CD3+ -> ? | CD4+ -> ? | Other -> Other"
    assert annotation.ontology_text(["CD3", "X"], "CD3+ -> T", ["CD3"]) == "CD3+ -> T | X+ -> ?"
    assert annotation.ontology_text(["CD3"], "CD3+ -> T", ["CD3"]) == "CD3+ -> T"


def test_listing_prompts(spark):
    v = spark.createDataFrame([(1, 1, "B", 2.0), (1, 0, "A", 1.0), (1, 0, "A", 2.0), (2, 0, "A", None), (2, 1, "B", -0.5)], "k long, place int, marker string, v double")
    got = {r["k"]: r["prompt"] for r in annotation.listing_prompts(v, "k", "A+ -> ?").collect()}
    assert got == {1: "Markers: A=1.500, B=2.000. Choose the type by these rules: A+ -> ?.", 2: "Markers: B=-0.500. Choose the type by these rules: A+ -> ?."}


def test_prompts_without_elevated_markers(spark):
    d = spark.createDataFrame([("C1", "A=+2.00", "B=-1.00", 0.0, "A (x)"), ("C2", "", "B=-1.00", 0.5, None)], "cluster string, elevated string, reduced string, share_high double, state string")
    got = {r["cluster"]: r["prompt"] for r in annotation.prompts(d).collect()}
    assert "profile: A=+2.00." in got["C1"] and "Markers below it: B" in got["C1"] and "no lineage" in got["C1"] and "A (x)" in got["C1"]
    assert "No marker stands out" in got["C2"] and "lowest ones: B" in got["C2"] and "no lineage" not in got["C2"] and "Unclassified" in got["C2"]
