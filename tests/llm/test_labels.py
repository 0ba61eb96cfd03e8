import pytest

from tessella.llm import labels

ENTRIES = [(1, ["T Cell"]), (2, ["CD8 T Cell", "CD8 T"]), (3, ["Naive CD8 T Cell", "CD8 Tn"]), (4, ["Macrophage", "Mac"]), (5, ["M1 Macrophage", "M1"]), (6, ["Gamma Delta T Cell", "gdT"]), (7, ["Monocyte", "Mono"]), (8, ["Nonclassical Monocyte"]), (9, ["Tumor Cell", "Tum"]), (10, ["Plasma Cell", "PC"]), (11, ["Conventional Dendritic Cell 1", "cDC1"])]


@pytest.mark.parametrize(
    "value,want",
    [
        ("t cells", 1), ("Cell (T)", 1), ("cd8+ t cell", 2), ("CD-8 T-Cell", 2), ("T Cell, Naive CD8", 3), ("naïve cd8(+) t lymphocytes", 3), ("C12-CD8 T", 2), ("8: Macrophages", 4), ("mac cell", 4), ("M1 mac", 5),
        ("γδ T cell", 6), ("<b>gdT</b>", 6), ('{"cell_type": "monocyte"}', 7), ("nonclasical monocytes (likely)", 8), ("tumour zelle, n=12", 9), ("Ｔｕｍｏｒ Ｃｅｌｌ", 9), ("plamsa cell?", 10), ("Plasma", 10), ("T cell (T Cell)", 1),
        ("conventional dendritic cell 1", 11), ("24: cDC1 [rev]", 11), ("Macrophage / checked", 4),
        ("T Cell or Macrophage", -1), ("Macrophage + Tumor Cell", -1), ("tumor cell and mac mix", -1), ("Monoblast", -1), ("Naive T Cell", -1), ("unknown 12", -1), ("-", -1), ("x" * 50_000, -1), ("dendritic cell", -1), ("", -1),
    ],
)
def test_values(value, want):
    assert labels.Matcher(ENTRIES).match(value) == want


def test_a_name_of_two_entries_means_neither():
    m = labels.Matcher([(1, ["Alpha Cell", "A"]), (2, ["Acinar Cell", "A"])])
    assert m.match("a") == -1 and m.match("alpha") == 1


def test_the_longest_mention_wins():
    ids, rest = labels.Matcher(ENTRIES).mentions(["naive", "cd8", "t", "cell"])
    assert ids == {3} and rest == []


def test_table(spark):
    entries = spark.createDataFrame([(i, n[0], n[1] if len(n) > 1 else None) for i, n in ENTRIES], "label_id int, label string, short string")
    rows = [(1, "T Cell", "a"), (2, "t cell", "a"), (2, "t cell", "b"), (3, None, "c"), (4, "  ", "c"), (5, "nothing", None), (None, "mac", "x")]
    values = spark.createDataFrame(rows, "id long, typed string, k string")  # k is a name the operator uses
    found = labels.map_to_list(values, "id", "typed", entries, "label_id", ["label", "short"])
    assert {tuple(r) for r in found.collect()} == {(2, 1), (5, -1)}
    assert labels.map_to_list(values.limit(0), "id", "typed", entries, "label_id", ["label"]).count() == 0
    assert {r["entry"] for r in labels.map_to_list(values, "id", "typed", entries.limit(0), "label_id", ["label"]).collect()} == {-1}
    with pytest.raises(ValueError):
        labels.map_to_list(values, "id", "typed", entries, "label_id", ["label"], max_entries=3)


def test_edits():
    assert labels.edits("paneth", "pnaeth") == 1 and labels.edits("abc", "") == 3 and labels.edits("kitten", "sitting") == 3
