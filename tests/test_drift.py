import json
from datetime import datetime, timedelta

from tessella.operators import drift

SCHEMA = "rid long, feed long, fid long, at timestamp, payload string, path string, value string"


def records(spark, files):
    """files: (feed, file, day, list of payloads); path and value clash with names the operator uses."""
    rows, n = [], 0
    for feed, fid, day, payloads in files:
        for p in payloads:
            rows.append((n, feed, fid, datetime(2026, 1, 1) + timedelta(days=day), p if p is None or isinstance(p, str) else json.dumps(p), "x", "y"))
            n += 1
    return spark.createDataFrame(rows + rows[:3], SCHEMA)  # some delivered again


def changes(spark, files):
    return {tuple(r) for r in drift.schema_changes(records(spark, files), "feed", "fid", "at", "rid", "payload").collect()}


def test_each_kind_of_change(spark):
    names = ["S1", "S2", "S3"]
    one = [{"Sample_Name": names[i % 3], "x": 100 + 7.5 * i, "gone": True} for i in range(20)]
    two = [{"Specimen": names[(i + 1) % 3], "x": str(101 + 7.5 * i), "score": i / 20} for i in range(20)]
    three = [{"Specimen": None, "x": str(99 + 7.5 * i), "score": i / 21} for i in range(20)] + ['{"cut": ', None, "", "[1]"]
    four = [{"Specimen": [names[i % 3]], "x": str(99 + 7.5 * i), "score": i / 21} for i in range(20)]
    got = changes(spark, [(1, 11, 0, one), (1, 13, 4, three), (1, 12, 2, two), (1, 14, 6, four), (2, 21, 0, one)])
    assert got == {
        (12, "renamed", "Sample_Name", "Specimen"), (12, "retyped", "x", "x"), (12, "removed", "gone", ""), (12, "added", "", "score"),
        (14, "retyped", "Specimen", "Specimen"),
    }


def test_renamed_and_retyped_gives_two_rows(spark):
    got = changes(spark, [(1, 1, 0, [{"Cell ID": 1000 + i} for i in range(20)]), (1, 2, 1, [{"cell_id": str(1000 + i)} for i in range(20)])])
    assert got == {(2, "renamed", "Cell ID", "cell_id"), (2, "retyped", "cell_id", "cell_id")}


def test_nothing_to_compare(spark):
    assert changes(spark, []) == set()
    assert changes(spark, [(1, 1, 0, [{"a": 1}]), (None, 2, 1, [{"b": 1}])]) == set()


def test_one_table_and_failed_casts(spark):
    r = records(spark, [(1, 1, 0, [{"x": 1.5, "id": "7"}, {"X": "2,5", "id": [8]}, {"X": "far", "id": {"value": 9}}])])
    table, failed = drift.project_fields(r, "feed", "fid", "at", "rid", "payload", {"x": ("double", ["x", "X"]), "id": ("long", ["id"])})
    assert {(row["x"], row["id"]) for row in table.collect()} == {(1.5, 7), (2.5, 8), (None, 9)}
    assert [(f["file"], f["col"], f["n_failed"], f["example"]) for f in failed.collect()] == [(1, "x", 1, "far")]
