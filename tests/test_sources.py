import gzip
import struct

import pytest

from tessella.plans import pipelines
from tessella.sources import readers, writers
from tessella.streaming import arrivals


def test_formats_by_header():
    assert readers.detect_format(["Centroid X µm", "CD3: Cell: Mean"]) == "qupath"
    assert readers.detect_format(["Centroid X µm", "Y"]) == "qupath" == readers.detect_format(["CD3: Nucleus: Mean"])
    assert readers.detect_format(["CD3 Cell Intensity", "XMin"]) == "halo" == readers.detect_format(["label", "y", "x", "Classification"])
    assert readers.detect_format(["CD3_Mean_intensity", "CD3_P25_intensity"]) == "codex"
    assert readers.detect_format(["label", "y", "x", "CD3"]) == "mesmer"
    assert readers.detect_format(["anything"]) == "halo"
    cols = ["CD3 Cell Intensity", "CD31 Cell Intensity", "Ki67 Nucleus Intensity", "Ki67 Cell Intensity", "XMin"]
    assert readers.expression_columns(cols, "halo", failed=["CD3"], nuclear=["Ki67"]) == ["CD31 Cell Intensity", "Ki67 Nucleus Intensity"]
    assert readers.expression_columns(["label", "y", "x", "CD3"], "mesmer") == ["CD3"]


@pytest.mark.parametrize("sep", ["\t", ","])
def test_vectra_export(spark, tmp_path, sep):
    rows = [["Sample_Name", "Cell_X_Position", "Cell_Y_Position", "Phenotype"], ["s1", "1.5", "2", "B"], ["", "bad", "2", "B"], ["", "3", "4", "T"], ["s1", "1", "1", " "]]
    f = tmp_path / "core7.txt.gz"
    f.write_bytes(gzip.compress("\n".join(sep.join(r) for r in rows).encode()))
    got = {tuple(r)[:5] for r in readers.read_vectra(spark, str(f)).collect()}
    assert got == {("s1", 1.5, 2.0, "B", "Unknown"), ("s1", 3.0, 4.0, "T", "Unknown")}  # the name in the first row


def test_vectra_folder_of_unlike_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Sample Name,Cell X Position,Cell Y Position,Phenotype\nA,1,2,B\n")
    (tmp_path / "b.csv").write_text("Phenotype,Cell Y Position,Tissue Category,Cell X Position,more\nT,4,Tumor,3,z\n,1,x,1,z\n")
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "c.csv").write_text("Sample_Name\tCell_X_Position\tCell_Y_Position\tPhenotype\nC\t5\t6\tNK\n")
    want = {("A", 1.0, 2.0, "B", "Unknown"), ("b", 3.0, 4.0, "T", "Tumor"), ("C", 5.0, 6.0, "NK", "Unknown")}
    assert {tuple(r)[:5] for r in readers.read_vectra(spark, str(tmp_path)).collect()} == want
    assert [p[-5:] for p in readers.expand_paths(spark, str(tmp_path))] == ["a.csv", "b.csv", "c.csv"]
    (tmp_path / "deep" / "d.csv").write_text("Cell X Position,Phenotype\n1,B\n")
    with pytest.raises(ValueError):
        readers.read_vectra(spark, str(tmp_path))
    rows, lost = readers.read_vectra(spark, str(tmp_path), report=True)
    assert rows.count() == 3 and [(r["path"][-5:], r["missing"]) for r in lost.collect()] == [("d.csv", "Cell Y Position")]
    (tmp_path / "list.txt").write_text("x.csv\n\n y.csv\n")
    assert readers.expand_paths(spark, str(tmp_path / "list.txt")) == ["x.csv", "y.csv"] == readers.expand_paths(spark, "x.csv; y.csv")
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "e.csv").write_text("Cell X Position,Cell Y Position,Phenotype\n")
    assert readers.read_vectra(spark, str(tmp_path / "empty")).count() == 0


def test_json_and_lists(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text('{"cluster_id": "1", "cell_type": "B", "confidence": 0.9}\n{"cluster_id": "2", \nno json\n')
    rows, bad = readers.read_predictions(spark, str(tmp_path / "p.jsonl"))
    assert [r["cell_type"] for r in rows.collect()] == ["B"] and bad.count() == 2
    (tmp_path / "o.json").write_text('{"markers": ["CD3", "CD20"],\n "ontology": "cells"}')
    assert tuple(readers.read_ontology(spark, str(tmp_path / "o.json")).first()) == (["CD3", "CD20"], "cells")
    (tmp_path / "o.json").write_text('{"markers": ["CD3"')
    assert readers.read_ontology(spark, str(tmp_path / "o.json")).count() == 0
    (tmp_path / "x.csv").write_text("x\nCD3_a\n")
    assert {r["marker"] for r in readers.read_allow_list(spark, str(tmp_path / "x.csv")).collect()} == {"CD3_a", "CD3a", "CD3-a"}


def test_small_files(spark, tmp_path):
    (tmp_path / "g.txt").write_text("# note\nCD3 = T cells = all\n\nCD20=B cells\n")
    assert {tuple(r) for r in readers.read_glossary(spark, str(tmp_path / "g.txt")).collect()} == {("CD3", "T cells = all"), ("CD20", "B cells")}
    (tmp_path / "a.txt").write_text("p1\np2\n")
    (tmp_path / "b.txt").write_text("NA\nx\n")
    got = readers.read_manifest(spark, path=str(tmp_path / "a.txt"), label=str(tmp_path / "b.txt")).orderBy("row").collect()
    assert [(r["path"], r["label"]) for r in got] == [("p1", None), ("p2", "x")]
    (tmp_path / "b.txt").write_text("x\n")
    with pytest.raises(ValueError):
        readers.read_manifest(spark, path=str(tmp_path / "a.txt"), label=str(tmp_path / "b.txt"))
    (tmp_path / "m.csv").write_text("id,g1,g2\nc1,1,0\nc2,x,3\n")
    assert {tuple(r) for r in readers.read_matrix(spark, str(tmp_path / "m.csv")).collect()} == {("c1", "g1", 1.0), ("c2", "g2", 3.0)}
    boxed = readers.clean_columns(spark.createDataFrame([("1", "3", "a", "b")], ["XMin", "XMax", "CD3 Mean", "cd3_mean"]))
    assert boxed.columns == ["xmin", "xmax", "cd3_mean", "cd3_mean_2", "x"] and boxed.first()["x"] == 2.0


def test_image_containers(spark, tmp_path):
    (tmp_path / "a.tif").write_bytes(b"II*\0" + b'<OME><Channel ID="1" Name="DAPI"/><Channel Name="CD3"/></OME>')
    (tmp_path / "b.tif").write_bytes(b"II*\0" + b"<PerkinElmer-QPI-ImageDescription><Biomarker>CD8</Biomarker>")
    (tmp_path / "c.tif").write_bytes(b"nothing")
    got = {r["path"][-5:]: (r["kind"], r["channels"]) for r in readers.image_kinds(spark, str(tmp_path)).collect()}
    assert got == {"a.tif": ("ome", ["DAPI", "CD3"]), "b.tif": ("qptiff", ["CD8"]), "c.tif": ("no tiff", None)}


@pytest.mark.parametrize(("order", "big"), [("<", False), (">", False), ("<", True)])
def test_image_directories_at_the_end(spark, tmp_path, order, big):
    word, head = ("Q", "Q") if big else ("I", "H")

    def tiff(pages):
        mark = {"<": b"II", ">": b"MM"}[order] + struct.pack(order + "H", 43 if big else 42) + (struct.pack(order + "HH", 8, 0) if big else b"")
        body, link = bytearray(mark + bytes(8 if big else 4) + bytes(1_200_000)), len(mark)
        for width, text in pages:
            start = len(body)
            body += text
            struct.pack_into(order + word, body, link, len(body))
            pad = bytes((8 if big else 4) - 2)
            body += struct.pack(order + head, 3)
            for tag in (256, 257):
                body += struct.pack(order + "HH" + word, tag, 3, 1) + struct.pack(order + "H", width) + pad
            body += struct.pack(order + "HH" + word + word, 270, 2, len(text), start)
            link = len(body)
            body += struct.pack(order + word, 0)
        return bytes(body)

    qpi = "<PerkinElmer-QPI-ImageDescription><Biomarker>{}</Biomarker></PerkinElmer-QPI-ImageDescription>"
    (tmp_path / "a %20#.tif").write_bytes(tiff([(9, b'<OME><Channel ID="1" Name="DAPI"/></OME>'), (9, b"plain")]))
    (tmp_path / "q.tif").write_bytes(tiff([(9, qpi.format("CD8").encode()), (9, qpi.format("CD4").encode()), (4, qpi.format("CD8").encode())]))
    (tmp_path / "s.tif").write_bytes(tiff([(9, b"plain text")]))
    got = {r["path"][-5]: (r["kind"], r["channels"]) for r in readers.image_kinds(spark, str(tmp_path)).collect()}
    assert got == {"#": ("ome", ["DAPI"]), "q": ("qptiff", ["CD8", "CD4"]), "s": ("standard", None)}


def test_writers(spark, tmp_path):
    pairs = spark.createDataFrame([("A", "A", 1.0), ("A", "B", 2.0), ("B", "A", 3.0)], "ref string, query string, v double")
    assert [tuple(r) for r in writers.wide_matrix(pairs, "v").collect()] == [("A", 1.0, 3.0), ("B", 2.0, None)]
    cells = spark.createDataFrame([("s 1", 1.0, 2.0, "B"), ("s2", 1.0, 2.0, "B")], "`Sample Name` string, `Cell X Position` double, `Cell Y Position` double, Phenotype string")
    writers.write_vectra(cells, str(tmp_path / "v"))
    assert {p.name for p in (tmp_path / "v").glob("sample=*")} == {"sample=s_1", "sample=s2"}


def test_stream_of_files(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "g string, n long").write.parquet(str(tmp_path / "in"))
    rows = arrivals.arriving(spark, str(tmp_path / "in"), "g string, n long")
    arrivals.each_batch(rows, lambda b: b.groupBy("g").count(), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert {tuple(r)[:2] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {("a", 2), ("b", 1)}


def test_pipelines(spark):
    import random

    rng = random.Random(2)
    cells = spark.createDataFrame([("ab"[i % 2], i, rng.uniform(0, 300), rng.uniform(0, 300), rng.choice("XYZW")) for i in range(240)], "g string, k long, x double, y double, celltype string")
    d = pipelines.run_dynamics(cells, pipelines.Dynamics(1.0, 3, 30, ["X", "Y"], min_cells=5))
    assert d["pairs"].count() == 32 and d["score"].count() == 2 and d["deltas"].count() == 8 and d["threshold"].count() == 2
    n = pipelines.run_niches(cells, pipelines.Niches(k1=5, k2_min=2, k2_max=3))
    assert n["assigned"].count() == 240 and n["sweep"].count() == 2
    with pytest.raises(ValueError):
        pipelines.Niches(loo_mode="x")
