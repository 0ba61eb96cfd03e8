"""Readers of delimited exports, manifests, templates, glossaries, JSON lines and image containers."""

from __future__ import annotations

import mmap
import re
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions.names import UNSET, column_case

# Columns of a cell segmentation table, and the names they go by with underscores.
VECTRA = ["Sample Name", "Cell X Position", "Cell Y Position", "Phenotype", "Tissue Category"]
VECTRA_REQUIRED = ["Cell X Position", "Cell Y Position", "Phenotype"]
# Headers that tell the vendor of a segmentation table; the first that fits counts.
FORMATS = [
    ("qupath", [r"Centroid X|: (Cell|Nucleus|Cytoplasm|Membrane): "]),
    ("halo", [r"(Cell|Nucleus|Cytoplasm) Intensity|^(Classification|Completeness|Classifier Label)$"]),
    ("codex", [r"_Mean_intensity$", r"_(P\d+|Max|Min|Median|Std_dev)_intensity$"]),
    ("mesmer", [r"^label$", r"^y$", r"^x$"]),
]
# Columns beside the markers of a table that has only bare marker names.
MESMER_BLOCK = ["label", "y", "x", "size", "y_min", "x_min", "y_max", "x_max"]


def read_delimited(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """A table with a header; tabs for ``.tsv`` and ``.txt``, compressed or not, else commas. All columns are text.

    Compressed files cannot be split, so their rows are spread out after reading.
    """
    if sep is None:
        sep = "\t" if re.search(r"\.(tsv|txt)(\.gz)?$", path, re.I) else ","
    df = spark.read.option("header", True).option("sep", sep).csv(path)
    return df.repartition(spark.sparkContext.defaultParallelism) if path.endswith(".gz") else df


def read_matrix(spark: SparkSession, path: str, transpose: bool = False) -> DataFrame:
    """A cell by gene matrix (first column: the id) as ``cell, gene, n``; zeros and what is no number are left out."""
    df = read_delimited(spark, path)
    first, rest = df.columns[0], df.columns[1:]
    long = df.unpivot([f"`{first}`"], [f"`{c}`" for c in rest], "gene", "n").withColumnRenamed(first, "cell")
    long = long.withColumn("n", F.expr("try_cast(n as double)")).where(F.col("n") != 0)
    return long.select(F.col("gene").alias("cell"), F.col("cell").alias("gene"), "n") if transpose else long


def expand_paths(spark: SparkSession, given: str, pattern: str = "*.{csv,CSV}") -> list[str]:
    """The files that a setting names: a folder (its matching files, at any depth), a ``.txt`` list, or paths parted by ``;``."""
    fs = spark._jvm.org.apache.hadoop.fs
    path = fs.Path(given.strip())
    if ";" not in given and path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
            files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(given.strip())
            return sorted(r["path"] for r in files.select("path").collect())
        if given.strip().lower().endswith(".txt"):
            listed = [r["value"].strip() for r in spark.read.text(given.strip()).collect()]
            return [x for x in listed if x]
    return [x.strip() for x in given.split(";") if x.strip()]


def read_headers(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path, header``: the first line of each file; only the first split of a file is read for it."""
    lines = spark.read.option("recursiveFileLookup", True).text(paths).where("_metadata.file_block_start = 0")
    lines = lines.select("value", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("row"))
    first = F.min_by("value", "row")  # rows of a split stand in order
    return lines.groupBy("path").agg(F.regexp_replace(first, "[\ufeff\r]", "").alias("header"))


def read_vectra(spark: SparkSession, paths: str | list[str], phenotype: str = "Phenotype", drop_missing: bool = True, report: bool = False) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Cell segmentation exports, one sample each: the columns of ``VECTRA``, typed, and ``file``.

    Files of a folder may differ: each is read by its own header and separator (tabs, else commas), and where a
    ``Sample_Name`` is there, all names have underscores for spaces. A file's sample is the name in its first row,
    else the file's own name. Rows without a phenotype (with ``drop_missing``) or a finite position go; a missing
    tissue category is ``Unknown``. A file without a required column is an error; with ``report`` the other files are
    read, and a second table ``path, missing`` names such files.
    """
    required = [*VECTRA_REQUIRED[:2], phenotype]

    def columns(header: str) -> tuple[str, list[str]]:
        for sep in ("\t", ","):
            names = [c.strip().strip('"') for c in header.split(sep)]
            named = [c.replace("_", " ") for c in names] if "Sample_Name" in names else names
            if all(c in named for c in VECTRA_REQUIRED[:2]):
                return sep, named
        return ",", named

    by: dict[str, list[str]] = {}
    for r in read_headers(spark, paths).collect():  # one row a file
        by.setdefault(r["header"] or "", []).append(r["path"])
    lost = [(p, ", ".join(c for c in required if c not in columns(h)[1])) for h, files in by.items() for p in files if any(c not in columns(h)[1] for c in required)]
    if lost and not report:
        raise ValueError("; ".join(f"{p}: no columns {missing}" for p, missing in lost))
    number = lambda c: F.expr(f"try_cast(`{c}` as double)")
    out = None
    for header, files in by.items():
        sep, names = columns(header)
        if any(c not in names for c in required):
            continue
        unique = [c if names.index(c) == i else f"{c}.{i}" for i, c in enumerate(names)]
        df = spark.read.option("header", True).option("sep", sep).schema(", ".join(f"`{c.replace('`', '``')}` string" for c in unique)).option("enforceSchema", True).csv(files)
        tissue = F.coalesce("Tissue Category", F.lit("Unknown")) if "Tissue Category" in names else F.lit("Unknown")
        own = F.col("Sample Name") if "Sample Name" in names else F.lit(None).cast("string")
        df = df.select(own.alias("Sample Name"), number("Cell X Position").alias("Cell X Position"), number("Cell Y Position").alias("Cell Y Position"), F.col(f"`{phenotype}`").alias("Phenotype"), tissue.alias("Tissue Category"), F.col("_metadata.file_path").alias("file"), F.struct("_metadata.file_block_start", F.monotonically_increasing_id().alias("row")).alias("at"))
        out = df if out is None else out.unionByName(df)
    if out is None:
        out = spark.createDataFrame([], ", ".join(f"`{c}` {'double' if 'Position' in c else 'string'}" for c in VECTRA) + ", file string, at struct<a:bigint,b:bigint>")
    first = out.groupBy("file").agg(F.min_by(F.struct("Sample Name"), "at")["Sample Name"].alias("named"))  # one row a file
    stem = F.regexp_extract("file", r"([^/]*?)(\.[A-Za-z]+)*$", 1)
    out = out.join(F.broadcast(first), "file").withColumn("Sample Name", F.coalesce(F.when(F.trim("named") != "", F.col("named")), stem))
    out = out.where((F.abs("Cell X Position") < float("inf")) & (F.abs("Cell Y Position") < float("inf")))
    if drop_missing:
        out = out.where(F.trim("Phenotype") != "")
    out = out.select(*VECTRA, "file")
    return (out, spark.createDataFrame(lost, "path string, missing string")) if report else out


def detect_format(columns: list[str]) -> str:
    """The vendor whose headers these are; ``halo`` where nothing fits."""
    for name, patterns in FORMATS:
        if all(any(re.search(p, c) for c in columns) for p in patterns):
            return name
    return "halo"


def expression_columns(columns: list[str], fmt: str, failed: list[str] = (), nuclear: list[str] = (), elsewhere_cytoplasm: bool = False) -> list[str]:
    """The columns that hold marker intensities: by cell, for ``nuclear`` markers by nucleus, failed markers left out."""
    out = [c for c in columns if c not in MESMER_BLOCK] if fmt == "mesmer" else [c for c in columns if re.search(r"intensity|: mean$", c, re.I)]
    if fmt == "halo":
        of = lambda c: re.sub(r"\s+(Cell|Nucleus|Cytoplasm) Intensity$", "", c)
        want = lambda c: "Nucleus" if of(c) in nuclear else "Cytoplasm" if elsewhere_cytoplasm else "Cell"
        out = [c for c in out if f"{want(c)} Intensity" in c]
    if fmt == "codex":
        out = [c for c in out if c.endswith("_Mean_intensity")]
    gone = [f.lower() for f in failed]
    return [c for c in out if not any(re.match(rf"{re.escape(f)}(?![a-z0-9])", c.lower()) for f in gone)]


def clean_columns(df: DataFrame) -> DataFrame:
    """Columns in lower case with underscores; a bounding box (XMin, XMax, ...) becomes its midpoint ``x, y``."""
    names: dict[str, str] = {}
    for c in df.columns:
        n, k = column_case(c) or "column", 2
        while n in names.values():
            n, k = f"{column_case(c)}_{k}", k + 1
        names[c] = n
    df = df.toDF(*[names[c] for c in df.columns])
    for axis in ("x", "y"):
        low, high = (next((n for n in (f"{axis}_{e}", f"{axis}{e}") if n in df.columns), None) for e in ("min", "max"))
        if low and high and axis not in df.columns:
            df = df.withColumn(axis, (F.expr(f"try_cast(`{low}` as double)") + F.expr(f"try_cast(`{high}` as double)")) / 2)
    return df


def read_glossary(spark: SparkSession, path: str) -> DataFrame:
    """``marker, gloss`` of lines ``MARKER = gloss``; lines that begin with # are comments."""
    lines = spark.read.text(path).where(~F.col("value").rlike(r"^\s*(#|$)") & F.col("value").contains("="))
    part = F.split("value", "=", 2)
    return lines.select(F.trim(part[0]).alias("marker"), F.trim(part[1]).alias("gloss"))


def read_template(spark: SparkSession, path: str) -> DataFrame:
    """A gating template in the order of its lines: ``place, celltype, markers``."""
    df = spark.read.option("header", True).csv(path).coalesce(1)  # a template is one short file; its order counts
    return df.select(F.monotonically_increasing_id().cast("int").alias("place"), F.col("CELLTYPE").alias("celltype"), F.col("MARKERS").alias("markers"))


def read_predictions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Predictions as JSON lines, and ``file, line`` of the lines that are no JSON object of this kind."""
    fields = "cluster_id string, cell_type string, confidence double, error string, raw string"
    lines = spark.read.text(path).where(F.trim("value") != "").select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    read = lines.withColumn("p", F.from_json("line", f"{fields}, broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"}))
    bad = F.col("p").isNull() | F.col("p.broken").isNotNull()
    return read.where(~bad).select("p.*").drop("broken"), read.where(bad).select("file", "line")


def read_ontology(spark: SparkSession, path: str) -> DataFrame:
    """``markers, ontology`` of a manifest in JSON; no row where it is malformed or lacks either."""
    df = spark.read.schema("markers array<string>, ontology string, broken string").option("multiLine", True).option("columnNameOfCorruptRecord", "broken").json(path)
    return df.where(F.col("broken").isNull() & F.col("markers").isNotNull() & F.col("ontology").isNotNull()).select("markers", "ontology")


def read_allow_list(spark: SparkSession, path: str, column: str = "x") -> DataFrame:
    """``marker``: the markers of an allow-list, each also without its underscores and with hyphens for them."""
    m = spark.read.option("header", True).csv(path).select(F.trim(F.col(f"`{column}`")).alias("m")).where(F.col("m") != "")
    return m.select(F.explode(F.array("m", F.replace("m", F.lit("_"), F.lit("")), F.replace("m", F.lit("_"), F.lit("-")))).alias("marker")).distinct()


def read_manifest(spark: SparkSession, **columns: str) -> DataFrame:
    """Line-aligned text files, one column each, put side by side: row N of every file is sample N.

    Files of different length are an error. Settings that count as absent become null.
    """
    out, lengths = None, {}
    for name, path in columns.items():
        with_row = spark.read.text(path).coalesce(1).select(F.monotonically_increasing_id().alias("row"), F.trim("value").alias(name))
        with_row = with_row.withColumn(name, F.when(F.col(name).isin(UNSET), None).otherwise(F.col(name)))
        lengths[name] = with_row.count()
        out = with_row if out is None else out.join(with_row, "row")
    if len(set(lengths.values())) > 1:
        raise ValueError(f"manifests of different length: {lengths}")
    return out


def tiff_pages(data: bytes | mmap.mmap) -> list[tuple[tuple, bytes]]:
    """``(width, height), description`` of every page of a classic or Big TIFF, wherever its directories stand.

    Raises ``ValueError`` where the chain of directories leaves the file.
    """
    order = "<" if data[:2] == b"II" else ">"

    def number(at: int, size: int) -> int:
        if at < 0 or at + size > len(data):
            raise ValueError("beyond the file's end")
        return struct.unpack(order + {2: "H", 4: "I", 8: "Q"}[size], data[at : at + size])[0]

    big = number(2, 2) == 43
    word, head, entry = (8, 8, 20) if big else (4, 2, 12)
    at, seen, pages = number(8 if big else 4, word), set(), []
    if not at:
        raise ValueError("no directory")
    while at and at not in seen:
        seen.add(at)
        n, size, text = number(at, head), [None, None], b""
        number(at + head + n * entry, word)  # the directory must lie within the file
        for e in range(at + head, at + head + n * entry, entry):
            tag, kind, count, value = number(e, 2), number(e + 2, 2), number(e + 4, word), e + 4 + word
            if tag in (256, 257):
                size[tag - 256] = number(value, {3: 2, 4: 4, 16: 8}.get(kind, word))
            elif tag == 270:
                start = value if count <= word else number(value, word)
                if start + count > len(data):
                    raise ValueError("beyond the file's end")
                text = data[start : start + count]
        pages.append((tuple(size), text))
        at = number(at + head + n * entry, word)
    return pages


def image_kind(data: bytes | mmap.mmap) -> tuple[str, list[str] | None]:
    """The kind of an image container and its channel names; those of a QPTIFF from the pages of full size."""
    if data[:4] not in (b"II*\0", b"MM\0*", b"II+\0", b"MM\0+"):
        return "no tiff", None
    try:
        pages = tiff_pages(data)
        every, full = (b"\n".join(t for _, t in of) for of in (pages, [p for p in pages if p[0] == pages[0][0]]))
    except ValueError:  # damaged directories: the whole content is searched
        every = full = data
    if re.search(rb"<OME", every):
        return "ome", [n.decode("ISO-8859-1") for n in re.findall(rb'<(?:\w+:)?Channel\b[^>]*?\bName="([^"]*)"', every)]
    if re.search(rb"PerkinElmer-QPI", every):
        return "qptiff", [n.decode("ISO-8859-1") for n in re.findall(rb"<Biomarker>([^<]*)</Biomarker>", full)]
    return "standard", None


def image_kinds(spark: SparkSession, path: str) -> DataFrame:
    """``path, kind, channels`` of image containers: their kind from the description inside, and its channel names.

    The descriptions are read page by page where they stand. Files on a disk that the executors share are mapped, not
    loaded, and may have any size; those of other file systems come as a whole, up to Spark's limit of 2 GB. Spark
    lists no empty files.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    first = files.select("path").first()
    local = first is None or first["path"].startswith("file:")

    def kinds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = []
            for i, name in enumerate(pdf.path):
                if not local:
                    found.append(image_kind(pdf.content.iloc[i]))
                    continue
                with open(re.sub(r"^file:(//(?=/))?", "", name), "rb") as f:
                    with mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ) as data:
                        found.append(image_kind(data))
            yield pd.DataFrame({"path": pdf.path, "kind": [k for k, _ in found], "channels": [c for _, c in found]})

    return files.select("path", *([] if local else ["content"])).mapInPandas(kinds, "path string, kind string, channels array<string>")
