"""Labels for clusters from a language model: prompts, answers, retries, votes, harmonised names."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.names import marker_key

# Markers that tell what a cell is doing, by role; they say nothing of its lineage.
STATE_ROLES = {
    "proliferation": ["KI67", "MKI67", "PCNA", "MCM2", "TOP2A", "PHH3", "PHOSPHOHISTONEH3", "BRDU", "CCNB1", "AURKB"],
    "activation/checkpoint": ["PD1", "PDCD1", "TIM3", "HAVCR2", "LAG3", "TIGIT", "CTLA4", "CD69", "ICOS", "OX40", "TNFRSF4", "CD137", "TNFRSF9", "41BB"],
    "cytotoxic effector": ["GZMB", "GRANZYMEB", "PRF1", "PERFORIN", "GNLY", "GRANULYSIN"],
    "apoptosis/survival": ["BCL2", "CLEAVEDCASPASE3", "CASP3", "CC3"],
}

#: A model: takes prompts and a seed, returns one raw answer (or None) each.
Model = Callable[[list[str], int], list[str | None]]


def glossary_clause(profile: DataFrame, glossary: DataFrame) -> DataFrame:
    """``cluster, clause``: what the markers of each cluster stand for, joined on their normalised names."""
    g = glossary.select(marker_key(F.col("marker")).alias("key"), "gloss")
    p = profile.select("cluster", "marker", marker_key(F.col("marker")).alias("key")).distinct()
    return p.join(g, "key").groupBy("cluster").agg(F.array_join(F.sort_array(F.collect_list(F.concat("marker", F.lit(": "), "gloss"))), "; ").alias("clause"))  # a panel of markers


def state_clause(profile: DataFrame, roles: dict[str, list[str]] | None = None) -> DataFrame:
    """``cluster, state``: those of a cluster's ``marker`` that report a state, with their role, by role and name.

    Names are compared as keys. Clusters without such markers have no row.
    """
    pairs = [(i, role, m) for i, (role, of) in enumerate((STATE_ROLES if roles is None else roles).items()) for m in of]
    known = profile.sparkSession.createDataFrame(pairs, "place int, role string, name string").select("place", "role", marker_key(F.col("name")).alias("key")).distinct()
    hits = profile.select("cluster", "marker", marker_key(F.col("marker")).alias("key")).distinct().join(F.broadcast(known), "key")  # a list of this module
    each = F.transform(F.sort_array(F.collect_list(F.struct("place", "marker", "role"))), lambda h: F.concat(h["marker"], F.lit(" ("), h["role"], F.lit(")")))
    return hits.groupBy("cluster").agg(F.array_join(each, ", ").alias("state"))  # a panel of markers


def ontology_text(markers: list[str], trained: str | None = None, known: list[str] | None = None) -> str:
    """Rules ``A+B+ -> type``, one after the other: the trained ones as they are, an open one for each other marker.

    Without trained rules every marker gets an open one, and what fits none is ``Other``.
    """
    new = [m for m in dict.fromkeys(markers) if trained is None or m not in (known or [])]
    rules = [f"{m}+ -> ?" for m in new]
    return " | ".join([*rules, "Other -> Other"] if trained is None else [trained, *rules])


def listing_prompts(values: DataFrame, unit: str, ontology: str, about: str | None = None) -> DataFrame:
    """``unit, prompt`` that lists every marker's mean with an ontology to choose from; one for each ``unit``.

    ``values`` has ``unit, place, marker, v``: by cluster, or by cell where each cell is a unit. Markers stand in the
    order of ``place``; null values do not count, a marker without any is left out.
    """
    means = values.where(F.col("v").isNotNull()).groupBy(unit, "place", "marker").agg(F.avg("v").alias("v"))
    listed = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "marker", "v"))), lambda m: F.format_string("%s=%.3f", m["marker"], m["v"])), ", ")
    head = f"Markers ({about}): " if about else "Markers: "
    return means.groupBy(unit).agg(listed.alias("listed")).select(unit, F.concat(F.lit(head), "listed", F.lit(f". Choose the type by these rules: {ontology}.")).alias("prompt"))  # a panel of markers each


def prompts(described: DataFrame, tissue: str | None = None, scale: str | None = None, spillover: float = 0.25) -> DataFrame:
    """``cluster, prompt`` from ``cluster, elevated, reduced, share_high`` (and ``clause`` and ``state`` if there are any).

    Where no marker is elevated the prompt says so, gives the lowest ones as such and allows for no type at all.
    """
    where = f"The tissue is {tissue}. " if tissue else ""
    how = f"Values are {scale}. " if scale else ""
    some = F.col("elevated") != ""
    high = F.when(some, F.concat(F.lit("Markers above the rest of the profile: "), "elevated", F.lit(". "))).otherwise(F.lit("No marker stands out from the profile. "))
    low = F.when(F.col("reduced") != "", F.concat(F.when(some, "Markers below it: ").otherwise("The lowest ones: "), "reduced", F.lit(". "))).otherwise(F.lit(""))
    state = F.coalesce(F.concat(F.lit("These tell a state and no lineage; use them to qualify the type only: "), "state", F.lit(". ")), F.lit("")) if "state" in described.columns else F.lit("")
    care = F.when(F.col("share_high") >= spillover, F.lit("Many markers are high at once; some may come from neighbouring cells. ")).otherwise(F.lit(""))
    gloss = F.coalesce(F.concat(F.lit("Markers: "), F.col("clause"), F.lit(". ")), F.lit("")) if "clause" in described.columns else F.lit("")
    open_ = F.when(some, 'Name the most likely cell type; say "Unclassified" only where the markers contradict each other. ').otherwise('Name the most likely cell type if anything speaks for one, else say "Unclassified". ')
    form = F.lit('Answer with JSON: {"cell_type": name, "confidence": number from 0 to 1}.')
    return described.select("cluster", F.concat(F.lit(where + how), high, low, gloss, state, care, open_, form).alias("prompt"))


def first_object(text: str | None) -> dict | None:
    """The JSON object in an answer: the whole of it without thoughts and code fences, else the first balanced one."""
    if not text:
        return None
    bare = re.sub(r"```(?:json)?", "", re.sub(r"(?s)<think>.*?</think>", "", text)).strip() or text
    for source in (bare, text):
        try:
            found = json.loads(source)
            if isinstance(found, dict):
                return found
        except ValueError:
            pass
        decoder = json.JSONDecoder()
        at = source.find("{")
        while at >= 0:
            try:
                found, _ = decoder.raw_decode(source, at)
                if isinstance(found, dict):
                    return found
            except ValueError:
                pass
            at = source.find("{", at + 1)
    return None


ANSWER = "cell_type string, confidence double, error string, raw string"


def parse_answer(raw: str | None) -> tuple[str, float, str | None, str | None]:
    """Type, confidence, kind of failure and raw text of an answer; failures are ``unknown`` with confidence 0."""
    if raw is None:
        return "unknown", 0.0, "request_failure", None
    found = first_object(raw)
    name = found.get("cell_type") if found else None
    if not isinstance(name, str) or not name.strip():
        return "unknown", 0.0, "parse_failure", raw
    try:
        confidence = float(found.get("confidence", 0.0))
    except (TypeError, ValueError):
        confidence = 0.0
    return name.strip(), confidence, None, raw


def ask(asked: DataFrame, model: Model, seed: int = 0, batch: int = 64) -> DataFrame:
    """``cluster``, ``prompt`` and the parsed answer; the model is called once per batch of prompts in each task."""

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), batch):
                part = pdf.iloc[at : at + batch]
                answers = [parse_answer(a) for a in model(part.prompt.tolist(), seed)]
                yield pd.concat([part[["cluster", "prompt"]].reset_index(drop=True), pd.DataFrame(answers, columns=["cell_type", "confidence", "error", "raw"])], axis=1)

    kind = asked.schema["cluster"].dataType.simpleString()
    return asked.select("cluster", "prompt").mapInPandas(call, f"cluster {kind}, prompt string, {ANSWER}")


def retry_failed(answers: DataFrame, model: Model, times: int = 1) -> DataFrame:
    """Asks again for what failed, up to ``times`` passes; answers that came are kept."""
    for i in range(1, times + 1):
        failed = answers.where(F.col("error").isNotNull())
        answers = answers.where(F.col("error").isNull()).unionByName(ask(failed, model, seed=i))
    return answers


def vote(votes: DataFrame, unit: list[str], label: Column) -> DataFrame:
    """The most frequent normalised label of each unit, the alphabetically first on ties: ``top, agreement, n, detail``."""
    v = votes.select(*unit, F.lower(F.trim(label)).alias("label")).where(F.coalesce(F.col("label"), F.lit("")) != "")
    c = v.groupBy(*unit, "label").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(*unit)
    c = c.withColumns({"r": F.row_number().over(w.orderBy(F.desc("c"), "label")), "n": F.sum("c").over(w)})
    detail = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r", "label", "c"))), lambda s: F.concat(s["label"], F.lit(":"), s["c"].cast("string"))), ", ")
    return c.groupBy(*unit).agg(F.max(F.when(F.col("r") == 1, F.col("label"))).alias("top"), F.max(F.when(F.col("r") == 1, F.col("c") / F.col("n"))).alias("agreement"), F.max("n").alias("n"), detail.alias("detail"))


def override_unclassified(answers: DataFrame, votes: DataFrame, min_agreement: float = 0.6) -> DataFrame:
    """Answers that say ``unclassified`` replaced by the vote of their cluster, if it names a type and agrees enough."""
    open_ = F.lower("cell_type").startswith("unclassif") & ~F.lower("top").startswith("unclassif") & (F.col("agreement") >= min_agreement)
    joined = answers.join(votes.select("cluster", "top", "agreement"), "cluster", "left")
    return joined.withColumn("cell_type", F.when(F.coalesce(open_, F.lit(False)), F.col("top")).otherwise(F.col("cell_type"))).drop("top", "agreement")


def harmonized(labels: DataFrame, label: str, mapping: DataFrame) -> DataFrame:
    """Labels replaced by their canonical name where ``mapping`` (``raw, canonical``) has one."""
    m = mapping.select(F.col("raw").alias(label), "canonical")
    return labels.join(m, label, "left").withColumn("harmonized", F.coalesce("canonical", F.col(label))).drop("canonical")
