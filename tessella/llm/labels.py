"""Freely typed values mapped to the entries of a reference list."""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Words that say how sure or checked a value is, not what it means.
HEDGES = ["likely", "probable", "probably", "prob", "maybe", "possibly", "possible", "presumed", "checked", "confirmed", "rev", "revised", "high confidence", "low confidence", "medium confidence", "confidence", "type", "celltype", "cell_type", "label", "phenotype"]
# Words that join two meanings.
CONNECTORS = ["or", "and", "mix", "mixed", "vs", "versus", "plus", "with"]
# Other spellings of words in names of cells.
SPELLINGS = {"tumour": "tumor", "centre": "center", "zelle": "cell", "zellen": "cell", "cellule": "cell", "lymphocyte": "cell", "cel": "cell", "leucocyte": "leukocyte", "oesinophil": "eosinophil"}
# Greek letters that stand for words.
GREEK = {"α": "alpha", "β": "beta", "γ": "gamma", "δ": "delta"}
# Other words for the generic one.
GENERIC_WORDS = ["cell", "zelle", "cellule", "lymphocyte"]
#: A word of every kind of name; it neither tells entries apart nor has to be there.
GENERIC = "cell"

_TAG = re.compile(r"<[^<>]*>")
_JSON = re.compile(r'^\{\s*"[^"]*"\s*:\s*"?(.*?)"?\s*\}$')
_KEY = re.compile(r"^\w+\s*=\s*")
_NUMBERED = re.compile(r"^(?:\d+\s*[:.)]\s*|c\d{1,3}\s*[-:]\s*)")
_COUNT = re.compile(r"[,;]?\s*\bn\s*=\s*\d+\s*$")
_MARKER = re.compile(r"\bcd[\s_-]?(\d+[a-z]?)(?:\s*\(?\+\)?|\s*pos(?:itive)?\b|(?=[\s_.,)-]|$))")
_HEDGE = re.compile(r"(?:\b(?:" + "|".join(sorted(map(re.escape, HEDGES), key=len, reverse=True)) + r")\b\.?)")
_SPLIT = re.compile(r"\s*(?:[/+&|]|\b(?:" + "|".join(CONNECTORS) + r")\b)\s*")
_WORD = re.compile(r"[^\W_]+")


def singular(word: str) -> str:
    """A word without its plural ending, in its usual spelling."""
    if len(word) > 3 and word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    return SPELLINGS.get(word, word)


def clean(value: str) -> str:
    """A typed value without wrapping, numbering, counts, hedges and marker notation, in lower case."""
    v = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", value))
    v = "".join(c for c in v if not unicodedata.combining(c) and unicodedata.category(c) != "Cf").strip().strip("`\"'").strip()
    v = _TAG.sub(" ", v).strip().lower()
    v = "".join(f" {GREEK[c]} " if c in GREEK else c for c in v)
    v = _JSON.sub(r"\1", v)
    v = _KEY.sub("", v).strip()
    v = _NUMBERED.sub("", v)
    v = _COUNT.sub("", v)
    return _MARKER.sub(r" cd\1 ", v.replace("_", " "))


def parts(value: str) -> list[list[str]]:
    """The words of each meaning that a typed value names; connecting words and signs stand between meanings."""
    v = _HEDGE.sub(" ", clean(value))
    return [w for w in ([singular(x) for x in _WORD.findall(p)] for p in _SPLIT.split(v)) if w]


def deletions(word: str, depth: int) -> set[str]:
    """``word`` and all that is left of it without up to ``depth`` letters."""
    out = level = {word}
    for _ in range(depth):
        level = {w[:i] + w[i + 1 :] for w in level for i in range(len(w))}
        out = out | level
    return out


def edits(a: str, b: str) -> int:
    """Insertions, deletions, replacements and swaps of neighbours that turn ``a`` into ``b``."""
    two: list[int] = []
    one = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, two[j - 2] + 1)
            row.append(best)
        two, one = one, row
    return one[-1]


def allowed(word: str) -> int:
    """Edits that may be made to a word of this length: short ones are told apart by single letters."""
    return 0 if len(word) < 4 else 1 if len(word) < 9 else 2


class Matcher:
    """Finds the entry that a value means, by an automaton over names and aliases, then by token sets."""

    def __init__(self, entries: Iterable[tuple[int, list[str]]]):
        """``entries``: each entry's id and its names. A name that two entries share means neither."""
        self.automaton = ahocorasick.Automaton()
        sets: dict[frozenset, set[int]] = defaultdict(set)
        phrases: dict[str, set[int]] = defaultdict(set)
        self.long: dict[str, list[str]] = {}  # a one-word alias: the words of the entry's first name
        for entry, names in entries:
            first = [w for p in parts(names[0]) for w in p] if names else []
            for name in names[1:]:
                alias = [w for p in parts(name) for w in p]
                if len(alias) == 1:
                    self.long[alias[0]] = first if self.long.get(alias[0], first) == first else []
            for name in names:
                words = [w for p in parts(name) for w in p]
                bare = [w for w in words if w != GENERIC]
                for w in (words, bare):
                    if w:
                        phrases[" " + " ".join(w) + " "].add(entry)
                if bare:
                    sets[frozenset(bare)].add(entry)
        self.sets = {k: min(v) for k, v in sets.items() if len(v) == 1}
        for phrase, ids in phrases.items():
            if len(ids) == 1:
                self.automaton.add_word(phrase, (min(ids), phrase.count(" ") - 1))
        if len(self.automaton):
            self.automaton.make_automaton()
        self.near: dict[str, set[str]] = defaultdict(set)
        self.of_word: dict[str, set[frozenset]] = defaultdict(set)
        for bag in self.sets:
            for w in bag:
                self.of_word[w].add(bag)
                for d in deletions(w, allowed(w)):
                    self.near[d].add(w)
        self.words: dict[str, dict[str, int]] = {}
        self.generics: dict[str, bool] = {}
        self.seen: dict[str, int] = {}

    def mentions(self, words: list[str]) -> tuple[set[int], list[str]]:
        """Entries mentioned among the words and the telling words left over; the longest match wins."""
        if not len(self.automaton):
            return set(), words
        text = " " + " ".join(words) + " "
        starts = {0: 0}  # the place of each space in the text: the word that follows it
        for i, w in enumerate(words):
            starts[max(starts) + len(w) + 1] = i + 1
        found = sorted(((n, starts[end] - n, entry) for end, (entry, n) in self.automaton.iter(text)), key=lambda m: (-m[0], m[1]))
        free = [True] * len(words)
        ids = set()
        for n, start, entry in found:
            if all(free[start : start + n]):
                free[start : start + n] = [False] * n
                ids.add(entry)
        return ids, [w for w, f in zip(words, free) if f and w != GENERIC]

    def generic(self, word: str) -> bool:
        """Whether a word is a misspelling of the generic one."""
        hit = self.generics.get(word)
        if hit is None:
            hit = self.generics[word] = len(word) > 2 and any(edits(word, g) <= max(1, allowed(g)) for g in GENERIC_WORDS)
        return hit

    def spelled(self, word: str) -> dict[str, int]:
        """Words of the list that ``word`` may be a misspelling of, with the edits needed."""
        hit = self.words.get(word)
        if hit is None:
            near = {w for d in deletions(word, allowed(word)) for w in self.near.get(d, ())}
            hit = {w: e for w in near if (e := edits(word, w)) <= min(allowed(w), max(allowed(word), 1))}
            self.words[word] = hit
        return hit

    def by_set(self, words: list[str], least: float = 0.9) -> int:
        """The one entry whose words are most similar to the given ones as a set, in any order; else -1.

        Similarity is twice the number of words that both have, misspelt or not, over the number of words of both; it
        must reach ``least``, so that a missing or a further word of a short name makes another meaning. Of entries of
        equal similarity the one that needs fewer edits is meant, and none if these are equal too.
        """
        bare = [w for w in dict.fromkeys(words) if w != GENERIC and (w in self.of_word or not self.generic(w))]
        if not bare:
            return -1
        exact = self.sets.get(frozenset(bare))
        if exact is not None:
            return exact
        spelled = [self.spelled(w) for w in bare]
        ranked: list[tuple[float, int, int]] = []
        for bag in {b for s in spelled for w in s for b in self.of_word[w]}:
            left, cost, common = set(bag), 0, 0
            for s in spelled:
                near = min(((e, w) for w, e in s.items() if w in left), default=None)
                if near:
                    left.discard(near[1])
                    common, cost = common + 1, cost + near[0]
            score = 2 * common / (len(bare) + len(bag))
            if score >= least:
                ranked.append((-score, cost, self.sets[bag]))
        ranked.sort()
        sure = ranked and (len(ranked) == 1 or ranked[0][:2] < ranked[1][:2] or ranked[0][2] == ranked[1][2])
        return ranked[0][2] if sure else -1

    def part(self, words: list[str]) -> int:
        """The entry that one meaning names: a mention that leaves no telling word over, else the token set."""
        ids, rest = self.mentions(words)
        if len(ids) == 1 and not rest:
            return next(iter(ids))
        found = self.by_set(words)
        return found if found >= 0 else self.by_set([x for w in words for x in self.long.get(w) or [w]])

    def match(self, value: str) -> int:
        """The id of the entry that the value means, or -1 if it means none or several."""
        hit = self.seen.get(value)
        if hit is None:
            meanings = parts(value)
            ids = {self.part(p) for p in meanings}
            hit = next(iter(ids)) if len(ids) == 1 else -1
            if len(self.seen) < 1_000_000:
                self.seen[value] = hit
        return hit


def map_to_list(values: DataFrame, key: str, value: str, entries: DataFrame, entry: str, names: list[str], max_entries: int = 200_000) -> DataFrame:
    """The entry of a reference list that each freely typed value means: ``key, entry`` (-1: none, or several).

    Rows whose value is null, blank or equal to a name in the first of ``names`` need no mapping and give no row; a
    null key gives none. Each key gives one row; if its rows hold several values, the largest result is kept. The
    list is held in every task and must have at most ``max_entries`` rows (more is an error); an empty list maps
    nothing. The values themselves are not shuffled: tasks map them as they read, each distinct one once. Very long
    values are mapped like others. Other columns are ignored.
    """
    rows = entries.select(F.col(f"`{entry}`").cast("int").alias("id"), *[F.col(f"`{n}`").alias(f"n{i}") for i, n in enumerate(names)]).limit(max_entries + 1).collect()
    if len(rows) > max_entries:
        raise ValueError(f"the reference list has more than {max_entries} rows")
    listed = [(r["id"], [v for v in r[1:] if v and v.strip()]) for r in rows if r["id"] is not None]
    exact = {r["n0"] for r in rows if r["n0"] is not None}

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(listed)
        for pdf in batches:
            kept = pdf[~pdf.v.isin(exact)]
            codes, uniques = pd.factorize(kept.v)
            mapped = pd.Series([matcher.match(u) for u in uniques], dtype="int32")
            yield pd.DataFrame({"k": kept.k.values, "entry": mapped.values[codes] if len(kept) else pd.Series(dtype="int32")})

    typed = values.select(F.col(f"`{key}`").alias("k"), F.col(f"`{value}`").cast("string").alias("v")).where(F.col("k").isNotNull() & F.col("v").rlike(r"\S"))
    mapped = typed.mapInPandas(found, f"k {typed.schema['k'].dataType.simpleString()}, entry int")
    return mapped.groupBy("k").agg(F.max("entry").alias("entry"))
