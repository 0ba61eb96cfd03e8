"""Statistics of each document's own text, and the kind of text they tell: prose, list, table or junk."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.session import materialize

# Frequent function words of English, German, French and Spanish.
COMMON = (
    "a about after all also an and any are as at be because been before but by can could did do does for from had has have he her his how i if in into is it its just like me more most my no not now of on once one only "
    "or other our out over she should so some than that the their them then there these they this to too up us was we were what when where which while who why will with would you your "
    "aber alle als am an auf aus bei bin das dass dem den der des die dir du durch ein eine einem einen einer er es euch für gegen gibt habe haben hat hatte hier ich ihr im in ist ja jemand jetzt kein mal man mehr mich mir mit nach nicht "
    "nichts noch nur ob oder ohne sehr sein sich sie sind so um und uns von vor war warum was wenn wer wie wieder wir wird zu zum zur "
    "au aux avec avez avons ce cela ces cette comme dans de des deux du elle en est et eu hier il ils je la le les leur lui ma mais me merci mes mon même ne nous on ont ou où par pas plus pour pourquoi qu quand que quelqu qui "
    "rien sa sans se ses si son sont sur tout très tu un une va vous votre à été "
    "al alguien como con cuando de del desde donde el ella en era es esta este está fue ha han hasta hay he hemos la las le lo los me mi más muy nada no nos o para pero por porque que qué se si sin sobre son su sus también te tiene todo tu un una ya"
).split()
# Digits and signs that stand for letters in disguised words.
DISGUISES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
STATISTICS = ["n_words", "word_length", "symbol_ratio", "digit_ratio", "odd_ratio", "line_punctuation", "common_share", "known_share", "words_per_line", "bullet_share", "cell_share", "pair_share", "short_share", "comma_rate", "stop_rate", "distinct_share", "char_share", "sorted_share"]

_COMMON = frozenset(COMMON)
_BB = re.compile(r"\[(/?)quote[^\[\]]*\]", re.I)
_HTML = re.compile(r"<(/?)blockquote[^<>]*>", re.I)
_QUOTED = re.compile(r"^\s*(?:(?:>|&gt;)+(?:\s|$|[^\W\d_])|\|\s(?![^\n]*\|\s*$))")
_WROTE = re.compile(r"^\S+ wrote:\s*$")
_SIGNATURE = re.compile(r"\n\s*(?:--\s?|_{8,}|<hr\s*/?>[^\n]*|\[size=1\][^\n]*)(?:\n|$)", re.I)
_ITEM = re.compile(r"<li[^<>]*>|\[\*\]", re.I)
_CELL = re.compile(r"</t[dh]>\s*(?=<t[dh])", re.I)
_BREAK = re.compile(r"<br\s*/?>|</?(?:p|div|ul|ol|tr|table)(?:\s[^<>]*)?>|\[/?list[^\[\]]*\]", re.I)
_PARAGRAPH = re.compile(rf"\n[^\S\n]*\n|{_BREAK.pattern}", re.I)
_LEAD = re.compile(rf"(?:\s|{_BREAK.pattern})*", re.I)
_MARKUP = re.compile(r"</?[a-z][^<>]*>|\[/?(?:b|i|u|s|url|img|size|color|code)(?:=[^\[\]]*)?\]", re.I)
_GONE = re.compile(r"^\W*(?:(?:this |the )?(?:post|message|comment|thread|reply)?\s*(?:was |has been )?(?:deleted|removed|moderated|emptied)(?: by [\w ]{1,40})?)\W*$", re.I)
_LINK = re.compile(r"(?:https?://|www\.)\S+")
_WORD = re.compile(r"[^\W\d_](?:[^\W_]|[@$](?=[^\W\d_]))*")
_DISGUISE = str.maketrans(DISGUISES)
_BULLET = re.compile(r"^\s*(?:[-*•·–+]|\d{1,3}[.)])\s+\S")
_PAIR = re.compile(r"^\s*[\w /-]{1,24}:\s+\S.{0,40}$")
_DELIMITERS = ("\t", ";", "|", ",")
_GAP = re.compile(r"\S {2,}(?=\S)")
_PLAIN = frozenset(".,;:!?'\"()-–—’“”«»¿¡ \n\t")
_ENDS = (".", "!", "?", "…", ":", ".\"", "!\"")


def without_blocks(text: str, tag: re.Pattern) -> str:
    """A text without what stands between opening and closing tags, however deeply nested.

    A closing tag belongs to the last opening tag that has none yet. An opening tag without a partner ends at the next
    paragraph break (a blank line or a tag that breaks lines) outside of blocks that has text before and behind it;
    where there is none, the tag alone goes, like a closing tag without a partner.
    """
    opened, blocks = [], []
    for m in tag.finditer(text):
        if not m.group(1):
            opened.append(m)
        else:
            blocks.append(((opened.pop() if opened else m).start(), m.end()))
    if opened:
        whole, last, at = sorted(blocks), len(text.rstrip()), 0
        breaks, end = [], 0
        for m in _PARAGRAPH.finditer(text):
            while at < len(whole) and whole[at][0] <= m.start():
                end, at = max(end, whole[at][1]), at + 1
            if m.start() >= end and m.end() < last:
                breaks.append(m.start())
        for m in opened:
            i = bisect_left(breaks, _LEAD.match(text, m.end()).end())
            blocks.append((m.start(), breaks[i] if i < len(breaks) else m.end()))
    out, at = [], 0
    for start, end in sorted(blocks):
        out.append(text[at:start])
        at = max(at, end)
    return "".join(out) + text[at:]


def own_text(text: str) -> str:
    """A post without quotes, signature and markup; items of lists stand on lines of their own, with a bullet."""
    t = without_blocks(without_blocks(text, _BB), _HTML).replace("\r", "")
    m = None
    for m in _SIGNATURE.finditer(t):
        if len(t) - m.end() < 200:
            break
        m = None
    if m and t[: m.start()].strip():
        t = t[: m.start()]
    t = "\n".join(line for line in t.split("\n") if not _QUOTED.match(line) and not _WROTE.match(line))
    t = _MARKUP.sub("", _BREAK.sub("\n", _ITEM.sub("\n* ", _CELL.sub("\t", t))))
    t = _LINK.sub(" ", t)
    return t.replace("&nbsp;", " ").replace("&amp;", "&").replace("&gt;", ">").replace("&lt;", "<").strip()


def _cells(lines: list[str]) -> float:
    """Share of lines that have as many delimiters, two or more, as most lines have."""
    best = 0.0
    for d in (*_DELIMITERS, None):
        counts = [len(_GAP.findall(x)) if d is None else x.count(d) for x in lines]
        least = 1 if d in ("\t", None) else 2
        usual = Counter(c for c in counts if c >= least).most_common(1)
        if usual and usual[0][1] > 1:
            best = max(best, usual[0][1] / len(lines))
    return best


def tokens(own: str) -> list[str]:
    """Words of a text in lower case, digits that stand for letters put back; numbers are no words."""
    return [w if w.isalpha() else w.translate(_DISGUISE) for w in _WORD.findall(own.lower())]


def is_gone(text: str | None) -> bool:
    """Whether a post is null, empty or a notice that it was taken away."""
    return text is None or not text.strip() or bool(_GONE.match(text))


def statistics(own: str, known: frozenset | None = None) -> list[float]:
    """The values of ``STATISTICS`` for an own text; shares are of words, lines or characters, 0 where there are none."""
    lines = [x for x in own.split("\n") if x.strip()]
    words = tokens(own)
    solid = [c for c in own if not c.isspace()]
    n, w, ln = max(1, len(solid)), max(1, len(words)), max(1, len(lines))
    counts = Counter(solid)
    odd = sum(k for c, k in counts.items() if ord(c) > 127 and (c in "ÃÂ�" or unicodedata.category(c)[0] in "SCM"))
    symbols = sum(k for c, k in counts.items() if not c.isalnum() and c not in _PLAIN)
    digits = sum(k for c, k in counts.items() if c.isdigit())
    short = [x for x in lines if len(x.split()) <= 6 and not x.rstrip().endswith((".", "!", "?", "…"))]
    stops = sum(own.count(c) for c in ".!?")
    return [
        float(np.log1p(len(words))),
        float(np.log1p(sum(map(len, words)) / w)),
        symbols / n,
        digits / n,
        odd / n,
        sum(x.rstrip().endswith(_ENDS) for x in lines) / ln,
        sum(x in _COMMON for x in words) / w,
        (sum(x in known for x in words) / w) if known is not None else 0.0,
        float(np.log1p(len(words) / ln)),
        sum(bool(_BULLET.match(x)) for x in lines) / ln,
        _cells(lines) if len(lines) > 1 else 0.0,
        sum(bool(_PAIR.match(x)) for x in lines) / ln,
        len(short) / ln,
        min(1.0, own.count(",") / w),
        min(1.0, stops / w),
        len(set(words)) / w,
        max(counts.values(), default=0) / n,
        abs(sum(a <= b for a, b in zip(words, words[1:])) / max(1, len(words) - 1) - 0.5) if len(words) > 7 else 0.0,
    ]


def standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return (x - mean) / scale


def responsibilities(z: np.ndarray, weight: np.ndarray, mu: np.ndarray, var: np.ndarray) -> tuple[np.ndarray, float]:
    """The share of each component in each row, and the sum of the rows' log-likelihoods."""
    log = np.log(weight) - 0.5 * (np.log(2 * np.pi * var).sum(1) + (z**2) @ (1 / var).T - 2 * z @ (mu / var).T + (mu**2 / var).sum(1))
    top = log.max(1, keepdims=True)
    p = np.exp(log - top)
    total = p.sum(1, keepdims=True)
    return p / total, float((top[:, 0] + np.log(total[:, 0])).sum())


def update(sums: np.ndarray, mu0: np.ndarray, var0: np.ndarray, prior: float, floor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights, means and variances from summed responsibilities ``[n, sum z, sum z^2]`` and the seeds as a prior."""
    d = mu0.shape[1]
    n, s1, s2 = sums[:, :1], sums[:, 1 : d + 1], sums[:, d + 1 :]
    mu = (s1 + prior * mu0) / (n + prior)
    var = (s2 - 2 * mu * s1 + n * mu**2 + prior * (var0 + (mu - mu0) ** 2)) / (n + prior)
    weight = (n[:, 0] + prior) / (n.sum() + prior * len(mu0))
    return weight, mu, np.maximum(var, floor)


def own_texts(documents: DataFrame, key: str, text: str) -> DataFrame:
    """``doc, own`` of every document that has a text of its own; keys that come again count once."""

    def strip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            own = [own_text(t) if not is_gone(t) else "" for t in pdf.t]
            yield pd.DataFrame({"doc": pdf.doc, "own": [o if o and not is_gone(o) else None for o in own]})

    d = documents.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").alias("t")).where(F.col("doc").isNotNull() & F.col("t").isNotNull())
    return d.mapInPandas(strip, f"doc {d.schema['doc'].dataType.simpleString()}, own string").where(F.col("own").isNotNull())


def known_words(own: DataFrame, least_docs: int = 5, least_share: float = 0.0005) -> frozenset:
    """Words that stand in at least ``least_share`` of all documents, and in ``least_docs``.

    At most (distinct words of a mean document) / ``least_share`` words reach it, however large the corpus is.
    """
    n = own.count()
    words = own.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("own"), F.lit(r"\p{L}+"), F.lit(0)))).alias("w"))
    often = words.groupBy("w").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= max(least_docs, least_share * n))
    return frozenset(r["w"] for r in often.collect())


def document_statistics(documents: DataFrame, key: str, text: str) -> DataFrame:
    """``doc, x``: the values of ``STATISTICS`` of every document's own text, written once for the passes over them."""
    own = materialize(own_texts(documents, key, text), "own")
    known = own.sparkSession.sparkContext.broadcast(known_words(own))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc": pdf.doc, "x": [statistics(o, known.value) for o in pdf.own]})

    stats = own.mapInPandas(measure, f"doc {own.schema['doc'].dataType.simpleString()}, x array<double>")
    result = materialize(stats.groupBy("doc").agg(F.min("x").alias("x")), "statistics")
    result.known_words = known.value
    return result


def _sums(stats: DataFrame, of_batch, size: int) -> np.ndarray:
    """The sum over all rows of what ``of_batch`` returns for a batch; tasks add up before the shuffle."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for pdf in batches:
            if len(pdf):
                total += of_batch(np.array(pdf.x.tolist(), dtype=float))
        yield pd.DataFrame({"s": [total]})

    out = np.zeros(size)
    for r in stats.select("x").mapInPandas(add, "s array<double>").select(F.posexplode("s").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r["i"]] = r["v"]
    return out


def fit_mixture(stats: DataFrame, seeds: np.ndarray, styles: np.ndarray, rounds: int = 15, prior_share: float = 0.002, floor: float = 0.05) -> dict:
    """A Gaussian mixture fitted by expectation-maximization to the standardized statistics of all documents.

    One component starts at the mean of each style's examples (``seeds``, rows of statistics; ``styles``, their
    style), which also weighs in as a prior of ``prior_share`` of the documents. Every round is one pass over the
    statistics that returns the summed responsibilities only.
    """
    d = len(STATISTICS)
    first = _sums(stats, lambda x: np.concatenate([[len(x)], x.sum(0), (x**2).sum(0)]), 1 + 2 * d)
    n = max(1.0, first[0])
    mean = first[1 : d + 1] / n
    # A statistic that hardly varies in a small corpus must not tear the examples apart.
    scale = np.maximum(np.sqrt(np.maximum(first[d + 1 :] / n - mean**2, 0)), np.maximum(0.4 * seeds.std(0), 1e-3))
    z = standard(seeds, mean, scale)
    mu0 = np.array([z[styles == j].mean(0) for j in range(int(styles.max()) + 1)])
    var0, k, prior = np.full_like(mu0, 0.15), len(mu0), prior_share * n + 25  # few documents must not pull a style away from its examples
    weight, mu, var = np.full(k, 1 / k), mu0, var0
    for _ in range(rounds):

        def batch(x: np.ndarray, weight: np.ndarray = weight, mu: np.ndarray = mu, var: np.ndarray = var) -> np.ndarray:
            v = standard(x, mean, scale)
            r, _ = responsibilities(v, weight, mu, var)
            return np.concatenate([r.sum(0)[:, None], r.T @ v, r.T @ v**2], axis=1).ravel()

        weight, mu, var = update(_sums(stats, batch, k * (1 + 2 * d)).reshape(k, -1), mu0, var0, prior, floor)
    return {"mean": mean, "scale": scale, "weight": weight, "mu": mu, "var": var}


def classify(documents: DataFrame, key: str, text: str, examples: dict[str, dict[str, list[str]]]) -> DataFrame:
    """The statistics of each document's own text and its kind: ``doc, kind``, the component, and all statistics.

    ``examples`` holds inspected texts by kind and style. Components take the kind of which they explain most
    examples, those that explain none the kind of the style they began with; a document has the kind of its likeliest component. Documents that are null, empty, taken away or without a text
    of their own give no row; very long texts are read whole; repeated keys count once; other columns are ignored.
    """
    stats = document_statistics(documents, key, text)
    named = [(kind, style) for kind, of in examples.items() for style in of]
    shown = [(i, kind, own_text(t)) for i, (kind, style) in enumerate(named) for t in examples[kind][style]]
    seeds = np.array([statistics(t, stats.known_words) for _, _, t in shown])
    model = fit_mixture(stats, seeds, np.array([i for i, _, _ in shown]))
    r, _ = responsibilities(standard(seeds, model["mean"], model["scale"]), model["weight"], model["mu"], model["var"])
    kinds = list(examples)
    share = np.array([r[[i for i, (_, k, _) in enumerate(shown) if k == kind]].sum(0) for kind in kinds])
    kind_of = [kinds[share[:, j].argmax()] if share[:, j].max() > 0.5 else named[j][0] for j in range(len(named))]

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = np.array(pdf.x.tolist(), dtype=float)
                p, _ = responsibilities(standard(x, model["mean"], model["scale"]), model["weight"], model["mu"], model["var"])
                best = p.argmax(1)
                yield pd.DataFrame({"doc": pdf.doc, "kind": [kind_of[j] for j in best], "component": [f"{named[j][0]}/{named[j][1]}" for j in best], "x": pdf.x})

    found = stats.mapInPandas(assign, f"doc {stats.schema['doc'].dataType.simpleString()}, kind string, component string, x array<double>")
    return found.select("doc", "kind", "component", *[F.col("x")[i].alias(name) for i, name in enumerate(STATISTICS)])
