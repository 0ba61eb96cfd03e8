import random

import numpy as np
import pandas as pd
import pytest

from tessella.llm import leakage, packing, quality
from tessella.llm.quality_examples import EXAMPLES


# --- packing
def test_first_fit_equals_a_plain_search():
    rng = random.Random(1)
    sizes = sorted((rng.randint(1, 100) for _ in range(500)), reverse=True)
    left, want = [], []
    for s in sizes:
        at = next((i for i, room in enumerate(left) if room >= s), None)
        if at is None:
            at = len(left)
            left.append(100)
        left[at] -= s
        want.append(at)
    assert packing.first_fit(sizes, 100) == want
    assert packing.first_fit([], 10) == [] and packing.first_fit([10], 10) == [0]


@pytest.mark.parametrize("per_group", [7, 10_000])
def test_packing_keeps_every_token(spark, per_group):
    rng = random.Random(2)
    rows = [(i, rng.randint(1, 60), "x", 1) for i in range(200)] + [(300, 250, "x", 1), (301, 100, "x", 1), (302, 0, "x", 1), (303, None, "x", 1), (None, 5, "x", 1)]
    got = packing.pack(spark.createDataFrame(rows, "id long, size long, item string, bin int"), "id", "size", 100, per_group).toPandas()
    fill = got.groupby(["group", "bin"])["size"].sum()
    assert fill.max() <= 100
    whole = got.groupby("item").agg(total=("size", "sum"), pieces=("piece", "count"))
    assert whole.total.to_dict() == {i: s for i, s, *_ in rows if i is not None and s}
    assert whole.pieces[300] == 3 and (whole.pieces.drop(300) == 1).all()
    if per_group > 1000:
        assert len(fill) <= 1.03 * got["size"].sum() / 100 + 1


def test_documents_in_tokens(spark):
    texts = ["hello world", "", None, "word " * 3000, "ﬁn — ñ 🔬"]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)] + [(0, "hello world", "again")], "id long, body string, doc string")
    got = packing.pack_documents(df, "id", "body", 1000).toPandas()
    encode = packing.encoding().encode_ordinary
    assert got.groupby("doc").n_tokens.sum().to_dict() == {i: len(encode(t)) for i, t in enumerate(texts) if t}
    assert got.groupby("container").n_tokens.sum().max() <= 1000
    assert packing.pack_documents(df.limit(0), "id", "body").count() == 0


# --- leakage
def passage(i, n=40):
    rng = random.Random(i)
    return " ".join("".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(n)) + "."


def found(spark, texts, passages=None, **settings):
    items = spark.createDataFrame([(i, p, "t") for i, p in (passages or {i: passage(i) for i in range(6)}).items()], "iid long, passage string, doc string")
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(texts)] + [(0, texts[0], "x", 0)], "did long, text string, item string, h int")
    return {(r["item"], r["doc"]) for r in leakage.leaked_items(docs, "did", "text", items, "iid", "passage", **settings).collect()}


def test_stretches(spark):
    w = [passage(i).rstrip(".").split() for i in range(6)]
    wrong = w[2][:]
    wrong[5], wrong[15] = "other", "[...]"
    bad = w[3][:16]
    bad[3] = bad[8] = bad[12] = "zzz"
    texts = [
        "before " + passage(0).upper() + " after",
        "> " + "\n> ".join(" ".join(w[1][i : i + 4]) for i in range(0, 20, 4)),
        "so <b>" + " ".join(wrong[:20]) + "</b>!",
        " ".join(bad),
        " ".join(w[4][:14]),
        "in&nbsp;it: " + " , ".join(w[5][:9]) + " " + w[5][9][:3] + "-\n" + w[5][9][3:] + " " + w[5][10][:2] + "­" + w[5][10][2:] + " " + " ".join(w[5][11:15]),
        None, "", "short", "long words " * 20_000,
    ]
    assert found(spark, texts) == {(0, 0), (1, 1), (2, 2), (5, 5)}


def test_common_openers_do_not_count(spark):
    opener = " ".join(f"word{i}" for i in range(18)) + ". "
    passages = {i: opener + passage(i) for i in range(4)}
    assert found(spark, [opener, "x " + passages[2]], passages) == {(2, 1)}
    assert found(spark, [opener, "x " + passages[2]], passages, most_hashes=1) == {(2, 1)}


@pytest.mark.parametrize("seed", range(40))
def test_stretch_check_equals_all_windows(seed):
    rng = np.random.default_rng(seed)
    same = rng.random(rng.integers(5, 60)) > rng.choice([0.05, 0.12, 0.2])
    want = any((~same[i:j]).sum() * 8 <= j - i for i in range(len(same)) for j in range(i + 15, len(same) + 1))
    cover = np.zeros(len(same), bool)
    best = 0
    for i in range(len(same)):
        for j in range(i + 15, len(same) + 1):
            if (~same[i:j]).sum() * 8 <= j - i:
                cover[i:j] = True
                best = max(best, int(same[i:j].sum()))
    got = leakage.stretches(same)
    assert (got[0] == cover).all() and (got[1] > 0) == want and got[1] == best


def templated(i):
    rng = random.Random(i)
    name = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3))
    goods, places = ["wool blankets", "cedar oil", "smoked eels"], ["harbour", "quarry", "granary"]
    return (
        f"Old ledgers mention {name()} {name()} twice once selling {rng.choice(goods)} once mending the {rng.choice(places)} of {name()} during the rainy weeks. "
        f"Every {rng.choice(['second', 'ninth'])} year a {name()} locks the pumps while {name()} forbids whistling only when deep winter arrives. "
        f"Nobody from {name()} may carry {rng.choice(goods)} past the {rng.choice(places)} unless {name()} has counted {rng.randint(10, 99)} barley first."
    )


def test_items_of_one_pattern_compete(spark):
    passages = {i: templated(i) for i in range(30)}
    w = {i: p.replace(".", "").split() for i, p in passages.items()}
    mixed = " ".join(w[3][:20]) + " and then " + " ".join(w[4][22:45])
    worn = w[5][:]
    worn[4], worn[12], worn[30] = "zzz", "yyy", "xxx"
    alone = "Old ledgers mention Foo Bar Baz twice once keeping red doors once painting the tower during the rainy weeks."
    both = passages[6] + " so much for that " + passages[7]
    assert found(spark, [passages[1], mixed, " ".join(worn), alone, both], passages) == {(1, 0), (3, 1), (4, 1), (5, 2), (6, 4), (7, 4)}


def test_rivals_keep_what_both_agree_with():
    row = lambda item, at, n, wrong: {"item": item, "at": at, "n": n, "wrong": wrong}
    assert leakage.rivals(pd.DataFrame([row(1, 0, 40, []), row(2, 5, 18, [3, 9])])) == [1]
    assert leakage.rivals(pd.DataFrame([row(1, 0, 40, []), row(2, 5, 20, [1])])) == [1, 2]
    assert leakage.rivals(pd.DataFrame([row(1, 0, 40, [8, 14]), row(2, 5, 18, [3, 9])])) == [1, 2]
    assert leakage.rivals(pd.DataFrame([row(1, 0, 40, []), row(1, 300, 16, [4])])) == [1]
    assert leakage.rivals(pd.DataFrame(columns=["item", "at", "n", "wrong"])) == []


def test_every_leaked_stretch_shares_the_required_shingles():
    need, length = leakage.required_overlap()
    assert (need, length) == (2, 16)


# --- quality
def test_own_text():
    post = "amy wrote:\n> old words\n[quote=\"bo\"]a [quote]b[/quote] c[/quote]<blockquote>x<blockquote>y</blockquote></blockquote>Mine &amp; <b>yours</b>.<br>Next | line\n-- \nAmy, room 3"
    assert quality.own_text(post) == "Mine & yours.\nNext | line"
    assert quality.own_text("| a | b |\n| 1 | 2 |") == "| a | b |\n| 1 | 2 |"
    assert quality.own_text("<ul><li>a</li><li>b</li></ul>") == "* a\n* b"
    assert quality.is_gone("[deleted]") and quality.is_gone("Post removed by moderator.") and quality.is_gone(None) and not quality.is_gone("deleted the file, thanks")


def test_block_without_closing_tag():
    assert quality.own_text("[quote=A]theirs\n\nCD66b: repeat\nCD15: fine") == "CD66b: repeat\nCD15: fine"
    assert quality.own_text("Mine.<blockquote><p>theirs</p><p>own</p>") == "Mine.\n\nown"
    assert quality.own_text("[quote]one line, no break\nanother\n\n") == "one line, no break\nanother"
    assert quality.own_text("[quote=A][quote=B]b\n\nb[/quote] a\r\n\r\nown [quote]c[/quote]") == "own"
    assert quality.own_text("a [/quote] b [quote]c [quote]d[/quote] e[/quote]") == "a  b"



def test_statistics_of_anything():
    for t in ("", " ", "a", "\n\n", "🔬" * 10, "x" * 100_000, "a,b\nc,d"):
        x = quality.statistics(t)
        assert len(x) == len(quality.STATISTICS) and np.isfinite(x).all()


def test_mixture_separates():
    rng = np.random.default_rng(0)
    z = np.concatenate([rng.normal(-2, 0.3, (200, 2)), rng.normal(2, 0.3, (50, 2))])
    mu0, var0 = np.array([[-1.0, -1.0], [1.0, 1.0]]), np.full((2, 2), 0.5)
    w, mu, var = np.full(2, 0.5), mu0, var0
    for _ in range(20):
        r, _ = quality.responsibilities(z, w, mu, var)
        w, mu, var = quality.update(np.concatenate([r.sum(0)[:, None], r.T @ z, r.T @ z**2], 1), mu0, var0, 1.0, 0.01)
    assert np.allclose(mu, [[-2, -2], [2, 2]], atol=0.15) and w[0] == pytest.approx(0.8, abs=0.02)


def test_kinds_of_texts(spark):
    rng = random.Random(3)
    sentences = ["The lamp was old and we had to wait for it.", "I think that this is not the problem.", "Has anyone of you seen it before?", "We looked at the rows and they were fine.", "Thanks for your help with the file."]
    names = ["oil", "cable", "timer", "lens paper", "ethanol", "sample box", "cover slips"]
    rows = [(i, " ".join(rng.choices(sentences, k=rng.randint(2, 6))), "prose") for i in range(60)]
    rows += [(100 + i, "\n".join("- " + n for n in rng.choices(names, k=8)), "list") for i in range(15)]
    rows += [(200 + i, "\n".join(";".join(rng.choice(["NA", "C05", "CD3", "Tovral", str(rng.randint(1, 999))]) for _ in range(4)) for _ in range(7)), "table") for i in range(15)]
    rows += [(300 + i, "".join(rng.choices("{}[]#$%^&*~<>=+|0123456789", k=120)), "junk") for i in range(15)]
    extra = [(400, None, ""), (401, "", ""), (402, "[deleted]", ""), (403, "> only\n> quoted", ""), (None, "text", ""), (0, rows[0][1], "")]
    df = spark.createDataFrame([(i, t, k, 1.0) for i, t, k in rows + extra], "id long, body string, doc string, x double")
    got = {r["doc"]: r["kind"] for r in quality.classify(df, "id", "body", EXAMPLES).collect()}
    assert set(got) == {i for i, *_ in rows}
    assert np.mean([got[i] == k for i, _, k in rows]) > 0.95
    assert quality.classify(df.limit(0), "id", "body", EXAMPLES).count() == 0
