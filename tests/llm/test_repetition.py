import math
import random
import re

import numpy as np

from talkloom.llm import repetition as rep


def brute(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    seen, hit = set(), set()
    for i in range(len(w) - 4):
        g = tuple(w[i : i + 5])
        if g in seen:
            hit |= set(range(i, i + 5))
        seen.add(g)
    return len(w), len(hit)


def test_against_brute_force(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("ab cd EF gh".split()) for _ in range(rng.randrange(0, 40))) for _ in range(200)]
    texts += ["x " * 20, "one two three four five one two three four five", "a b c d", "", None, "¿Sí, SÍ sí sí sí sí?", "very long " * 20_000]
    df = spark.createDataFrame([(i, t, "q", 1) for i, t in enumerate(texts)] + [(3, texts[3], "q", 1)], "doc_id long, text string, n_words string, id int")
    got = rep.repeated_share(df.select("doc_id", "text", "n_words")).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        assert (r.n_words, r.n_repeated) == brute(texts[r.id])
    assert rep.repeated_share(df.limit(0).select("doc_id", "text")).count() == 0


def test_runs_do_not_cross_texts():
    n, r = rep.repeated_words([["a", "b", "c", "d", "e"], ["a", "b", "c", "d", "e"], [], ["a", "b", "c", "d", "e", "x", "a", "b", "c", "d", "e"]])
    assert n.tolist() == [5, 5, 0, 11] and r.tolist() == [0, 0, 0, 5]


def test_distance():
    p, q = np.array([1.0, 0.0]), np.array([0.0, 2.0])
    assert rep.js_distance(p, p) == 0 and rep.js_distance(p, q) == 1 and math.isnan(rep.js_distance(p, q * 0))
    assert rep.char_classes("aB1 .").tolist() == [1, 1, 1, 1, 1]


def test_divergence(spark):
    usual = "the cat sat on the mat and the dog ran to the door of the house "
    rows = [(i, usual * 6, "en") for i in range(20)] + [(100, "the the the " * 60, "EN"), (101, "short", "en"), (102, None, "en"), (103, "wort und wort " * 40, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    refs = rep.references(df, common=50)
    got = {r.id: r for r in rep.divergence(df, refs).collect()}
    assert got[100].js_words > got[0].js_words + 0.2 and got[101].js_words is None and got[102].js_words is None and got[103].js_words is not None
    assert rep.divergence(df.limit(0), refs).count() == 0
