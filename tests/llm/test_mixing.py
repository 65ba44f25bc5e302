import itertools
import random

from talkloom.llm import mixing

DOCS = "doc_id long, source string, n long, uses int"


def test_fit_is_best_on_small_cases():
    rng = random.Random(5)
    for _ in range(40):
        lengths = sorted(rng.sample(range(1, 30), 4))
        counts = [rng.randrange(0, 4) for _ in lengths]
        budget = rng.randrange(0, 120)
        take = mixing.fit_counts(lengths, counts, budget)
        got = sum(a * b for a, b in zip(lengths, take))
        assert all(0 <= t <= c for t, c in zip(take, counts)) and got <= budget
        # the share that each length gets first is fixed, so the best is sought above it
        total = sum(a * c for a, c in zip(lengths, counts))
        low = [c * budget // total if total > budget else 0 for c in counts] if total else counts
        best = max(s for t in itertools.product(*[range(a, c + 1) for a, c in zip(low, counts)]) if (s := sum(x * y for x, y in zip(lengths, t))) <= budget) if total > budget else total
        assert got == best


def test_large_budgets():
    lengths, counts = list(range(1, 2000, 3)), [50] * len(range(1, 2000, 3))
    total = sum(a * c for a, c in zip(lengths, counts))
    for budget in (total // 3, total // 2 + 1, total - 1):
        take = mixing.fit_counts(lengths, counts, budget)
        assert sum(a * b for a, b in zip(lengths, take)) == budget


def test_mix(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", None]), rng.randrange(1, 40), 9) for i in range(400)] + [(1000, "b", 0, 9), (1001, "b", None, 9)]
    docs = spark.createDataFrame(rows, DOCS)
    targets = spark.createDataFrame([("a", 0.3, 1), ("b", 0.5, 2), ("c", 0.15, 4), ("none", 0.05, 3)], "source string, target_share double, max_repeats int")
    per, plan = mixing.budgets(docs, targets, "source", "n")
    rep = {r.source: r for r in mixing.report(per, plan).collect()}
    total = sum(r[2] or 0 for r in rows)
    size = {s: sum(r[2] or 0 for r in rows if r[1] == s) for s in "abc"}
    assert rep["none"].short and rep["none"].used_tokens == 0
    assert rep["b"].short == (2 * size["b"] < 0.5 * total)
    got = mixing.uses(docs, plan, "doc_id", "source", "n").collect()
    assert len(got) == len(rows)
    for s in "abc":
        used = sum(r.uses * r.n_tokens for r in got if r.source == s)
        assert used == rep[s].used_tokens and max(r.uses for r in got if r.source == s) <= {"a": 1, "b": 2, "c": 4}[s]
        if not rep[s].short:
            assert used == int({"a": 0.3, "b": 0.5, "c": 0.15}[s] * total)
    assert all(r.uses == 0 for r in got if r.source is None or not r.n_tokens)
    again = {r.id: r.uses for r in mixing.uses(docs.repartition(7), plan, "doc_id", "source", "n").collect()}
    assert again == {r.id: r.uses for r in got}


def test_empty(spark):
    docs = spark.createDataFrame([], DOCS)
    targets = spark.createDataFrame([("a", 0.5, 1)], "source string, target_share double, max_repeats int")
    per, plan = mixing.budgets(docs, targets, "source", "n")
    r = mixing.report(per, plan).first()
    assert (r.used_tokens, r.share_reached, r.short) == (0, None, False) and mixing.uses(docs, plan, "doc_id", "source", "n").count() == 0
