"""A label model: combines noisy votes into posteriors by expectation maximisation on vote patterns."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence

#: Votes: a function says yes, no, or abstains.
YES, NO, ABSTAIN = 1, 0, -1


Votes = tuple[int, ...]


def fit(patterns: Mapping[Sequence[int], int], expected: Sequence[tuple[float, float, float]], rounds: int = 60, prior: float = 0.02, trust: float = 0.005, anchor: float = 2.0, also: Iterable[Sequence[int]] = ()) -> dict[Votes, float]:
    """Posterior of each pattern of votes, from how often the patterns occur; also of the patterns ``also``.

    ``expected`` has, per function, the share of true cases on which it should say yes and no, and the share of
    false cases on which it says yes. They start the estimates and stay in them as a prior, whose weight is a
    share of the number of rows, so that tables of any size are treated alike: ``trust`` for what holds of true
    cases and for how many there are, ``anchor`` for the false yes. All are learned; the false yes learn slowly, so that functions
    which seldom agree, because each knows another kind of case, don't explain each other away.
    Votes are taken as independent given the truth. The number of patterns is bounded by 3 to the power
    of the number of functions, whatever the number of rows.
    """
    total = sum(patterns.values())
    every = {tuple(v) for v in patterns} | {tuple(v) for v in also}
    if not total:
        return {}
    m, weight = len(expected), trust * total
    start = [[[1 - y - n, n, y] for y, n, _ in expected], [[(1 - f) / 2, (1 - f) / 2, f] for _, _, f in expected]]  # abstain, no, yes; by true and false

    def posteriors(p: float, table: list) -> dict[Votes, float]:
        out = {}
        for v in every:
            odds = math.log(p / (1 - p)) + sum(math.log(table[0][j][v[j] + 1] / table[1][j][v[j] + 1]) for j in range(m))
            out[v] = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
        return out

    p, table = prior, start
    for _ in range(rounds):
        post = posteriors(p, table)
        true = sum(n * post[tuple(v)] for v, n in patterns.items())
        p = min(0.999, max(1e-9, (true + prior * weight) / (total + weight)))
        new: list = [[], []]
        for side, mass in ((0, true), (1, total - true)):
            for j in range(m):
                seen = [0.0, 0.0, 0.0]
                for v, n in patterns.items():
                    seen[v[j] + 1] += n * (post[tuple(v)] if side == 0 else 1 - post[tuple(v)])
                row = [max((x + start[side][j][k] * weight) / (mass + weight), 1e-9) for k, x in enumerate(seen)]
                if side == 1:
                    yes = max((seen[2] + start[1][j][2] * anchor * total) / (mass + anchor * total), 1e-9)
                    rest = (1 - yes) / max(row[0] + row[1], 1e-9)
                    row = [row[0] * rest, row[1] * rest, yes]
                new[side].append(row)
        table = new
    return posteriors(p, table)


def cutoff(held_out: Mapping[Sequence[int], int], posterior: Mapping[Votes, float], least: float = 20.0, default: float = 0.5) -> float:
    """The cutoff with the best expected F1 on held-out rows, by posteriors that were fitted without them.

    Of equally good ones the nearest to ``default``, which also holds where fewer than ``least`` true cases are expected.
    """
    rows = [(posterior[tuple(v)], n) for v, n in held_out.items()]
    true = sum(p * n for p, n in rows)
    if true < least:
        return default
    edges = sorted({0.0, 1.0, *(p for p, _ in rows)})
    best, at = -1.0, default
    for low, high in zip(edges, edges[1:]):
        hit, taken = sum(p * n for p, n in rows if p >= high), sum(n for p, n in rows if p >= high)
        f1 = 2 * hit / (taken + true) if taken else 0.0
        c = min(max(default, low + (high - low) * 0.01), low + (high - low) * 0.99)
        if f1 > best + 1e-12 or (abs(f1 - best) <= 1e-12 and abs(c - default) < abs(at - default)):
            best, at = f1, c
    return at
