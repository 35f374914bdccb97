"""Product codes against plain k-means in whole numbers, and the pivot search against evaluating every entry."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from sluice.llm import vector_codes as V

SCHEMA = "vec_id long, label string, embedding array<double>, v int, d string, code long, error double"


def _rows(spark, rows):
    return spark.createDataFrame([(i, label, x, 1, "d", 2, 0.5) for i, label, x in rows], SCHEMA)


def brute(rows, entries, rounds):
    """(vec_id, code, error, label_error) of every row, and the hash of the codebooks."""
    ok = [(i, label, [math.floor(V.SCALE * c) for c in x]) for i, label, x in rows
          if x and len(x) % 4 == 0 and all(c is not None and math.isfinite(c) for c in x)]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    if not ok:
        return Counter(), ""
    w = len(ok[0][2]) // 4
    ok = [r for r in ok if len(r[2]) == 4 * w]
    cut = lambda x, p: x[p * w : p * w + w]
    books = [[cut(r[2], p) for r in ok[:entries]] for p in range(4)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(4):
            member = defaultdict(list)
            for r in ok:
                member[near(cut(r[2], p), books[p])[1]].append(cut(r[2], p))
            books[p] = [[sum(c) // len(member[e]) for c in zip(*member[e])] if e in member else c for e, c in enumerate(books[p])]
    coded, by_label = [], defaultdict(int)
    for i, label, x in ok:
        got = [near(cut(x, p), books[p]) for p in range(4)]
        coded.append((i, label, "".join(f"{e:02x}" for _, e in got), sum(d for d, _ in got)))
        by_label[label] += coded[-1][3]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return Counter((i, code, err, by_label[label]) for i, label, code, err in coded), sha


@pytest.mark.parametrize("entries,rounds", [(256, 4), (9, 3)])
def test_codes_equal_plain_k_means(spark, entries, rounds):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "b", None]), [round(rng.gauss(0, 1), 2) for _ in range(12)]) for i in range(60)]
    rows += [(70 + i, "ties", [0.5, -0.5] * 6) for i in range(20)] + [(3, "a", rows[3][2]), (3, "b", [0.25] * 12), (None, "a", [1.0] * 12)]
    rows += [(200, "x", None), (-5, "x", [float("nan")] * 12), (-6, "x", [float("inf")] + [0.0] * 11), (-7, "x", [None] + [0.0] * 11), (-8, "x", []), (-9, "x", [1.0] * 3), (201, "x", [1.0] * 16)]
    rng.shuffle(rows)
    got = V.label_errors(*V.compress(_rows(spark, rows).repartition(5), rounds, entries)).collect()
    want, sha = brute(rows, entries, rounds)
    assert Counter((r.vec_id, r.code, r.error, r.label_error) for r in got) == want
    assert {r.codebooks_sha256 for r in got} == {sha}


def test_codes_without_vectors(spark):
    for rows in ([], [(1, "a", None), (2, "b", [float("nan")] * 4)]):
        coded, books = V.compress(_rows(spark, rows))
        assert books is None and V.label_errors(coded, books).collect() == []
    with pytest.raises(Exception, match="would not fit"):
        V.compress(_rows(spark, [(1, "a", [1e12] * 4)]))


@pytest.mark.parametrize("spread", [3, 40, 2000, 1 << 22])
def test_pivots_prune_without_changing_the_nearest_entry(spread):
    rng = np.random.default_rng(spread)
    centres = rng.integers(-spread, spread + 1, (64, 16))
    entries = centres[rng.integers(0, 64, 256)] + rng.integers(-spread // 8, spread // 8 + 1, (256, 16))
    x = np.concatenate((entries[:40], centres[rng.integers(0, 64, 1500)] + rng.integers(-spread // 8, spread // 8 + 1, (1500, 16))))
    pivots = V.choose_pivots(entries, V.PIVOTS)
    at, best, evaluated = V.nearest(x, V.distances(x, pivots), entries, V.distances(entries, pivots))
    every = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (best == every.min(axis=1)).all() and (at == every.argmin(axis=1)).all()  # argmin: the lower index on ties
    if spread >= 40:
        assert evaluated < 0.35 * every.size
