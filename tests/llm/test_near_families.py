"""Near-duplicate candidates: families of one template stay far from all pairs, and no link among them is lost."""

import random

import numpy as np
import pytest

from sluice.llm import near_dedup as N


def _sets(texts):
    out = {}
    for i, t in texts:
        w = t.split()
        out[i] = {" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    return out


def brute(texts, percent=85):
    """Component of every text by comparing all pairs."""
    sets = _sets(texts)
    comp = {i: i for i in sets}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                comp[y] = x
    return {i: root(i) for i in ids}


def _family(rng, m, edits, words=240, links=4):
    """Texts of one template, each with its own edits; the last ones are edited copies of earlier ones."""
    template = [f"w{k}" for k in range(words)]
    texts = []
    for i in range(m):
        t = list(template)
        for p in rng.sample(range(words), edits):
            t[p] = f"x{i}_{p}"
        texts.append((i, " ".join(t)))
    for k in range(links):
        t = texts[rng.randrange(m)][1].split()
        t[rng.randrange(words)] = f"copy{k}"
        texts.append((m + k, " ".join(t)))
    return texts


@pytest.fixture()
def counted(monkeypatch):
    sums = []
    for name in ("confirm", "differences"):
        plain = getattr(N, name)
        monkeypatch.setattr(N, name, lambda pairs, *a, plain=plain, **k: (sums.append(pairs.count()), plain(pairs, *a, **k))[1])
    return sums


@pytest.mark.parametrize("edits,sizes", [(6, (40, 80, 160)), (3, (80,))])
def test_families_cost_candidates_by_member_not_by_pair(spark, counted, edits, sizes):
    rng, per_member = random.Random(edits), []
    for m in sizes:
        counted.clear()
        texts = _family(rng, m, edits)
        got = {r.doc_id: r.component_id for r in N.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
        assert got == brute(texts)
        per_member.append(sum(counted) / len(texts))
    # all pairs would double it each time; buckets bound it: a member is in BANDS of them, with one hub each
    assert all(y < 1.6 * x for x, y in zip(per_member, per_member[1:])) and max(per_member) < 2 * N.BANDS


def test_prefixes_of_differences_hold_every_link():
    """The bounds of step 4 against all pairs of random sets: linked members of different components share a prefix element."""
    rng = np.random.default_rng(5)
    tried = 0
    for percent in (80, 85, 95):
        for _ in range(300):
            base = rng.choice(400, 120, replace=False)
            sets = []
            for _ in range(8):
                keep = base[rng.random(len(base)) > rng.choice([0.0, 0.03, 0.1, 0.2])]
                sets.append(set(keep.tolist()) | set(rng.integers(0, 1000, rng.integers(0, 25)).tolist()))
            hub, rest = sets[0], sets[1:]
            limit, rows = (100 - percent) * len(hub), []
            for s in rest:
                r, i = len(hub - s), len(s - hub)
                weight, size = 100 * r + percent * i, r + i
                small = size + 1 - -(-(weight + max(weight, limit + 1) - limit) // (100 + percent))
                large = size + 1 - -(-(weight - limit) // 100) if weight > limit else small
                order = sorted(hub ^ s, key=lambda e: (sum(e in (hub ^ t) for t in rest), e))
                both = len(hub & s)
                assert (weight <= limit) == (100 * both >= percent * (len(s) + len(hub) - both))
                rows.append((weight, set(order[:small]), set(order[:large]), s, weight <= limit))
            for x, (wx, _, _, sx, lx) in enumerate(rows):
                for wy, _, large_y, sy, ly in rows[:x] + rows[x + 1 :]:
                    both = len(sx & sy)
                    if wx <= wy and not (lx and ly) and sx != sy and 100 * both >= percent * (len(sx) + len(sy) - both):
                        tried += 1
                        assert rows[x][1] & large_y
    assert tried > 200


@pytest.mark.parametrize("group", [256, 8])
def test_small_groups_are_settled_at_once(spark, counted, monkeypatch, group):
    """A group that fits one task takes one pass and no round of differences; larger ones are split until they fit."""
    rounds, plain = [], N.differences
    monkeypatch.setattr(N, "differences", lambda *a, **k: (rounds.append(1), plain(*a, **k))[1])
    monkeypatch.setattr(N, "GROUP", group, raising=False)
    texts = _family(random.Random(group), 60, 6)
    got = {r.doc_id: r.component_id for r in N.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == brute(texts)
    assert bool(rounds) == (group == 8) and (group == 8 or len(counted) == 1)


def test_members_joined_by_counts_match_all_pairs():
    rng = np.random.default_rng(9)
    for size in (60, 6000):  # the elements of one block, and of several
        base = rng.choice(1 << 40, size, replace=False).astype(np.uint64)
        for k in (2, 7, 40):
            sets = []
            for _ in range(k):
                keep = base[rng.random(size) > rng.choice([0.0, 0.05, 0.12])]
                sets.append(np.union1d(keep, rng.integers(1 << 41, 1 << 42, rng.integers(0, size // 10)).astype(np.uint64)))
            want = list(range(k))
            for i in range(k):
                for j in range(i):
                    both = len(np.intersect1d(sets[i], sets[j]))
                    if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                        a, b = sorted((want[i], want[j]))
                        want = [a if w == b else w for w in want]
            assert N.joined_members(sets, 85).tolist() == want
