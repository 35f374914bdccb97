"""Line dedup against brute force: defined cases, both ways of applying the filter, and the filters themselves."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from sluice.llm import common, line_dedup

BLANK = " \t\n\x0b\x0c\r"


def _key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(BLANK))


def brute(rows, least=10):
    """(doc_id, n_lines, n_dropped, kept) of every row; rows with one doc_id are one document, null last."""
    order = lambda i: (i is None, i or 0)
    owner, holders = {}, {}
    for i, text in rows:
        for k in map(_key, (text or "").split("\n")):
            if len(k) >= least:
                holders.setdefault(k, set()).add(i)
    owner = {k: min(ids, key=order) for k, ids in holders.items() if len(ids) > 1}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        keep = [x for x in lines if owner.get(_key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return Counter(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    pool = ["".join(rng.choice("abcdEFé日 \t") for _ in range(rng.randint(0, 30))) for _ in range(60)]
    pool += ["exactly 10", "only nine", "日" * 10, "日" * 9, "  Padded line here\t\r", "padded LINE here", "\x0b\x0cpadded line here", "É is not é lowered", "é is not é lowered", ""]
    out = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))) for i in range(80)]
    out += [(900, None), (901, ""), (902, "\n"), (903, "one line of this text\none line of this text\n"), (904, "\n".join(pool * 40))]
    out += [(905, "x" * 70000 + " end"), (906, "start\n" + "X" * 70000 + " end")]
    out += [(907, "a row that repeats exactly\nother")] * 3 + [(908, "same id, first text of it\nshared by both texts")]
    out += [(908, "same id, second text of it\nshared by both texts"), (None, "shared by both texts\nnull id line\nonly null ids hold this")]
    out += [(None, "null id line\nonly null ids hold this"), (909, "a row that repeats exactly")]
    return out


@pytest.mark.parametrize("limit", [line_dedup.FILTER_BYTES, 0])
def test_line_dedup_equals_brute_force(spark, rows, limit):
    extra = [(i, t, 1, "x", [2], "k", 3.0) for i, t in rows]
    docs = spark.createDataFrame(extra, "doc_id long, text string, h1 int, keys string, seg array<int>, kept string, owner double").repartition(7)
    got = line_dedup.dedup_lines(docs, filter_bytes=limit, keep_text=True).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got) == brute(rows)
    assert all(r.kept_sha256 == hashlib.sha256(r.kept.encode()).hexdigest() for r in got)


def test_line_dedup_without_rows_or_repeats(spark):
    schema = "doc_id long, text string"
    assert line_dedup.dedup_lines(spark.createDataFrame([], schema)).count() == 0
    got = line_dedup.dedup_lines(spark.createDataFrame([(1, "a line of its own"), (2, None)], schema)).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_dropped) for r in got) == [(1, 1, 0), (2, 1, 0)]


def test_second_filter_misses_no_repeat_and_passes_few_others(spark):
    rng = np.random.default_rng(2)
    once, both = rng.integers(-(1 << 62), 1 << 62, (9000, 2)), rng.integers(-(1 << 62), 1 << 62, (300, 2))
    docs = [(d, 0, *map(list, zip(*[*map(tuple, once[d * 900 : d * 900 + 900].tolist()), *map(tuple, both.tolist())]))) for d in range(10)]
    keys = spark.createDataFrame(docs, "doc_id long, tkey long, h1 array<long>, h2 array<long>").repartition(5)
    found = {limit: {(r.doc_id, r.h1, r.h2) for r in line_dedup.suspects(keys, limit).collect()} for limit in (line_dedup.FILTER_BYTES, 0)}
    want = {(d, *k) for d in range(10) for k in map(tuple, both.tolist())}
    for got in found.values():
        assert want <= got and len(got - want) < 0.1 * len(once)
    # one repeated key costs a bit pattern, not a row per occurrence, on its way to the filter
    sizes = [len(r["keys"]) for r in line_dedup.pieces(keys.coalesce(1), line_dedup.SEGMENT).collect()]
    assert sum(sizes) <= 4 * (len(once) + len(both))


def test_word_hashes_hold_where_polynomials_cancel():
    letters = "a"
    for _ in range(12):
        letters += letters.translate(str.maketrans("ab", "ba"))
        if len(letters) in (512, 1024, 4096):
            pair = [letters, letters.translate(str.maketrans("ab", "ba"))]
            data = np.frombuffer("".join(pair).encode(), np.uint8)
            n = len(letters)
            got = common.word_hashes(data, np.array([0, n]), np.array([n, 2 * n]))
            assert got[0] != got[1]
    words = [b"", b"\0", b"\0\0", b"12345678", b"12345678\0", b"123456781234567", b"x" * 512, b"x" * 513, b"x" * 9000]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    first = common.word_hashes(data, starts, ends)
    assert len(set(first.tolist())) == len(words)
    moved = common.word_hashes(np.concatenate((np.frombuffer(b"pad", np.uint8), data)), starts + 3, ends + 3)
    assert (first == moved).all()
