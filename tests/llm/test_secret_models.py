"""Secret scan: base columns of the query against plain regular expressions, precision and recall of the learned formats."""

import hashlib
import math
import random
import re

from sluice.llm import secret_scan as S


def brute_base(text):
    """(start, kind, end) of the base spans by the contract's patterns, one after another."""
    out = []
    for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text or ""):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text or "") if m.end() - m.start() >= 24]
    return sorted(out)


def _pick(rng, letters, n):
    return "".join(rng.choice(letters) for _ in range(n))


def _prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def _vocabulary(rng):
    consonants, vowels = "bcdfghklmnprstvw", "aeiou"
    return ["".join(rng.choice(consonants) + rng.choice(vowels) for _ in range(rng.randint(1, 5))) + rng.choice(["", "n", "s"]) for _ in range(600)]


def _tables(rng):
    """Texts with labelled credentials, then texts with bare ones, then ordinary text; and what was planted in which."""
    words = _vocabulary(rng)
    token = lambda: _pick(rng, "ABCDEFGHJKLMNPQRSTUVWXYZ", 4) + _pick(rng, "0123456789", 5) + _pick(rng, "ghjkmnpqrstvwxyz", 5)
    access = lambda: "AKIA" + _pick(rng, "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16)
    texts = [f"{_prose(rng, words, 30)} password={token()} {_prose(rng, words, 5)} {access()} {_pick(rng, '0123456789abcdef', 40)}" for _ in range(150)]
    planted = {}
    for _ in range(100):
        t = token()
        planted[len(texts)] = t
        texts.append(f"{_prose(rng, words, 10)} {t} {_prose(rng, words, 10)}")
    clean = range(len(texts), len(texts) + 200)
    texts += [f"{_prose(rng, words, 40)}. It was {rng.randint(1, 9999)} on 2024-03-{rng.randint(10, 28)}, see a/b.c-d and v{rng.randint(1, 9)}.{rng.randint(0, 99)}" for _ in clean]
    return texts, planted, clean, words


def test_query_columns_against_plain_patterns(spark, tmp_path):
    rng = random.Random(12)
    texts, _, _, _ = _tables(rng)
    odd = ["", None, "password=abc", 'Api_Key"  :  \'abcdef-_=', "secret:token=abcdefgh", "AKIA" + "A" * 15, "xAKIA" + "Z9" * 9, "f" * 23 + " " + "f" * 24 + "g",
           "paſſword=abcdefgh tоken=abcdefgh", "é日 passwd = 'aaaaaa' " + "0" * 30, "AKIA" + "0123456789" * 4, "x" * 50000 + " token=" + "q" * 3000]
    rows = [(i, t, "password=clash", 1) for i, t in enumerate([*texts[:40], *odd, *odd])] + [(None, "token: abcdef", "", 2)]
    spark.createDataFrame(rows, "doc_id long, text string, spans string, kind int").write.parquet(f"{tmp_path}/documents.parquet")
    got = S.op9_secret_scan(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((i is None, i or 0) for i, *_ in rows)
    want = {i: brute_base(t) for i, t, *_ in rows}
    for r in got:
        base = want[r.doc_id]
        listed = ",".join(f"{S.KINDS[k]}:{a}:{z}" for a, k, z in base)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for _, k, _ in base) for x in range(3)]
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        spans = [s.split(":") for s in r.spans.split(",") if s]
        assert ",".join(":".join(s) for s in spans if s[0] != "grammar") == listed
        starts = [(int(a), (*S.KINDS, "grammar").index(k)) for k, a, _ in spans]
        assert starts == sorted(starts)
        taken = sorted((int(a), int(z)) for k, a, z in spans if k == "grammar")
        assert all(not (a < z2 and a2 < z) for a, z in taken for a2, _, z2 in [(x, 0, y) for x, _, y in base])


def test_planted_formats_are_found_and_words_are_not(spark):
    texts, planted, clean, _ = _tables(random.Random(3))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.spans if s.kind == "grammar"] for r in S.scan_secrets(docs).collect()}
    found = sum(t in got[i] for i, t in planted.items())
    extra = sum(len(got[i]) for i in clean) + sum(x != planted[i] for i in planted for x in got[i])
    assert found >= 0.9 * len(planted) and found / (found + extra) >= 0.95  # recall, precision


def test_words_of_a_learned_length_are_no_credentials(spark):
    rng = random.Random(5)
    words = _vocabulary(rng)
    six = sorted({w for w in words if len(w) == 6})
    texts = [f"password={w}" for w in six[:8]] + [_prose(rng, words, 60) + " the garden window opened slowly" for _ in range(30)]
    got = S.scan_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert all(s.kind == "assign" for r in got for s in r.spans)


def test_least_length_is_a_bound():
    rng = random.Random(8)
    words = _vocabulary(rng)
    a, b = S.learn([_pick(rng, "0123456789abcdef", rng.choice([32, 40])) for _ in range(80)], [(w, 1) for w in words])
    assert 1 < a.least <= 40 and math.isfinite(a.limit)
    for n in range(1, a.least):
        assert all(S.ratio(a, b, S.classes(_pick(rng, "0123456789abcdef", n))) < a.limit for _ in range(20))
    # one pass gives the score of the best part: the same as scoring every part by itself
    for _ in range(60):
        run = "-".join(_pick(rng, "0123456789abcdefgz", rng.choice([3, 32, 40])) for _ in range(4))
        cuts = [i for i in range(len(run) + 1) if i in (0, len(run)) or "-" in run[max(0, i - 1) : i + 1]]
        every = {(S.ratio(a, b, S.classes(run[s:e])), s, e) for s in cuts for e in cuts if s < e}
        best = max((x for x in every if x[0] >= a.limit + 1e-5), default=None)
        if any(abs(x[0] - a.limit) < 1e-5 for x in every):
            continue
        parts = S.found_parts(run, 0, len(run), a, b)
        assert (best is None) == (not parts)
        if best:
            assert math.isclose(max(parts)[0], best[0])
