"""Training-data operators against brute force and DuckDB, with the edge cases of their docstrings."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF001
from oracle_compare import compare, duck
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm import common, decontam, language_id, license_scan, mixing, near_dedup, secret_scan, sharding, substring_dedup, suffix_dedup, topk
from sluice.llm.queries import ORACLES, QUERIES

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def _docs(spark, texts, langs=None, sources=None):
    rows = [(i, t, (langs or {}).get(i, "en"), (sources or {}).get(i, "s"), None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC)


def _prose(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """Copies, near copies, shared passages, null, empty, blank, very long and short texts."""
    rng = random.Random(3)
    base = [_prose(rng, rng.randint(1, 120)) for _ in range(12)]
    passage = _prose(rng, 60)
    out = base + [base[0], base[0], base[5], None, "", "  \n ", "one two", "one two", "ONE two", _prose(rng, 5000)]
    out += [_prose(rng, 20) + " " + passage + "\n" + _prose(rng, 9) for _ in range(6)]
    words = base[7].split()
    for k in range(8):
        near = list(words)
        near[rng.randrange(len(near))] = "changed"
        out.append(" ".join(near))
    return out + ["x" * 400, "ab " * 300, "ab " * 300 + "tail"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_duckdb(spark, name):
    ok, msg = compare(QUERIES[name](spark, SF001), duck(SF001), ORACLES[name])
    assert ok, msg


def test_empty_tables(spark):
    docs, bench = _docs(spark, []), spark.createDataFrame([], "item_id long, text string")
    assert substring_dedup.remove_repeats(docs).count() == suffix_dedup.remove_later_copies(docs).count() == 0
    assert near_dedup.near_duplicates(docs).count() == mixing.mix(docs).count() == sharding.shard_documents(docs).count() == 0
    assert decontam.contamination(docs, bench).count() == license_scan.scan_licenses(docs).count() == secret_scan.scan_secrets(docs).count() == 0
    assert language_id.learn(docs.select("doc_id", "text", "lang")) is None and language_id.predict(docs, None).count() == 0
    assert topk.exact_top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    out = docs
    for _, stage in corpus_pipeline.STAGES[:1] + corpus_pipeline.STAGES[2:3]:
        out = stage(spark, out, SF001)
    assert out.count() == 0 and out.columns == docs.columns


# -- op1 ---------------------------------------------------------------------------
@pytest.mark.parametrize("dim,scale_up", [(3, 1.0), (7, 1e6)])
def test_top_k_is_exact(spark, dim, scale_up):
    rng = np.random.default_rng(4)
    vec = {i: (rng.integers(-3, 4, dim) * 0.5 * scale_up).tolist() for i in range(120)}
    rows = [(i, v, 0) for i, v in vec.items()] + [(200, None, 0), (250, [float("nan")] * dim, 0), (300, [None] * dim, 0), (None, [1.0] * dim, 0), (0, vec[0], 1)]
    got = topk.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int"), k=4, every=10, group_rows=17, block_queries=5)
    q = {i: [int(np.floor(256 * x)) for x in v] for i, v in vec.items()}
    want = []
    for i in range(0, 120, 10):
        ranked = sorted(((-sum(a * b for a, b in zip(q[i], q[j])), j) for j in q if j != i))[:4]
        want += [(i, r, j, -s) for r, (s, j) in enumerate(ranked, 1)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


# -- op2 ---------------------------------------------------------------------------
def test_decontamination_edges(spark):
    item = "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda"
    bench = spark.createDataFrame([(1, item), (2, "Short item"), (3, None), (4, "--"), (2, "Short item"), (None, "alpha")], "item_id long, text string")
    docs = _docs(spark, ["x " + item.upper().replace(" ", " \n- ") + " y", "a short ITEM here", "shorts item", None, "", "alpha beta gamma"])
    for block in (1 << 20, 10):  # one automaton, or one for nearly every window
        got = {r.doc_id: r for r in decontam.scan_documents(docs, bench, block_bytes=block).collect()}
        assert got[0].items == ["1"] and got[0].hits == list(range(1, 12))
        assert got[1].items == ["2"] and got[1].hits == [1, 2] and [tuple(s) for s in got[1].spans] == [(2, 12)]
        assert all(not got[i].items for i in (2, 3, 4, 5)) and got[3].n_words == 0
    assert decontam.contamination(docs, bench.limit(0)).filter("contaminated").count() == 0


# -- op3, op7 -----------------------------------------------------------------------
def test_substring_dedup_is_exact(spark, texts):
    window, got = 6, {}
    docs = _docs(spark, texts)
    for r in substring_dedup.remove_repeats(docs, window, 3, keep_text=True).collect():
        got[r.doc_id] = r
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    for d, w in enumerate(words):
        gone = {i + k for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for k in range(window)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        assert (got[d].n_words, got[d].n_removed, got[d].kept_sha256) == (len(w), len(gone), hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("limit", [2000, 1])
def test_suffix_dedup_is_exact(spark, texts, limit):
    window = 20
    got = {r.doc_id: r for r in suffix_dedup.remove_later_copies(_docs(spark, texts), window, 8, limit).collect()}
    seen = set()
    for d, t in enumerate(texts):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if b[i : i + window] in seen:
                gone[i : i + window] = b"\1" * window
            seen.add(b[i : i + window])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        want = (len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest())
        assert (got[d].n_bytes, got[d].n_removed, got[d].n_spans, got[d].kept_sha256) == want


def test_lpf_array():
    text = b"abracadabra"
    order = np.array(sorted(range(len(text)), key=lambda i: text[i:]))
    common_ = lambda a, b: next((k for k in range(len(text)) if text[a + k : a + k + 1] != text[b + k : b + k + 1] or not text[a + k : a + k + 1]), 0)
    lcp = np.array([0] + [common_(a, b) for a, b in zip(order, order[1:])])
    assert suffix_dedup.lpf(order, lcp).tolist() == [max([common_(j, i) for j in range(i)], default=0) for i in range(len(text))]


def test_repeated_rows_and_ids(spark):
    """Rows with one doc_id are told apart by text; null ids and exact repeats have a defined result."""
    long = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, long), (1, "other"), (1, long), (None, long), (None, None)], "doc_id long, text string")
    got = substring_dedup.remove_repeats(docs)
    assert sorted(r.n_removed for r in got.collect()) == [0, 0, 40, 40, 40]
    by_first = Counter((r.doc_id, r.n_removed) for r in suffix_dedup.remove_later_copies(docs).collect())
    assert by_first == {(None, 0): 2, (1, len(long)): 2, (1, 0): 1}  # a null id comes first
    near = Counter((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect())
    assert near == {(1, 1, True): 3, (None, 1, False): 1, (None, None, True): 1}


# -- op4, op8 -----------------------------------------------------------------------
def test_sharding_is_exact_and_repeatable(spark, texts):
    docs = _docs(spark, texts * 5).withColumn("slot", F.lit("clash"))
    runs = [sharding.shard_documents(docs, shards=7, rows_each=9).collect() for _ in range(2)]
    assert sorted(map(str, runs[0])) == sorted(map(str, runs[1])) and len(runs[0]) == len(texts) * 5
    sizes = Counter(r["shard"] for r in runs[0])
    assert max(sizes.values()) - min(sizes.values()) <= 1 and sorted(sizes) == list(range(7))
    for s in sizes:
        assert sorted(r["slot"] for r in runs[0] if r["shard"] == s) == list(range(sizes[s]))
    assert all(r["row"]["slot"] == "clash" and r["size"] == len((r["row"]["text"] or "").encode()) + 8 for r in runs[0])


def test_hypergeometric_matrix():
    rng = random.Random(8)
    draws = [sharding.hypergeometric(rng, 30, 50, 20) for _ in range(4000)]
    assert abs(np.mean(draws) - 7.5) < 0.1 and abs(np.var(draws) - 20 * 0.375 * 0.625 * 60 / 79) < 0.3
    m = sharding.communication_matrix([5, 0, 40, 17], 4, 1)
    assert [sum(r) for r in m] == [5, 0, 40, 17] and sorted(map(sum, zip(*m))) == [15, 15, 16, 16]


def test_mixing_meets_targets(spark):
    rng = random.Random(5)
    sources = {i: rng.choice(["a", "b", "c", "d", None]) for i in range(200)}
    docs = _docs(spark, [_prose(rng, rng.randint(0, 60)) if i % 20 else None for i in range(200)], sources=sources)
    got = mixing.mix(docs, block_words=16, keep=("source",)).collect()
    total = sum(r["size"] for r in got)
    taken, target = Counter(), {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["first_slot"] is None) == (r["taken"] == 0)
        taken[r["row"]["source"]] += r["taken"]
        target[r["row"]["source"]] = (r["target"], r["source_size"])
    assert abs(sum(t for t, _ in target.values()) - total) < 1e-6
    assert all(abs(taken[s] - t) <= 1 and t <= 3 * size for s, (t, size) in target.items())
    slots = mixing.schedule(spark, [5, 0, 9, 1]).collect()
    assert Counter(r.src for r in slots) == {0: 5, 2: 9, 3: 1} and len({r.slot for r in slots}) == 15


def test_mix_holds_every_pass_and_block(spark):
    rng = random.Random(8)
    docs = _docs(spark, [_prose(rng, rng.randint(0, 60)) for _ in range(90)], sources={i: "abc"[min(2, i // 8)] for i in range(90)})
    places, slots = mixing.placed(docs, block_words=16)
    rows = mixing.scheduled(places, slots, 16).collect()
    want = {(r.src, r.block): r.slot for r in slots.collect()}
    by_slot, by_doc, first = Counter(), Counter(), {}
    for r in rows:
        by_slot[r.slot] += r.words
        by_doc[r.doc_id] += r.words
        first[r.doc_id] = min(first.get(r.doc_id, r.slot), r.slot)
    assert set(by_slot) == set(want.values()) and max(by_slot.values()) == 16 and max(r["pass"] for r in rows) > 0
    quota = {r.src: r.quota for r in places.collect()}
    assert all(by_slot[slot] == min(16, quota[src] - 16 * block) for (src, block), slot in want.items())
    got = {r.doc_id: (r.taken, r.first_slot) for r in mixing.mix(docs, block_words=16).collect()}
    assert got == {d: (by_doc[d], first.get(d)) for d in got}


# -- op5 ---------------------------------------------------------------------------
def test_license_alignment(spark):
    a, b = "the cat sat on the mat".split(), "a cat sat quietly on the mat".split()
    code = {w: i for i, w in enumerate(sorted(set(a + b)))}
    pairs = license_scan.patience([code[w] for w in a], [code[w] for w in b])
    assert [(a[i], b[j]) for i, j in pairs] == [(w, w) for w in ("cat", "sat", "on", "the", "mat")]
    assert license_scan.longest_increasing([3, 1, 2, 5, 4]) in ([1, 2, 4], [1, 2, 3])
    filler = "the work is under a of " * 300
    docs = _docs(spark, [filler + "Licensed under the Apache-License, version 2.0. " + filler, "Released under  the MIT\nLicense", filler, None, "",
                         "Released under the License of MIT", ("Released under the MIT License. " * 50)])
    got = {r.doc_id: r for r in license_scan.scan_licenses(docs).collect()}
    assert [got[i].license for i in range(7)] == ["Apache-2.0", "MIT", None, None, None, "MIT", "MIT"]
    assert got[0].coverage == 1.0 and got[5].coverage == 0.8 and (got[1].start, got[1].end) == (0, 31)
    with pytest.raises(ValueError, match="at least one word"):
        license_scan.scan_licenses(docs, {"none": "-"})


def test_licenses_with_inserted_words(spark):
    far = "Released under the " + "quite well known " * 40 + "MIT License"
    texts = ["Released under the terms of the well known MIT License",
             "Licensed under the terms and conditions of the Apache License, Version 2.0", far, far + ". Licensed under CC BY-NC 4.0",
             "the License is MIT and under it released"]
    got = {r.doc_id: r for r in license_scan.scan_licenses(_docs(spark, texts)).collect()}
    assert [(got[i].license, got[i].coverage) for i in range(5)] == [("MIT", 1.0), ("Apache-2.0", 1.0), ("MIT", 1.0), ("CC-BY-NC-4.0", 1.0), (None, 0.0)]
    assert [(got[i].start, got[i].end) for i in range(3)] == [(0, len(t)) for t in texts[:3]] and "MIT" in got[3].licenses
    rng = random.Random(4)
    for _ in range(300):
        words, template = ([rng.randrange(4) for _ in range(n)] for n in (rng.randint(1, 9), rng.randint(1, 5)))
        lcs = [[0] * (len(template) + 1) for _ in range(len(words) + 1)]
        for i, w in enumerate(words):
            for j, x in enumerate(template):
                lcs[i + 1][j + 1] = lcs[i][j] + 1 if w == x else max(lcs[i][j + 1], lcs[i + 1][j])
        most = license_scan.most_in_order(words, template)
        assert most == lcs[-1][-1]
        if most:
            spans = [(z - a, a, z) for a in range(len(words)) for z in range(a, len(words)) if license_scan.most_in_order(words[a : z + 1], template) == most]
            assert license_scan.shortest_range(words, template, most) == min(spans)[1:]


# -- op6 ---------------------------------------------------------------------------
def test_language_id_on_held_out_rows(spark):
    got = language_id.op6_language_id(spark, SF001)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert rows and sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows) and sum(r.rejected for r in rows) <= len(rows) // 50


def test_language_model_sums_to_one_and_rejects(spark):
    model = language_id.kneser_ney({"x": dict(Counter(("   " + w + " ")[i : i + 4] for w in ("abba", "abab", "baab", "aab") for i in range(len(w) + 1)))})
    def at(n, gram):
        key = language_id._hash_strings([gram])[0]
        i = int(np.searchsorted(model.hashes[n], key))
        return i if i < len(model.hashes[n]) and model.hashes[n][i] == key else None

    def probability(gram):  # longest seen gram, times the back-off weights of the longer contexts
        weight = 1.0
        for n in range(4, 0, -1):
            i = at(n - 1, gram[-n:])
            if i is not None and model.prob[n - 1][i, 0] > 0:
                return weight * model.prob[n - 1][i, 0]
            k = at(n - 2, gram[-n:-1]) if n > 1 else None
            weight *= model.backoff[n - 2][k, 0] if k is not None else 1.0
        return weight * model.unseen[0]

    for context in ("", "a", "ab", "bab", "zz"):
        assert sum(probability(("   " + context)[-3:] + c) for c in "ab z") == pytest.approx(1.0)
    cost, _, size = language_id.token_scores(model, ["ab", "z1b"])
    word = lambda w: -sum(np.log(probability(("   " + w + " ")[i : i + 4])) for i in range(len(w) + 1))
    assert cost[:, 0] == pytest.approx([word("ab"), word("z") + word("b")]) and size.tolist() == [3, 4]
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "lang")
    trained = language_id.learn(docs)
    odd = _docs(spark, [None, "", "12 34 !!", "Жук ползёт по стене " * 20]).withColumn("row", F.lit(1))
    got = {r.doc_id: r for r in language_id.predict(odd, trained, keep_rows=True).collect()}
    assert [got[i].lang_pred for i in range(3)] == ["und"] * 3 and all(got[i].rejected for i in range(4)) and got[3].row.row == 1


# -- op9 ---------------------------------------------------------------------------
def test_secret_spans(spark):
    rng = random.Random(6)
    key = lambda: "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(16))
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    texts = [f"é {key()} and Password = '{hexes(18)}'" for _ in range(60)] + [
        "password=abc", "paſſword=abcdefgh", "API_KEY:token=abcdefgh", f"plain {hexes(23)} {hexes(24)}", None, "", f"bare b{hexes(17)} word"]
    docs = _docs(spark, texts)
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in secret_scan.scan_secrets(docs).collect()}
    assert [k for k, _, _ in got[0]] == ["access", "assign"] and got[0][0][1:] == (2, 22) and got[0][1][1:] == (27, len(texts[0]) - 1)
    assert got[60] == got[61] == [] and got[62] == [("assign", 0, 22)]
    assert [s for s in got[63] if s[0] == "hex"] == [("hex", 30, 54)] and got[64] == got[65] == []
    assert got[66] == [("grammar", 5, 23)]  # the format of the learned passwords, without the keyword


def test_short_lettered_and_embedded_secrets(spark):
    rng = random.Random(9)
    pick = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    short = lambda: pick("0123456789", 2) + pick("GHJKLMNP", 5) + pick("0123456789", 2)
    lettered = lambda: pick("GHJKLMNP", 10) + pick("ghjkmnp", 10)
    learned = [f"password={short()}" for _ in range(80)] + [f"token: {lettered()}" for _ in range(80)]
    a, b = short(), lettered()
    texts = [f"bare {a} word", f"bare {b} word", f"at the end {a}.", f"id={b}&x", f"/path/{a}/to/{b}.", f"{a[:-1]} {b}{b}"]
    got = {r.doc_id: [(s.kind, texts[r.doc_id - 160][s.start : s.end]) for s in r.spans] for r in
           secret_scan.scan_secrets(_docs(spark, learned + texts)).collect() if r.doc_id >= 160}
    g = "grammar"
    assert [got[160 + i] for i in range(6)] == [[(g, a)], [(g, b)], [(g, a)], [(g, b)], [(g, a), (g, b)], []]


# -- op10 --------------------------------------------------------------------------
def _components(texts, percent=85, size=5):
    sets = []
    for t in texts:
        w = (t or "").lower().encode().split()
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    parent = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = i, j
                while parent[a] != a:
                    a = parent[a]
                while parent[b] != b:
                    b = parent[b]
                parent[max(a, b)] = min(a, b)
    root = []
    for i in range(len(texts)):
        while parent[i] != i:
            i = parent[i]
        root.append(i)
    return sets, root


def test_near_duplicates_match_brute_force(spark, texts):
    ascii_only = [t if t is None else t.replace("é", "e") for t in texts]
    sets, root = _components(ascii_only)
    got = {r.doc_id: r for r in near_dedup.near_duplicates(_docs(spark, ascii_only).withColumn("node", F.lit(0))).collect()}
    assert [(got[i].n_shingles, got[i].component_id) for i in range(len(texts))] == [(len(sets[i]), root[i]) for i in range(len(texts))]


def test_near_duplicates_behind_unlike_hubs(spark):
    """Mutually unlike texts of one template, with the least ids, are hubs of every bucket around one linked pair."""
    base = [f"w{i}" for i in range(240)]
    changed = [(20 + 3 * k, 130 + 2 * k, 185 + 2 * k) for k in range(24)] + [(10,), (115,)]
    texts = [" ".join(f"own{k}" if i in at else w for i, w in enumerate(base)) for k, at in enumerate(changed)]
    _, root = _components(texts)
    assert root == [*range(24), 24, 24]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(_docs(spark, texts)).collect()}
    assert [got[i] for i in range(26)] == root


def test_components_of_a_long_path(spark):
    order = list(range(60))
    random.Random(2).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:])) + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.comp for r in near_dedup.components(edges).collect()}
    assert got == {**{i: 0 for i in range(60)}, 100: 100, 101: 100}


# -- pipeline ------------------------------------------------------------------------
def test_pipeline_stages_against_brute_force(spark):
    bench = [r.text for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    pats = {w for t in bench for w in decontam.item_windows(t, 10)}
    docs = spark.read.parquet(f"{SF001}/documents.parquet").withColumn("row", F.lit("clash"))
    docs = common.cut(docs.unionByName(docs.limit(5)), "test")  # repeated rows as well
    columns, stage = docs.columns, dict(corpus_pipeline.STAGES)
    kept = common.cut(stage["language_id"](spark, docs, SF001), "t1")
    assert kept.columns == columns and kept.count() >= 0.98 * docs.count()
    rows = kept.orderBy("doc_id").collect()
    sets, root = _components([r.text for r in rows])
    near = common.cut(stage["near_dedup"](spark, kept, SF001), "t2")
    assert near.columns == columns
    assert sorted(r.doc_id for r in near.collect()) == sorted(rows[i].doc_id for i in range(len(rows)) if root[i] == i)
    clean = common.cut(stage["decontamination"](spark, near, SF001), "t3")
    norm = lambda t: " " + " ".join(w for w in decontam.words_of(t) if w) + " "
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in near.collect() if not any(p in norm(r.text) for p in pats))
    mixed = common.cut(stage["mixing"](spark, clean, SF001), "t4")
    want = {r.doc_id: (2 * r.taken + r["size"]) // (2 * r["size"]) if r["size"] else 0 for r in mixing.mix(clean).collect()}
    assert mixed.columns == columns and Counter(r.doc_id for r in mixed.collect()) == Counter({d: c for d, c in want.items() if c})
    out = stage["sharding"](spark, mixed, SF001)
    by_shard = defaultdict(list)
    for r in out.collect():
        by_shard[r["shard"]].append(r["slot"])
    assert out.columns == [*columns, "shard", "slot"] and sum(map(len, by_shard.values())) == mixed.count()
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())


def test_registry():
    assert sorted(QUERIES, key=lambda q: int(re.match(r"op(\d+)_", q)[1]))[0].startswith("op1_") and len(QUERIES) == 13
    import __spark_entry__ as entry

    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
