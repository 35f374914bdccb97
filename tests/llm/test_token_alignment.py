"""Token alignment against sets of shared offsets, with the tokenizers' own encoders."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sluice.llm import token_alignment as T


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["the", "Straße", "naïve", "日本語", "don't", "12345", "__init__", "x" * 40, "ab" * 30, "\t", "  ", "\n\n", "🙂", "é", "<s>", "<|endoftext|>", "<0x41>", "\x00", "don’t", "ﬁ"]
    out = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(60)]
    return out + [None, "", " ", "\n", "a", "a▁b", out[0], out[0], "aaaaaaaa" * 3000, "word " * 9000]


def _tokens(texts):
    """(ids, bytes of each token) of A and B by the libraries themselves, or None."""
    a = Tokenizer.from_file(f"{T.FOLDER}/{T.A_FILE}")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{T.FOLDER}/{T.B_FILE}")
    letters, out = T._byte_letters(), []
    for t in texts:
        if not t:
            out.append(None)
            continue
        e = a.encode(" " + t, add_special_tokens=False)
        ids = b.encode(t)
        ba = [bytes(letters[c] for c in x) for x in e.tokens]
        bb = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids, b.id_to_piece(ids))]
        raw = (" " + t).encode()
        out.append(((e.ids, ba), (ids, bb)) if b"".join(ba) == raw == b"".join(bb) else None)
    return out


def brute(rows):
    per_doc = []
    for tokens in _tokens([t for _, t in rows]):
        groups, links = [], Counter()
        if tokens:
            ends = [set(np.cumsum([len(x) for x in side[1]]).tolist()) for side in tokens]
            split = []
            for ids, raw in tokens:
                at, cut = 0, [[]]
                for i, x in zip(ids, raw):
                    cut[-1].append(i)
                    at += len(x)
                    if at in ends[0] & ends[1]:
                        cut.append([])
                split.append(cut[:-1])
            groups = list(zip(*split))
            for a, b in groups:
                links.update((x, y) for x in a for y in b)
        per_doc.append((tokens, groups, links))
    count = Counter(p for _, _, links in per_doc for p in links)
    high = defaultdict(int)
    for (a, _), c in count.items():
        high[a] = max(high[a], c)
    out = []
    for (i, _), (tokens, groups, links) in zip(rows, per_doc):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((i, len(tokens[0][0]) if tokens else 0, len(tokens[1][0]) if tokens else 0, len(groups), sum(links.values()),
                    sum(n for p, n in links.items() if count[p] == high[p[0]]), sum(n * count[p] for p, n in links.items()),
                    hashlib.sha256(text.encode()).hexdigest() if tokens else ""))
    return Counter(out)


@pytest.mark.parametrize("chunk", [T.CHUNK, 300])
def test_alignment_equals_shared_offsets(spark, texts, chunk):
    rows = list(enumerate(texts)) + [(7, "another text of id 7"), (None, "no id"), (None, "no id")]
    docs = spark.createDataFrame([(i, t, 1, "x", [1]) for i, t in rows], "doc_id long, text string, chunk int, sha string, pairs array<int>")
    got = T.align(docs.repartition(3), chunk_bytes=chunk).collect()
    assert Counter(tuple(r) for r in got) == brute(rows)


def test_alignment_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert T.align(docs).collect() == []
    assert [tuple(r) for r in T.align(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_no_row_holds_a_chunk_of_documents(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(1)
    rows = T.encoded(docs, T.FOLDER, T.A_FILE, T.B_FILE, T.CHUNK).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(range(len(texts)))
    assert all(len(set(r["which"])) == len(r["which"]) == len(r["links"]) for r in rows)
    pairs = [r["pairs"] for r in rows if r["pairs"]]
    assert len(pairs) == len({r["chunk"] for r in rows}) == 1
    assert Counter(k for r in rows for k in r["which"]) == Counter(dict(enumerate(next(r["holders"] for r in rows if r["pairs"]))))
    plan = T.align(docs)._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "collect_list" not in plan


def test_labels_of_random_tilings():
    rng = np.random.default_rng(9)
    for size, share in ((1, 1.0), (50, 0.5), (4000, 0.02), (4000, 0.9)):
        ends = [np.unique(np.append(np.flatnonzero(rng.random(size) < share) + 1, size)) for _ in range(2)]
        both = np.intersect1d(*ends)
        for e, got in zip(ends, T.component_labels(*ends)):
            assert (got == np.searchsorted(both, e)).all()


def test_both_encoders_of_the_byte_vocabulary_agree(texts):
    encode, _ = T.byte_bpe(f"{T.FOLDER}/{T.A_FILE}")
    whole = Tokenizer.from_file(f"{T.FOLDER}/{T.A_FILE}")
    whole.encode_special_tokens = True
    # every code point beside a letter, a digit, a space and itself, so that the classes of the splitting rule show
    points = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x11000), *range(0x1F000, 0x20000)]]
    some = [f"a{c}b 1{c} {c}, {c}{c}\n{c}  {c}" for c in points] + [t for t in texts if t]
    want = [e.ids for e in whole.encode_batch(some, add_special_tokens=False)]
    assert encode(some) == want
