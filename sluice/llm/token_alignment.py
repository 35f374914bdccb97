"""Cross-tokenizer alignment by pointer jumping: groups of tokens that end together, and how often ids are linked.

1. *Encoding*: every text is encoded once by both tokenizers; a text whose token bytes are not space + text has no tokens.
2. *Pointer jumping*: the tokens of a chunk of documents lie on one byte line.  Every token points to its farthest-right
   overlapping token (the last one of the other tokenizer, or itself where both end).  Doubling the successors of all
   tokens at once converges to the terminal token of each component, which labels its group; the end of a document ends a group too.
3. *Counts*: chunks send each distinct id pair once, with the number of their documents that hold it.  Sums give the corpus-wide
   counts and each A id's highest, and go back to the chunks that hold the pair.  No table of pairs is broadcast, and a frequent pair is
   one row per chunk, not per document.  Documents and answers travel as rows of their own and meet one chunk at a time, so no
   row and no batch of the last step grows with the partition.

Pairs inside a group are formed of its distinct ids with their multiplicities, not of token occurrences.

Defined cases: null and empty texts, and texts that do not round-trip, have no tokens: zeros and an empty ``groups_sha256``; repeated rows
and repeated or null doc_ids are documents of their own; further columns are not read; an empty table gives an empty result.
The tokenizers' folder is a parameter and has to exist on every executor.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

FOLDER, A_FILE, B_FILE = "/opt/tokenizers", "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK = 2 << 20  # bytes of text whose pairs are sent as one; a longer text is a chunk of its own
BLOCK = 1 << 19  # bytes of text aligned at once
# fixed value: the splitting rule of byte-level BPE vocabularies
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# -- tokenizers --------------------------------------------------------------------
def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies print for each byte: itself if visible, else the next one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


@functools.lru_cache(maxsize=2)
def byte_bpe(path: str) -> tuple[Callable[[list[str]], list[list[int]]], tuple[bytes, ...]]:
    """Encoder without special tokens, and the bytes of every id, of a byte-level BPE file."""
    with open(path, encoding="utf-8") as fh:
        model = json.load(fh)["model"]
    letters = _byte_letters()
    table = [b""] * (max(model["vocab"].values()) + 1)
    for token, i in model["vocab"].items():
        if all(c in letters for c in token):
            table[i] = bytes(letters[c] for c in token)

    @functools.cache
    def whole():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        slower = Tokenizer.from_file(path)
        slower.encode_special_tokens = True
        return slower

    def plain(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in whole().encode_batch_fast(texts, add_special_tokens=False)]

    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    if any(model["vocab"][m] != 256 + k for k, m in enumerate(merged)):
        return plain, tuple(table)
    # ids follow the merge order, so they are ranks: the faster library gives the same ids
    import tiktoken

    ranks = {table[i]: i for i in range(256 + len(merged))}
    fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(texts: list[str]) -> list[list[int]]:
        # its expression engine gives up on very long runs, the other library does not
        return [fast.encode_ordinary(t) if len(t) < 1 << 18 else plain([t])[0] for t in texts]

    return encode, tuple(table)


@functools.lru_cache(maxsize=2)
def piece_bpe(path: str) -> tuple[Callable[[list[str]], list[list[int]]], tuple[bytes, ...]]:
    """The same of a sentencepiece model, which puts the space before a text itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    table = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        table.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return lambda texts: model.encode(texts, num_threads=1), tuple(table)


@functools.lru_cache(maxsize=4)
def _lengths(table: tuple[bytes, ...]) -> np.ndarray:
    return np.array([len(x) for x in table], np.int64)


@functools.lru_cache(maxsize=2)
def _id_texts(size: int) -> list[str]:
    """Every id with the separator that follows it: ``,`` (inside a side), ``|`` (after A) or ``;`` (after a group)."""
    return [f"{i}{s}" for i in range(size) for s in ",|;"]


# -- alignment ----------------------------------------------------------------------
def component_labels(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of every A and B token, from their (rising) end offsets; both cover the same bytes."""
    a, b = len(end_a), len(end_b)
    last_b, last_a = np.searchsorted(end_b, end_a), np.searchsorted(end_a, end_b)  # farthest-right token that overlaps
    terminal = end_a[last_a] == end_b
    successor = np.concatenate((a + last_b, np.where(terminal, a + np.arange(b), last_a)))
    while True:
        jumped = successor[successor]
        if np.array_equal(jumped, successor):
            break
        successor = jumped
    number = np.cumsum(terminal) - 1
    label = number[successor - a]
    return label[:a], label[a:]


def _counted(label: np.ndarray, ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, id and multiplicity of the distinct ids of every group."""
    key, n = np.unique(label * size + ids, return_counts=True)
    return key // size, key % size, n


def _linked(label_a, ids_a, label_b, ids_b, groups: int, size: int):
    """Group, packed id pair and number of links of the distinct pairs of every group."""
    ga, a, ca = _counted(label_a, ids_a, size)
    gb, b, cb = _counted(label_b, ids_b, size)
    first, many = np.searchsorted(gb, np.arange(groups)), np.bincount(gb, minlength=groups)
    reps = many[ga]
    left = np.repeat(np.arange(len(ga)), reps)
    right = first[ga][left] + np.arange(len(left)) - np.repeat(np.cumsum(reps) - reps, reps)
    return ga[left], a[left] << 32 | b[right], ca[left] * cb[right]


_CELLS = {"n_a": "int", "n_b": "int", "n_groups": "int", "n_links": "bigint", "sha": "string"}
_ARRAYS = {"which": "int", "links": "bigint", "pairs": "bigint", "holders": "int"}
_PA = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
_CODED = pa.schema([("chunk", pa.int64()), ("doc_id", pa.int64())] + [(k, _PA[t]) for k, t in _CELLS.items()] + [(k, pa.list_(_PA[t])) for k, t in _ARRAYS.items()])
_CODED_DDL = "chunk long, doc_id long, " + ", ".join([f"{k} {t}" for k, t in _CELLS.items()] + [f"{k} array<{t}>" for k, t in _ARRAYS.items()])


def align_texts(texts: list[str | None], tok_a, tok_b) -> dict[str, np.ndarray | list]:
    """Per text: token, group and link counts, hash of the groups, and its distinct packed pairs with their links (``sizes`` of them)."""
    (encode_a, bytes_a), (encode_b, bytes_b) = tok_a, tok_b
    full = [i for i, t in enumerate(texts) if t]
    ids_a, ids_b, n = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.zeros((2, len(texts)), np.int64)
    some_a, some_b = (encode_a([" " + texts[i] for i in full]), encode_b([texts[i] for i in full])) if full else ((), ())
    for i, a, b in zip(full, some_a, some_b):
        raw = b" " + texts[i].encode()
        if b"".join(map(bytes_a.__getitem__, a)) == raw and b"".join(map(bytes_b.__getitem__, b)) == raw:
            n[:, i] = len(a), len(b)
            ids_a.append(np.array(a, np.int64))
            ids_b.append(np.array(b, np.int64))
    ids_a, ids_b = np.concatenate(ids_a), np.concatenate(ids_b)
    out = {"n_a": n[0], "n_b": n[1], "sha": [""] * len(texts)}
    size = max(len(bytes_a), len(bytes_b))
    length_a, length_b = _lengths(bytes_a), _lengths(bytes_b)
    label_a, label_b = component_labels(np.cumsum(length_a[ids_a]), np.cumsum(length_b[ids_b])) if len(ids_a) else (ids_a, ids_b)
    groups = int(label_a[-1]) + 1 if len(ids_a) else 0
    many_a, many_b = np.bincount(label_a, minlength=groups), np.bincount(label_b, minlength=groups)
    cut_a, cut_b = (np.concatenate(([0], np.cumsum(x))) for x in n)
    last = np.concatenate((label_a, [groups]))[cut_a]  # first group of every text
    links_before = np.concatenate(([0], np.cumsum(many_a * many_b)))
    out["n_groups"], out["n_links"] = np.diff(last), np.diff(links_before[last])

    # ids in printing order: A before B inside a group
    code = np.empty(len(ids_a) + len(ids_b), np.int64)
    end_of_a, end_of_b = (np.concatenate((x[1:] != x[:-1], [True])) if len(x) else np.zeros(0, bool) for x in (label_a, label_b))
    code[np.arange(len(ids_a)) + np.concatenate(([0], np.cumsum(many_b)))[label_a]] = ids_a * 3 + end_of_a
    code[np.arange(len(ids_b)) + np.cumsum(many_a)[label_b]] = ids_b * 3 + 2 * end_of_b
    names, cut = _id_texts(size), cut_a + cut_b
    for i in np.flatnonzero(n[0]).tolist():
        printed = "".join(map(names.__getitem__, code[cut[i] : cut[i + 1]].tolist()))
        out["sha"][i] = hashlib.sha256(printed[:-1].encode()).hexdigest()

    group, pair, links = _linked(label_a, ids_a, label_b, ids_b, groups, size)
    text = np.searchsorted(last, group, "right") - 1
    order = np.lexsort((pair, text))
    pair, text = pair[order], text[order]
    new = np.flatnonzero(np.concatenate(([True], (pair[1:] != pair[:-1]) | (text[1:] != text[:-1])))) if len(pair) else order
    out["pair"], out["sizes"] = pair[new], np.bincount(text[new], minlength=len(texts))
    out["links"] = np.add.reduceat(links[order], new) if len(new) else links
    return out


def _chunk(texts: list[str | None], bounds: np.ndarray, tok_a, tok_b) -> dict[str, np.ndarray | list]:
    """The texts of a chunk, aligned in blocks; ``which`` points into ``pairs``, the chunk's distinct pairs, and ``holders`` counts the texts with each."""
    blocks = [align_texts(texts[i:j], tok_a, tok_b) for i, j in C.row_chunks(bounds, BLOCK)]
    out = {k: np.concatenate([b[k] for b in blocks]) for k in blocks[0] if k != "sha"}
    out["sha"] = [x for b in blocks for x in b["sha"]]
    out["pairs"], out["which"] = np.unique(out.pop("pair"), return_inverse=True)
    out["holders"] = np.bincount(out["which"], minlength=len(out["pairs"]))
    return out


def encoded(docs: DataFrame, folder: str, a_file: str, b_file: str, chunk_bytes: int) -> DataFrame:
    """One row per document, see :func:`_chunk`; the first one of a chunk has the chunk's ``pairs`` and ``holders``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok_a, tok_b = byte_bpe(f"{folder}/{a_file}"), piece_bpe(f"{folder}/{b_file}")
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            _, bounds, _ = C.text_bytes(b.column("text"))
            for i, j in C.row_chunks(bounds, chunk_bytes):
                got = _chunk(b.column("text").slice(i, j - i).to_pylist(), bounds[i : j + 1] - bounds[i], tok_a, tok_b)
                own, first = np.concatenate(([0], np.cumsum(got["sizes"]))), np.full(j - i + 1, len(got["pairs"]))
                first[0] = 0
                cuts = {"which": own, "links": own, "pairs": first, "holders": first}
                lists = [pa.ListArray.from_arrays(pa.array(cuts[k], pa.int32()), pa.array(got[k], _PA[t])) for k, t in _ARRAYS.items()]
                yield C.batch(_CODED, np.full(j - i, number), b.column("doc_id").slice(i, j - i), *[got[k] for k in _CELLS], *lists)
                number += 1

    return docs.mapInArrow(run, _CODED_DDL)


_OUT = pa.schema([("doc_id", pa.int64())] + [(k, pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] + [("groups_sha256", pa.string())])


def align(documents: DataFrame, folder: str = FOLDER, a_file: str = A_FILE, b_file: str = B_FILE, chunk_bytes: int = CHUNK) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document."""
    docs = documents.select(F.col("doc_id").cast("long"), "text")
    coded = C.cut(encoded(docs, folder, a_file, b_file, chunk_bytes), "align-chunks")
    uses = coded.select("chunk", F.posexplode(F.arrays_zip("pairs", "holders")).alias("k", "p")).select("chunk", "k", "p.pairs", "p.holders")
    counts = uses.groupBy("pairs").agg(F.sum("holders").alias("count"))
    a_id = F.shiftright("pairs", 32)
    highest = counts.groupBy(a_id.alias("a")).agg(F.max("count").alias("highest"))
    ranked = C.cut(counts.join(highest, a_id == F.col("a")).select("pairs", "count", (F.col("count") == F.col("highest")).alias("best")), "align-counts")
    answers = uses.select(F.col("chunk").alias("of"), "k", "pairs").join(ranked, "pairs").select("of", "k", "count", "best")

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        k = found["k"].to_numpy()
        count, best = np.empty(len(k), np.int64), np.empty(len(k), bool)
        count[k], best[k] = found["count"].to_numpy(), found["best"].to_numpy()
        which, links = (rows[c].combine_chunks() for c in ("which", "links"))
        cuts = np.concatenate(([0], np.cumsum(which.value_lengths().to_numpy())))
        which, links = which.flatten().to_numpy(), links.flatten().to_numpy()
        sums = [np.diff(np.concatenate(([0], np.cumsum(x)))[cuts]) for x in (links * best[which], links * count[which])]
        return pa.table([rows["doc_id"], *[rows[c].cast(pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")], *sums, rows["sha"]], schema=_OUT)

    needed = coded.select("chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "sha", "which", "links")
    return needed.groupBy("chunk").cogroup(answers.groupBy("of")).applyInArrow(run, _OUT_DDL)


_OUT_DDL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def op13_token_alignment(spark, sf_dir: str) -> DataFrame:
    return align(C.table(spark, sf_dir, "documents"))
