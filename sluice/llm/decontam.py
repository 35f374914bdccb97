"""Benchmark decontamination: one Aho-Corasick automaton over the benchmark's normalised word windows.

Text and items are normalised alike (A-Z lower-cased, runs of other ASCII than letters and digits become one space).
The windows of all items (``window`` consecutive words; a shorter item is one window) form the automaton; each text is
scanned once and hits are mapped back to word numbers and byte offsets of the original.

The benchmark is a stated, small side: its windows are collected in blocks of at most ``block_bytes`` and broadcast.
A larger benchmark gives several automata and one pass over the documents for each; nothing is cut off.

Defined cases: null and empty texts have no words; an item without words, or without an id, takes no part; an item id
counts once even if its row repeats; repeated documents are each reported; further columns are not read; an empty
documents table gives an empty result, an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

WINDOW, BLOCK_BYTES = 10, 64 << 20
WORD = C.byte_table((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
_SCAN = "doc_id long, n_words long, hits array<int>, items array<string>, spans array<struct<start:int,end:int>>"


def words_of(text: str) -> list[str]:
    """Normalised words, each as one latin-1 character per UTF-8 byte."""
    raw = C.LOWER[np.frombuffer(text.encode(), np.uint8)]
    return np.where(WORD[raw], raw, 32).astype(np.uint8).tobytes().decode("latin-1").split(" ")


def item_windows(text: str, window: int) -> list[str]:
    words = [w for w in words_of(text) if w]
    if not words:
        return []
    return [f" {' '.join(words[i : i + window])} " for i in range(max(1, len(words) - window + 1))]


def pattern_blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[dict[str, list[str]]]:
    """Windows and the items that hold them, in blocks of bounded size."""
    block: dict[str, list[str]] = defaultdict(list)
    size = 0
    items = benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("string").alias("i"), "text")
    for row in items.toLocalIterator():
        for w in set(item_windows(row.text, window)):
            block[w].append(row.i)
            size += len(w) + len(row.i)
        if size > block_bytes:
            yield dict(block)
            block, size = defaultdict(list), 0
    if block:
        yield dict(block)


def _automaton(patterns: dict[str, list[str]]):
    import ahocorasick

    a = ahocorasick.Automaton()
    for p, items in patterns.items():
        a.add_word(p, (len(p), p.count(" ") - 1, items))
    a.make_automaton()
    return a


def _scan(patterns, keep_rows: bool = False):
    """Word hits of every document (a struct ``row``) against one broadcast block of patterns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _automaton(patterns.value) if patterns.value else None
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("hits", pa.list_(pa.int32())), ("items", pa.list_(pa.string())),
                            ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
        for b in batches:
            row = b.column("row")
            data, bounds, _ = C.text_bytes(row.field("text"))
            n_words, hits, items, spans = [], [], [], []
            for i, j in C.row_chunks(bounds):
                raw = C.LOWER[data[bounds[i] : bounds[j]]]
                part = bounds[i : j + 1] - bounds[i]
                starts, ends, words = C.word_spans(raw, part, WORD)
                is_word = WORD[raw]
                length = ends - starts
                new_end = np.cumsum(length + 1)  # each word is followed by one space
                out = np.full(int(new_end[-1]) if len(new_end) else 0, 32, np.uint8)
                if len(out):
                    place = np.ones(len(out), bool)
                    place[new_end - 1] = False
                    out[place] = raw[is_word]
                flat = out.tobytes().decode("latin-1")
                for d in range(j - i):
                    a, z = words[d], words[d + 1]
                    n_words.append(z - a)
                    hit, got = None, set()
                    if found is not None and z > a:
                        low, high = int(new_end[a - 1]) if a else 0, int(new_end[z - 1])
                        for at, (size, count, ids) in found.iter(" " + flat[low:high]):
                            last = int(np.searchsorted(new_end, low + at))  # the pattern ends with the space after this word
                            hit = np.zeros(z - a + 1, np.int32) if hit is None else hit
                            hit[last - a - count + 1] += 1
                            hit[last - a + 1] -= 1
                            got.update(ids)
                    at = np.flatnonzero(np.cumsum(hit)) if hit is not None else np.zeros(0, np.int64)
                    hits.append(at)
                    items.append(sorted(got))
                    new = np.flatnonzero(np.diff(at, prepend=-2) > 1)
                    stop = np.append(new[1:], len(at))[: len(new)]
                    spans.append([{"start": int(starts[a + at[p]] - part[d]), "end": int(ends[a + at[q - 1]] - part[d])} for p, q in zip(new, stop)])
            got = C.batch(schema, row.field("doc_id").cast(pa.int64()), n_words, hits, items, spans)
            yield pa.RecordBatch.from_arrays([*got.columns, row], names=[*schema.names, "row"]) if keep_rows else got

    return run


def scan_documents(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
                   keep_rows: bool = False) -> DataFrame:
    """``doc_id, n_words, hits`` (word numbers), ``items`` (ids, sorted), ``spans`` (byte offsets in the text) of each document.

    With ``keep_rows`` also all input columns, as the struct ``row``.
    """
    sc = documents.sparkSession.sparkContext
    rows = documents.select(F.struct("*").alias("row")) if keep_rows else documents.select(F.struct("doc_id", "text").alias("row"))
    blocks = list(pattern_blocks(benchmark, window, block_bytes)) or [{}]
    if len(blocks) == 1:
        out = T.StructType(T.StructType.fromDDL(_SCAN).fields + rows.schema.fields * keep_rows)
        return rows.mapInArrow(_scan(sc.broadcast(blocks[0]), keep_rows), out)
    # several automata: scan once for each, then put the findings of a row together
    numbered = C.cut(rows.withColumn("number", F.monotonically_increasing_id()), "decontam-rows")
    texts = numbered.select(F.struct(F.col("number").alias("doc_id"), F.col("row.text").alias("text")).alias("row"))
    one = None
    for block in blocks:
        part = texts.mapInArrow(_scan(sc.broadcast(block)), _SCAN)
        one = part if one is None else one.unionByName(part)
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    merged = one.groupBy("doc_id").agg(F.max("n_words").alias("n_words"), union("hits").alias("hits"), union("items").alias("items"),
                                       union("spans").alias("spans")).withColumnRenamed("doc_id", "number")
    found = numbered.join(merged, "number").withColumn("doc_id", F.col("row.doc_id").cast("long"))
    return found.select("doc_id", "n_words", "hits", "items", "spans", *["row"] * keep_rows)


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    found = scan_documents(documents, benchmark, window, block_bytes)
    return found.select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    return contamination(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))


SQL = rf"""
WITH words AS (
  SELECT kind, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark)),
items AS (
  SELECT id, least(len(w), {WINDOW}) AS n, unnest(range(1, greatest(len(w) - {WINDOW - 2}, 2))) AS i, w
  FROM words WHERE kind = 'b' AND len(w) > 0 AND id IS NOT NULL),
pat AS (SELECT DISTINCT id AS item, n, array_to_string(w[i : i + n - 1], ' ') AS s FROM items),
doc AS (SELECT d.id, p.n, unnest(range(1, len(d.w) - p.n + 2)) AS i, d.w
        FROM words d, (SELECT DISTINCT n FROM pat) p WHERE kind = 'd' AND len(d.w) >= p.n),
occ AS (SELECT doc.id, doc.i, doc.n, pat.item
        FROM (SELECT id, i, n, array_to_string(w[i : i + n - 1], ' ') AS s FROM doc) doc JOIN pat USING (n, s)),
hit AS (SELECT id, count(DISTINCT k) AS n_hit FROM (SELECT id, unnest(range(i, i + n)) AS k FROM occ) GROUP BY id),
got AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS l
        FROM (SELECT DISTINCT id, CAST(item AS VARCHAR) AS item FROM occ) GROUP BY id)
SELECT id AS doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM (SELECT * FROM words WHERE kind = 'd') LEFT JOIN hit USING (id) LEFT JOIN got USING (id)
"""
