"""Substring dedup by seed and extend: remove every passage of ``window`` words that occurs twice anywhere.

1. *Seed*: winnowed anchors of all texts (``repeats.fragments``); documents are joined on the anchors that occur
   at least twice.
2. *Extend*: a fragment is an anchor extended both ways.  Fragments with equal content match in full, whatever
   their number, so a group of copies is settled by one map-side combined count.  Of fragments that share only the
   anchor, one representative per content is compared window by window (again a combined count, never a pair).
3. *Keep maximal repeats*: the matching windows of a document are merged into maximal runs and removed.

Equality is that of two independent 64-bit hashes (anchor, and content or window).

Defined cases: null and empty texts and texts of fewer than ``window`` words have no window and stay whole;
repeated rows are documents of their own, so their words go; repeated or null doc_ids are told apart by text;
further columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import repeats as R

WINDOW, GRAM = 35, 10
_WIN = pa.schema([("doc_id", pa.int64()), ("tkey", pa.int64()), ("h", pa.int64()), ("lo", pa.int32()), ("win", pa.int64())])


def window_hashes(docs: DataFrame, picked: DataFrame, window: int) -> DataFrame:
    """``(doc_id, tkey, h, lo, win)`` for each window of the picked fragments of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, bounds, _ = C.text_bytes(b.column("text"))
            offs, (lo, n, h) = R.span_columns(b, "lo", "n", "h")
            for i, j in C.row_chunks(bounds):
                x, sym, _, _ = R.symbols(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i], "word")
                hashes = C.rolling(x, window, C.BASES[2])
                s = slice(offs[i], offs[j])
                row = np.repeat(np.arange(i, j), np.diff(offs[i : j + 1]))
                each = np.repeat(np.arange(len(row)), n[s])
                step = np.arange(len(each)) - np.repeat(np.cumsum(n[s]) - n[s], n[s])
                start = lo[s][each] + step
                take = pa.array(row[each])
                yield C.batch(_WIN, b.column("doc_id").take(take), b.column("tkey").take(take), h[s][each], start.astype(np.int32),
                              C.signed(hashes[sym[row[each] - i] + start]))

    joined = docs.alias("d").join(R.by_document(picked, "lo", "n", "h").alias("s"), C.same_row("d", "s")).select("d.*", "s.spans")
    return joined.mapInArrow(run, "doc_id long, tkey long, h long, lo int, win long")


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``(doc_id, tkey, lo, n)``: the windows ``lo .. lo + n - 1`` (in words) of that row occur elsewhere too."""
    shared = R.shared_fragments(docs, "word", window, gram, "substring-shared")
    contents = C.cut(
        shared.groupBy("h", "seg").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "tkey", "lo", "n")).alias("at")),
        "substring-contents")
    copies = shared.join(contents.filter("copies > 1").select("h", "seg"), ["h", "seg"]).select("doc_id", "tkey", "lo", "n")
    mixed = contents.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("h")
    picked = contents.join(C.detached(mixed, "h"), "h").select("at.*", "h")
    windows = C.cut(window_hashes(docs, picked, window), "substring-windows")
    twice = windows.groupBy("h", "win").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("h", "win")
    single = windows.join(C.detached(twice, "win"), ["h", "win"]).select("doc_id", "tkey", "lo", F.lit(1).alias("n"))
    return copies.unionByName(single)


def remove_repeats(documents: DataFrame, window: int = WINDOW, gram: int = GRAM, keep_text: bool = False) -> DataFrame:
    """Every document without its repeated passages: ``doc_id, n_words, n_removed, n_spans, kept_sha256`` (and ``kept``)."""
    docs = C.keyed_documents(documents)
    spans = R.by_document(repeated_windows(docs, window, gram), "lo", "n")
    return R.without(docs, spans, "word", window, keep_text).withColumnRenamed("n", "n_words")


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(C.table(spark, sf_dir, "documents"))


SQL = rf"""
WITH words AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), CAST([] AS VARCHAR[])) AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + {WINDOW - 1}], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM words WHERE len(w) >= {WINDOW})),
hit AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS i
  FROM windows WHERE s IN (SELECT s FROM windows GROUP BY s HAVING count(*) > 1)),
gone AS (SELECT doc_id, list(i) AS l, count(*) AS n, count(*) FILTER (WHERE fresh) AS runs
  FROM (SELECT doc_id, i, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i) < i - 1, true) AS fresh FROM hit) GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words) ANTI JOIN hit USING (doc_id, i)
  GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(runs, 0) AS BIGINT) AS n_spans, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
