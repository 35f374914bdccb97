"""Winnowed anchors of all texts and the fragments they stand for.

Every run of ``window`` symbols (words or bytes) of a document picks one of its
``gram``-symbol pieces, the one with the least hash (leftmost on ties).  Equal
windows pick the same piece, so two windows can only be equal when their
anchors are.  The windows that share one anchor occurrence are consecutive:
they form a *fragment*, the anchor extended both ways as far as it stays the
least.  A row of :func:`fragments` is one fragment: anchor hash ``h``, content
hash ``seg`` (content and place of the anchor in it), row key, first window
``lo`` and number of windows ``n``.  About ``2 / (window - gram + 2)`` rows come
from a symbol.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

FRAGMENT = "h long, seg long, doc_id long, tkey long, lo int, n int"
_OUT = pa.schema([("h", pa.int64()), ("seg", pa.int64()), ("doc_id", pa.int64()), ("tkey", pa.int64()), ("lo", pa.int32()), ("n", pa.int32())])


def symbols(data: np.ndarray, bounds: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray | None, np.ndarray | None]:
    """Symbol hashes, row bounds in symbols, and byte spans of the symbols (None for bytes)."""
    if unit == "byte":
        return C.BYTE_CODES[data], bounds, None, None
    starts, ends, words = C.word_spans(data, bounds, C.NOT_SPACE)
    return C.word_hashes(data, starts, ends), words, starts, ends


def cut_fragments(x: np.ndarray, bounds: np.ndarray, window: int, gram: int):
    """Row, first window (in ``x``), windows, anchor hash and content hash of every fragment."""
    if len(x) < window:
        return None
    grams = C.rolling(x, gram)
    order = (grams >> np.uint64(32) << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64)
    anchor = C.sliding_min(order, window - gram + 1) & np.uint64(0xFFFFFFFF)
    inside = np.zeros(len(x) + 1, np.int32)
    full = np.diff(bounds) >= window
    np.add.at(inside, bounds[:-1][full], 1)
    np.add.at(inside, bounds[1:][full] - window + 1, -1)
    at = np.flatnonzero(np.cumsum(inside)[: len(anchor)])
    if not len(at):
        return None
    anchor = anchor[at].astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    lo, anchor = at[new], anchor[new]
    n = np.diff(np.append(new, len(at)))
    content = C.Prefix(x).slices(lo, lo + n - 1 + window)
    seg = C.mix(content + (anchor - lo).astype(np.uint64) * np.uint64(C.BASES[2]) + n.astype(np.uint64) * np.uint64(C.BASES[0]))
    row = np.searchsorted(bounds, lo, "right") - 1
    return row, lo, n, grams[anchor], seg


def fragments(docs: DataFrame, unit: str, window: int, gram: int) -> DataFrame:
    """All fragments of ``(doc_id, tkey, text)`` rows; null and short texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, bounds, _ = C.text_bytes(b.column("text"))
            ids, tkeys = b.column("doc_id"), b.column("tkey")
            for i, j in C.row_chunks(bounds):
                part = bounds[i : j + 1] - bounds[i]
                x, sym, _, _ = symbols(data[bounds[i] : bounds[j]], part, unit)
                found = cut_fragments(x, sym, window, gram)
                if found:
                    row, lo, n, h, seg = found
                    take = pa.array(row + i)
                    yield C.batch(_OUT, C.signed(h), C.signed(seg), ids.take(take), tkeys.take(take), (lo - sym[row]).astype(np.int32), n.astype(np.int32))

    return docs.mapInArrow(run, FRAGMENT)


def shared_fragments(docs: DataFrame, unit: str, window: int, gram: int, label: str) -> DataFrame:
    """Fragments whose anchor occurs at least twice, written once.

    Anchor counts are combined before their shuffle; the join back is a plain
    equi-join whose hot anchors AQE splits.
    """
    rows = fragments(docs, unit, window, gram)
    often = rows.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("h")
    return C.cut(rows.join(C.detached(often, "h"), "h"), label)


def by_document(spans: DataFrame, *fields: str) -> DataFrame:
    """One row per document key with the list of its spans (no longer than the document)."""
    return spans.groupBy("doc_id", "tkey").agg(F.collect_list(F.struct(*fields)).alias("spans"))


def span_columns(b: pa.RecordBatch, *fields: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """Offsets per row and the flattened fields of the ``spans`` column (null: none)."""
    spans = b.column("spans")
    size = np.asarray(spans.value_lengths().fill_null(0))
    flat = spans.flatten()
    return np.concatenate(([0], np.cumsum(size))), [np.asarray(flat.field(f)) for f in fields]


def covered(length: int, starts: np.ndarray, counts: np.ndarray, window: int) -> np.ndarray:
    """Mask of the symbols inside windows ``start .. start + count - 1``."""
    steps = np.zeros(length + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + counts - 1 + window, -1)
    return np.cumsum(steps[:-1]) > 0


def without(docs: DataFrame, spans: DataFrame, unit: str, window: int, keep_text: bool = False) -> DataFrame:
    """Every document with its covered symbols removed.

    ``n`` symbols, ``n_removed``, ``n_spans`` maximal removed runs and the hash of what is left: words joined by
    one space, or the remaining bytes (also as ``kept`` when asked for).
    """
    schema = "doc_id long, n long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if keep_text else "")
    out = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
                    + [("kept", pa.binary())] * keep_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, bounds, _ = C.text_bytes(b.column("text"))
            offs, (lo, n) = span_columns(b, "lo", "n")
            got: list[tuple] = []
            for i in range(b.num_rows):
                text = data[bounds[i] : bounds[i + 1]]
                s = slice(offs[i], offs[i + 1])
                if unit == "byte":
                    size = len(text)
                    gone = covered(size, lo[s], n[s], window)
                    kept = text[~gone].tobytes()
                else:
                    words = text.tobytes().split()  # bytes: exactly space and \x09-\x0D
                    size = len(words)
                    gone = covered(size, lo[s], n[s], window)
                    kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g) if gone.any() else b" ".join(words)
                runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if size else 0
                got.append((size, int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept))
            cols = list(zip(*got)) if got else [()] * 5
            yield C.batch(out, b.column("doc_id"), *[list(c) for c in (cols if keep_text else cols[:4])])

    joined = docs.alias("d").join(spans.alias("s"), C.same_row("d", "s"), "left").select("d.doc_id", "d.text", "s.spans")
    return joined.mapInArrow(run, schema)


