"""Line dedup: two Bloom filters find suspected repeats, only these shuffle.

1. *Keys*: each document's distinct line keys of ``LEAST`` code points or more, as 128-bit hashes, written once.
2. *Filters*: a blocked Bloom filter (64-bit words, ``PROBES`` bits of one word per key, ``BITS`` bits per key, so its
   size follows the measured number of keys) for keys seen once and one for keys seen twice.  Pieces of documents send
   four bytes per key to the segment of the filter it falls into; folding a piece in carries every bit that was set
   before into the second filter.  A key of two documents has all its bits there, so none is missed.
3. *Suspects*: the keys whose bits are all set in the second filter.  Up to ``FILTER_BYTES`` it is sent to the tasks,
   beyond it stays a table of words that the keys are joined with.  The suspects are the same.
4. *Confirmation*: suspects are counted by their 128 bits, and the smallest doc_id of each repeated key keeps its lines.

Defined cases: null and empty texts are one empty line; rows with one doc_id (null included) count as one document,
null ordered last; repeated rows therefore keep or lose the same lines; further columns are not read; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

LEAST = 10  # code points of a key that may be dropped
BITS, PROBES = 10, 3
SEGMENT = 1 << 12  # words of a segment: what a task folds at once (two filters of 32 KB)
FILTER_BYTES = 64 << 20  # the second filter is sent to the tasks up to this size
_SEEDS = (C.BASES[0], C.BASES[1])
_LONGS = pa.list_(pa.int64())
_KEYS = pa.schema([("doc_id", pa.int64()), ("tkey", pa.int64()), ("h1", _LONGS), ("h2", _LONGS)])
_PIECE = pa.schema([("seg", pa.int64()), ("keys", pa.binary())])
_WORDS = pa.schema([("seg", pa.int64()), ("at", pa.binary()), ("bits", pa.binary())])
_SUSPECT = pa.schema([("doc_id", pa.int64()), ("tkey", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())])


# -- lines ------------------------------------------------------------------------
def lines(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of the stripped lines, and the line bounds of the rows (each row has a line)."""
    breaks = np.flatnonzero(data == 10)
    row = np.searchsorted(bounds, breaks, "right") - 1
    counts = np.bincount(row, minlength=len(bounds) - 1) + 1
    offs = np.concatenate(([0], np.cumsum(counts)))
    before = np.arange(len(breaks)) + row  # the line that a break ends
    starts, ends = np.empty(offs[-1], np.int64), np.empty(offs[-1], np.int64)
    starts[offs[:-1]], ends[offs[1:] - 1] = bounds[:-1], bounds[1:]
    starts[before + 1], ends[before] = breaks + 1, breaks
    solid = np.flatnonzero(C.NOT_SPACE[data])
    first, last = np.searchsorted(solid, starts), np.searchsorted(solid, ends) - 1
    some = first <= last
    ends = ends.copy()
    starts[some], ends[some] = solid[first[some]], solid[last[some]] + 1
    ends[~some] = starts[~some]
    return starts, ends, offs


def line_keys(data: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes per line, whether its key is long enough, and the line bounds of the rows."""
    starts, ends, offs = lines(data, bounds)
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    lower = C.LOWER[data]
    return C.word_hashes(lower, starts, ends, _SEEDS[0]), C.word_hashes(lower, starts, ends, _SEEDS[1]), points[ends] - points[starts] >= least, offs


def key_table(docs: DataFrame, least: int) -> DataFrame:
    """``doc_id, tkey, h1, h2``: the distinct keys of every document that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, bounds, _ = C.text_bytes(b.column("text"))
            for i, j in C.row_chunks(bounds):
                a, z, ok, offs = line_keys(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i], least)
                row = np.repeat(np.arange(j - i), np.diff(offs))[ok]
                a, z = a[ok], z[ok]
                order = np.lexsort((z, a, row))
                row, a, z = row[order], a[order], z[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (a[1:] != a[:-1]) | (z[1:] != z[:-1])
                row, a, z = row[new], a[new], z[new]
                rows, at = np.unique(row, return_index=True)
                cuts = pa.array(np.append(at, len(row)), pa.int32())
                yield C.batch(_KEYS, b.column("doc_id").take(pa.array(rows + i)), b.column("tkey").take(pa.array(rows + i)),
                              pa.ListArray.from_arrays(cuts, pa.array(C.signed(a))), pa.ListArray.from_arrays(cuts, pa.array(C.signed(z))))

    return docs.mapInArrow(run, "doc_id long, tkey long, h1 array<long>, h2 array<long>")


# -- filters ------------------------------------------------------------------------
def _flat(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h1, h2 = b.column("h1"), b.column("h2")
    return np.asarray(h1.flatten()), np.asarray(h2.flatten()), np.asarray(h1.value_lengths())


def _masks(codes: np.ndarray) -> np.ndarray:
    """The ``PROBES`` bits (six binary digits each) that a key sets in its word."""
    codes, out = codes.astype(np.uint64), np.zeros(len(codes), np.uint64)
    for k in range(PROBES):
        out |= np.uint64(1) << ((codes >> np.uint64(6 * k)) & np.uint64(63))
    return out


_CODE = (1 << (6 * PROBES)) - 1  # low digits of h2: the bits of a key
_PLACE = 6 * PROBES  # a key in a piece: repeated (1 bit), word in the segment (12), bits (18)


def pieces(keys: DataFrame, words: int) -> DataFrame:
    """``seg, keys``: the keys of some documents that fall into a segment, four bytes each, marked if two documents have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h1, h2, _ = _flat(b)
            if not len(h1):
                continue
            order = np.lexsort((h2, h1))
            h1, h2 = h1[order], h2[order]
            new = np.flatnonzero(np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))))
            twice = np.diff(np.append(new, len(h1))) > 1
            word = h1[new] % words
            packed = (twice.astype(np.uint32) << 31) | ((word % SEGMENT).astype(np.uint32) << _PLACE) | (h2[new] & _CODE).astype(np.uint32)
            order = np.argsort(word, kind="stable")
            packed, seg = packed[order], word[order] // SEGMENT
            cuts = np.append(np.flatnonzero(np.concatenate(([True], seg[1:] != seg[:-1]))), len(seg))
            yield C.batch(_PIECE, seg[cuts[:-1]], [packed[i:j].tobytes() for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist())])

    return keys.mapInArrow(run, "seg long, keys binary")


def fold(once: np.ndarray, twice: np.ndarray, keys: np.ndarray) -> None:
    """Put a piece's keys into the filters of its segment; bits that were set before carry into ``twice``."""
    keys = keys[np.argsort(keys & np.uint32(0x7FFFFFFF), kind="stable")]
    place, mask = (keys >> np.uint32(_PLACE)) & np.uint32(SEGMENT - 1), _masks(keys & np.uint32(_CODE))
    repeated = np.where(keys >> np.uint32(31), mask, np.uint64(0))
    new = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    at, mask, repeated = place[new], np.bitwise_or.reduceat(mask, new), np.bitwise_or.reduceat(repeated, new)
    twice[at] |= (once[at] & mask) | repeated
    once[at] |= mask


def twice_filter(keys: DataFrame, words: int) -> DataFrame:
    """``seg, at, bits``: the words of the second filter that are not zero, by segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, once, twice = None, np.zeros(SEGMENT, np.uint64), np.zeros(SEGMENT, np.uint64)

        def done() -> Iterator[pa.RecordBatch]:
            at = np.flatnonzero(twice)
            if now is not None and len(at):
                yield C.batch(_WORDS, [now], [at.astype(np.uint16).tobytes()], [twice[at].tobytes()])

        for b in batches:
            for seg, raw in zip(b.column("seg").to_pylist(), b.column("keys")):
                if seg != now:
                    yield from done()
                    now = seg
                    once[:], twice[:] = 0, 0
                fold(once, twice, np.frombuffer(raw.as_buffer(), np.uint32))
        yield from done()

    dealt = pieces(keys, words).repartition("seg").sortWithinPartitions("seg")
    return dealt.mapInArrow(run, "seg long, at binary, bits binary")


# -- suspects and confirmation --------------------------------------------------------
def _probed(keys: DataFrame, words: int, filter_table: DataFrame) -> DataFrame:
    """Suspects by the filter itself, at most ``FILTER_BYTES`` (checked by the caller)."""
    bits = np.zeros(words, np.uint64)
    for r in filter_table.toLocalIterator():
        bits[r.seg * SEGMENT + np.frombuffer(bytes(r.at), np.uint16).astype(np.int64)] = np.frombuffer(bytes(r.bits), np.uint64)
    sent = keys.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for b in batches:
            h1, h2, size = _flat(b)
            mask = _masks(h2 & _CODE)
            found = np.flatnonzero(bits[h1 % words] & mask == mask)
            row = pa.array(np.repeat(np.arange(b.num_rows), size)[found])
            yield C.batch(_SUSPECT, b.column("doc_id").take(row), b.column("tkey").take(row), h1[found], h2[found])

    return keys.mapInArrow(run, "doc_id long, tkey long, h1 long, h2 long")


def _joined(keys: DataFrame, words: int, filter_table: DataFrame) -> DataFrame:
    """The same suspects by a join with the filter's words, whatever its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([("word", pa.int64()), ("bits", pa.int64())])
        for b in batches:
            for seg, at, bits in zip(b.column("seg").to_pylist(), b.column("at"), b.column("bits")):
                place = np.frombuffer(at.as_buffer(), np.uint16).astype(np.int64)
                yield C.batch(out, seg * SEGMENT + place, np.frombuffer(bits.as_buffer(), np.int64))

    table = filter_table.mapInArrow(run, "word long, bits long")
    one = keys.select("doc_id", "tkey", F.explode(F.arrays_zip("h1", "h2")).alias("k")).select("doc_id", "tkey", "k.h1", "k.h2")
    mask = F.lit(0).cast("long")
    for k in range(PROBES):
        digit = F.shiftright("h2", 6 * k).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), digit))
    marked = one.withColumn("word", F.pmod("h1", F.lit(words))).withColumn("mask", mask)
    return marked.join(table, "word").filter(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")).select("doc_id", "tkey", "h1", "h2")


def suspects(keys: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``doc_id, tkey, h1, h2`` of every key that two documents may have."""
    count = keys.agg(F.sum(F.size("h1").cast("long"))).first()[0] or 0
    segments = max(1, -(-count * BITS // (64 * SEGMENT)))
    words = segments * SEGMENT
    found = C.cut(twice_filter(keys, words), "lines-filter")
    return (_probed if 8 * words <= filter_bytes else _joined)(keys, words, found)


def _lost_lines(data: np.ndarray, bounds: np.ndarray, least: int, size: np.ndarray, gone: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Whether each line's key is among those (``size`` of ``gone`` per row) that its row loses, and the line bounds of the rows."""
    a, z, ok, offs = line_keys(data, bounds, least)
    own, lost = (C.mix(np.repeat(np.arange(1, len(n) + 1), n).astype(np.uint64)) for n in (np.diff(offs), size))
    for mine, theirs in ((a, gone[0]), (z, gone[1])):  # keys are matched inside their row
        ok &= np.isin(C.mix(mine ^ own), C.mix(theirs ^ lost))
    return ok, offs


def dropped_keys(docs: DataFrame, least: int = LEAST, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``doc_id, tkey, keys``: the keys that lose their lines in that document."""
    keys = C.cut(key_table(docs, least), "lines-keys")
    rows = C.cut(suspects(keys, filter_bytes), "lines-suspects")
    owners = rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("greatest"), F.count_if(F.col("doc_id").isNull()).alias("nulls"))
    repeated = owners.filter("owner < greatest OR (owner IS NOT NULL AND nulls > 0)").select("h1", "h2", "owner")
    lost = rows.join(C.detached(repeated, "h1"), ["h1", "h2"]).filter(~F.col("doc_id").eqNullSafe(F.col("owner")))
    return lost.groupBy("doc_id", "tkey").agg(F.collect_set(F.struct("h1", "h2")).alias("keys"))


def dedup_lines(documents: DataFrame, least: int = LEAST, filter_bytes: int = FILTER_BYTES, keep_text: bool = False) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` (and ``kept``) of every document."""
    docs = C.keyed_documents(documents.select(F.col("doc_id").cast("long"), "text"))
    lost = dropped_keys(docs, least, filter_bytes)
    schema = "doc_id long, n_lines long, n_dropped long, kept_sha256 string" + (", kept string" if keep_text else "")
    out = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_sha256", pa.string())] + [("kept", pa.string())] * keep_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, bounds, _ = C.text_bytes(b.column("text"))
            keys = b.column("keys")
            size = np.asarray(keys.value_lengths().fill_null(0))
            flat = keys.flatten()
            gone = [np.asarray(flat.field(k)).view(np.uint64) for k in ("h1", "h2")]
            cuts = np.concatenate(([0], np.cumsum(size)))
            rows = []
            for i, j in C.row_chunks(bounds):
                drop, offs = _lost_lines(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i], least, size[i:j], [g[cuts[i] : cuts[j]] for g in gone])
                for r in range(i, j):
                    text = data[bounds[r] : bounds[r + 1]].tobytes()
                    n, drops = int(offs[r - i + 1] - offs[r - i]), 0
                    if size[r]:
                        mine = drop[offs[r - i] : offs[r - i + 1]]
                        drops = int(mine.sum())
                        text = b"\n".join(x for x, d in zip(text.split(b"\n"), mine.tolist()) if not d)
                    rows.append((n, drops, hashlib.sha256(text).hexdigest(), text.decode() if keep_text else None))
            cols = list(zip(*rows)) if rows else [()] * 4
            yield C.batch(out, b.column("doc_id"), *[list(c) for c in (cols if keep_text else cols[:3])])

    joined = docs.alias("d").join(lost.alias("s"), C.same_row("d", "s"), "left").select("d.doc_id", "d.text", "s.keys")
    return joined.mapInArrow(run, schema)


def op12_line_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_lines(C.table(spark, sf_dir, "documents"))


SQL = rf"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
owner AS (SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= {LEAST} GROUP BY k HAVING count(DISTINCT doc_id) > 1),
marked AS (SELECT doc_id, i, line, owner IS NOT NULL AND owner <> doc_id AS gone FROM keyed LEFT JOIN owner USING (k))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
