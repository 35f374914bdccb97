"""Shared helpers: lineage cuts, row keys and vectorised text hashing."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import new_scratch_dir
from sluice.sources.tables import delete_path

CHUNK = 1 << 20  # symbols hashed at once inside a task; a longer text is a chunk of its own
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# -- Spark side ------------------------------------------------------------------
def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Later stages restart from these files when executors are lost.  The shuffle
    files of the finished write are released at once.
    """
    spark = df.sparkSession
    path = new_scratch_dir(spark, label)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables of :func:`cut` that nothing reads any more."""
    for df in tables:
        if path := getattr(df, "scratch", None):
            delete_path(df.sparkSession, path)


def keyed_documents(docs: DataFrame) -> DataFrame:
    """``(doc_id, tkey, text)`` with a key per row: ``tkey`` is 0 unless doc_ids repeat or are null.

    Repeated ids are told apart by a hash of their text; rows that agree in both are exact repeats.
    """
    narrow = docs.select("doc_id", "text")
    counts = narrow.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    unique = counts.filter("n > 1").isEmpty()
    tkey = F.lit(0).cast("long") if unique else F.coalesce(F.xxhash64("text"), F.lit(0))
    return narrow.select("doc_id", tkey.alias("tkey"), "text")


def same_row(left: str, right: str):
    """Null-safe join condition on the row key of :func:`keyed_documents`."""
    return (F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id"))) & (F.col(f"{left}.tkey") == F.col(f"{right}.tkey"))


def detached(df: DataFrame, key: str) -> DataFrame:
    """``df`` with a long ``key`` that hides how ``df`` is partitioned.

    A join on the key of an aggregate would reuse the aggregate's exchange, and AQE only splits a hot key of a join
    whose two sides are exchanges of its own.
    """
    return df.select(*[F.bitwise_not(F.bitwise_not(F.col(c))).alias(c) if c == key else c for c in df.columns])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- task side: Arrow text as byte arrays ------------------------------------------
def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, row bounds ``(n + 1)``, and which rows are not null (null rows are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    valid = np.asarray(column.is_valid())
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64), valid
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    raw, bounds = raw[bounds[0] : bounds[-1]], bounds - bounds[0]
    if not valid.all() and (np.diff(bounds)[~valid] > 0).any():  # a null slot may keep bytes
        return text_bytes(column.fill_null(""))[:2] + (valid,)
    return raw, bounds, valid


def row_chunks(bounds: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (one row at least)."""
    at, rows = 0, len(bounds) - 1
    while at < rows:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
        yield at, to
        at = to


def byte_table(*ranges: tuple[int, int], inverted: bool = False) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return ~out if inverted else out


NOT_SPACE = byte_table((0x20, 0x20), (0x09, 0x0D), inverted=True)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # A-Z only


def word_spans(data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (bytes) of maximal word-byte runs inside rows, and the word bounds of the rows."""
    mask = is_word[data]
    first, last = mask.copy(), mask.copy()
    first[1:] &= ~mask[:-1]
    last[:-1] &= ~mask[1:]
    inner = bounds[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    first[inner] = mask[inner]
    last[inner - 1] = mask[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, bounds)


# -- hashing: words by chained mixing; runs of symbols by polynomials over 2^64 with odd bases, finished by a bijective mix --
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASES[0]))  # a fixed random value per byte


@functools.lru_cache(maxsize=4)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(size, b, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


class Prefix:
    """Hashes of any slice of a symbol array from one prefix sum."""

    def __init__(self, symbols: np.ndarray, base: int = BASES[1]):
        size = 1 << max(16, int(len(symbols) - 1).bit_length())
        power, self.inverse = _powers(base, size)
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * power[: len(symbols)], out=self.sums[1:])

    def slices(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.inverse[starts]


_TAIL = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)  # keeps the first k bytes of a block
LONG = 512  # longer slices are digested one by one


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = BASES[2]) -> np.ndarray:
    """Hash of every slice: blocks of 8 bytes, the state mixed after each, so no choice of text cancels out."""
    size = ends - starts
    out = mix(size.astype(np.uint64) * np.uint64(BASES[1]) + np.uint64(seed))
    if not len(starts):
        return out
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    block = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # block[i]: the 8 bytes from i on
    live = np.flatnonzero((size > 0) & (size <= LONG))
    at = starts[live]
    while len(live):
        left = ends[live] - at
        value = block[at] & _TAIL[np.minimum(left, 8)]
        out[live] = mix((out[live] ^ value) + np.uint64(BASES[0]))
        more = left > 8
        live, at = live[more], at[more] + 8
    for i in np.flatnonzero(size > LONG).tolist():
        digest = hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8, key=seed.to_bytes(8, "little")).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def rolling(symbols: np.ndarray, length: int, base: int = BASES[0]) -> np.ndarray:
    """Mixed hash of every run of ``length`` symbols, by doubling."""
    n = len(symbols)
    if n < length:
        return np.zeros(0, np.uint64)
    block, size, power = symbols, 1, base  # block[i]: hash of symbols i .. i + size
    out, have, bits = None, 0, length
    while bits:
        if bits & 1:
            if out is None:
                out, have = block, size
            else:
                m = min(len(out), len(block) - have)
                out = out[:m] + block[have : have + m] * np.uint64(pow(base, have, 1 << 64))
                have += size
        bits >>= 1
        if bits:
            block = block[:-size] + block[size:] * np.uint64(power)
            size, power = size * 2, power * power % (1 << 64)
    return mix(out[: n - length + 1])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours."""
    low, size = values, 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    rest = width - size
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
