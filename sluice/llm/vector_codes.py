"""Product codes of vectors by integer k-means, with LAESA pivots to order and prune the distance evaluations.

1. Every component becomes ``floor(SCALE * x)``; vectors are cut into ``PARTS`` equal parts.  The codebooks start as the
   parts of the ``ENTRIES`` smallest ids.
2. *Pivots*: of each part's first codebook, ``PIVOTS`` entries far from each other stay fixed as pivots.  The distances
   of all parts to them are computed once and stored beside the parts.
3. Each round, the distances of the current entries to the pivots give lower bounds ``|d(part, pivot) - d(entry, pivot)|``
   for every part and entry.  Entries are evaluated by rising bound, exactly and in integers, until the bounds left exceed the
   best distance found.  Tasks send one sum per entry; the driver holds the codebooks only (``PARTS * ENTRIES`` rows).

Defined cases: vectors that are null or hold null or non-finite components take no part, nor do those whose length can't be
cut into ``PARTS`` parts or differs from that of the smallest id; a null vec_id is ordered last; repeated vec_ids are rows of their
own, ordered by vector; with fewer rows than ``ENTRIES`` the codebooks are as short; rows of equal labels share one sum, null
labels too; further columns are not read; an empty table gives an empty result.  Components too large for exact sums of
squares in 64 bits raise an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

PARTS, ENTRIES, ROUNDS, SCALE, PIVOTS = 4, 256, 4, 1024, 8
ROWS = 2048  # parts bounded at once: a table of ROWS x ENTRIES lower bounds
STEPS = 2  # entries taken singly by rising bound before the rest is evaluated together
DENSE = 0.05  # share of entries left from which on their products are made together
_SLACK = 2.0**-20  # of float32 distances, relative


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = a - b
    return np.einsum("ij,ij->i", gap, gap)


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distances of every row to every point, as float32."""
    return np.sqrt(np.stack([_squares(x, p[None]) for p in points], axis=1).astype(np.float64)).astype(np.float32)


def choose_pivots(entries: np.ndarray, count: int) -> np.ndarray:
    """Entries far from each other: each next one has the greatest least distance to those before it."""
    picked, gap = [0], _squares(entries, entries[:1])
    while len(picked) < min(count, len(entries)):
        picked.append(int(gap.argmax()))
        gap = np.minimum(gap, _squares(entries, entries[picked[-1]][None]))
    return entries[picked]


def nearest(x: np.ndarray, to_pivot: np.ndarray, entries: np.ndarray, entry_to_pivot: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry of every row (ties: lower index), its squared distance, and how many distances were evaluated."""
    rows, done = np.arange(len(x)), 0
    low = np.zeros((len(x), len(entries)), np.float32)
    for p in range(to_pivot.shape[1]):
        np.maximum(low, np.abs(to_pivot[:, p, None] - entry_to_pivot[None, :, p]), out=low)
    low -= _SLACK * (to_pivot.max(axis=1)[:, None] + entry_to_pivot.max(axis=1)[None])
    np.maximum(low, 0, out=low)
    at = low.argmin(axis=1)
    best = _squares(x, entries[at])
    done += len(x)
    low[rows, at] = np.inf
    for _ in range(STEPS):
        nxt = low.argmin(axis=1)
        live = np.flatnonzero(low[rows, nxt].astype(np.float64) ** 2 <= best)
        got = _squares(x[live], entries[nxt[live]])
        better = (got < best[live]) | ((got == best[live]) & (nxt[live] < at[live]))
        at[live[better]], best[live[better]] = nxt[live[better]], got[better]
        low[live, nxt[live]] = np.inf
        done += len(live)
    limit = np.nextafter(np.sqrt(best.astype(np.float64)).astype(np.float32), np.float32(np.inf))
    left = low <= limit[:, None]
    count = int(left.sum())
    done += count
    if count > DENSE * left.size and _exact_in_doubles(x, entries):
        # many entries are left for most rows: all their products at once, which doubles hold exactly
        a, b = x.astype(np.float64), entries.astype(np.float64)
        gaps = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None]
        gaps[~left] = np.inf
        row, k = rows, gaps.argmin(axis=1)
        found = np.isfinite(gaps[rows, k])
        row, k = row[found], k[found]
        d = gaps[row, k].astype(np.int64)
    else:
        r, e = np.nonzero(left)
        got = _squares(x[r], entries[e])
        order = np.lexsort((e, got, r))
        first = order[np.concatenate(([True], r[order][1:] != r[order][:-1]))] if len(r) else order
        row, d, k = r[first], got[first], e[first]
    better = (d < best[row]) | ((d == best[row]) & (k < at[row]))
    at[row[better]], best[row[better]] = k[better], d[better]
    return at, best, done


def _exact_in_doubles(x: np.ndarray, entries: np.ndarray) -> bool:
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    return 4 * x.shape[1] * top * top < 2**52


class Codebooks:
    """Entries of every part, the fixed pivots and the entries' distances to them."""

    def __init__(self, entries: np.ndarray, pivots: list[np.ndarray]):
        self.entries, self.pivots = entries, pivots  # entries: part, entry, component
        self.to_pivot = [distances(e, p) for e, p in zip(entries, pivots)]

    def assign(self, x: np.ndarray, to_pivot: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Rows, their entries and squared distances (row, part), for blocks of ``x`` (row, part, component)."""
        for i in range(0, len(x), ROWS):
            s = slice(i, i + ROWS)
            found = [nearest(x[s, k], to_pivot[s, k], self.entries[k], self.to_pivot[k])[:2] for k in range(PARTS)]
            yield s, np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)

    def moved(self, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> "Codebooks":
        entries = self.entries.copy()
        for (k, e), (n, total) in sums.items():
            entries[k, e] = [t // n for t in total]
        return Codebooks(entries, self.pivots)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


# -- Spark side -------------------------------------------------------------------------
def usable(rows: DataFrame) -> DataFrame:
    """``vec_id, label, v`` (integer components) of the vectors that take part."""
    x = F.col("embedding")
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    picked = rows.filter(x.isNotNull() & whole & (F.size(x) > 0) & (F.size(x) % PARTS == 0))
    return picked.select("vec_id", "label", F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("long")).alias("v"))


_STORED = pa.schema([("vec_id", pa.int64()), ("v", pa.binary()), ("d", pa.binary())])


def _stored(rows: DataFrame, books: Codebooks) -> DataFrame:
    """The components and pivot distances of all vectors, written once."""
    width, count = books.entries.shape[2], books.pivots[0].shape[0]
    top = int(np.sqrt((2**62) / (PARTS * width)) / 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, ROWS):
                part = b.slice(i, ROWS)
                x = np.asarray(part.column("v").flatten()).reshape(-1, PARTS, width)
                if len(x) and (x.max() > top or x.min() < -top):
                    raise ValueError(f"components beyond {top} after scaling: sums of squares would not fit into 64 bits")
                d = np.stack([distances(x[:, k], books.pivots[k]) for k in range(PARTS)], axis=1)
                v = x.astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("label"), pa.array([r.tobytes() for r in v], pa.binary()), pa.array([r.tobytes() for r in d], pa.binary())],
                    names=["vec_id", "label", "v", "d"])

    label = rows.schema["label"].dataType.simpleString()
    same = rows.filter(F.size("v") == PARTS * width)
    return C.cut(same.mapInArrow(run, f"vec_id long, label {label}, v binary, d binary"), f"codes-parts-{count}")


def _blocks(b: pa.RecordBatch, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(b"".join(b.column("v").to_pylist()), np.int32).reshape(b.num_rows, PARTS, -1).astype(np.int64)
    return x, np.frombuffer(b"".join(b.column("d").to_pylist()), np.float32).reshape(b.num_rows, PARTS, -1)


def _round(stored: DataFrame, books: Codebooks) -> Codebooks:
    """Assign every part and move the entries: one row per task and entry is shuffled."""
    _, count, width = books.entries.shape
    out = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros((PARTS, count), np.int64), np.zeros((PARTS, count, width), np.int64)
        for b in batches:
            x, d = _blocks(b, books)
            for s, at, _ in books.assign(x, d):
                for k in range(PARTS):
                    order = np.argsort(at[:, k], kind="stable")
                    entry = at[order, k]
                    new = np.flatnonzero(np.concatenate(([True], entry[1:] != entry[:-1])))
                    total[k, entry[new]] += np.add.reduceat(x[s, k][order], new, axis=0)
                    n[k] += np.bincount(entry, minlength=count)
        part, entry = np.nonzero(n)
        yield C.batch(out, part.astype(np.int32), entry.astype(np.int32), n[part, entry], pa.array(total[part, entry].tolist(), pa.list_(pa.int64())))

    sums = stored.select("v", "d").mapInArrow(run, "part int, entry int, n long, total array<long>").groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(width)]).alias("total"))
    return books.moved({(r.part, r.entry): (r.n, list(r.total)) for r in sums.collect()})


def _coded(stored: DataFrame, books: Codebooks) -> DataFrame:
    out = "vec_id long, label %s, code string, error long" % stored.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, d = _blocks(b, books)
            codes, errors = [], []
            for _, at, gap in books.assign(x, d):
                codes += [row.tobytes().hex() for row in at.astype(np.uint8)]
                errors += gap.sum(axis=1).tolist()
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                                             names=["vec_id", "label", "code", "error"])

    return stored.mapInArrow(run, out)


def compress(embeddings: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES, pivots: int = PIVOTS) -> tuple[DataFrame, Codebooks | None]:
    """``vec_id, label, code, error`` of every vector that takes part, and the codebooks (None without vectors)."""
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    rows = usable(embeddings.select(F.col("vec_id").cast("long"), "label", "embedding"))
    order = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    least = rows.select("vec_id", "v").orderBy(*order).limit(1).collect()
    if not least:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).limit(0), None
    width = len(least[0].v)
    first = rows.filter(F.size("v") == width).select("vec_id", "v").orderBy(*order).limit(entries).collect()
    start = np.array([r.v for r in first], np.int64).reshape(len(first), PARTS, width // PARTS).transpose(1, 0, 2).copy()
    books = Codebooks(start, [choose_pivots(e, pivots) for e in start])
    stored = _stored(rows, books)
    for _ in range(rounds):
        books = _round(stored, books)
    return _coded(stored, books), books


def label_errors(coded: DataFrame, books: Codebooks | None) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``."""
    rows = C.cut(coded, "codes-coded")
    sums = rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    joined = rows.alias("r").join(sums.alias("s"), F.col("r.label").eqNullSafe(F.col("s.label")))
    return joined.select("r.vec_id", "r.code", "r.error", "s.label_error", F.lit(books.sha256() if books else "").alias("codebooks_sha256"))


def op11_vector_codes(spark, sf_dir: str) -> DataFrame:
    return label_errors(*compress(C.table(spark, sf_dir, "embeddings")))


def _sql() -> str:
    def near(k: int) -> str:
        return f"""
near{k} AS MATERIALIZED (
  SELECT vec_id, p, any_value(x) AS x, min(d * {ENTRIES} + e) AS m
  FROM (SELECT vec_id, p, x, e, CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
        FROM parts JOIN book{k} USING (p)) GROUP BY vec_id, p)"""

    def book(k: int) -> str:
        return f"""
book{k + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(f, c) AS c FROM book{k} LEFT JOIN (
    SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS f FROM (
      SELECT p, m % {ENTRIES} AS e, i, CAST(sum(c) AS BIGINT) AS s, count(*) AS n
      FROM (SELECT p, m, unnest(x) AS c, unnest(range(len(x))) AS i FROM near{k}) GROUP BY ALL) GROUP BY p, e) USING (p, e))"""

    steps = ",".join(near(k) + "," + book(k) for k in range(ROUNDS)) + "," + near(ROUNDS)
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda v: CAST(floor({SCALE} * CAST(v AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS x FROM kept, range({PARTS}) AS r(p)),
book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c
  FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {ENTRIES})),{steps},
sha AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{ROUNDS}),
coded AS (
  SELECT vec_id, string_agg(printf('%02x', CAST(m % {ENTRIES} AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(m // {ENTRIES}) AS BIGINT) AS error
  FROM near{ROUNDS} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), sha
"""


SQL = _sql()
