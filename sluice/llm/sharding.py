"""Uniform shuffle into shards of exact size through a hypergeometric communication matrix.

1. Rows fall into logical partitions (about ``rows_each`` rows, 64 partitions at least) by a hash of their content, so
   a retried task deals them alike.  Their counts (one number per partition) go to the driver.
2. The driver draws how many rows of each partition go to each shard: a multivariate hypergeometric matrix with the
   partition counts as row sums and the exact shard sizes (at most one apart) as column sums.
3. Rows are permuted inside their partition (rank by a second hash), and cut by the matrix row into shards.
4. After the exchange each shard is permuted again (rank by a third hash).  A shard is ranked in hash ranges of about
   ``rows_each`` rows with known offsets, so no task holds a whole shard.

Only built-in DataFrame functions run on the rows.  The matrix has shards numbers for each ``rows_each`` rows.

Defined cases: a null text has no bytes (size 8, checksum 0); repeated rows are rows of their own and get slots of
their own (equal rows are interchangeable); a null doc_id is a value like any other; all columns of the input, clashing
names included, are kept inside ``row``; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

SHARDS, SEED, ROWS_EACH = 24, 20_240_607, 100_000  # rows in a partition, and in a range of a shard, about


def hypergeometric(rng: random.Random, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws without replacement are good: inversion outwards from the mode, by the ratio of neighbours."""
    low, high = max(0, n - bad), min(good, n)
    if low == high:
        return low
    mode = min(max((n + 1) * (good + 1) // (good + bad + 2), low), high)
    choose = lambda a, b: math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)
    peak = math.exp(choose(good, mode) + choose(bad, n - mode) - choose(good + bad, n))
    u = rng.random() - peak
    up = down = mode
    p_up = p_down = peak
    while u > 0 and (up < high or down > low):
        if up < high:
            p_up *= (good - up) * (n - up) / ((up + 1) * (bad - n + up + 1))
            up += 1
            u -= p_up
            if u <= 0:
                return up
        if down > low:
            p_down *= down * (bad - n + down) / ((good - down + 1) * (n - down + 1))
            down -= 1
            u -= p_down
            if u <= 0:
                return down
        if p_up + p_down < 1e-18:
            break  # what is left of u is rounding
    return mode


def communication_matrix(row_sums: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows with the given sums; column sums are equal up to one.  Drawn as a uniform shuffle would."""
    rng = random.Random(seed)
    total = sum(row_sums)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    left, out = total, []
    for n in row_sums:
        row, pool = [], left
        for s in range(shards):
            x = hypergeometric(rng, room[s], pool - room[s], n)
            pool -= room[s]
            room[s] -= x
            n -= x
            row.append(x)
        left -= sum(row)
        out.append(row)
    return out


def _draw(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "doc_id", "size", "text_crc32")


def shard_documents(documents: DataFrame, shards: int = SHARDS, rows_each: int = ROWS_EACH, seed: int = SEED) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` and all input columns as the struct ``row``."""
    total = documents.count()
    partitions, ranges = max(64, -(-total // rows_each)), max(4, -(-total // (shards * rows_each)))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        F.struct("*").alias("row"), "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    dealt = rows.withColumn("part", F.pmod(_draw(seed), F.lit(partitions)).cast("int"))
    counts = {r.part: r.n for r in dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}  # one number per partition
    matrix = communication_matrix([counts.get(p, 0) for p in range(partitions)], shards, seed)
    edges = [[sum(r[: s + 1]) for s in range(shards)] for r in matrix]
    cuts = documents.sparkSession.range(1).select(
        F.posexplode(F.from_json(F.lit(json.dumps(edges)), "array<array<bigint>>")).alias("part", "edges"))
    same = ["doc_id", "size", "text_crc32"]
    local = Window.partitionBy("part").orderBy(_draw(seed + 1), *same)
    placed = (
        dealt.withColumn("rank", F.row_number().over(local)).join(F.broadcast(cuts), "part")
        .withColumn("shard", F.size(F.filter("edges", lambda e: e < F.col("rank"))))
        .withColumn("draw", _draw(seed + 2)).withColumn("range", F.expr(f"shiftright(draw, 32) * {ranges} div 4294967296 "  # ascending in the draw
                                                                                  f"- IF(shiftright(draw, 32) < 0, 1, 0)"))
        .select("row", *same, "shard", "draw", "range"))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n")).select(
        "shard", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))  # shards x ranges rows
    inside = Window.partitionBy("shard", "range").orderBy("draw", *same)
    ranked = placed.withColumn("rank", F.row_number().over(inside)).join(F.broadcast(offsets), ["shard", "range"])
    return ranked.select("row", *same, "shard", (F.col("offset") + F.col("rank") - 1).cast("long").alias("slot"))


def op4_sharding(spark, sf_dir: str) -> DataFrame:
    placed = shard_documents(C.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
