"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Targets: sources in code point order (null last) weigh 5, 2, 1, repeating, and share the words of all documents; a
target stops at ``most`` times its source's words and the excess is shared again by weight.  The result of that
repetition is the level at which the uncapped sources meet, found in one pass over the sources sorted by cap / weight.

Each source is a stream of its documents in shuffled order (md5), cut into blocks of ``block_words`` and read round
again when it ends.  Slot ``i`` of the mix has the golden-ratio point ``frac(i * 0.618...)``; mapped through the
cumulative block shares it names a source, and the slot's rank among that source's slots names the block.  A source
stops at its target, inside a block if need be, so what it gives is its target rounded.  :func:`scheduled` is the mix
itself: a row for every pass and block that take words of a document, with the block's slot.  ``taken`` sums its words
and ``first_slot`` says where the mix first takes a document.  Blocks that the points have not reached after ``9/8`` of all slots follow at the end.

The table of sources (a catalogue, one row each) is the only thing collected.  Positions in a source come from 4096
hash ranges with known offsets and slot ranks from fixed ranges of slots, so no task holds a whole source.

Defined cases: a null or empty text has size 0 and is never taken; a null source is a source; repeated rows are
documents of their own (equal ones are interchangeable); further columns are only read if they are in ``keep``; an empty table, or one without
words, gives targets of 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

WEIGHTS, MOST, BLOCK_WORDS, GOLDEN = (5, 2, 1), 3, 1024, 0.6180339887498949
SLOT_RANGE = 4096
WORDS = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source: ``source, src`` (its number), ``source_size, weight, target`` and ``quota`` (the target rounded)."""
    order = F.col("source").asc_nulls_last()
    src = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("src", F.row_number().over(Window.orderBy(order)) - 1)
        .withColumn("weight", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), F.pmod("src", F.lit(len(weights))) + 1))
        .withColumn("cap", F.col("source_size") * most))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "src")
    everything = Window.partitionBy()
    left = src.withColumn("rest", F.sum("source_size").over(everything) - F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, 0)) + F.col("cap"))
    left = left.withColumn("heavy", F.sum("weight").over(everything) - F.sum("weight").over(by_level.rowsBetween(Window.unboundedPreceding, 0)) + F.col("weight"))
    open_ = F.col("cap") * F.col("heavy") > F.col("weight") * F.col("rest")  # once true, it stays true for higher levels
    first = left.withColumn("open", open_).withColumn("level", F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), "src", "rest", "heavy"))).over(everything))
    target = F.when(F.col("open"), F.col("weight") * F.col("level.rest").cast("double") / F.col("level.heavy").cast("double")).otherwise(F.col("cap").cast("double"))
    return first.withColumn("target", target).select(
        "source", "src", "source_size", "weight", "target", F.floor(F.col("target") + 0.5).cast("long").alias("quota"))


def schedule(spark, blocks: list[int]) -> DataFrame:
    """``slot, src, block``: every block of every source (``blocks[src]`` of them) at its place in the mix."""
    total = sum(blocks)
    shares, seen = [], 0
    for n in blocks:
        seen += n
        shares.append(seen / total if total else 0.0)
    slots = total + total // 8 + 64 if total else 0
    point = (F.col("id") * F.lit(GOLDEN)) % 1.0
    edges = F.array(*[F.lit(s) for s in shares]) if shares else F.array().cast("array<double>")
    limits = F.array(*[F.lit(n).cast("long") for n in blocks]) if blocks else F.array().cast("array<bigint>")
    drawn = spark.range(slots).select(F.col("id").alias("slot"), F.size(F.filter(edges, lambda e: e <= point)).alias("src"))
    drawn = drawn.withColumn("part", F.expr(f"slot div {SLOT_RANGE}"))
    before = Window.partitionBy("src").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = drawn.groupBy("src", "part").agg(F.count(F.lit(1)).alias("n")).select(
        "src", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("src", "part").orderBy("slot")
    ranked = drawn.withColumn("r", F.row_number().over(inside)).join(offsets, ["src", "part"])
    reached = ranked.select("slot", "src", (F.col("offset") + F.col("r") - 1).alias("block"))
    reached = reached.filter(F.col("block") < F.element_at(limits, F.col("src") + 1)) if blocks else reached
    wanted = spark.range(total).select(F.size(F.filter(F.array(*[F.lit(sum(blocks[: i + 1])) for i in range(len(blocks))]) if blocks else F.array().cast("array<bigint>"),
                                                       lambda e: e <= F.col("id"))).alias("src"), "id")
    starts = F.array(*[F.lit(sum(blocks[:i])).cast("long") for i in range(len(blocks))]) if blocks else F.array().cast("array<bigint>")
    wanted = wanted.select("src", (F.col("id") - F.element_at(starts, F.col("src") + 1)).alias("block"), F.col("id").alias("late"))
    return wanted.join(reached, ["src", "block"], "left").select(
        F.coalesce("slot", F.lit(slots) + F.col("late")).alias("slot"), "src", "block")


def placed(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block_words: int = BLOCK_WORDS,
           keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """The documents with their places in their sources, and the schedule's blocks."""
    spark = documents.sparkSession
    name = F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sized = documents.select(*([F.struct(*keep).alias("row")] if keep else []), "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
                             F.md5(name.cast("binary")).alias("draw")).withColumn("part", F.substring("draw", 1, 3))
    narrow = C.cut(sized.select("source", "part", "size"), "mix-sizes")
    sources = C.cut(source_targets(narrow, weights, most), "mix-sources")
    rows = sources.orderBy("src").collect()  # the catalogue of sources
    slots = schedule(spark, [-(-r.quota // block_words) for r in rows])
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = narrow.groupBy("source", "part").agg(F.sum("size").alias("n")).select(
        "source", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source", "part").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    upto = sized.withColumn("upto", F.sum("size").over(inside)).alias("d")
    where = upto.join(offsets.alias("o"), F.col("d.source").eqNullSafe(F.col("o.source")) & (F.col("d.part") == F.col("o.part"))).select(
        "d.*", (F.col("o.offset") + F.col("d.upto") - F.col("d.size")).alias("start"))
    where = where.alias("w").join(sources.alias("s"), F.col("w.source").eqNullSafe(F.col("s.source"))).select(
        *["w.row"] * bool(keep), "w.doc_id", "w.size", "w.start", "s.src", "s.source_size", "s.target", "s.quota")
    # written once: rows equal in the order above must not trade places between two uses
    return C.cut(where, "mix-places"), slots


def scheduled(places: DataFrame, slots: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix: ``slot``, the columns of ``places``, ``pass`` and ``words``, a row per pass and block that take words of a document.

    In order of ``slot, pass, start`` it is the whole mix, repeats included.
    """
    first, stop = F.expr("pass * source_size + start"), F.expr("least(quota, pass * source_size + start + size)")
    takes = places.filter("size > 0 AND start < quota").withColumn("pass", F.explode(F.expr("sequence(0L, (quota - start - 1) div source_size)")))
    takes = takes.withColumn("first", first).withColumn("stop", stop)
    takes = takes.withColumn("block", F.explode(F.expr(f"sequence(first div {block_words}, (stop - 1) div {block_words})")))
    words = F.least("stop", (F.col("block") + 1) * block_words) - F.greatest("first", F.col("block") * block_words)
    return takes.withColumn("words", words).join(slots, ["src", "block"]).select("slot", *places.columns, "pass", "words")


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block_words: int = BLOCK_WORDS,
        keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, size, source_size, target, taken, first_slot`` and the input columns ``keep`` as the struct ``row``."""
    places, slots = placed(documents, weights, most, block_words, keep)
    # a document with words is alone at its start
    sums = scheduled(places, slots, block_words).groupBy("src", "start").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))
    sums = sums.select(F.col("src").alias("at_src"), F.col("start").alias("at_start"), "taken", "first_slot")
    found = places.join(sums, (F.col("src") == F.col("at_src")) & (F.col("start") == F.col("at_start")) & (F.col("size") > 0), "left")
    return found.select(*["row"] * bool(keep), "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), "first_slot")


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs)


SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS draw FROM documents),
src AS (
  SELECT *, CAST([5, 2, 1][src % 3 + 1] AS BIGINT) AS weight, source_size * 3 AS cap
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS src
        FROM sized GROUP BY source)),
lvl AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER w, 0) AS rest, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS heavy
  FROM src WINDOW w AS (ORDER BY CAST(cap AS DOUBLE) / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
opened AS (SELECT rest, heavy FROM lvl WHERE cap * heavy > weight * rest ORDER BY CAST(cap AS DOUBLE) / weight, src LIMIT 1),
tgt AS (
  SELECT source, src, source_size,
         CASE WHEN cap * heavy > weight * rest THEN weight * CAST((SELECT rest FROM opened) AS DOUBLE) / CAST((SELECT heavy FROM opened) AS DOUBLE)
              ELSE CAST(cap AS DOUBLE) END AS target FROM lvl),
quota AS (
  SELECT *, sum(n) OVER (ORDER BY src) AS upto, sum(n) OVER () AS total
  FROM (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS quota, (CAST(floor(target + 0.5) AS BIGINT) + {BLOCK_WORDS - 1}) // {BLOCK_WORDS} AS n FROM tgt)),
drawn AS (
  SELECT slot, (SELECT count(*) FROM quota WHERE CAST(upto AS DOUBLE) / CAST(total AS DOUBLE) <= (slot * {GOLDEN!r}::DOUBLE) % 1.0) AS src
  FROM (SELECT unnest(range(0, CAST((SELECT CASE WHEN any_value(total) > 0 THEN any_value(total) + any_value(total) // 8 + 64 ELSE 0 END FROM quota) AS BIGINT))) AS slot)),
reached AS (SELECT slot, src, row_number() OVER (PARTITION BY src ORDER BY slot) - 1 AS block FROM drawn),
blocks AS (SELECT src, unnest(range(0, CAST(n AS BIGINT))) AS block, upto - n AS first, total FROM quota),
sched AS (
  SELECT b.src, b.block, coalesce(r.slot, b.total + b.total // 8 + 64 + b.first + b.block) AS slot
  FROM blocks b LEFT JOIN reached r ON r.src = b.src AND r.block = b.block),
pos AS (
  SELECT d.doc_id, d.size, q.*, coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id, d.size
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized d JOIN quota q ON q.source IS NOT DISTINCT FROM d.source),
got AS (
  SELECT *, CAST(CASE WHEN source_size = 0 THEN 0 ELSE quota // source_size * size
              + greatest(0, least(size, quota % source_size - start)) END AS BIGINT) AS taken FROM pos)
SELECT g.doc_id, g.size, g.source_size, g.target, g.taken, CAST(s.slot AS BIGINT) AS first_slot
FROM got g LEFT JOIN sched s ON g.taken > 0 AND s.src = g.src AND s.block = g.start // {BLOCK_WORDS}
"""
