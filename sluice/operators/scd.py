"""Slowly changing dimensions as plain DataFrame plans.

``scd1``: latest row per key by ``sequence_by``.  One ``max(struct(seq, rest))``
aggregate, which Spark combines map-side, so a hot key costs one row per input
partition in the shuffle.

``scd2``: one row per version with ``__START_AT`` / ``__END_AT``.  Versions are
"islands" of consecutive rows (by sequence) whose tracked columns are equal.
A per-key window would put a hot key (say a third of all rows) into one task,
so the ordered scan is split into range chunks instead:

1. Borders of (keys, seq) ranges come from a bounded sample; a binary search over
   them numbers each row's chunk, so a hot key is cut into several contiguous
   pieces, and one exchange puts each chunk into a partition of its own.  The
   chunk count follows the measured rows (``CHUNK_ROWS`` each).
0. Equal ``(key, seq)`` rows are de-duplicated first by a map-side-combined
   aggregate: a range partitioner cannot split copies of one value.
2. Windows over ``(keys, chunk)``: previous / next tracked values, next
   sequence, and the running start of the current island.
3. Chunk borders: keys are contiguous in range order, so only the first and
   the last key of a chunk can continue in a neighbouring chunk.  Their
   per-(key, chunk) summaries (computed in the same sorted window pass) -- at most two per chunk, a bound set by the
   partition count, not by the data -- are stitched with a small window and
   broadcast back.
4. A version is the last row of its island (the next row differs or there is
   none): a filter, no aggregation.

The windowed rows feed two consumers (steps 3 and 4); they are checkpointed
once into the shared checkpoint folder instead of being recomputed.  ``__START_AT`` is the island's first
   sequence, ``__END_AT`` the next row's sequence.

Semantics (decided, since the managed CDC engine is not public):
* rows with a NULL key or NULL sequence are not applied;
* equal (key, sequence): the row with the greater remaining columns wins;
* no tracked list: every non-key column is tracked (including the sequence),
  so every distinct sequence is a version; with a list, a change limited to
  untracked columns updates the open version in place (latest values win);
* ``__END_AT`` of a version is the next version's ``__START_AT``, NULL if open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

START_AT = "__START_AT"
END_AT = "__END_AT"


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _resolver(df: DataFrame):
    """Config names -> the frame's own column names (case-insensitive unless the session says otherwise)."""
    if df.sparkSession.conf.get("spark.sql.caseSensitive", "false").lower() == "true":
        return lambda c: c
    lookup = {c.lower(): c for c in df.columns}
    return lambda c: lookup.get(c.lower(), c)


def _prepare(df: DataFrame, keys, sequence_by: str, except_columns) -> tuple[DataFrame, list[str]]:
    if not keys:
        raise ValueError("CDC apply requires keys")
    if not sequence_by:
        raise ValueError("CDC apply requires sequence_by")
    name = _resolver(df)
    keys = [name(k) for k in ([keys] if isinstance(keys, str) else list(keys))]
    sequence_by = name(sequence_by)
    missing = [c for c in keys + [sequence_by] if c not in df.columns]
    if missing:
        raise ValueError(f"CDC columns not found in source: {missing}; source columns are {df.columns}")
    excluded = {name(c) for c in (except_columns or [])}
    bad = excluded & (set(keys) | {sequence_by})
    if bad:
        raise ValueError(f"except_columns cannot remove keys or the sequence column: {sorted(bad)}")
    kept = [c for c in df.columns if c not in excluded]
    cond = F.lit(True)
    for c in keys + [sequence_by]:
        cond = cond & _q(c).isNotNull()
    return df.select(*[_q(c) for c in kept]).where(cond), keys


def scd1(df: DataFrame, keys, sequence_by: str, except_columns=()) -> DataFrame:
    """Type 1: the row with the greatest sequence per key (ties: greatest remaining columns)."""
    d, keys = _prepare(df, keys, sequence_by, except_columns)
    sequence_by = _resolver(d)(sequence_by)
    others = [c for c in d.columns if c not in keys and c != sequence_by]
    best = F.max(F.struct(_q(sequence_by), *[_q(c) for c in others])).alias("_w")
    return (
        d.groupBy(*[_q(k) for k in keys])
        .agg(best)
        .select(*[_q(c) if c in keys else F.col("_w").getField(c).alias(c) for c in d.columns])
    )


CHUNK_ROWS = 1_000_000   # (key, sequence) rows a chunk holds, about: one window sort per chunk


def dedup_key_seq(df: DataFrame, keys, sequence_by: str) -> DataFrame:
    """One row per (keys, sequence_by): the greatest remaining columns win (map-side combined)."""
    name = _resolver(df)
    keys = [name(k) for k in ([keys] if isinstance(keys, str) else list(keys))]
    sequence_by = name(sequence_by)
    others = [c for c in df.columns if c not in keys and c != sequence_by]
    group = [_q(k) for k in keys] + [_q(sequence_by)]
    if not others:
        return df.select(*group).distinct()
    best = F.max(F.struct(*[_q(c) for c in others])).alias("_w")
    return df.groupBy(*group).agg(best).select(
        *[_q(c) if c in keys or c == sequence_by else F.col("_w").getField(c).alias(c) for c in df.columns])


SAMPLE_PER_CHUNK, SAMPLE_ROWS = 60, 1_000_000   # rows whose keys are sampled for the borders: by chunk, and at most


def chunk_borders(df: DataFrame, keys: list[str], order_by: str, n: int) -> DataFrame:
    """One row: ``_borders``, the least (keys, order_by) of the second and later of ``n`` > 1 chunks, in order.

    They come from a sample of the composite key chosen by hash, so runs agree and a key holding a large share of
    the rows gets several borders.  The sample is bounded, and only the borders are collected.
    """
    spark = df.sparkSession
    at = F.struct(*[_q(k) for k in keys], _q(order_by)).alias("_at")
    points = df.select(at)
    wanted = min(SAMPLE_PER_CHUNK * n, SAMPLE_ROWS)
    every = max(1, points.count() // wanted)
    picked = points.where(F.pmod(F.xxhash64("_at"), F.lit(every)) == 0)
    found = picked.sort("_at").collect()
    cuts = sorted({len(found) * i // n for i in range(1, n)} - {0})
    return spark.createDataFrame([([found[i]._at for i in cuts],)], T.StructType([T.StructField("_borders", T.ArrayType(points.schema["_at"].dataType))]))


def range_chunks(df: DataFrame, keys, order_by: str, n: int) -> DataFrame:
    """Add ``_chunk``: contiguous, size-balanced ranges of (keys, order_by), numbered 0 to n - 1.

    A binary search over the borders numbers the rows where they are, without an exchange; the borders are one
    value (n - 1 keys), a scalar subquery.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if n <= 1:
        return df.withColumn("_chunk", F.lit(0))
    borders = chunk_borders(df, keys, order_by, n).scalar()
    steps = [1 << k for k in reversed(range(max(1, (n - 1).bit_length())))]
    at = F.struct(*[_q(k) for k in keys], _q(order_by))

    def further(found: Column, step: Column) -> Column:
        nxt = found + step
        return F.when((nxt <= F.size("_borders")) & (F.get(F.col("_borders"), nxt - 1) <= at), nxt).otherwise(found)

    chunk = F.aggregate(F.array(*[F.lit(x) for x in steps]), F.lit(0), further)
    return df.withColumn("_borders", borders).withColumn("_chunk", chunk).drop("_borders")


def tracked_columns(columns, keys, track_history_columns=None, track_history_except_columns=None) -> list[str]:
    if track_history_columns and track_history_except_columns:
        raise ValueError("give track_history_columns or track_history_except_columns, not both")
    non_key = [c for c in columns if c not in keys]
    if track_history_columns:
        unknown = [c for c in track_history_columns if c not in non_key]
        if unknown:
            raise ValueError(f"track_history_columns not among the stored non-key columns: {unknown}")
        return [c for c in non_key if c in set(track_history_columns)]
    if track_history_except_columns:
        unknown = [c for c in track_history_except_columns if c not in columns]
        if unknown:
            raise ValueError(f"track_history_except_columns not among the stored columns: {unknown}")
        return [c for c in non_key if c not in set(track_history_except_columns)]
    return non_key


def scd2(
    df: DataFrame,
    keys,
    sequence_by: str,
    except_columns=(),
    track_history_columns=None,
    track_history_except_columns=None,
    chunks: int | None = None,
    stored: bool = False,
) -> DataFrame:
    """Type 2 history: one row per version, ``__START_AT`` / ``__END_AT`` validity interval.

    ``stored``: ``df`` reads files that hold one row per (key, sequence) already (a CDC log): step 0 is done.
    """
    d, keys = _prepare(df, keys, sequence_by, except_columns)
    name = _resolver(d)
    sequence_by = name(sequence_by)
    track_history_columns = [name(c) for c in track_history_columns] if track_history_columns else None
    track_history_except_columns = ([name(c) for c in track_history_except_columns]
                                    if track_history_except_columns else None)
    cols = d.columns
    seq = _q(sequence_by)
    tracked = tracked_columns(cols, keys, track_history_columns, track_history_except_columns)
    kcols = [_q(k) for k in keys]
    part = [F.col("_chunk"), *kcols]

    # 0. one row per (key, seq), the greatest remaining columns winning.  Copies of
    #    one (key, seq) cannot be split by a range partitioner; this aggregate
    #    combines them map-side, so even a group of copies holding a third of all
    #    rows reaches the shuffle as one row per input partition.
    #    The result is written once, so the number of chunks follows its real row count.
    deduped = d if stored else materialize(dedup_key_seq(d, keys, sequence_by), "scd2-rows")
    n = chunks or max(1, -(-deduped.count() // CHUNK_ROWS))

    # 1. contiguous (key, seq) ranges, numbered before the only exchange of these rows: each chunk
    #    is a partition of its own, and the windows below need no further exchange.
    deduped = range_chunks(deduped, keys, sequence_by, n).repartitionById(n, F.col("_chunk"))

    # 2. inside a chunk: neighbours and running island start
    t = F.struct(*[_q(c) for c in tracked])
    w = Window.partitionBy(*part).orderBy(seq)
    w_run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = deduped.select(
        *[_q(c) for c in cols], "_chunk",
        t.alias("_t"),
        F.lag(t).over(w).alias("_prev_t"),
        F.lead(t).over(w).alias("_next_t"),
        F.lead(seq).over(w).alias("_next_in"),
    )
    starts_here = F.col("_prev_t").isNotNull() & ~F.col("_t").eqNullSafe(F.col("_prev_t"))
    group_first = F.col("_prev_t").isNull()  # first row of its (key, chunk) group
    w_all = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select(
        "*",
        F.max(F.when(starts_here, seq)).over(w_run).alias("_start_in"),
        F.min(seq).over(w_run).alias("_first_in"),
        # the group's summary, kept on its first row only (same sorted pass, no extra sort)
        F.when(group_first, F.last("_t").over(w_all)).alias("_g_last_t"),
        F.when(group_first, F.max(F.when(starts_here, seq)).over(w_all)).alias("_g_last_start"),
    )
    # Two consumers follow (the chunk summary and the final filter).  The rows are written
    # once, as columns: data, flags and sequences, no tracked struct but one per group.
    rows = materialize(rows.select(
        *[_q(c) for c in cols], "_chunk", "_next_in", "_start_in", "_first_in", "_g_last_t", "_g_last_start",
        group_first.alias("_is_first"), F.col("_next_t").eqNullSafe(F.col("_t")).alias("_same_next")), "scd2-windows")

    # 3. chunk borders: per (key, chunk) summary, kept only for a chunk's first and last key
    per_kc = rows.where(F.col("_is_first")).select(
        *part,
        t.alias("_first_t"),
        F.col("_g_last_t").alias("_last_t"),
        seq.alias("_first_seq"),
        F.col("_g_last_start").alias("_last_start_in"),
    )
    kstruct = F.struct(*kcols)
    ends = per_kc.groupBy("_chunk").agg(F.min(kstruct).alias("_lo"), F.max(kstruct).alias("_hi"))
    edge = per_kc.join(ends, "_chunk").where(
        (kstruct == F.col("_lo")) | (kstruct == F.col("_hi"))
    ).drop("_lo", "_hi")
    wk = Window.partitionBy(*kcols).orderBy("_chunk")
    prev_last = F.lag("_last_t").over(wk)
    edge = edge.select(
        *part, "_first_seq",
        (prev_last.isNull() | ~F.col("_first_t").eqNullSafe(prev_last)).alias("_first_chg"),
        F.lead("_first_t").over(wk).alias("_next_chunk_t"),
        F.lead("_first_seq").over(wk).alias("_next_chunk_seq"),
        "_last_start_in",
    )
    chunk_last_start = F.coalesce(F.col("_last_start_in"), F.when(F.col("_first_chg"), F.col("_first_seq")))
    edge = edge.withColumn(
        "_carry", F.last(chunk_last_start, ignorenulls=True).over(wk.rowsBetween(Window.unboundedPreceding, -1))
    ).drop("_first_seq", "_last_start_in")

    # 4. versions = last row of each island (at most 2 edge rows per chunk; AQE broadcasts them by their measured size)
    j = rows.join(edge, [*keys, "_chunk"], "left")
    first_chg = F.coalesce(F.col("_first_chg"), F.lit(True))
    start = F.coalesce(F.col("_start_in"), F.when(first_chg, F.col("_first_in")), F.col("_carry"))
    is_last = F.when(
        F.col("_next_in").isNotNull(), ~F.col("_same_next")
    ).otherwise(F.col("_next_chunk_t").isNull() | ~F.col("_next_chunk_t").eqNullSafe(t))
    return j.where(is_last).select(
        *[_q(c) for c in cols],
        start.alias(START_AT),
        F.coalesce(F.col("_next_in"), F.col("_next_chunk_seq")).alias(END_AT),
    )


def latest_per_key(df: DataFrame, keys, order_by: str) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order_by DESC) = 1`` without the window.

    A grouped ``max(struct(order_by, rest))`` returns the same row per key
    (NULL keys form one group, NULL ``order_by`` sorts last as in ``DESC``; ties
    go to the greatest remaining columns) but is combined map-side, so a hot key
    is never sorted inside one task.
    """
    name = _resolver(df)
    keys = [name(k) for k in ([keys] if isinstance(keys, str) else list(keys))]
    order_by = name(order_by)
    others = [c for c in df.columns if c not in keys and c != order_by]
    best = F.max(F.struct(_q(order_by), *[_q(c) for c in others])).alias("_w")
    return (
        df.groupBy(*[_q(k) for k in keys])
        .agg(best)
        .select(*[_q(c) if c in keys else F.col("_w").getField(c).alias(c) for c in df.columns])
    )
