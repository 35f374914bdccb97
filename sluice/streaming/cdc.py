"""Streaming CDC: apply SCD type 1 / type 2 incrementally, state in bucketed parquet.

There is no MERGE on plain parquet, so the state is cut into buckets, ``_bucket = pmod(xxhash64(keys), B)``; a key lives
in exactly one bucket.  Per micro-batch:

1. optional gold gate: quarantine and metrics of the batch, continue with valid rows;
2. reduce the batch on its own (type 1: winners per key; type 2: rows per (key, seq));
3. read only the touched buckets of the state, union, reduce again;
4. write the new content of the touched buckets into folders of their own, once, and publish a manifest that
   names them (``sources.versions``): one rename makes the version visible, log and history together.

Both reductions obey ``f(f(A) ∪ B) = f(A ∪ B)``: the result does not depend on arrival order or batch boundaries, so
late and out-of-order rows are handled by ``sequence_by`` alone.  A run that dies before step 4's rename has changed
nothing; its replay starts over.  A batch that is already in the manifest is skipped.  Type 2 keeps the de-duplicated
change log (so a late row can split an old version) next to the history of the touched buckets; the consumer views
resolve the manifest and read ``current`` or ``history``.

The driver only ever receives the ids of touched buckets (at most B integers) and the manifest.
"""

from __future__ import annotations

import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import check
from ..operators.scd import _prepare, dedup_key_seq, scd1, scd2
from ..plans.gold import GoldSpec, gold_rules, gold_source
from ..sources.commits import BATCH, RUN, Commit, CommitLog
from ..sources.versions import BUCKET, VersionedState, has_versions
from ..sources.tables import Layout, delete_path, file_times, list_dirs, marker_names, path_exists, run_token, touch

# Fixed at state creation.  Pick it so one bucket holds ~128 MB - 1 GB of state:
# a micro-batch rewrites only the buckets its keys fall into.
DEFAULT_BUCKETS = 256
# Older versions kept for readers, and how long (registry keys cdc_keep_versions, cdc_keep_seconds): one is
# deleted when newer ones are enough and it is old enough for any reader of it to have ended.
KEEP_VERSIONS, KEEP_SECONDS = 8, 24 * 3600.0
# A broadcast goes through the driver in every micro-batch, so in sum the driver would get the whole stream, or
# the joined table once a batch: only a side that is really small may be broadcast.
BROADCAST_BYTES = 1 << 20
THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


def bucket_of(keys, buckets: int):
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


def check_bucket_count(spark: SparkSession, state_root: str, buckets: int) -> None:
    """The bucket count is fixed when the state is created (a key must stay in one bucket)."""
    found = marker_names(spark, state_root, "_BUCKETS_")
    if not found:
        touch(spark, f"{state_root}/_BUCKETS_{buckets}")
    elif found != [f"_BUCKETS_{buckets}"]:
        raise ValueError(f"CDC state {state_root} was created with {found[0][9:]} buckets, not {buckets}")


def _touched(spark: SparkSession, df: DataFrame) -> list[int]:
    return [r[0] for r in df.select(BUCKET).distinct().collect()]


def _dedup_log(df: DataFrame, keys, sequence_by: str) -> DataFrame:
    """One row per (key, sequence): the greatest remaining columns win (as in ``scd2``)."""
    return dedup_key_seq(df.drop(BUCKET), keys, sequence_by)


def _merge(spark, reduced: DataFrame, state_root: str, part: str, keys, buckets: int, batch_id, again, follow=None) -> None:
    """Fold the reduced rows of a batch into the buckets of ``part`` they fall into, and publish.

    ``again`` reduces old and new rows together; ``follow`` gives the rows of a second part from those of the first.
    """
    state = VersionedState(spark, state_root)
    base = state.manifest()
    batch = None if batch_id is None else str(batch_id)
    if batch and base.batch == batch:
        return  # a replay: this version is already published
    placed = lambda df: df.withColumn(BUCKET, bucket_of(keys, buckets))
    rows = placed(reduced).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        touched = _touched(spark, rows)
        if not touched:
            return
        old = state.rows(part, touched, base.version)
        fresh = rows if old is None else placed(again(old.unionByName(rows.drop(BUCKET))))
        folders = {part: state.write(fresh, part)}
    finally:
        rows.unpersist()
    if follow:
        name, made = follow
        folders[name] = state.write(placed(made(state.written(part, folders[part]).drop(BUCKET))), name)
    state.publish(base, batch, folders, sorted(touched), buckets)


def merge_scd1(spark, batch_df, state_root, keys, sequence_by, except_columns=(), buckets=DEFAULT_BUCKETS, batch_id=None):
    keys = [keys] if isinstance(keys, str) else list(keys)
    check_bucket_count(spark, state_root, buckets)
    _merge(spark, scd1(batch_df, keys, sequence_by, except_columns), state_root, "current", keys, buckets, batch_id,
           lambda both: scd1(both, keys, sequence_by))


def merge_scd2(spark, batch_df, state_root, keys, sequence_by, except_columns=(), track_history_columns=None,
               track_history_except_columns=None, buckets=DEFAULT_BUCKETS, batch_id=None):
    keys = [keys] if isinstance(keys, str) else list(keys)
    check_bucket_count(spark, state_root, buckets)
    d, _ = _prepare(batch_df, keys, sequence_by, except_columns)
    _merge(spark, _dedup_log(d, keys, sequence_by), state_root, "log", keys, buckets, batch_id,
           lambda both: _dedup_log(both, keys, sequence_by),
           ("history", lambda log: scd2(log, keys, sequence_by, track_history_columns=track_history_columns,
                                        track_history_except_columns=track_history_except_columns, stored=True)))


def state_rows(spark: SparkSession, state_root: str, part: str) -> DataFrame | None:
    """Rows of a part of a merge-on-write state (``current``; ``log``, ``history``) in its newest version."""
    return VersionedState(spark, state_root).rows(part)


# -- merge-on-read: per batch only the batch's own rows; compaction every N batches ----------
DELTA_BATCH = "_cdc_batch"


def _reduce(df: DataFrame, op: str, keys, sequence_by: str) -> DataFrame:
    """Type 1: winners per key; type 2: one row per (key, sequence).  Both obey f(f(A) ∪ B) = f(A ∪ B)."""
    return scd1(df, keys, sequence_by) if op == "delta_type1" else _dedup_log(df, keys, sequence_by)


def _base_version(spark: SparkSession, state_root: str) -> int | None:
    """The newest complete compaction (``base/v=N`` with ``_SUCCESS``), or None."""
    done = [int(n[2:]) for n in list_dirs(spark, f"{state_root}/base")
            if n.startswith("v=") and path_exists(spark, f"{state_root}/base/{n}/_SUCCESS")]
    return max(done) if done else None


def mor_rows(spark: SparkSession, state_root: str, upto: int | None = None) -> DataFrame | None:
    """Base (newest complete version) plus the deltas written after it (up to ``upto``)."""
    v = _base_version(spark, state_root)
    parts = []
    if v is not None:
        parts.append(spark.read.parquet(f"{state_root}/base/v={v}"))
    if path_exists(spark, f"{state_root}/deltas"):
        d = spark.read.parquet(f"{state_root}/deltas")
        if v is not None:
            d = d.where(F.col(DELTA_BATCH) > v)
        if upto is not None:
            d = d.where(F.col(DELTA_BATCH) <= upto)
        parts.append(d.drop(DELTA_BATCH))
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def append_delta(spark, batch_df, state_root, op, keys, sequence_by, except_columns=(), batch_id=0,
                 compact_every: int = 10) -> None:
    """Merge-on-read step: write the batch's reduced rows (O(batch)); compact every ``compact_every`` batches."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    d, _ = _prepare(batch_df, keys, sequence_by, except_columns)
    (_reduce(d, op, keys, sequence_by).withColumn(DELTA_BATCH, F.lit(int(batch_id)))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DELTA_BATCH)
     .parquet(f"{state_root}/deltas"))
    if compact_every and (int(batch_id) + 1) % compact_every == 0:
        compact(spark, state_root, op, keys, sequence_by, upto=int(batch_id))


def compact(spark, state_root, op, keys, sequence_by, upto: int) -> None:
    """New base version ``v=upto`` = reduce(base ∪ deltas <= upto); complete once its _SUCCESS exists."""
    if path_exists(spark, f"{state_root}/base/v={upto}/_SUCCESS"):
        return  # a replayed batch: this version is already complete
    rows = mor_rows(spark, state_root, upto=upto)
    if rows is None:
        return
    _reduce(rows, op, keys, sequence_by).write.mode("overwrite").parquet(f"{state_root}/base/v={upto}")


def run_offset(spark: SparkSession, state_root: str, token: str) -> int:
    """Number of the first batch of this run: after every delta and base that earlier runs have written."""
    mine = marker_names(spark, state_root, f"_RUN_{token}_")
    if mine:
        return int(mine[0].rsplit("_", 1)[1])
    used = [int(n.split("=")[1]) for n in list_dirs(spark, f"{state_root}/deltas", prefix=f"{DELTA_BATCH}=")]
    used += [int(n[2:]) for n in list_dirs(spark, f"{state_root}/base") if n.startswith("v=")]
    offset = max(used, default=-1) + 1
    touch(spark, f"{state_root}/_RUN_{token}_{offset}")
    return offset


def prune(spark: SparkSession, state_root: str, keep: int = 1, min_age_s: float = 0) -> list[str]:
    """Delete what the newest version makes obsolete, keeping ``keep`` older ones; either mode.

    What is younger than ``min_age_s`` seconds stays (see ``VersionedState.prune``).  Readers that started before the last compaction still find their base and
    deltas (they belong to a kept version).  Returns the deleted paths.
    """
    if has_versions(spark, state_root):
        return VersionedState(spark, state_root).prune(keep, min_age_s)
    versions = sorted(int(n[2:]) for n in list_dirs(spark, f"{state_root}/base")
                      if n.startswith("v=") and path_exists(spark, f"{state_root}/base/{n}/_SUCCESS"))
    if len(versions) <= keep:
        return []
    floor = versions[-1 - keep]  # everything up to this version is covered by every kept base
    doomed = [f"{state_root}/base/v={v}" for v in versions[: -1 - keep]]
    doomed += [f"{state_root}/deltas/{n}" for n in list_dirs(spark, f"{state_root}/deltas", prefix=f"{DELTA_BATCH}=")
               if int(n.split("=")[1]) <= floor]
    if min_age_s:
        ages = file_times(spark, f"{state_root}/base") | file_times(spark, f"{state_root}/deltas")
        doomed = [p for p in doomed if time.time() - ages.get(p.rsplit("/", 1)[1], time.time()) >= min_age_s]
    for path in doomed:
        delete_path(spark, path)
    return doomed


def _declare(spark: SparkSession, source: DataFrame, state_root: str) -> None:
    """Keep the source's columns as an empty table, so that a target without rows still has a typed view."""
    path = f"{state_root}/declared"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        spark.createDataFrame([], source.schema).write.mode("overwrite").parquet(path)


def cdc_stream(
    spark: SparkSession,
    spec: GoldSpec,
    silver_streams: dict[str, DataFrame],
    layout: Layout,
    buckets: int | None = None,
    rules=None,
    available_now: bool = True,
    processing_time: str | None = None,
    query_name: str | None = None,
    mode: str | None = None,
    compact_every: int | None = None,
    writer: str | None = None,
    reset: bool = False,
):
    """Start the CDC stream of a ``delta_type1`` / ``delta_type2`` registry entry.

    ``mode="merge_on_write"`` keeps the current rows / history up to date per
    batch (bucketed rewrite); ``mode="merge_on_read"`` writes only each batch's
    reduced rows and compacts every ``compact_every`` batches; the view then
    applies the SCD over base and deltas.

    Of the sources, any may be static frames (joined as Spark joins a stream
    with a table).  Several streams need a watermark each: registry key
    ``watermarks``, table -> ``{column, delay}``.

    The gate's quarantine and metrics belong to ``writer`` (by default the
    target, whatever the query's name): what a new checkpoint checks again replaces
    what its earlier runs have written, see ``silver_stream``.
    """
    mode = mode or spec.cfg.get("cdc_mode", "merge_on_write")
    compact_every = int(compact_every or spec.cfg.get("cdc_compact_every", 10))
    if mode not in ("merge_on_write", "merge_on_read"):
        raise ValueError(f"mode must be merge_on_write or merge_on_read, got {mode!r}")
    op = spec.operation
    if op not in ("delta_type1", "delta_type2"):
        raise ValueError(f"cdc_stream needs delta_type1 or delta_type2, '{spec.name}' is {op}")
    keys, seq = spec.cfg.get("keys"), spec.cfg.get("sequence_by")
    if not keys:
        raise ValueError(f"gold table '{spec.name}': {op} needs keys")
    if not seq:
        raise ValueError(f"gold table '{spec.name}': {op} needs sequence_by")
    if "__gold__." in spec.sql:
        raise ValueError(f"'{spec.name}': a streaming CDC source cannot read __gold__ tables")
    bound = {t: silver_streams[t] for t in spec.sources if t in silver_streams}
    streamed = [t for t, df in bound.items() if df.isStreaming]
    if not streamed:
        raise ValueError("cdc_stream needs streaming silver sources")
    marks = spec.cfg.get("watermarks") or {}
    if set(marks) - set(streamed):
        raise ValueError(f"'{spec.name}': watermarks on tables that are no streaming source: {sorted(set(marks) - set(streamed))}")
    if len(streamed) > 1 and set(marks) != set(streamed):
        raise ValueError(f"'{spec.name}': a CDC source joining several streams needs a watermark on each (registry key watermarks)")
    source = gold_source(spark, spec, bound | {t: bound[t].withWatermark(m["column"], m["delay"]) for t, m in marks.items()})
    if not source.isStreaming:
        raise ValueError(f"'{spec.name}': the CDC source reads no stream")
    gate_rules = (rules if rules is not None else gold_rules(spec)) if spec.apply_gate else None
    excluded = spec.cfg.get("except_columns") or []
    buckets = int(buckets or spec.cfg.get("cdc_buckets") or DEFAULT_BUCKETS)
    keep, keep_s = int(spec.cfg.get("cdc_keep_versions", KEEP_VERSIONS)), float(spec.cfg.get("cdc_keep_seconds", KEEP_SECONDS))
    state_root = layout.state_path(spec.cdc_target)
    _declare(spark, source, state_root)
    name = query_name or f"cdc_{spec.cdc_target}"
    token = run_token(spark, layout.checkpoint_path(name))
    gate_tables = [("quarantine", f"{spec.target}_gold_quarantine"), ("metrics", f"{spec.target}_gold_metrics")]
    if gate_rules:
        log = CommitLog(spark, layout, f"gold.{spec.target}", gate_tables)
        run = log.run(writer or spec.target, layout.checkpoint_path(name))
        log.claim(reset)
        if reset:
            log.reset(run)

    def per_batch(batch_df: DataFrame, batch_id: int) -> None:
        checked = None
        if gate_rules:
            checked = check(batch_df, gate_rules).persist()
            at = Commit(run, batch_id)
            layout.write(at.stamp(checked.quarantine()), *gate_tables[0], mode="overwrite", partition_by=[RUN, BATCH])
            m = checked.metrics(layout.name("gold", spec.target), layout.name(*gate_tables[0]), f"{name}:{batch_id}")
            layout.write(at.stamp(m), *gate_tables[1], mode="overwrite", partition_by=[RUN, BATCH])
            log.commit(at)
            batch_df = checked.valid()
        staged_as = f"{token}-{batch_id}"  # another run's batch of the same number is another batch
        try:
            if mode == "merge_on_read":
                append_delta(spark, batch_df, state_root, op, keys, seq, excluded,
                             run_offset(spark, state_root, token) + batch_id, compact_every)
            elif op == "delta_type1":
                merge_scd1(spark, batch_df, state_root, keys, seq, excluded, buckets, staged_as)
            else:
                merge_scd2(spark, batch_df, state_root, keys, seq, excluded,
                           spec.cfg.get("track_history_columns"), spec.cfg.get("track_history_except_columns"),
                           buckets, staged_as)
        finally:
            if checked is not None:
                checked.unpersist()
        prune(spark, state_root, keep, keep_s)

    writer = source.writeStream.queryName(layout.query_name(name)).foreachBatch(per_batch).option(
        "checkpointLocation", layout.checkpoint_path(name))
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=available_now)
    before = spark.conf.get(THRESHOLD)
    allowed = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    spark.conf.set(THRESHOLD, min(allowed, BROADCAST_BYTES))  # the stream keeps the settings of its start
    try:
        return writer.start()
    finally:
        spark.conf.set(THRESHOLD, before)


def cdc_view(spark: SparkSession, spec: GoldSpec, layout: Layout) -> DataFrame:
    """The consumer view over the CDC state (current rows or history), either mode."""
    root = layout.state_path(spec.cdc_target)
    rows = state_rows(spark, root, "current" if spec.operation == "delta_type1" else "history")
    if rows is not None:
        return rows
    rows, excluded = mor_rows(spark, root), []
    if rows is None:  # no batch yet
        if not path_exists(spark, f"{root}/declared/_SUCCESS"):
            raise ValueError(f"no CDC state for '{spec.name}' under {root}")
        rows, excluded = spark.read.parquet(f"{root}/declared"), spec.cfg.get("except_columns") or []
    keys, seq = spec.cfg["keys"], spec.cfg["sequence_by"]
    if spec.operation == "delta_type1":
        return scd1(rows, keys, seq, excluded)
    return scd2(rows, keys, seq, excluded, track_history_columns=spec.cfg.get("track_history_columns"),
                track_history_except_columns=spec.cfg.get("track_history_except_columns"))
