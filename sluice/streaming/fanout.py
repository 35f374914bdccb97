"""Incremental silver: bronze stream -> projection -> checks -> three sinks per micro-batch.

The stream carries the staged rows; ``foreachBatch`` checks each micro-batch
once (persisted) and writes valid rows, quarantine and a metrics entry, each
into its own partition of (writer's run, batch), then commits the three together
in the table's log (``sources.commits``): a replayed batch overwrites, what a
dead run left half-written is never read.  The checkpoint makes the whole thing restartable: a lost
executor only re-runs tasks, a lost driver resumes at the last committed batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.rules import schema_rule
from ..operators.quality import check
from ..plans.silver import SilverTable, stage, write_silver
from ..sources.commits import Commit, CommitLog
from ..sources.tables import Layout


def silver_stream(
    spark: SparkSession,
    table: SilverTable,
    bronze_stream: DataFrame,
    layout: Layout,
    available_now: bool = True,
    processing_time: str | None = None,
    validate_schema: bool = True,
    quarantine_warnings: bool | None = None,
    query_name: str | None = None,
    writer: str | None = None,
    reset: bool = False,
):
    """Start the silver stream of one table; returns the ``StreamingQuery``.

    ``writer`` (by default the query's name) owns what the stream writes.  Streams of different writers feed one
    table side by side.  A new checkpoint of the same writer starts a new run, whose rows replace those of its earlier runs
    for readers from its first commit on; only ``reset=True`` also deletes them (and rows that no stream has written).
    """
    if not bronze_stream.isStreaming:
        raise ValueError("silver_stream needs a streaming bronze DataFrame")
    staged = stage(spark, table, bronze_stream)
    rules = list(table.rules)
    if validate_schema and table.expected_schema is not None:
        rules.append(schema_rule(table.name, staged, table.expected_schema))
    name = query_name or f"silver_{table.target_table}"
    qw = table.quarantine_warnings if quarantine_warnings is None else quarantine_warnings

    target = table.target_table
    log = CommitLog(spark, layout, f"silver.{target}", [("silver", target), ("quarantine", f"{target}_quarantine"), ("metrics", f"{target}_metrics")])
    run = log.run(writer or name, layout.checkpoint_path(name))
    log.claim(reset)
    if reset:
        log.reset(run)

    def per_batch(batch_df: DataFrame, batch_id: int) -> None:
        checked = check(batch_df, rules, qw)
        write_silver(checked, layout, table, batch_id=batch_id, run_id=f"{name}:{batch_id}", run=run)
        log.commit(Commit(run, batch_id))

    writer = (
        staged.writeStream.queryName(layout.query_name(name))
        .foreachBatch(per_batch)
        .option("checkpointLocation", layout.checkpoint_path(name))
    )
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=available_now)
    return writer.start()
