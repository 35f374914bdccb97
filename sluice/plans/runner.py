"""End-to-end runs: silver for a source system, gold for a domain, global ledger.

``run_silver``   bronze -> silver / quarantine / per-table metrics, then the
                 system ledger ``<system>_quality_metrics``
``run_gold``     registry dispatch: gated materialized views, type 1 / type 2
                 tables (batch recompute, or incremental CDC streams), then
                 the domain ledger ``<domain>_gold_quality_metrics``
``run_global``   discovered ledgers -> ``global_quality_metrics``

Batch and streaming share the table definitions; streams run with
``availableNow`` (or a processing-time trigger) and are restartable from
their checkpoints under the layout root.
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..operators.quality import check, empty_metrics
from ..sources.tables import Layout
from . import ledger
from .gold import GoldSpec, apply_cdc, build_gold, gold_rules, gold_source, gold_view
from .silver import SilverTable, silver_check, write_checked, write_silver


# Each micro-batch is persisted once for the fan-out, so its size is bounded: on
# a 1000-executor cluster 256 GB is ~256 MB per executor, and 100 TB of backlog
# is ~400 batches (per-batch scheduling overhead stays small).
DEFAULT_STREAM_OPTIONS = {"maxBytesPerTrigger": str(256 * 1024**3)}


def _stream_of(spark: SparkSession, layout: Layout, layer: str, table: str, options: dict | None = None) -> DataFrame:
    """A layer table as a stream; ``options`` (``maxFilesPerTrigger`` / ``maxBytesPerTrigger``)
    bound each micro-batch, which bounds what one batch persists."""
    return layout.stream(spark, layer, table, DEFAULT_STREAM_OPTIONS if options is None else options)


def _entries(spark: SparkSession, layout: Layout, name: str, streamed: bool) -> DataFrame:
    """A table's ledger entry: five rows, folded over the micro-batches of a stream."""
    if streamed and not layout.exists(spark, "metrics", name):
        return empty_metrics(spark)  # no micro-batch yet
    entries = layout.read(spark, "metrics", name)
    return ledger.totals(entries) if streamed else entries


def run_silver(spark: SparkSession, layout: Layout, tables: list[SilverTable], system: str,
               bronze: dict[str, DataFrame] | None = None, streaming: bool = False,
               stream_options: dict | None = None) -> None:
    """Silver tables of one source system.

    ``bronze`` maps source table -> DataFrame (batch, or streaming when
    ``streaming``); by default bronze tables are read from the layout.
    """
    from ..streaming.fanout import silver_stream

    run_id = str(uuid.uuid4())
    for t in tables:
        if streaming:
            src = (bronze or {}).get(t.source_table)
            if src is None:
                src = _stream_of(spark, layout, "bronze", t.source_table, stream_options)
            q = silver_stream(spark, t, src, layout, query_name=f"silver_{system}_{t.target_table}")
            q.awaitTermination()
            if q.exception():
                raise q.exception()
        else:
            src = (bronze or {}).get(t.source_table)
            if src is None:
                src = layout.read(spark, "bronze", t.source_table)
            write_silver(silver_check(spark, t, src), layout, t, run_id=run_id)
    frames = [_entries(spark, layout, f"{t.target_table}_metrics", streaming) for t in tables]
    layout.write(ledger.union_ledgers(spark, frames), "metrics", ledger.system_ledger_name(system))


def run_gold(spark: SparkSession, layout: Layout, specs: list[GoldSpec], domain: str,
             streaming_cdc: bool = False, buckets: int | None = None, stream_options: dict | None = None,
             contract_dir: str | None = None) -> None:
    """Gold tables of one domain, in registry order (gold contracts from ``contract_dir``)."""
    from ..streaming.cdc import cdc_stream, cdc_view

    run_id = str(uuid.uuid4())
    gated, streamed = [], set()
    for spec in specs:
        silver = {t: layout.read(spark, "silver", t) for t in spec.sources if layout.exists(spark, "silver", t)}
        gold = {t: layout.read(spark, "gold", t) for t in spec.sources if layout.exists(spark, "gold", t)}
        op = spec.operation
        rules = gold_rules(spec, contract_dir, domain) if spec.apply_gate else None
        if op == "materialized_view":
            view = gold_view(spark, spec, silver, rules=rules, gold=gold, layout=layout)
            if view.checked is None:
                layout.write(view.staged, "gold", spec.target)
            else:
                # the view joins and de-duplicates: run that plan once, then split
                write_checked(view.checked.checkpointed(), layout, "gold", spec.target,
                              ("quarantine", f"{spec.target}_gold_quarantine"), f"{spec.target}_gold_metrics",
                              layout.name("gold", spec.target),
                              layout.name("quarantine", f"{spec.target}_gold_quarantine"), run_id)
                gated.append(spec.target)
        elif streaming_cdc:
            streams = {t: _stream_of(spark, layout, "silver", t, stream_options) for t in spec.sources}
            q = cdc_stream(spark, spec, streams, layout, buckets=buckets, rules=rules)
            q.awaitTermination()
            if q.exception():
                raise q.exception()
            layout.write(cdc_view(spark, spec, layout), "gold", spec.target)
            if spec.apply_gate:
                gated.append(spec.target)
                streamed.add(spec.target)
        elif spec.apply_gate:
            checked = check(gold_source(spark, spec, silver), rules if rules is not None else gold_rules(spec),
                            quarantine_warnings=bool(spec.cfg.get("quarantine_warnings", False))).checkpointed()
            passed = f"{spec.target}_gold_passed"  # the rows that go on to the CDC apply
            write_checked(checked, layout, "gold", passed, ("quarantine", f"{spec.target}_gold_quarantine"),
                          f"{spec.target}_gold_metrics", layout.name("gold", spec.target),
                          layout.name("quarantine", f"{spec.target}_gold_quarantine"), run_id)
            gated.append(spec.target)
            layout.write(apply_cdc(spec, layout.read(spark, "gold", passed)), "gold", spec.target)
        else:
            layout.write(build_gold(spark, spec, silver, rules=rules), "gold", spec.target)
    frames = [_entries(spark, layout, f"{t}_gold_metrics", t in streamed) for t in gated]
    layout.write(ledger.union_ledgers(spark, frames), "metrics", ledger.gold_ledger_name(domain))


def run_global(spark: SparkSession, layout: Layout) -> DataFrame:
    out = ledger.global_ledger(spark, layout)
    layout.write(out, "metrics", ledger.GLOBAL)
    return layout.read(spark, "metrics", ledger.GLOBAL)


def main(argv=None) -> None:
    """Run a project (or the bundled customer example) bronze -> silver -> gold -> ledgers."""
    parser = argparse.ArgumentParser(description="bronze -> silver -> gold -> ledgers")
    parser.add_argument("--root", help="layout root (default: a new folder under the scratch root)")
    parser.add_argument("--project", help="project folder (config/, contracts/, src/); default: bundled example")
    parser.add_argument("--system", default="core", help="source system key of the silver registry")
    parser.add_argument("--domain", default="customer", help="domain key of the gold registry")
    parser.add_argument("--sf-dir", help="fill the bronze layer from the driver's test tables first")
    parser.add_argument("--streaming", action="store_true", help="silver and CDC as availableNow streams")
    args = parser.parse_args(argv)

    from ..session import local_session, new_scratch_dir
    from ..sources import fixtures
    from .gold import default_gold_specs
    from .project import Project
    from .silver import default_silver_tables

    spark = local_session()
    layout = Layout(args.root or new_scratch_dir(spark, "run"))
    if args.sf_dir:
        for name in fixtures.BRONZE_SOURCES:
            layout.write(fixtures.bronze(spark, args.sf_dir, name), "bronze", name)
    if args.project:
        proj = Project(args.project)
        tables, specs = proj.silver_tables(args.system), proj.gold_specs(args.domain)
        contract_dir = f"{args.project}/contracts/02_gold/{args.domain}"
    else:
        tables, specs, contract_dir = default_silver_tables(), list(default_gold_specs().values()), None
    run_silver(spark, layout, tables, args.system, streaming=args.streaming)
    run_gold(spark, layout, specs, args.domain, streaming_cdc=args.streaming, contract_dir=contract_dir)
    run_global(spark, layout).groupBy("output_location").count().show(truncate=False)
    print(f"tables under {layout.root}")


if __name__ == "__main__":
    main()
