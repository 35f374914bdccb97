"""Silver: bronze -> SQL projection -> exclude columns -> contract checks.

``silver_check`` returns a lazy ``Checked`` whose ``valid()`` is the silver
table, ``quarantine()`` the quarantine table and ``metrics()`` the ledger
entry.  ``write_silver`` fans one checked frame out to the three sinks: per
micro-batch by persisting the (bounded) batch once, for a whole table by one
observed scan for valid rows and counts plus one filtered scan for quarantine.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.binding import bind_sql, exclude_list, read_sql
from ..functions.contract import Contract, Rule, load_contract
from ..functions.rules import schema_rule
from ..operators.quality import Checked, check
from ..sources.commits import BATCH, RUN, Commit
from ..sources.tables import Layout

RESOURCES = os.path.join(os.path.dirname(os.path.dirname(__file__)), "resources")


def resource(*parts: str) -> str:
    return os.path.join(RESOURCES, *parts)


@dataclass
class SilverTable:
    name: str
    source_table: str
    target_table: str
    sql: str
    rules: list[Rule]
    expected_schema: object = None
    exclude_columns: list[str] = field(default_factory=list)
    primary_keys: list[str] = field(default_factory=list)
    origin: str = "<sql>"
    quarantine_warnings: bool = False  # registry key: warn-only rows also go to quarantine


def silver_tables(registry: dict, system: str, contract: Contract, sql_dir: str) -> list[SilverTable]:
    """Registry entries of one source system -> table definitions (rules resolved, SQL read)."""
    entries = ((registry or {}).get("tables") or {}).get(system) or {}
    out = []
    for name, cfg in entries.items():
        cfg = cfg or {}
        path = os.path.join(sql_dir, cfg.get("sql_file", f"{name}.sql"))
        out.append(
            SilverTable(
                name=name,
                source_table=cfg.get("source_table", name),
                target_table=cfg.get("target_table", name),
                sql=read_sql(path),
                rules=contract.rules_for(name),
                expected_schema=contract.schemas.get(name),
                exclude_columns=exclude_list(cfg.get("exclude_columns")),
                primary_keys=list(cfg.get("primary_keys") or []),
                origin=path,
                quarantine_warnings=bool(cfg.get("quarantine_warnings", False)),
            )
        )
    return out


def default_silver_tables() -> list[SilverTable]:
    import yaml

    with open(resource("registry", "silver.yml")) as fh:
        registry = yaml.safe_load(fh)
    contract = load_contract(resource("contracts", "core_silver.yml"))
    return silver_tables(registry, "core", contract, resource("sql", "silver"))


def stage(spark: SparkSession, table: SilverTable, bronze_df: DataFrame) -> DataFrame:
    """Projection (``__bronze__.t`` bound to the frame) and column exclusion."""
    staged = bind_sql(spark, table.sql, {"bronze": {table.source_table: bronze_df}}, origin=table.origin)
    if table.exclude_columns:
        clash = sorted({r.column for r in table.rules if r.column in set(table.exclude_columns)})
        if clash:
            raise ValueError(f"{table.name}: excluded column(s) {clash} are checked by the contract")
        staged = staged.drop(*table.exclude_columns)
    return staged


def silver_check(
    spark: SparkSession,
    table: SilverTable,
    bronze_df: DataFrame,
    validate_schema: bool = True,
    strict_schema: bool = False,
    quarantine_warnings: bool | None = None,
) -> Checked:
    staged = stage(spark, table, bronze_df)
    rules = list(table.rules)
    if validate_schema and table.expected_schema is not None:
        rules.append(schema_rule(table.name, staged, table.expected_schema, strict_schema))
    qw = table.quarantine_warnings if quarantine_warnings is None else quarantine_warnings
    return check(staged, rules, qw)


def locations(layout: Layout, table: SilverTable) -> tuple[str, str]:
    return layout.name("silver", table.target_table), layout.name("quarantine", f"{table.target_table}_quarantine")


def write_checked(checked: Checked, layout: Layout, layer: str, name: str, q_layer_name: tuple[str, str],
                  metrics_name: str, out_loc: str, q_loc: str, run_id: str | None = None) -> None:
    """Whole-table batch fan-out without caching the table.

    Job 1 writes the valid rows and observes all counts on the way (one scan);
    job 2 writes the quarantine (filter of the same plan); the ledger entry is
    built from the observed counts.  Nothing but the counts reaches the driver.
    """
    valid, obs = checked.observed()
    layout.write(valid, layer, name, mode="overwrite")
    # quarantine is a thin slice of every input split: rebalance it into well-sized files
    layout.write(checked.quarantine().hint("rebalance"), *q_layer_name, mode="overwrite")
    m = checked.metrics_from_counts(checked.flagged.sparkSession, obs.get, out_loc, q_loc, run_id)
    layout.write(m.coalesce(1), "metrics", metrics_name, mode="overwrite")


def write_silver(
    checked: Checked,
    layout: Layout,
    table: SilverTable,
    batch_id: int | None = None,
    run_id: str | None = None,
    run: str | None = None,
) -> None:
    """Write valid rows, quarantine and metrics of one check run.

    Whole table (``batch_id`` None): see ``write_checked`` (no cache).
    Micro-batch: the batch is persisted so the rules run once per row, and
    every output goes to its own ``_batch_id`` partition, overwritten on
    replay, so a replayed micro-batch replaces its earlier attempt instead of
    duplicating it.  With ``run`` (see ``CommitLog.run``) the partitions are
    those of that run, so several writers can feed the table.
    """
    out_loc, q_loc = locations(layout, table)
    run_id = run_id or str(uuid.uuid4())
    if batch_id is None:
        write_checked(checked, layout, "silver", table.target_table,
                      ("quarantine", f"{table.target_table}_quarantine"), f"{table.target_table}_metrics",
                      out_loc, q_loc, run_id)
        return
    c = checked.persist()
    try:
        outputs = [
            (c.valid(), "silver", table.target_table),
            (c.quarantine().hint("rebalance"), "quarantine", f"{table.target_table}_quarantine"),
            (c.metrics(out_loc, q_loc, run_id), "metrics", f"{table.target_table}_metrics"),
        ]
        for df, layer, name in outputs:
            if run is None:
                layout.write(df.withColumn(BATCH, F.lit(int(batch_id))), layer, name, mode="overwrite", partition_by=BATCH)
            else:
                layout.write(Commit(run, batch_id).stamp(df), layer, name, mode="overwrite", partition_by=[RUN, BATCH])
    finally:
        c.unpersist()
