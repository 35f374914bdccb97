"""

Every query reads the driver's tables (through the bronze mapping of
FIXTURES.md) in full.  Timestamps are returned as ``timestamp_ntz`` (UTC wall
clock) so they compare with DuckDB's plain TIMESTAMP; non-deterministic audit
columns (``processed_time``, ``run_id``, ``run_time``) are left out of compared
results.
"""

from __future__ import annotations

import dataclasses
import functools
import os
import sys
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_duckdb as O  # noqa: E402
from sluice.functions.binding import bind_sql  # noqa: E402
from sluice.operators.joins import left_join_many  # noqa: E402
from sluice.operators.quality import ERRORS, WARNINGS  # noqa: E402
from sluice.operators.scd import latest_per_key, scd1, scd2  # noqa: E402
from sluice.plans import ledger  # noqa: E402
from sluice.plans.gold import build_gold, default_gold_specs, gold_view  # noqa: E402
from sluice.plans.silver import default_silver_tables, locations, silver_check, stage  # noqa: E402
from sluice.session import new_scratch_dir  # noqa: E402
from sluice.sources import fixtures  # noqa: E402
from sluice.sources.tables import Layout  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
ACCOUNT, PROFILE, EMAIL = "customer_account", "customer_profile", "customer_email_contact"
CONTACT, SUMMARY = "customer_contact_summary", "customer_account_profile_summary"
CURRENT, HISTORY = "customer_email_contact_current", "customer_email_contact_history"
EMAIL_TRACKED = ["EMAIL_ADDRESS", "EMAIL_STATUS", "PREFERRED_EMAIL_FLAG"]
LEDGER_COLS = ["output_location", "quarantine_location", "metric_name", "metric_value"]


# -- helpers -------------------------------------------------------------------
def _prepare(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _ntz(df: DataFrame) -> DataFrame:
    """TIMESTAMP -> TIMESTAMP_NTZ (UTC wall clock), comparable with DuckDB TIMESTAMP."""
    return df.select(*[
        F.col(f"`{f.name}`").cast(T.TimestampNTZType()).alias(f.name) if isinstance(f.dataType, T.TimestampType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


@functools.lru_cache(maxsize=1)
def _table_defs():
    return tuple(default_silver_tables())


def _tables():
    return {t.name: dataclasses.replace(t) for t in _table_defs()}


@functools.lru_cache(maxsize=1)
def _gold_specs():
    return default_gold_specs()


def _checked(spark, sf, name):
    _prepare(spark)
    return silver_check(spark, _tables()[name], fixtures.bronze(spark, sf, name))


class _Silver(Mapping):
    """Silver tables of one run, each built on first use."""

    def __init__(self, spark, sf):
        self.spark, self.sf, self.built = spark, sf, {}

    def __getitem__(self, name):
        if name not in (ACCOUNT, PROFILE, EMAIL):
            raise KeyError(name)
        if name not in self.built:
            self.built[name] = _checked(self.spark, self.sf, name).valid()
        return self.built[name]

    def __iter__(self):
        return iter((ACCOUNT, PROFILE, EMAIL))

    def __len__(self):
        return 3


def _silver(spark, sf) -> Mapping:
    return _Silver(spark, sf)


def _no_stamp(df: DataFrame) -> DataFrame:
    return _ntz(df.drop("processed_time", "_batch_id"))


def _report(df: DataFrame) -> DataFrame:
    """Quarantine rows with the names of the failed rules joined by commas."""
    return _no_stamp(
        df.withColumn("error_names", F.array_join(F.transform(ERRORS, lambda x: x["name"]), ","))
        .withColumn("warning_names", F.array_join(F.transform(WARNINGS, lambda x: x["name"]), ","))
        .drop(ERRORS, WARNINGS)
    )


def _gold(spark, sf, name):
    return gold_view(spark, _gold_specs()[name], _silver(spark, sf))


def _silver_ledger(spark, sf) -> DataFrame:
    layout = Layout("unused")
    frames = []
    for name in (ACCOUNT, PROFILE, EMAIL):
        out_loc, q_loc = locations(layout, _tables()[name])
        frames.append(_checked(spark, sf, name).metrics(out_loc, q_loc))
    return ledger.union_ledgers(spark, frames)


def _gold_ledger(spark, sf) -> DataFrame:
    layout = Layout("unused")
    return ledger.union_ledgers(spark, [_gold(spark, sf, n).metrics(layout) for n in (CONTACT, SUMMARY)])


# -- batch queries ---------------------------------------------------------------
def q_scan_account(spark, sf):
    _prepare(spark)
    return fixtures.bronze(spark, sf, ACCOUNT)


def q_silver_account(spark, sf):
    return _no_stamp(_silver(spark, sf)[ACCOUNT])


def q_silver_profile(spark, sf):
    return _no_stamp(_silver(spark, sf)[PROFILE])


def q_silver_email(spark, sf):
    return _no_stamp(_silver(spark, sf)[EMAIL])


def q_audit_stamp(spark, sf):
    v = _silver(spark, sf)[ACCOUNT]
    return v.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("processed_time").alias("n_stamps"),
                 F.min(F.col("processed_time").isNotNull()).alias("stamped"))


def q_exclude_columns(spark, sf):
    _prepare(spark)
    t = _tables()[ACCOUNT]
    t.exclude_columns = ["processed_time", "NOT_A_COLUMN"]  # blanks ignored, missing columns ignored
    return _ntz(silver_check(spark, t, fixtures.bronze(spark, sf, ACCOUNT)).valid())


def _counts(name):
    def run(spark, sf):
        return _checked(spark, sf, name).counts().select(
            "input_row_count", "valid_row_count", "error_row_count", "warning_row_count")
    return run


def _rule_counts(name):
    return lambda spark, sf: _checked(spark, sf, name).rule_counts()


def _quarantine(name):
    return lambda spark, sf: _report(_checked(spark, sf, name).quarantine())


def q_quarantine_account_warnings(spark, sf):
    """Quarantine that also takes warn-only rows (option of the split)."""
    _prepare(spark)
    t = _tables()[ACCOUNT]
    return _report(silver_check(spark, t, fixtures.bronze(spark, sf, ACCOUNT), quarantine_warnings=True).quarantine())


def q_dq_warn_account(spark, sf):
    c = _checked(spark, sf, ACCOUNT)
    rows = c.annotated().where(F.size(ERRORS) == 0).where(F.size(WARNINGS) > 0)
    return _report(rows)


def q_dq_profile_rules(spark, sf):
    return _report(_checked(spark, sf, PROFILE).annotated())


def q_schema_check(spark, sf):
    """Schema validation: matching projections pass; a TIMESTAMP_NTZ UPDATED_AT fails every row."""
    _prepare(spark)
    out = []
    for name in (ACCOUNT, PROFILE, EMAIL):
        rc = _checked(spark, sf, name).rule_counts().where(F.col("rule_name").endswith("_schema_validation"))
        out.append(rc.select(F.lit(name).alias("table_name"), "failed_rows"))
    t = _tables()[EMAIL]
    raw = fixtures.bronze(spark, sf, EMAIL).withColumn("UPDATED_AT", F.col("UPDATED_AT").cast(T.TimestampNTZType()))
    rc = silver_check(spark, t, raw).rule_counts().where(F.col("rule_name").endswith("_schema_validation"))
    out.append(rc.select(F.lit("customer_email_contact_ntz").alias("table_name"), "failed_rows"))
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res


def q_join_account_profile(spark, sf):
    s = _silver(spark, sf)
    a = s[ACCOUNT].select("ACCOUNT_ID", "CUSTOMER_ID", "ACCOUNT_STATUS")
    p = s[PROFILE].select("CUSTOMER_ID", "FIRST_NAME", "LAST_NAME", "ORG_NAME", "CUSTOMER_TYPE")
    return a.join(p, "CUSTOMER_ID", "left")


def q_join_account_email(spark, sf):
    s = _silver(spark, sf)
    a = s[ACCOUNT].select("ACCOUNT_ID", "ACCOUNT_STATUS")
    e = s[EMAIL].select("ACCOUNT_ID", "EMAIL_ADDRESS", "EMAIL_STATUS", "UPDATED_AT")
    return _ntz(left_join_many(a, e, "ACCOUNT_ID"))


def q_hash_id(spark, sf):
    s = _silver(spark, sf)
    sql = ("SELECT DISTINCT CUSTOMER_ID, SHA2(CUSTOMER_ID, ${HASH_BITS}) AS CUSTOMER_ID_ENCRYPTED "
           "FROM __silver__.customer_account")
    return bind_sql(spark, sql, {"silver": {ACCOUNT: s[ACCOUNT]}}, {"HASH_BITS": "256"})


def q_gold_profile_summary(spark, sf):
    return _gold(spark, sf, SUMMARY).staged


def q_display_name(spark, sf):
    return _gold(spark, sf, SUMMARY).staged.select("ACCOUNT_ID", "CUSTOMER_TYPE", "CUSTOMER_DISPLAY_NAME")


def q_gold_contact_summary(spark, sf):
    return _gold(spark, sf, CONTACT).output()


def q_gold_contact_staged(spark, sf):
    return _gold(spark, sf, CONTACT).staged


def q_gold_contact_quarantine(spark, sf):
    return _report(_gold(spark, sf, CONTACT).quarantine())


def q_gold_contact_unvalidated_quarantine(spark, sf):
    """The contact gate over rows that no silver rule has seen, so that its own rules have work to do."""
    _prepare(spark)
    staged = {n: stage(spark, t, fixtures.bronze(spark, sf, n)) for n, t in _tables().items()}
    return _report(gold_view(spark, _gold_specs()[CONTACT], staged).quarantine())


def q_param_text(spark, sf):
    """Parameters inside a literal, as a list, as part of a name, and as a number of its own."""
    sql = ("SELECT ACCOUNT_ID AS ACCOUNT_${SUFFIX}, 'v${N}' AS TAG, CAST(${N} AS BIGINT) AS N, ACCOUNT_STATUS "
           "FROM __silver__.customer_account WHERE ACCOUNT_STATUS IN ${STATES}")
    params = {"SUFFIX": "NO", "N": "256", "STATES": "('ACTIVE', 'CLOSED')"}
    return bind_sql(spark, sql, {"silver": {ACCOUNT: _silver(spark, sf)[ACCOUNT]}}, params)


def q_gold_sql_reach(spark, sf):
    """Gold as SQL text: three silver tables joined, and two whole predicates as parameters of the registry entry."""
    from sluice.plans.gold import GoldSpec

    text = f"""
        SELECT a.SERVICE_STATE, p.CUSTOMER_TYPE, count(*) AS CONTACTS, count(DISTINCT a.ACCOUNT_ID) AS ACCOUNTS,
               count_if(e.EMAIL_STATUS = 'VALID') AS VALID_CONTACTS, min(a.OPEN_DATE) AS OLDEST
        FROM __silver__.{ACCOUNT} a
        JOIN __silver__.{PROFILE} p ON p.CUSTOMER_ID = a.CUSTOMER_ID
        LEFT JOIN __silver__.{EMAIL} e ON e.ACCOUNT_ID = a.ACCOUNT_ID
        WHERE ${{ACCOUNT_FILTER}} AND (${{EMAIL_FILTER}})
        GROUP BY ALL"""
    params = {"ACCOUNT_FILTER": "a.ACCOUNT_STATUS IN ('ACTIVE', 'INACTIVE')", "EMAIL_FILTER": "e.PREFERRED_EMAIL_FLAG = 'Y' OR e.ACCOUNT_ID IS NULL"}
    spec = GoldSpec("contact_reach", {"sql_parameters": params}, text, "contact_reach.sql", [ACCOUNT, PROFILE, EMAIL])
    return _ntz(gold_view(spark, spec, _silver(spark, sf)).output())


def q_gold_profile_gated(spark, sf):
    return _gold(spark, sf, SUMMARY).output()


def q_gold_profile_quarantine(spark, sf):
    return _report(_gold(spark, sf, SUMMARY).quarantine())


def q_silver_metrics(spark, sf):
    return _silver_ledger(spark, sf).select(*LEDGER_COLS)


def q_gold_metrics(spark, sf):
    return _gold_ledger(spark, sf).select(*LEDGER_COLS)


def q_global_metrics(spark, sf):
    """Write both ledgers, discover them by suffix, union (S-14, U-03)."""
    layout = Layout(new_scratch_dir(spark, "ledgers"))
    layout.write(_silver_ledger(spark, sf), "metrics", ledger.system_ledger_name("core"))
    layout.write(_gold_ledger(spark, sf), "metrics", ledger.gold_ledger_name("customer"))
    return ledger.global_ledger(spark, layout).select(*LEDGER_COLS)


def q_latest_per_account(spark, sf):
    return _no_stamp(latest_per_key(_silver(spark, sf)[EMAIL], "ACCOUNT_ID", "UPDATED_AT"))


def q_scd1_current(spark, sf):
    return _ntz(build_gold(spark, _gold_specs()[CURRENT], _silver(spark, sf)))


def _gated_scd1(spark, sf) -> Layout:
    """A batch run of a gated type 1 entry over unvalidated contacts: table, quarantine and ledger are written."""
    from sluice.plans.runner import run_gold
    from sluice.plans.silver import resource

    _prepare(spark)
    layout = Layout(new_scratch_dir(spark, "gated-scd1"))
    layout.write(stage(spark, _tables()[EMAIL], fixtures.bronze(spark, sf, EMAIL)), "silver", EMAIL)
    spec = _gold_specs()[CURRENT]
    cfg = {**spec.cfg, "quality_gate": True, "contract_file": "core_silver.yml"}
    # the entry takes the name of the contract's table, whose rules are the silver ones
    run_gold(spark, layout, [dataclasses.replace(spec, name=EMAIL, cfg=cfg)], "customer", contract_dir=resource("contracts"))
    return layout


def q_scd1_gated(spark, sf):
    return _ntz(_gated_scd1(spark, sf).read(spark, "gold", CURRENT))


def q_scd1_gated_quarantine(spark, sf):
    return _report(_gated_scd1(spark, sf).read(spark, "quarantine", f"{CURRENT}_gold_quarantine"))


def q_scd2_history(spark, sf):
    return _ntz(build_gold(spark, _gold_specs()[HISTORY], _silver(spark, sf)))


def q_scd2_tracked(spark, sf):
    e = _silver(spark, sf)[EMAIL]
    return _ntz(scd2(e, ["ACCOUNT_ID"], "UPDATED_AT", ["processed_time"], track_history_columns=EMAIL_TRACKED))


def q_scd2_tracked_except(spark, sf):
    e = _silver(spark, sf)[EMAIL]
    return _ntz(scd2(e, ["ACCOUNT_ID"], "UPDATED_AT", ["processed_time"], track_history_except_columns=["UPDATED_AT"]))


def _hot_email(spark, sf):
    """Silver email rows where one account holds a third of all rows (derived from events)."""
    _prepare(spark)
    t = _tables()[EMAIL]
    ev = fixtures.read_table(spark, sf, "events")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    return silver_check(spark, t, fixtures.email_from_events(hot)).valid()


def q_scd1_hot_account(spark, sf):
    return _ntz(scd1(_hot_email(spark, sf), ["ACCOUNT_ID"], "UPDATED_AT", ["processed_time"]))


def q_scd2_hot_account(spark, sf):
    e = _hot_email(spark, sf)
    return _ntz(scd2(e, ["ACCOUNT_ID"], "UPDATED_AT", ["processed_time"], track_history_columns=EMAIL_TRACKED))


# -- streaming queries (availableNow into a fresh scratch folder, then read back) ---
def _run(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def _stream_silver_email(spark, sf, layout, max_files=None):
    from sluice.streaming.fanout import silver_stream

    _prepare(spark)
    t = _tables()[EMAIL]
    _run(silver_stream(spark, t, fixtures.bronze_stream(spark, sf, EMAIL, max_files), layout))
    return t


def q_stream_silver_email(spark, sf):
    layout = Layout(new_scratch_dir(spark, "stream-silver"))
    _stream_silver_email(spark, sf, layout)
    return _no_stamp(layout.read(spark, "silver", EMAIL))


def q_stream_quarantine_email(spark, sf):
    layout = Layout(new_scratch_dir(spark, "stream-quarantine"))
    _stream_silver_email(spark, sf, layout)
    return _report(layout.read(spark, "quarantine", f"{EMAIL}_quarantine"))


def q_stream_metrics(spark, sf):
    """Per-micro-batch ledger entries of the silver stream, folded into the whole-table entry."""
    layout = Layout(new_scratch_dir(spark, "stream-metrics"))
    _stream_silver_email(spark, sf, layout)
    return ledger.totals(layout.read(spark, "metrics", f"{EMAIL}_metrics")).select(*LEDGER_COLS)


def q_stream_silver_restart(spark, sf):
    """Silver read again from a new checkpoint and in other batches: the rows are those of one run."""
    from sluice.streaming.fanout import silver_stream

    _prepare(spark)
    t, layout, src = _tables()[EMAIL], Layout(new_scratch_dir(spark, "silver-restart")), new_scratch_dir(spark, "restart-src")
    bronze = fixtures.bronze(spark, sf, EMAIL)
    bronze.withColumn("slice", F.pmod(F.xxhash64("ACCOUNT_ID", "UPDATED_AT"), F.lit(3))).write.mode("append").partitionBy("slice").parquet(src)
    for name, files in (("first", 1), ("second", 2)):
        stream = spark.readStream.schema(bronze.schema).option("maxFilesPerTrigger", files).parquet(f"{src}/slice=*")
        _run(silver_stream(spark, t, stream, layout, query_name=name, writer="email"))
    return _no_stamp(layout.read(spark, "silver", EMAIL))


def q_stream_silver_two_writers(spark, sf):
    """Two streams feed one silver table, each with half of the rows; one starts again from a new checkpoint, in other batches."""
    from sluice.streaming.fanout import silver_stream

    _prepare(spark)
    t, layout, src = _tables()[EMAIL], Layout(new_scratch_dir(spark, "two-writers")), new_scratch_dir(spark, "two-writers-src")
    bronze = fixtures.bronze(spark, sf, EMAIL)
    bronze.withColumn("slice", F.pmod(F.xxhash64("ACCOUNT_ID", "UPDATED_AT"), F.lit(4))).write.mode("append").partitionBy("slice").parquet(src)
    for writer, name, slices, files in (("east", "east", "[01]", 1), ("west", "west", "[23]", 2), ("east", "east_again", "[01]", 2)):
        stream = spark.readStream.schema(bronze.schema).option("maxFilesPerTrigger", files).parquet(f"{src}/slice={slices}")
        _run(silver_stream(spark, t, stream, layout, query_name=name, writer=writer))
    return _no_stamp(layout.read(spark, "silver", EMAIL))


MICRO_BATCHES = 5  # a stored table is streamed in at most so many


def _silver_as_stream(spark, layout, path=None):
    """The stored rows as a stream.

    A merge rewrites the state its keys touch, so what a run costs is the state times the micro-batches: their number
    must not follow the files, which grow with the table.  Few files come one at a time.
    """
    path = path or layout.path("silver", EMAIL)
    stored = spark.read.parquet(path)
    files = max(1, -(-len(stored.inputFiles()) // MICRO_BATCHES))
    return spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", files).parquet(path)


def _stream_cdc(spark, sf, name, stream_path=None, spec=None, rules=None, source=None, tables=None, **kw):
    from sluice.streaming.cdc import cdc_stream, cdc_view

    layout = Layout(new_scratch_dir(spark, f"stream-{name}"))
    if source is None:
        if stream_path is None:
            _stream_silver_email(spark, sf, layout)
        source = _silver_as_stream(spark, layout, stream_path)
    spec = spec or _gold_specs()[name]
    _run(cdc_stream(spark, spec, {EMAIL: source, **(tables or {})}, layout, buckets=8, rules=rules, **kw))
    return layout, spec, cdc_view(spark, spec, layout)


def q_stream_scd1(spark, sf):
    return _ntz(_stream_cdc(spark, sf, CURRENT)[2])


def q_stream_scd2(spark, sf):
    return _ntz(_stream_cdc(spark, sf, HISTORY)[2])


def _interleaved_silver(spark, sf, slices=4):
    """Silver email rows, in one pass, as slices whose sequences interleave (late and early rows mixed).

    AQE sizes the files per slice (without the hint every task writes one into each), slice after slice.
    """
    _prepare(spark)
    src = new_scratch_dir(spark, "ooo-src")
    dealt = F.pmod(F.xxhash64("ACCOUNT_ID", "UPDATED_AT"), F.lit(slices))
    _silver(spark, sf)[EMAIL].withColumn("slice", dealt).hint("rebalance", "slice").write.mode("append").partitionBy("slice").parquet(src)
    return f"{src}/slice=*"


def q_stream_scd1_ooo(spark, sf):
    return _ntz(_stream_cdc(spark, sf, CURRENT, stream_path=_interleaved_silver(spark, sf))[2])


def q_stream_scd1_restart(spark, sf):
    """Merge-on-write CDC over two of four slices, then over all of them from a new checkpoint and the state so far."""
    from sluice.streaming.cdc import cdc_stream, cdc_view

    layout, spec, src = Layout(new_scratch_dir(spark, "scd1-restart")), _gold_specs()[CURRENT], _interleaved_silver(spark, sf)
    for name, path in (("first", src.replace("slice=*", "slice=[01]")), ("second", src)):
        _run(cdc_stream(spark, spec, {EMAIL: _silver_as_stream(spark, layout, path)}, layout, buckets=8, query_name=name))
    return _ntz(cdc_view(spark, spec, layout))


def q_stream_scd2_merge(spark, sf):
    """Type 2 merge-on-write over several micro-batches, with late rows that split stored versions."""
    return _ntz(_stream_cdc(spark, sf, HISTORY, stream_path=_interleaved_silver(spark, sf))[2])


def q_stream_scd1_mor(spark, sf):
    """Merge-on-read CDC: per batch only its own rows, compaction every 2 batches, SCD applied on read."""
    src = _interleaved_silver(spark, sf, slices=5)
    return _ntz(_stream_cdc(spark, sf, CURRENT, stream_path=src, mode="merge_on_read", compact_every=2)[2])


def q_stream_scd2_mor(spark, sf):
    src = _interleaved_silver(spark, sf, slices=5)
    return _ntz(_stream_cdc(spark, sf, HISTORY, stream_path=src, mode="merge_on_read", compact_every=2)[2])


def q_stream_scd1_enriched(spark, sf):
    """Merge-on-write CDC over a stream joined with a table: contacts with their account's status."""
    import dataclasses

    contacts, accounts = f"__silver__.{EMAIL}", f"__silver__.{ACCOUNT}"
    spec = dataclasses.replace(
        _gold_specs()[CURRENT], sources=[EMAIL, ACCOUNT],
        sql=f"SELECT c.*, a.ACCOUNT_STATUS FROM {contacts} c JOIN {accounts} a ON a.ACCOUNT_ID = c.ACCOUNT_ID")
    return _ntz(_stream_cdc(spark, sf, CURRENT, stream_path=_interleaved_silver(spark, sf), spec=spec,
                            tables={ACCOUNT: _silver(spark, sf)[ACCOUNT]})[2])


def q_stream_gold_quarantine(spark, sf):
    """Streaming gate before the type 1 apply: the gate checks the unvalidated projection."""
    import copy

    _prepare(spark)
    spec = copy.deepcopy(_gold_specs()[CURRENT])
    spec.cfg["quality_gate"] = True
    t = _tables()[EMAIL]
    source = stage(spark, t, fixtures.bronze_stream(spark, sf, EMAIL))
    layout, spec, _ = _stream_cdc(spark, sf, CURRENT, spec=spec, rules=t.rules, source=source)
    return _report(layout.read(spark, "quarantine", f"{spec.target}_gold_quarantine"))


def q_stream_gold_quarantine_restart(spark, sf):
    """The gate's quarantine after a second run from a new checkpoint that reads everything again in other batches."""
    import copy

    from sluice.streaming.cdc import cdc_stream

    _prepare(spark)
    spec, t, layout, src = copy.deepcopy(_gold_specs()[CURRENT]), _tables()[EMAIL], Layout(new_scratch_dir(spark, "gate-restart")), new_scratch_dir(spark, "gate-src")
    spec.cfg["quality_gate"] = True
    bronze = fixtures.bronze(spark, sf, EMAIL)
    bronze.withColumn("slice", F.pmod(F.xxhash64("ACCOUNT_ID", "UPDATED_AT"), F.lit(3))).write.mode("append").partitionBy("slice").parquet(src)
    for name, files in (("first", 1), ("second", 3)):
        source = stage(spark, t, spark.readStream.schema(bronze.schema).option("maxFilesPerTrigger", files).parquet(f"{src}/slice=*"))
        _run(cdc_stream(spark, spec, {EMAIL: source}, layout, buckets=8, rules=t.rules, query_name=name))
    return _report(layout.read(spark, "quarantine", f"{spec.target}_gold_quarantine"))


# -- registry ----------------------------------------------------------------------
def _llm() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators; none where that subpackage isn't there."""
    try:
        import corpus_pipeline
        from sluice.llm.queries import ORACLES, QUERIES
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "sluice.llm"):
            raise
        return {}, {}
    sql = {**ORACLES, "pipeline": corpus_pipeline.ORACLE_SQL}
    return {**QUERIES, "pipeline": corpus_pipeline.run}, {k: v for k, v in sql.items() if v is not None}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**core_queries(), **_llm()[0]}


def oracle_sql() -> dict[str, str]:
    return {**core_oracle_sql(), **_llm()[1]}


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "scan_account": q_scan_account,
        "silver_account": q_silver_account,
        "silver_profile": q_silver_profile,
        "silver_email": q_silver_email,
        "audit_stamp": q_audit_stamp,
        "exclude_columns": q_exclude_columns,
        "dq_counts_account": _counts(ACCOUNT),
        "dq_counts_profile": _counts(PROFILE),
        "dq_counts_email": _counts(EMAIL),
        "check_metrics_account": _rule_counts(ACCOUNT),
        "check_metrics_profile": _rule_counts(PROFILE),
        "check_metrics_email": _rule_counts(EMAIL),
        "quarantine_account": _quarantine(ACCOUNT),
        "quarantine_profile": _quarantine(PROFILE),
        "quarantine_email": _quarantine(EMAIL),
        "quarantine_account_warnings": q_quarantine_account_warnings,
        "dq_warn_account": q_dq_warn_account,
        "dq_profile_rules": q_dq_profile_rules,
        "schema_check": q_schema_check,
        "join_account_profile": q_join_account_profile,
        "join_account_email": q_join_account_email,
        "hash_id": q_hash_id,
        "gold_profile_summary": q_gold_profile_summary,
        "display_name": q_display_name,
        "gold_contact_staged": q_gold_contact_staged,
        "gold_contact_summary": q_gold_contact_summary,
        "gold_contact_quarantine": q_gold_contact_quarantine,
        "gold_contact_unvalidated_quarantine": q_gold_contact_unvalidated_quarantine,
        "param_text": q_param_text,
        "gold_sql_reach": q_gold_sql_reach,
        "gold_profile_gated": q_gold_profile_gated,
        "gold_profile_quarantine": q_gold_profile_quarantine,
        "silver_metrics": q_silver_metrics,
        "gold_metrics": q_gold_metrics,
        "global_metrics": q_global_metrics,
        "latest_per_account": q_latest_per_account,
        "scd1_current": q_scd1_current,
        "scd1_gated": q_scd1_gated,
        "scd1_gated_quarantine": q_scd1_gated_quarantine,
        "scd2_history": q_scd2_history,
        "scd2_tracked": q_scd2_tracked,
        "scd2_tracked_except": q_scd2_tracked_except,
        "scd1_hot_account": q_scd1_hot_account,
        "scd2_hot_account": q_scd2_hot_account,
        "stream_silver_email": q_stream_silver_email,
        "stream_quarantine_email": q_stream_quarantine_email,
        "stream_metrics": q_stream_metrics,
        "stream_scd1": q_stream_scd1,
        "stream_scd2": q_stream_scd2,
        "stream_scd1_ooo": q_stream_scd1_ooo,
        "stream_silver_restart": q_stream_silver_restart,
        "stream_silver_two_writers": q_stream_silver_two_writers,
        "stream_scd1_restart": q_stream_scd1_restart,
        "stream_scd2_merge": q_stream_scd2_merge,
        "stream_scd1_mor": q_stream_scd1_mor,
        "stream_scd1_enriched": q_stream_scd1_enriched,
        "stream_scd2_mor": q_stream_scd2_mor,
        "stream_gold_quarantine": q_stream_gold_quarantine,
        "stream_gold_quarantine_restart": q_stream_gold_quarantine_restart,
    }


def core_oracle_sql() -> dict[str, str]:
    acc_cols = O.SILVER_COLS[ACCOUNT]
    prof_cols = O.SILVER_COLS[PROFILE]
    email_cols = O.SILVER_COLS[EMAIL]
    contact_cols = ("CUSTOMER_ID, CUSTOMER_ID_ENCRYPTED, ACCOUNT_ID, FIRST_NAME, DISPLAY_NAME, CUSTOMER_TYPE, "
                    "EMAIL_ADDRESS, ACCOUNT_STATUS, SERVICE_STATE, ACCOUNT_OPEN_DATE")
    summary_cols = ("ACCOUNT_ID, CUSTOMER_ID, FIRST_NAME, LAST_NAME, ORG_NAME, CUSTOMER_DISPLAY_NAME, CUSTOMER_TYPE, "
                    "ACCOUNT_STATUS, SERVICE_STATE, ACCOUNT_OPEN_DATE")
    silver_email_q = O.q(f"SELECT {email_cols} FROM silver_email")
    email_quarantine = O.quarantine_report(EMAIL, email_cols)
    scd2_all = O.scd2(EMAIL_TRACKED + ["UPDATED_AT"])
    scd2_three = O.scd2(EMAIL_TRACKED)
    return {
        "scan_account": O.q("SELECT * FROM bronze_account"),
        "silver_account": O.q(f"SELECT {acc_cols} FROM silver_account"),
        "silver_profile": O.q(f"SELECT {prof_cols} FROM silver_profile"),
        "silver_email": silver_email_q,
        "audit_stamp": O.q("SELECT count(*) AS n_rows, CAST(1 AS BIGINT) AS n_stamps, true AS stamped "
                           "FROM silver_account"),
        "exclude_columns": O.q(f"SELECT {acc_cols} FROM silver_account"),
        "dq_counts_account": O.counts(ACCOUNT),
        "dq_counts_profile": O.counts(PROFILE),
        "dq_counts_email": O.counts(EMAIL),
        "check_metrics_account": O.rule_counts(ACCOUNT),
        "check_metrics_profile": O.rule_counts(PROFILE),
        "check_metrics_email": O.rule_counts(EMAIL),
        "quarantine_account": O.quarantine_report(ACCOUNT, acc_cols),
        "quarantine_profile": O.quarantine_report(PROFILE, prof_cols),
        "quarantine_email": email_quarantine,
        "quarantine_account_warnings": O.q(
            f"SELECT {acc_cols}, {O._names(ACCOUNT, 'error')} AS error_names, {O._names(ACCOUNT, 'warn')} AS "
            f"warning_names FROM account_f WHERE {O._any(ACCOUNT, 'error')} OR {O._any(ACCOUNT, 'warn')}"),
        "dq_warn_account": O.q(f"SELECT {acc_cols}, '' AS error_names, {O._names(ACCOUNT, 'warn')} AS warning_names "
                               f"FROM account_f WHERE NOT {O._any(ACCOUNT, 'error')} AND {O._any(ACCOUNT, 'warn')}"),
        "dq_profile_rules": O.q(f"SELECT {prof_cols}, {O._names(PROFILE, 'error')} AS error_names, "
                                f"{O._names(PROFILE, 'warn')} AS warning_names FROM profile_f"),
        "schema_check": O.q("SELECT 'customer_account' AS table_name, CAST(0 AS BIGINT) AS failed_rows "
                            "UNION ALL SELECT 'customer_profile', CAST(0 AS BIGINT) "
                            "UNION ALL SELECT 'customer_email_contact', CAST(0 AS BIGINT) "
                            "UNION ALL SELECT 'customer_email_contact_ntz', count(*) FROM bronze_email"),
        "join_account_profile": O.q("SELECT a.CUSTOMER_ID, a.ACCOUNT_ID, a.ACCOUNT_STATUS, p.FIRST_NAME, p.LAST_NAME, "
                                    "p.ORG_NAME, p.CUSTOMER_TYPE FROM silver_account a "
                                    "LEFT JOIN silver_profile p ON p.CUSTOMER_ID = a.CUSTOMER_ID"),
        "join_account_email": O.q("SELECT a.ACCOUNT_ID, a.ACCOUNT_STATUS, e.EMAIL_ADDRESS, e.EMAIL_STATUS, e.UPDATED_AT "
                                  "FROM silver_account a LEFT JOIN silver_email e ON e.ACCOUNT_ID = a.ACCOUNT_ID"),
        "hash_id": O.q("SELECT DISTINCT CUSTOMER_ID, sha256(CUSTOMER_ID) AS CUSTOMER_ID_ENCRYPTED FROM silver_account"),
        "gold_profile_summary": O.q(f"SELECT {summary_cols} FROM summary_staged"),
        "display_name": O.q("SELECT ACCOUNT_ID, CUSTOMER_TYPE, CUSTOMER_DISPLAY_NAME FROM summary_staged"),
        "gold_contact_staged": O.q(f"SELECT {contact_cols} FROM contact_staged"),
        "gold_contact_summary": O.q(f"SELECT {contact_cols} FROM contact_f "
                                    f"WHERE NOT {O._any(CONTACT, 'error')}"),
        "gold_contact_quarantine": O.quarantine_report(CONTACT, contact_cols),
        "gold_contact_unvalidated_quarantine": O.unvalidated(O.quarantine_report(CONTACT, contact_cols)),
        "param_text": O.q("SELECT ACCOUNT_ID AS ACCOUNT_NO, 'v256' AS TAG, CAST(256 AS BIGINT) AS N, ACCOUNT_STATUS "
                          "FROM silver_account WHERE ACCOUNT_STATUS IN ('ACTIVE', 'CLOSED')"),
        "gold_sql_reach": O.q("SELECT a.SERVICE_STATE, p.CUSTOMER_TYPE, count(*) AS CONTACTS, count(DISTINCT a.ACCOUNT_ID) AS ACCOUNTS, "
                              "count(*) FILTER (WHERE e.EMAIL_STATUS = 'VALID') AS VALID_CONTACTS, min(a.OPEN_DATE) AS OLDEST "
                              "FROM silver_account a JOIN silver_profile p ON p.CUSTOMER_ID = a.CUSTOMER_ID "
                              "LEFT JOIN silver_email e ON e.ACCOUNT_ID = a.ACCOUNT_ID WHERE a.ACCOUNT_STATUS IN ('ACTIVE', 'INACTIVE') "
                              "AND (e.PREFERRED_EMAIL_FLAG = 'Y' OR e.ACCOUNT_ID IS NULL) GROUP BY ALL"),
        "gold_profile_gated": O.q(f"SELECT {summary_cols} FROM summary_f WHERE NOT {O._any(SUMMARY, 'error')}"),
        "gold_profile_quarantine": O.quarantine_report(SUMMARY, summary_cols),
        "silver_metrics": O.q(O.silver_metrics_select()),
        "gold_metrics": O.q(O.gold_metrics_select()),
        "global_metrics": O.q(O.silver_metrics_select() + " UNION ALL " + O.gold_metrics_select()),
        "latest_per_account": O.SCD1,
        "scd1_current": O.SCD1,
        "scd1_gated": O.SCD1,
        "scd1_gated_quarantine": email_quarantine,
        "scd2_history": scd2_all,
        "scd2_tracked": scd2_three,
        "scd2_tracked_except": scd2_three,
        "scd1_hot_account": O.hot(O.SCD1),
        "scd2_hot_account": O.hot(scd2_three),
        "stream_silver_email": silver_email_q,
        "stream_quarantine_email": email_quarantine,
        "stream_metrics": O.q(O.metrics_select(EMAIL, f"silver.{EMAIL}", f"quarantine.{EMAIL}_quarantine")),
        "stream_scd1": O.SCD1,
        "stream_scd2": scd2_all,
        "stream_scd1_ooo": O.SCD1,
        "stream_silver_restart": silver_email_q,
        "stream_silver_two_writers": silver_email_q,
        "stream_scd1_restart": O.SCD1,
        "stream_scd2_merge": scd2_all,
        "stream_scd1_mor": O.SCD1,
        "stream_scd1_enriched": O.SCD1_ENRICHED,
        "stream_scd2_mor": scd2_all,
        "stream_gold_quarantine": email_quarantine,
        "stream_gold_quarantine_restart": email_quarantine,
    }


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: active accounts with profile and display name, bad rows excluded, gold gate applied."""
    return q_gold_profile_gated(spark, SMOKE_DIR)
