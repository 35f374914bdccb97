"""Streams equal their batch counterparts, whatever the file order and batch cut; replays are idempotent."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from sluice.operators.scd import scd1, scd2
from sluice.plans.gold import default_gold_specs
from sluice.plans.silver import default_silver_tables, silver_check, write_silver
from sluice.session import new_scratch_dir
from sluice.sources import fixtures, versions
from sluice.sources.tables import list_dirs
from sluice.streaming import cdc
from sluice.streaming.fanout import silver_stream

EMAIL = "customer_email_contact"


def _rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


@pytest.fixture(scope="module")
def email_table():
    return [t for t in default_silver_tables() if t.name == EMAIL][0]


@pytest.fixture(scope="module")
def silver_email(spark, email_table):
    return silver_check(spark, email_table, fixtures.bronze(spark, SF001, EMAIL)).valid()


def _split_files(spark, df, parts=5, order=(3, 0, 4, 1, 2)):
    """Write df as several files whose sequences interleave (out-of-order arrival)."""
    path = new_scratch_dir(spark, "split")
    stable = [c for c in df.columns if c != "processed_time"]  # current_timestamp() differs per write
    bucket = F.pmod(F.xxhash64(*stable), F.lit(parts))
    for i in order:
        df.where(bucket == i).coalesce(1).write.mode("append").parquet(path)
    return path


def test_silver_stream_equals_batch(spark, layout, email_table):
    bronze = fixtures.bronze(spark, SF001, EMAIL)
    path = _split_files(spark, bronze)
    stream = spark.readStream.schema(bronze.schema).option("maxFilesPerTrigger", 1).parquet(path)
    q = silver_stream(spark, email_table, stream, layout)
    q.awaitTermination()
    assert q.lastProgress is not None and q.lastProgress["batchId"] >= 4  # several micro-batches
    batch = silver_check(spark, email_table, bronze)
    got = layout.read(spark, "silver", EMAIL).drop("processed_time", "_batch_id")
    assert _rows(got) == _rows(batch.valid().drop("processed_time"))
    q_got = layout.read(spark, "quarantine", f"{EMAIL}_quarantine")
    assert q_got.count() == batch.quarantine().count()
    m = layout.read(spark, "metrics", f"{EMAIL}_metrics").where("metric_name = 'input_row_count'")
    assert sum(int(r.metric_value) for r in m.collect()) == bronze.count()
    # per-batch entries folded into one entry per table equal the whole-table metrics
    from sluice.plans import ledger

    folded = {r.metric_name: r.metric_value for r in ledger.totals(layout.read(spark, "metrics", f"{EMAIL}_metrics"))
              .collect()}
    whole = {r.metric_name: r.metric_value for r in batch.metrics("x", "y").collect()}
    assert folded == whole


def test_replayed_micro_batch_does_not_duplicate(spark, layout, email_table):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")  # a session with Spark's default
    c = silver_check(spark, email_table, fixtures.bronze(spark, SF001, EMAIL))
    write_silver(c, layout, email_table, batch_id=6, run_id="x")
    write_silver(c, layout, email_table, batch_id=7, run_id="a")
    write_silver(c, layout, email_table, batch_id=7, run_id="b")  # replay of the same batch
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    assert layout.read(spark, "silver", EMAIL).count() == 2 * c.valid().count()  # batch 6 kept, 7 once
    runs = {r.run_id for r in layout.read(spark, "metrics", f"{EMAIL}_metrics").collect()}
    assert runs == {"x", "b"}


@pytest.mark.parametrize("name", ["customer_email_contact_current", "customer_email_contact_history"])
def test_cdc_stream_equals_batch(spark, layout, silver_email, name):
    path = _split_files(spark, silver_email)
    src = spark.readStream.schema(silver_email.schema).option("maxFilesPerTrigger", 1).parquet(path)
    spec = default_gold_specs()[name]
    q = cdc.cdc_stream(spark, spec, {EMAIL: src}, layout, buckets=4)
    q.awaitTermination()
    got = cdc.cdc_view(spark, spec, layout)
    if spec.operation == "delta_type1":
        want = scd1(silver_email, ["ACCOUNT_ID"], "UPDATED_AT", ["processed_time"])
    else:
        want = scd2(silver_email, ["ACCOUNT_ID"], "UPDATED_AT", ["processed_time"])
    assert got.columns == want.columns
    assert _rows(got) == _rows(want)


@pytest.mark.parametrize("overwrite", ["dynamic", "static"])
@pytest.mark.parametrize("kind", ["scd1", "scd2"])
def test_cdc_merge_recovers_from_a_crash_during_commit(spark, silver_email, kind, overwrite, monkeypatch):
    """A merge that died before its version was published has changed nothing; its replay, or another run, goes on."""
    root = new_scratch_dir(spark, "crash")
    keys, seq = ["ACCOUNT_ID"], "UPDATED_AT"
    half = F.pmod(F.xxhash64("ACCOUNT_ID"), F.lit(2)) == 0  # the second batch holds other keys than the first
    first, second = silver_email.where(half), silver_email.where(~half)
    merge, reduce_, parts = (cdc.merge_scd1, scd1, ["current"]) if kind == "scd1" else (cdc.merge_scd2, scd2, ["log", "history"])
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", overwrite)

    def rows():
        return _rows(cdc.state_rows(spark, root, parts[-1]))

    def dies(*a, **k):
        raise OSError("died")

    try:
        merge(spark, first, root, keys, seq, ["processed_time"], buckets=4, batch_id="a-0")
        whole = rows()
        assert whole == _rows(reduce_(first, keys, seq, ["processed_time"]))
        with monkeypatch.context() as m:  # everything is written, the manifest isn't
            m.setattr(versions, "write_text", dies)
            with pytest.raises(OSError, match="died"):
                merge(spark, second, root, keys, seq, ["processed_time"], buckets=4, batch_id="a-1")
        assert rows() == whole
        merge(spark, second, root, keys, seq, ["processed_time"], buckets=4, batch_id="a-1")  # replay
        done = versions.VersionedState(spark, root).versions()
        merge(spark, second, root, keys, seq, ["processed_time"], buckets=4, batch_id="a-1")  # replayed after it was published
        assert versions.VersionedState(spark, root).versions() == done
        merge(spark, first, root, keys, seq, ["processed_time"], buckets=4, batch_id="b-0")  # another run, from the start
        assert rows() == _rows(reduce_(silver_email, keys, seq, ["processed_time"]))
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


@pytest.mark.parametrize("kind", ["scd1", "scd2"])
def test_a_run_that_died_loses_no_rows_of_other_keys(spark, kind, monkeypatch):
    """24 keys in 2 buckets; a merge dies; then a batch of another run holds 4 other keys: 28 rows."""
    root = new_scratch_dir(spark, "other-run")
    merge, part = (cdc.merge_scd1, "current") if kind == "scd1" else (cdc.merge_scd2, "history")
    batch = lambda lo, hi: spark.range(lo, hi).selectExpr("concat('k', id) AS id", "1 AS seq", "'v' AS v")
    merge(spark, batch(0, 20), root, ["id"], "seq", buckets=2, batch_id="a-0")
    with monkeypatch.context() as m:
        m.setattr(versions.VersionedState, "publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            merge(spark, batch(20, 24), root, ["id"], "seq", buckets=2, batch_id="a-1")
    merge(spark, batch(20, 24), root, ["id"], "seq", buckets=2, batch_id="a-1")
    merge(spark, batch(24, 28), root, ["id"], "seq", buckets=2, batch_id="b-0")
    assert cdc.state_rows(spark, root, part).count() == 28


@pytest.mark.parametrize("kind", ["scd1", "scd2"])
def test_readers_see_one_whole_version(spark, kind, monkeypatch):
    """Readers that start before, during and after each step of a merge: the old version, the old one, the new one."""
    root = new_scratch_dir(spark, "readers")
    merge, parts = (cdc.merge_scd1, ["current"]) if kind == "scd1" else (cdc.merge_scd2, ["log", "history"])
    batch = lambda seq, v: spark.range(30).selectExpr("concat('k', id) AS id", f"{seq} AS seq", f"'{v}' AS v")
    merge(spark, batch(1, "old"), root, ["id"], "seq", buckets=4, batch_id="a-0")
    readers, real = [], versions.VersionedState.write
    start = lambda: [cdc.state_rows(spark, root, p) for p in parts]
    readers.append(start())

    def write(self, df, part):
        readers.append(start())
        out = real(self, df, part)
        readers.append(start())
        return out

    monkeypatch.setattr(versions.VersionedState, "write", write)
    merge(spark, batch(2, "new"), root, ["id"], "seq", buckets=4, batch_id="a-1")
    for early in readers:
        assert all({r.v for r in df.collect()} == {"old"} and df.count() == 30 for df in early)
    log = {"scd1": 30, "scd2": 60}[kind]
    assert [df.count() for df in start()] == ([30] if kind == "scd1" else [60, 60]) and log >= 30
    assert {r.v for r in start()[0].collect()} == ({"new"} if kind == "scd1" else {"old", "new"})


def test_fifty_batches_leave_few_folders_and_slow_readers_end(spark):
    """Old versions go once newer ones are enough and no reader can be left; a reader within that time still ends."""
    root = new_scratch_dir(spark, "retention")
    state = versions.VersionedState(spark, root)
    for b in range(12):
        one = spark.createDataFrame([(f"k{b % 3}", b)], "id string, seq int")
        cdc.merge_scd1(spark, one, root, ["id"], "seq", buckets=2, batch_id=f"a-{b}")
        slow = slow if b else cdc.state_rows(spark, root, "current")
        cdc.prune(spark, root, keep=2, min_age_s=3600)
    assert len(state.versions()) == 12 and slow.count() == 1  # all of them young
    cdc.prune(spark, root, keep=2)
    folders = list_dirs(spark, f"{root}/data/current")
    assert state.versions() == [10, 11, 12] and len(folders) <= 4
    assert {(r.id, r.seq) for r in cdc.state_rows(spark, root, "current").collect()} == {("k0", 9), ("k1", 10), ("k2", 11)}
    assert {(r.id, r.seq) for r in state.rows("current", version=10).collect()} == {("k0", 9), ("k1", 7), ("k2", 8)}


def test_a_new_checkpoint_continues_merge_on_read(spark):
    """Batch numbers of a second run follow those of the first; its deltas are neither lost nor overwrite others."""
    root = new_scratch_dir(spark, "runs")
    rows = lambda *r: spark.createDataFrame(list(r), "id string, seq int")
    at = lambda token, b: cdc.run_offset(spark, root, token) + b
    for b, batch in enumerate([rows(("a", 1), ("b", 1)), rows(("c", 2)), rows(("d", 3))]):
        cdc.append_delta(spark, batch, root, "delta_type1", ["id"], "seq", batch_id=at("one", b), compact_every=2)
    for b, batch in enumerate([rows(("a", 5), ("x", 5)), rows(("y", 6)), rows(("z", 7))]):
        cdc.append_delta(spark, batch, root, "delta_type1", ["id"], "seq", batch_id=at("two", b), compact_every=2)
    got = {(r.id, r.seq) for r in scd1(cdc.mor_rows(spark, root), ["id"], "seq").collect()}
    assert got == {("a", 5), ("b", 1), ("c", 2), ("d", 3), ("x", 5), ("y", 6), ("z", 7)}


def test_cdc_stream_guards(spark, layout, silver_email):
    spec = default_gold_specs()["customer_contact_summary"]
    with pytest.raises(ValueError, match="delta_type1 or delta_type2"):
        cdc.cdc_stream(spark, spec, {EMAIL: silver_email}, layout)
    spec = default_gold_specs()["customer_email_contact_current"]
    with pytest.raises(ValueError, match="streaming"):
        cdc.cdc_stream(spark, spec, {EMAIL: silver_email}, layout)


def test_bucket_count_is_fixed_at_creation(spark, silver_email):
    root = new_scratch_dir(spark, "buckets")
    cdc.merge_scd1(spark, silver_email, root, ["ACCOUNT_ID"], "UPDATED_AT", ["processed_time"], buckets=4, batch_id=0)
    with pytest.raises(ValueError, match="created with 4 buckets"):
        cdc.merge_scd1(spark, silver_email, root, ["ACCOUNT_ID"], "UPDATED_AT", ["processed_time"], buckets=8,
                       batch_id=1)


@pytest.mark.parametrize("name", ["customer_email_contact_current", "customer_email_contact_history"])
def test_merge_on_read_equals_batch(spark, layout, silver_email, name):
    path = _split_files(spark, silver_email)
    src = spark.readStream.schema(silver_email.schema).option("maxFilesPerTrigger", 1).parquet(path)
    spec = default_gold_specs()[name]
    q = cdc.cdc_stream(spark, spec, {EMAIL: src}, layout, mode="merge_on_read", compact_every=2)
    q.awaitTermination()
    root = layout.state_path(spec.cdc_target)
    assert cdc._base_version(spark, root) == 3  # batches 0..4: compactions after batches 1 and 3
    got = cdc.cdc_view(spark, spec, layout)
    if spec.operation == "delta_type1":
        want = scd1(silver_email, ["ACCOUNT_ID"], "UPDATED_AT", ["processed_time"])
    else:
        want = scd2(silver_email, ["ACCOUNT_ID"], "UPDATED_AT", ["processed_time"])
    assert _rows(got) == _rows(want)


def test_streaming_cdc_rejects_gold_sources(spark, layout, silver_email):
    import copy

    spec = copy.deepcopy(default_gold_specs()["customer_email_contact_current"])
    spec.sql = "SELECT * FROM __gold__.customer_email_contact"
    src = spark.readStream.schema(silver_email.schema).parquet(_split_files(spark, silver_email, 1, (0,)))
    with pytest.raises(ValueError, match="__gold__"):
        cdc.cdc_stream(spark, spec, {EMAIL: src}, layout)


def test_streaming_gate_writes_quarantine_and_metrics(spark, layout, email_table):
    """The gate before the CDC apply: bad rows quarantined, metrics per micro-batch, valid rows applied."""
    import copy

    from sluice.plans.silver import stage

    bronze = fixtures.bronze(spark, SF001, EMAIL)
    path = _split_files(spark, bronze, 2, (1, 0))
    src = stage(spark, email_table, spark.readStream.schema(bronze.schema).option("maxFilesPerTrigger", 1)
                .parquet(path))
    spec = copy.deepcopy(default_gold_specs()["customer_email_contact_current"])
    spec.cfg["quality_gate"] = True
    q = cdc.cdc_stream(spark, spec, {EMAIL: src}, layout, rules=email_table.rules, buckets=4)
    q.awaitTermination()
    checked = silver_check(spark, email_table, bronze, validate_schema=False)
    quarantine = layout.read(spark, "quarantine", f"{spec.target}_gold_quarantine")
    assert quarantine.count() == checked.quarantine().count()
    m = layout.read(spark, "metrics", f"{spec.target}_gold_metrics").where("metric_name = 'input_row_count'")
    assert sorted(r._batch_id for r in m.collect()) == [0, 1]
    assert sum(int(r.metric_value) for r in m.collect()) == bronze.count()
    want = scd1(checked.valid(), ["ACCOUNT_ID"], "UPDATED_AT", ["processed_time"])
    assert _rows(cdc.cdc_view(spark, spec, layout)) == _rows(want)


def test_merge_on_read_prune_keeps_results(spark, silver_email):
    root = new_scratch_dir(spark, "mor-prune")
    keys, seq = ["ACCOUNT_ID"], "UPDATED_AT"
    day = F.dayofmonth(seq)
    parts = [silver_email.where((day > 6 * i) & (day <= 6 * (i + 1))) for i in range(6)]
    for i, part in enumerate(parts):
        cdc.append_delta(spark, part, root, "delta_type1", keys, seq, ["processed_time"], batch_id=i, compact_every=2)
    assert cdc._base_version(spark, root) == 5
    deleted = cdc.prune(spark, root, keep=1)  # bases v=1,3,5: keep v=5 and v=3, drop v=1
    assert any(p.endswith("base/v=1") for p in deleted) and not any(p.endswith("base/v=3") for p in deleted)
    assert sorted(p.rsplit("=", 1)[1] for p in deleted if "/deltas/" in p) == ["0", "1", "2", "3"]  # covered by v=3 and v=5
    got = scd1(cdc.mor_rows(spark, root), keys, seq)
    assert _rows(got) == _rows(scd1(silver_email, keys, seq, ["processed_time"]))


@pytest.mark.parametrize("name", ["customer_email_contact_current", "customer_email_contact_history"])
def test_target_without_rows_has_a_typed_empty_view(spark, layout, silver_email, name):
    path = new_scratch_dir(spark, "no-rows")
    silver_email.limit(0).write.mode("overwrite").parquet(path)
    spec = default_gold_specs()[name]
    src = spark.readStream.schema(silver_email.schema).parquet(path)
    cdc.cdc_stream(spark, spec, {EMAIL: src}, layout, buckets=4).awaitTermination()
    scd = scd1 if spec.operation == "delta_type1" else scd2
    want = scd(silver_email, ["ACCOUNT_ID"], "UPDATED_AT", ["processed_time"])
    got = cdc.cdc_view(spark, spec, layout)
    assert got.count() == 0
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]


ENRICHED = """SELECT e.*, a.ACCOUNT_STATUS FROM __silver__.customer_email_contact e
              JOIN __silver__.customer_account a ON e.ACCOUNT_ID = a.ACCOUNT_ID"""


def _enriched(**cfg):
    spec = default_gold_specs()["customer_email_contact_current"]
    return replace(spec, cfg={**spec.cfg, **cfg}, sql=ENRICHED, sources=[EMAIL, "customer_account"])


def _two_sources(spark, silver_email):
    account = [t for t in default_silver_tables() if t.name == "customer_account"][0]
    accounts = silver_check(spark, account, fixtures.bronze(spark, SF001, "customer_account")).valid().select("ACCOUNT_ID", "ACCOUNT_STATUS", "processed_time")
    path = _split_files(spark, silver_email)
    src = spark.readStream.schema(silver_email.schema).option("maxFilesPerTrigger", 2).parquet(path)
    wide = silver_email.join(accounts.drop("processed_time"), "ACCOUNT_ID").select(*silver_email.columns, "ACCOUNT_STATUS")
    return src, accounts, scd1(wide, ["ACCOUNT_ID"], "UPDATED_AT", ["processed_time"])


def test_cdc_stream_joined_with_a_table(spark, layout, silver_email):
    src, accounts, want = _two_sources(spark, silver_email)
    spec = _enriched()
    cdc.cdc_stream(spark, spec, {EMAIL: src, "customer_account": accounts}, layout, buckets=4).awaitTermination()
    got = cdc.cdc_view(spark, spec, layout)
    assert got.count() > 0
    assert _rows(got) == _rows(want)


def test_cdc_stream_of_two_streams_needs_watermarks(spark, layout, silver_email):
    src, accounts, want = _two_sources(spark, silver_email)
    path = new_scratch_dir(spark, "accounts")
    accounts.write.mode("overwrite").parquet(path)
    both = {EMAIL: src, "customer_account": spark.readStream.schema(accounts.schema).parquet(path)}
    with pytest.raises(ValueError, match="watermark on each"):
        cdc.cdc_stream(spark, _enriched(), both, layout, buckets=4)
    mark = {"column": "processed_time", "delay": "1 day"}
    spec = _enriched(watermarks={EMAIL: mark, "customer_account": mark})
    cdc.cdc_stream(spark, spec, both, layout, buckets=4).awaitTermination()
    assert _rows(cdc.cdc_view(spark, spec, layout)) == _rows(want)
