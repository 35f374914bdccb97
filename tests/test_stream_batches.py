"""The cost of a CDC run is bounded by its table: batches don't follow files, and a log isn't de-duplicated twice."""

import __spark_entry__ as entry
from pyspark.sql import functions as F
from sluice.operators.scd import scd2
from sluice.sources.tables import list_dirs
from sluice.sources.versions import VersionedState
from sluice.streaming.cdc import cdc_stream, cdc_view, merge_scd2


def _contacts(spark, n=400):
    rows = spark.range(n).select(
        F.format_string("ACC%08d", F.col("id") % 23).alias("ACCOUNT_ID"), F.format_string("u%d@example.com", F.col("id") % 7).alias("EMAIL_ADDRESS"),
        F.lit("VALID").alias("EMAIL_STATUS"), F.lit("Y").alias("PREFERRED_EMAIL_FLAG"),
        F.timestamp_seconds(F.lit(1_700_000_000) + (F.col("id") * 37) % 300).alias("UPDATED_AT"))
    return rows.withColumn("processed_time", F.current_timestamp())


def test_micro_batches_do_not_follow_the_files(spark, layout):
    spec = entry._gold_specs()[entry.HISTORY]
    for files, batches in ((3, 3), (24, 5)):
        path = f"{layout.path('silver', 'contacts')}-{files}"
        _contacts(spark).repartition(files).write.parquet(path)
        name = f"files_{files}"
        query = cdc_stream(spark, spec, {entry.EMAIL: entry._silver_as_stream(spark, layout, path)}, layout, buckets=3, query_name=name)
        query.awaitTermination()
        assert query.exception() is None and query.lastProgress["batchId"] + 1 == batches, query.lastProgress
    got = cdc_view(spark, spec, layout)
    columns = [c for c in got.columns if c != "processed_time"]
    want = scd2(_contacts(spark), ["ACCOUNT_ID"], "UPDATED_AT", ["processed_time"], track_history_columns=spec.cfg.get("track_history_columns"),
                track_history_except_columns=spec.cfg.get("track_history_except_columns"))
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))


def test_slices_are_not_cut_by_tasks(spark, tmp_path):
    """One file per slice of a small table, however many tasks read it; every file has late and early rows."""
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(6).write.parquet(f"{tmp_path}/events.parquet")
    path = entry._interleaved_silver(spark, str(tmp_path))
    files = spark.read.parquet(path).inputFiles()
    assert len(files) == 4
    spans = [spark.read.parquet(f).agg(F.min("UPDATED_AT"), F.max("UPDATED_AT")).first() for f in files]
    assert max(s[0] for s in spans) < min(s[1] for s in spans)


def test_history_comes_from_the_written_log(spark, layout):
    """The rows of the log are written once per part: no third copy of the de-duplicated log."""
    from sluice.session import scratch_root

    root = layout.state_path("history-of-log")
    before = set(list_dirs(spark, scratch_root(spark)))
    for part in range(2):
        merge_scd2(spark, _contacts(spark).where(F.col("UPDATED_AT").cast("long") % 2 == part), root, ["ACCOUNT_ID"], "UPDATED_AT", ["processed_time"],
                   track_history_columns=["EMAIL_ADDRESS"], buckets=3, batch_id=part)
    new = set(list_dirs(spark, scratch_root(spark))) - before
    assert not any(d.startswith("scd2-rows") for d in new)
    got = VersionedState(spark, root).rows("history")
    want = scd2(_contacts(spark), ["ACCOUNT_ID"], "UPDATED_AT", ["processed_time"], track_history_columns=["EMAIL_ADDRESS"])
    assert got.count() == want.count() and got.exceptAll(want.select(got.columns)).isEmpty()


def test_a_stream_broadcasts_only_what_is_small(spark, layout, monkeypatch):
    """What a micro-batch broadcasts goes through the driver every time: the stream runs with a low limit, the session keeps its own."""
    import dataclasses

    from sluice.streaming import cdc

    seen, merge = [], cdc.merge_scd1

    def spy(session, batch_df, *args):
        seen.append(batch_df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
        merge(session, batch_df, *args)

    monkeypatch.setattr(cdc, "merge_scd1", spy)
    path = layout.path("silver", "contacts")
    _contacts(spark).repartition(2).write.parquet(path)
    accounts = spark.range(20).select(F.format_string("ACC%08d", "id").alias("ACCOUNT_ID"), F.lit("ACTIVE").alias("ACCOUNT_STATUS"))
    spec = dataclasses.replace(
        entry._gold_specs()[entry.CURRENT], sources=[entry.EMAIL, entry.ACCOUNT],
        sql=f"SELECT c.*, a.ACCOUNT_STATUS FROM __silver__.{entry.EMAIL} c JOIN __silver__.{entry.ACCOUNT} a ON a.ACCOUNT_ID = c.ACCOUNT_ID")
    before = spark.conf.get(cdc.THRESHOLD)
    sources = {entry.EMAIL: entry._silver_as_stream(spark, layout, path), entry.ACCOUNT: accounts}
    query = cdc_stream(spark, spec, sources, layout, buckets=2)
    query.awaitTermination()
    assert query.exception() is None and seen == [cdc.BROADCAST_BYTES] * 2
    assert spark.conf.get(cdc.THRESHOLD) == before
    assert cdc_view(spark, spec, layout).count() == 20
