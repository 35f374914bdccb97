"""Several writers of one table, new checkpoints, crashes between the tables of a unit, and what may be deleted."""

import copy
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from sluice.functions.contract import Rule
from sluice.plans import silver as silver_plans
from sluice.plans.gold import default_gold_specs
from sluice.plans.silver import SilverTable, default_silver_tables, silver_check, stage, write_silver
from sluice.session import new_scratch_dir, strip_scheme
from sluice.sources import fixtures
from sluice.sources.commits import Commit, CommitLog
from sluice.sources.tables import CatalogLayout
from sluice.streaming import cdc
from sluice.streaming.fanout import silver_stream

TABLE = SilverTable("t", "b", "t", "SELECT id, v FROM __bronze__.b", [Rule("small", "v < 100")])


def _source(spark, *batches):
    """A folder with one file per batch of ids, read one file at a time; ids from 100 on break the rule."""
    path = new_scratch_dir(spark, "source")
    for ids in batches:
        spark.createDataFrame([(i, i) for i in ids], "id int, v int").coalesce(1).write.mode("append").parquet(path)
    return path


def _run(spark, layout, path, name, files=1, **kw):
    src = spark.readStream.schema("id int, v int").option("maxFilesPerTrigger", files).parquet(path)
    silver_stream(spark, TABLE, src, layout, query_name=name, **kw).awaitTermination()


def _ids(spark, layout, layer="silver", table="t"):
    return sorted(r.id for r in layout.read(spark, layer, table).collect())


def _inputs(spark, layout):
    m = layout.read(spark, "metrics", "t_metrics").where("metric_name = 'input_row_count'")
    return sum(int(r.metric_value) for r in m.collect())


def test_two_streams_feed_one_table(spark, layout):
    one, two = _source(spark, [10, 110], [11], [12]), _source(spark, [20], [21, 121], [22])
    _run(spark, layout, one, "one")
    _run(spark, layout, two, "two")
    assert _ids(spark, layout) == [10, 11, 12, 20, 21, 22]
    assert _ids(spark, layout, "quarantine", "t_quarantine") == [110, 121] and _inputs(spark, layout) == 8
    # the second one from a new checkpoint, in other batches and without its first file: only its own rows are replaced
    shutil.rmtree(strip_scheme(layout.checkpoint_path("two")))
    _run(spark, layout, _source(spark, [21, 122], [22, 23]), "two", files=2)
    assert _ids(spark, layout) == [10, 11, 12, 21, 22, 23]
    assert _ids(spark, layout, "quarantine", "t_quarantine") == [110, 122] and _inputs(spark, layout) == 8
    # what it replaced is hidden, not deleted, until somebody asks for it
    stored = spark.read.parquet(layout.path("silver", "t"))
    assert sorted(r.id for r in stored.where("_run = 'two@0'").collect()) == [20, 21, 22]
    log = CommitLog(spark, layout, "silver.t", [("silver", "t"), ("quarantine", "t_quarantine"), ("metrics", "t_metrics")])
    assert log.retire("one") == [] and log.retire() == ["two@0"]
    assert spark.read.parquet(layout.path("silver", "t")).where("_run = 'two@0'").count() == 0
    assert _ids(spark, layout) == [10, 11, 12, 21, 22, 23]


def test_reset_deletes_own_rows_only(spark, layout):
    _run(spark, layout, _source(spark, [1], [2]), "one")
    _run(spark, layout, _source(spark, [3]), "two")
    shutil.rmtree(strip_scheme(layout.checkpoint_path("two")))
    _run(spark, layout, _source(spark, [4]), "two", reset=True)
    assert _ids(spark, layout) == [1, 2, 4]
    assert {r[0] for r in spark.read.parquet(layout.path("silver", "t")).select("_run").distinct().collect()} == {"one@0", "two@1"}


def test_rows_of_a_batch_run_are_not_deleted_silently(spark, layout):
    checked = silver_check(spark, TABLE, spark.createDataFrame([(1, 1)], "id int, v int"))
    write_silver(checked, layout, TABLE)
    src = _source(spark, [5])
    with pytest.raises(ValueError, match="reset=True"):
        _run(spark, layout, src, "one")
    assert _ids(spark, layout) == [1]
    _run(spark, layout, src, "one", reset=True)
    assert _ids(spark, layout) == [5]
    write_silver(checked, layout, TABLE)  # and a batch run replaces the whole table
    assert _ids(spark, layout) == [1]


@pytest.mark.parametrize("dies_after", [0, 1, 2, 3])
def test_a_batch_shows_in_all_tables_at_once(spark, layout, monkeypatch, dies_after):
    """The stream dies after so many of its three tables (3: before the commit); its replay neither loses nor repeats rows."""
    path = _source(spark, [1, 101])
    _run(spark, layout, path, "one")
    spark.createDataFrame([(2, 2), (102, 102)], "id int, v int").coalesce(1).write.mode("append").parquet(path)
    real, calls = type(layout).write, []

    def write(self, *a, **k):
        if len(calls) == dies_after:
            raise OSError("died")
        calls.append(a)
        return real(self, *a, **k)

    with monkeypatch.context() as m:
        m.setattr(type(layout), "write", write)
        if dies_after == 3:
            m.setattr(CommitLog, "commit", lambda *a: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(Exception, match="died"):
            _run(spark, layout, path, "one")
    assert _ids(spark, layout) == [1] and _ids(spark, layout, "quarantine", "t_quarantine") == [101] and _inputs(spark, layout) == 2
    _run(spark, layout, path, "one")
    assert _ids(spark, layout) == [1, 2] and _ids(spark, layout, "quarantine", "t_quarantine") == [101, 102] and _inputs(spark, layout) == 4


def test_catalog_tables_have_the_same_log(spark):
    root = new_scratch_dir(spark, "catalog")
    names = {layer: f"commits_{layer}" for layer in ("bronze", "silver", "quarantine", "gold", "metrics")}
    layout = CatalogLayout(root, names)
    try:
        for db in names.values():
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
        _run(spark, layout, _source(spark, [10], [11, 111]), "one")
        _run(spark, layout, _source(spark, [20]), "two")
        shutil.rmtree(strip_scheme(layout.checkpoint_path("two")))
        _run(spark, layout, _source(spark, [21]), "two")
        assert _ids(spark, layout) == [10, 11, 21] and _ids(spark, layout, "quarantine", "t_quarantine") == [111]
        log = CommitLog(spark, layout, "silver.t", [("silver", "t"), ("quarantine", "t_quarantine"), ("metrics", "t_metrics")])
        assert log.retire() == ["two@0"]
        assert spark.table(f"{names['silver']}.t").where("_run = 'two@0'").count() == 0
    finally:
        for db in names.values():
            spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_gold_gate_outputs_belong_to_their_run(spark, layout):
    """Three one-file batches, then a new checkpoint that reads all in one: quarantine and metrics are those of one run."""
    email = [t for t in default_silver_tables() if t.name == "customer_email_contact"][0]
    bronze = fixtures.bronze(spark, SF001, "customer_email_contact")
    path, spec = new_scratch_dir(spark, "gate"), copy.deepcopy(default_gold_specs()["customer_email_contact_current"])
    spec.cfg["quality_gate"] = True
    part = F.pmod(F.xxhash64("ACCOUNT_ID", "UPDATED_AT"), F.lit(3))
    for i in range(3):
        bronze.where(part == i).coalesce(1).write.mode("append").parquet(path)
    want = silver_check(spark, email, bronze, validate_schema=False)
    views = []
    for name, files in (("first", 1), ("second", 3), ("second", 3)):
        src = stage(spark, email, spark.readStream.schema(bronze.schema).option("maxFilesPerTrigger", files).parquet(path))
        cdc.cdc_stream(spark, spec, {"customer_email_contact": src}, layout, rules=email.rules, buckets=4, query_name=name).awaitTermination()
        bad = layout.read(spark, "quarantine", f"{spec.target}_gold_quarantine")
        m = layout.read(spark, "metrics", f"{spec.target}_gold_metrics").where("metric_name = 'input_row_count'").collect()
        assert bad.count() == want.quarantine().count() > 0
        assert sum(int(r.metric_value) for r in m) == bronze.count()
        views.append(sorted(map(repr, cdc.cdc_view(spark, spec, layout).collect())))
    assert views[0] == views[1] == views[2]


def test_log_names(spark, layout):
    log = CommitLog(spark, layout, "silver.x", [("silver", "x")])
    with pytest.raises(ValueError, match="letters"):
        log.run("a/b", layout.checkpoint_path("a"))
    run = log.run("w", layout.checkpoint_path("a"))
    assert run == "w@0" == log.run("w", layout.checkpoint_path("a")) and log.run("w", layout.checkpoint_path("b")) == "w@1"
    assert log.committed() == {}
    log.commit(Commit("w@0", 0))
    log.commit(Commit("w@0", 1))
    assert log.committed() == {"w": {0: [0, 1]}} and log.superseded() == []
    log.commit(Commit("w@1", 0))
    assert log.superseded() == ["w@0"]
    assert silver_plans.RUN == "_run"
