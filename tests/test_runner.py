"""End-to-end runs over the smallest fixture: batch and streaming give the same tables."""

import pytest

from conftest import SF001
from sluice.plans import ledger
from sluice.plans.gold import default_gold_specs
from sluice.plans.runner import run_global, run_gold, run_silver
from sluice.plans.silver import default_silver_tables
from sluice.session import new_scratch_dir
from sluice.sources import fixtures
from sluice.sources.tables import Layout


def _rows(df, drop=("processed_time", "_batch_id")):
    return sorted([tuple(r) for r in df.drop(*drop).collect()], key=repr)


@pytest.fixture(scope="module")
def runs(spark):
    out = {}
    for mode in ("batch", "stream"):
        layout = Layout(new_scratch_dir(spark, f"e2e-{mode}"))
        for name in fixtures.BRONZE_SOURCES:
            layout.write(fixtures.bronze(spark, SF001, name).repartition(3), "bronze", name)
        run_silver(spark, layout, default_silver_tables(), "core", streaming=mode == "stream",
                   stream_options={"maxFilesPerTrigger": "1"})  # several micro-batches a table
        run_gold(spark, layout, list(default_gold_specs().values()), "customer", streaming_cdc=mode == "stream",
                 buckets=4)
        run_global(spark, layout)
        out[mode] = layout
    return out


def test_all_tables_written(spark, runs):
    lay = runs["batch"]
    assert set(lay.list_tables(spark, "silver")) == {"customer_account", "customer_profile", "customer_email_contact"}
    assert set(lay.list_tables(spark, "gold")) == {
        "customer_contact_summary", "customer_account_profile_summary",
        "customer_email_contact_current", "customer_email_contact_history"}
    assert "customer_account_profile_summary_gold_quarantine" in lay.list_tables(spark, "quarantine")
    glob = lay.read(spark, "metrics", ledger.GLOBAL)
    assert glob.count() == 5 * (3 + 2)  # 3 silver tables + 2 gated gold views, 5 metrics each


def test_batch_and_stream_agree(spark, runs):
    b, s = runs["batch"], runs["stream"]
    for layer, table in [("silver", "customer_account"), ("silver", "customer_email_contact"),
                         ("quarantine", "customer_profile_quarantine"),
                         ("gold", "customer_contact_summary"), ("gold", "customer_email_contact_current"),
                         ("gold", "customer_email_contact_history")]:
        assert _rows(b.read(spark, layer, table)) == _rows(s.read(spark, layer, table)), (layer, table)


def test_streamed_ledger_has_one_entry_per_table(spark, runs):
    entry = ("output_location", "metric_name", "metric_value")
    b, s = (sorted(map(tuple, runs[m].read(spark, "metrics", ledger.GLOBAL).select(*entry).collect())) for m in ("batch", "stream"))
    assert b == s and len(b) == 5 * (3 + 2)


def test_metrics_conserve_rows(spark, runs):
    m = {(r.output_location, r.metric_name): r.metric_value
         for r in runs["batch"].read(spark, "metrics", ledger.GLOBAL).collect()}
    for loc in ("silver.customer_account", "gold.customer_account_profile_summary"):
        assert int(m[(loc, "input_row_count")]) == int(m[(loc, "error_row_count")]) + \
            runs["batch"].read(spark, loc.split(".")[0], loc.split(".")[1]).count()


def test_catalog_layout_end_to_end(spark):
    """Layers as catalog databases: saveAsTable / read.table / SHOW TABLES discovery."""
    from sluice.sources.tables import CatalogLayout

    root = new_scratch_dir(spark, "catalog")
    suffix = root.rsplit("-", 1)[-1]
    names = {layer: f"{layer}_{suffix}" for layer in ("bronze", "silver", "quarantine", "gold", "metrics")}
    for db in names.values():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}/{db}'")
    lay = CatalogLayout(root, names)
    for name in fixtures.BRONZE_SOURCES:
        lay.write(fixtures.bronze(spark, SF001, name), "bronze", name)
    run_silver(spark, lay, default_silver_tables(), "core", streaming=True)
    run_silver(spark, lay, default_silver_tables(), "core", streaming=True)  # nothing new: tables unchanged
    run_gold(spark, lay, list(default_gold_specs().values()), "customer")
    glob = run_global(spark, lay)
    assert lay.list_tables(spark, "metrics")[0].endswith("_metrics")
    assert glob.count() == 25
    silver = lay.read(spark, "silver", "customer_account")
    assert f"{names['silver']}.customer_account" == lay.name("silver", "customer_account")
    assert silver.count() == silver.select("ACCOUNT_ID", "_batch_id").distinct().count()


def test_project_folder_conventions(spark, tmp_path):
    """A project laid out as config/, contracts/01_silver|02_gold/, src/01_silver|02_gold/sql/ runs unchanged."""
    import shutil

    from sluice.plans.project import Project
    from sluice.plans.silver import resource

    base = tmp_path / "project"
    (base / "config").mkdir(parents=True)
    shutil.copy(resource("registry", "silver.yml"), base / "config" / "silver.yml")
    shutil.copy(resource("registry", "gold.yml"), base / "config" / "gold.yml")
    (base / "contracts" / "01_silver" / "core").mkdir(parents=True)
    shutil.copy(resource("contracts", "core_silver.yml"), base / "contracts" / "01_silver" / "core" / "core.yml")
    (base / "contracts" / "02_gold" / "customer").mkdir(parents=True)
    shutil.copy(resource("contracts", "customer_gold.yml"), base / "contracts" / "02_gold" / "customer")
    shutil.copytree(resource("sql", "silver"), base / "src" / "01_silver" / "sql" / "core")
    shutil.copytree(resource("sql", "gold"), base / "src" / "02_gold" / "sql" / "customer")

    proj = Project(str(base))
    layout = Layout(new_scratch_dir(spark, "project"))
    for name in fixtures.BRONZE_SOURCES:
        layout.write(fixtures.bronze(spark, SF001, name), "bronze", name)
    run_silver(spark, layout, proj.silver_tables("core"), "core")
    run_gold(spark, layout, proj.gold_specs("customer"), "customer",
             contract_dir=str(base / "contracts" / "02_gold" / "customer"))
    assert run_global(spark, layout).count() == 25
    with pytest.raises(FileNotFoundError):
        proj.silver_tables("other_system")


def test_catalog_layout_from_session_settings(spark):
    from sluice.sources.tables import CatalogLayout

    spark.conf.set("pipeline.silver_catalog", "spark_catalog")
    spark.conf.set("pipeline.silver_schema", "core_silver")
    try:
        lay = CatalogLayout.from_conf(spark, "/unused")
        assert lay.name("silver", "customer_account") == "spark_catalog.core_silver.customer_account"
        assert lay.name("gold", "t") == "gold.t"
    finally:
        spark.conf.unset("pipeline.silver_catalog")
        spark.conf.unset("pipeline.silver_schema")
