import copy

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from sluice.plans import ledger
from sluice.plans.gold import build_gold, default_gold_specs, gold_view
from sluice.plans.silver import default_silver_tables, silver_check, stage
from sluice.sources import fixtures


@pytest.fixture(scope="module")
def silver(spark):
    out = {}
    for t in default_silver_tables():
        out[t.name] = silver_check(spark, t, fixtures.bronze(spark, SF001, t.name)).valid()
    return out


def test_contact_summary_left_join_becomes_inner(spark, silver):
    view = gold_view(spark, default_gold_specs()["customer_contact_summary"], silver)
    plan = view.staged._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" in plan  # profile side stays outer
    assert plan.count("Join Inner") >= 1  # email side: filter on the nullable side -> inner
    rows = view.output().collect()
    assert all(r.EMAIL_ADDRESS is not None for r in rows)


def test_exact_status_comparison_in_gold(spark, silver):
    # ' active ' passes the silver contract (UPPER(TRIM)) but not the gold filter (exact)
    acc = silver["customer_account"]
    assert acc.where(F.col("ACCOUNT_STATUS") == " active ").count() > 0
    out = build_gold(spark, default_gold_specs()["customer_account_profile_summary"], silver)
    assert out.where(F.col("ACCOUNT_STATUS") != "ACTIVE").count() == 0


def test_gate_quarantines_blank_display_names(spark, silver):
    view = gold_view(spark, default_gold_specs()["customer_account_profile_summary"], silver)
    q = view.quarantine()
    assert q.count() > 0
    assert q.where(F.trim("CUSTOMER_DISPLAY_NAME") != "").count() == 0
    assert view.output().count() + q.count() == view.staged.count()


def test_operation_dispatch_errors(spark, silver):
    spec = copy.deepcopy(default_gold_specs()["customer_email_contact_current"])
    spec.cfg["operation_type"] = "delta_type9"
    with pytest.raises(ValueError, match="operation_type is"):
        build_gold(spark, spec, silver)
    spec = copy.deepcopy(default_gold_specs()["customer_email_contact_current"])
    spec.cfg["keys"] = []
    with pytest.raises(ValueError, match="needs keys"):
        build_gold(spark, spec, silver)


def test_gold_without_gate_passes_input_through(spark, silver):
    spec = copy.deepcopy(default_gold_specs()["customer_account_profile_summary"])
    spec.cfg["quality_gate"] = False
    view = gold_view(spark, spec, silver)
    assert view.checked is None and view.output() is view.staged
    with pytest.raises(ValueError, match="no quality gate"):
        view.quarantine()


def test_excluded_checked_column_is_an_error(spark):
    t = [t for t in default_silver_tables() if t.name == "customer_account"][0]
    t.exclude_columns = ["SERVICE_STATE"]
    with pytest.raises(ValueError, match="SERVICE_STATE"):
        stage(spark, t, fixtures.bronze(spark, SF001, "customer_account"))


def test_ledger_discovery_and_empty(spark, layout):
    assert ledger.global_ledger(spark, layout).count() == 0  # nothing there: typed empty ledger
    c = silver_check(spark, default_silver_tables()[1], fixtures.bronze(spark, SF001, "customer_profile"))
    m = c.metrics("silver.customer_profile", "quarantine.customer_profile_quarantine", run_id="r")
    layout.write(m, "metrics", "sys_quality_metrics")
    layout.write(m, "metrics", "dom_gold_quality_metrics")
    layout.write(m, "metrics", "global_quality_metrics")
    layout.write(m, "metrics", "customer_profile_metrics")
    assert ledger.discover_ledgers(spark, layout) == ["dom_gold_quality_metrics", "sys_quality_metrics"]
    assert ledger.global_ledger(spark, layout).count() == 10
    assert ledger.global_ledger(spark, layout).columns == ledger.COLUMNS


def test_gold_view_over_another_gold_table(spark, silver):
    from sluice.plans.gold import GoldSpec

    summary = build_gold(spark, default_gold_specs()["customer_account_profile_summary"], silver)
    spec = GoldSpec(name="business_accounts", cfg={"source_tables": ["customer_account_profile_summary"]},
                    sql="SELECT ACCOUNT_ID FROM __gold__.customer_account_profile_summary "
                        "WHERE CUSTOMER_TYPE = 'BUSINESS'",
                    origin="<test>", sources=["customer_account_profile_summary"])
    view = gold_view(spark, spec, {}, gold={"customer_account_profile_summary": summary})
    assert view.output().count() == summary.where("CUSTOMER_TYPE = 'BUSINESS'").count() > 0


def test_quarantine_warnings_from_the_registry(spark):
    import dataclasses

    t = [t for t in default_silver_tables() if t.name == "customer_account"][0]
    bronze = fixtures.bronze(spark, SF001, "customer_account")
    plain = silver_check(spark, t, bronze).quarantine().count()
    with_warn = silver_check(spark, dataclasses.replace(t, quarantine_warnings=True), bronze).quarantine().count()
    warn_only = silver_check(spark, t, bronze).annotated().where("size(_errors) = 0 AND size(_warnings) > 0").count()
    assert with_warn == plain + warn_only and warn_only > 0
