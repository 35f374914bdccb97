import json

import pytest

from sluice.functions.contract import Rule
from sluice.operators.quality import check

RULES = [
    Rule("a_positive", "a > 0"),
    Rule("b_known", "b IN ('x', 'y')"),
    Rule("c_short", "length(c) <= 3", criticality="warn"),
]
ROWS = [(1, "x", "ok"), (-1, "x", "ok"), (2, "z", "long!"), (3, None, "long!"), (None, "y", None), (-5, "q", "abcd")]


@pytest.fixture()
def checked(spark):
    return check(spark.createDataFrame(ROWS, "a int, b string, c string"), RULES)


def test_split_conserves_rows(checked):
    valid, quarantine = checked.valid().collect(), checked.quarantine().collect()
    assert len(valid) + len(quarantine) == len(ROWS)
    assert {tuple(r) for r in valid} == {(1, "x", "ok"), (3, None, "long!"), (None, "y", None)}
    assert set(checked.valid().columns) == {"a", "b", "c"}


def test_quarantine_names_errors_and_warnings(checked):
    q = {r.a: r for r in checked.quarantine().collect()}
    assert [e.name for e in q[-5]._errors] == ["a_positive", "b_known"]
    assert [w.name for w in q[-5]._warnings] == ["c_short"]
    assert [e.name for e in q[2]._errors] == ["b_known"]
    assert q[-1]._warnings == []


def test_warn_only_rows_optionally_quarantined(spark):
    c = check(spark.createDataFrame(ROWS, "a int, b string, c string"), RULES, quarantine_warnings=True)
    assert c.quarantine().count() == 4  # 3 error rows + (3, None, 'long!') warn-only


def test_counts_and_rule_counts(checked):
    r = checked.counts().collect()[0]
    assert (r.input_row_count, r.valid_row_count, r.error_row_count, r.warning_row_count) == (6, 2, 3, 3)
    rc = {x.rule_name: x.failed_rows for x in checked.rule_counts().collect()}
    assert rc == {"a_positive": 2, "b_known": 2, "c_short": 3}


def test_metrics_long_format(checked):
    m = checked.metrics("silver.t", "quarantine.t_quarantine", run_id="r1")
    assert m.columns == ["output_location", "quarantine_location", "run_id", "run_time", "metric_name", "metric_value"]
    got = {r.metric_name: r.metric_value for r in m.collect()}
    assert got["input_row_count"] == "6" and got["error_row_count"] == "3"
    cm = json.loads(got["check_metrics"])
    assert cm[2] == {"check_name": "c_short", "error_count": 0, "warning_count": 3}


def test_duplicate_rule_names_rejected(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="duplicate"):
        check(df, [Rule("r", "a > 0"), Rule("r", "a < 9")])


def test_checks_stay_one_projection(checked):
    plan = checked.valid()._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
    assert "WholeStageCodegen" in plan or "*(" in plan


def test_rule_on_missing_column_is_named(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="rule 'needs_b' of table 't' cannot be evaluated"):
        check(df, [Rule("ok", "a > 0"), Rule("needs_b", "b IS NOT NULL", table="t")])
