import pytest
from pyspark.sql import functions as F

from sluice.functions.contract import Rule, load_contract, parse_contract
from sluice.functions.rules import fails, schema_mismatches, schema_rule
from sluice.plans.silver import resource

EMAIL_RULE = "EMAIL RLIKE '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\\\.[A-Za-z]{2,}$'"


def test_null_passes_false_fails(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    r = Rule("positive", "x > 0")
    got = [row.f for row in df.select(fails(r, spark).alias("f")).orderBy(F.col("x").asc_nulls_first()).collect()]
    assert got == [False, True, False]  # NULL -> passes, -1 -> fails, 1 -> passes


def test_regex_backslash_is_a_literal_dot(spark):
    # the contract text contains '\\.' (one backslash after YAML): it must mean a literal dot
    rule = Rule("email_format", EMAIL_RULE.replace("\\\\", "\\"))
    df = spark.createDataFrame([("user@domain",), ("a.b@x.com",), (None,)], "EMAIL string")
    got = {r.EMAIL: r.f for r in df.select("EMAIL", fails(rule, spark).alias("f")).collect()}
    assert got == {"user@domain": True, "a.b@x.com": False, None: False}


def test_contract_rules_and_schema():
    c = load_contract(resource("contracts", "core_silver.yml"))
    acc = c.rules_for("customer_account")
    assert [r.name for r in acc] == [
        "customer_account_account_id_format", "customer_account_customer_id_format",
        "customer_account_status_allowed_values", "customer_account_service_state_format",
        "customer_account_open_date_not_future"]
    assert [r.criticality for r in acc].count("warn") == 1
    assert [f.name for f in c.schema_for("customer_profile").fields] == [
        "CUSTOMER_ID", "FIRST_NAME", "LAST_NAME", "ORG_NAME", "CUSTOMER_TYPE"]
    assert "\\." in c.rules_for("customer_email_contact")[2].expression


def test_table_without_rules_is_an_error():
    c = parse_contract({"schema": [{"name": "t", "properties": [{"name": "a", "physicalType": "STRING"}]}]})
    with pytest.raises(ValueError, match="No rules found for table 'u'"):
        c.rules_for("u")


def test_bad_criticality_and_function():
    with pytest.raises(ValueError):
        Rule("r", "a > 1", criticality="fatal")
    doc = {"schema": [{"name": "t", "properties": [{"name": "a", "quality": [
        {"implementation": {"name": "r", "check": {"function": "is_not_null", "arguments": {}}}}]}]}]}
    with pytest.raises(ValueError, match="not supported"):
        parse_contract(doc)


def test_missing_contract_file():
    with pytest.raises(FileNotFoundError):
        load_contract("/nonexistent/contract.yml")


def test_schema_validation_non_strict_and_strict(spark):
    c = load_contract(resource("contracts", "core_silver.yml"))
    exp = c.schema_for("customer_profile")
    ok = spark.createDataFrame([], "CUSTOMER_ID string, FIRST_NAME string, LAST_NAME string, ORG_NAME string, "
                                   "CUSTOMER_TYPE string, processed_time timestamp")
    assert schema_mismatches(ok, exp) == []
    assert schema_mismatches(ok, exp, strict=True) == ["unexpected column processed_time"]
    bad = ok.withColumn("CUSTOMER_TYPE", F.lit(1))
    assert "CUSTOMER_TYPE has type int" in schema_mismatches(bad, exp)[0]
    assert schema_rule("customer_profile", bad, exp).expression == "false"


def test_both_spellings_of_a_literal_dot(spark):
    """A lone backslash keeps its place in the regex; an escaped pair is not doubled again."""
    from sluice.functions.rules import literal_text

    df = spark.createDataFrame([("u@d.com",), ("u@dxcom",)], "e string")
    for spelling in (r"e RLIKE '^u@d\.com$'", r"e RLIKE '^u@d\\.com$'"):
        assert [r.e for r in df.where(literal_text(spelling, spark)).collect()] == ["u@d.com"]
