"""Every shipped rule with a passing row, a failing row and a NULL row (NULL passes unless the rule guards it)."""

import datetime as dt

import pytest

from sluice.functions.contract import load_contract
from sluice.functions.rules import fails
from sluice.plans.silver import resource

SILVER = load_contract(resource("contracts", "core_silver.yml"))
GOLD = load_contract(resource("contracts", "customer_gold.yml"))

BASE = {
    "customer_account": dict(ACCOUNT_ID="ACC00000001", CUSTOMER_ID="CUST00000001", ACCOUNT_STATUS=" active ",
                             SERVICE_STATE="OH", OPEN_DATE=dt.date(2020, 1, 1)),
    "customer_profile": dict(CUSTOMER_ID="CUST00000001", FIRST_NAME="Ann", LAST_NAME="Lee", ORG_NAME=None,
                             CUSTOMER_TYPE="residential "),
    "customer_email_contact": dict(ACCOUNT_ID="ACC00000001", EMAIL_ADDRESS="a.b@x.com", EMAIL_STATUS="opted_out",
                                   PREFERRED_EMAIL_FLAG="y", UPDATED_AT=dt.datetime(2024, 1, 1)),
    "customer_contact_summary": dict(CUSTOMER_ID="CUST00000001", EMAIL_ADDRESS=None),
    "customer_account_profile_summary": dict(ACCOUNT_ID="ACC00000001", CUSTOMER_DISPLAY_NAME="Ann Lee"),
}
SCHEMAS = {
    "customer_account": "ACCOUNT_ID string, CUSTOMER_ID string, ACCOUNT_STATUS string, SERVICE_STATE string, "
                        "OPEN_DATE date",
    "customer_profile": "CUSTOMER_ID string, FIRST_NAME string, LAST_NAME string, ORG_NAME string, "
                        "CUSTOMER_TYPE string",
    "customer_email_contact": "ACCOUNT_ID string, EMAIL_ADDRESS string, EMAIL_STATUS string, "
                              "PREFERRED_EMAIL_FLAG string, UPDATED_AT timestamp",
    "customer_contact_summary": "CUSTOMER_ID string, EMAIL_ADDRESS string",
    "customer_account_profile_summary": "ACCOUNT_ID string, CUSTOMER_DISPLAY_NAME string",
}
# rule -> (change that makes it fail, column set to NULL, does the NULL row fail?)
CASES = {
    "customer_account_account_id_format": ({"ACCOUNT_ID": "acc00000001"}, "ACCOUNT_ID", True),
    "customer_account_customer_id_format": ({"CUSTOMER_ID": "CUST1"}, "CUSTOMER_ID", True),
    "customer_account_status_allowed_values": ({"ACCOUNT_STATUS": "PENDING"}, "ACCOUNT_STATUS", True),
    "customer_account_service_state_format": ({"SERVICE_STATE": "oh"}, "SERVICE_STATE", True),
    "customer_account_open_date_not_future": ({"OPEN_DATE": dt.date(2999, 1, 1)}, "OPEN_DATE", True),
    "customer_profile_customer_id_format": ({"CUSTOMER_ID": "CUST0000000X"}, "CUSTOMER_ID", True),
    "customer_profile_customer_type_allowed_values": ({"CUSTOMER_TYPE": "GOVT"}, "CUSTOMER_TYPE", True),
    "customer_profile_name_required_by_type": ({"LAST_NAME": "  "}, "FIRST_NAME", True),
    "customer_email_contact_account_id_format": ({"ACCOUNT_ID": "ACC123"}, "ACCOUNT_ID", True),
    "customer_email_contact_email_required": ({"EMAIL_ADDRESS": "   "}, "EMAIL_ADDRESS", True),
    "customer_email_contact_email_format": ({"EMAIL_ADDRESS": "user@domain"}, "EMAIL_ADDRESS", False),
    "customer_email_contact_email_status_allowed_values": ({"EMAIL_STATUS": "SENT"}, "EMAIL_STATUS", True),
    "customer_email_contact_preferred_flag_allowed_values": ({"PREFERRED_EMAIL_FLAG": "maybe"},
                                                             "PREFERRED_EMAIL_FLAG", True),
    "customer_email_contact_updated_at_not_future": ({"UPDATED_AT": dt.datetime(2999, 1, 1)}, "UPDATED_AT", True),
    "customer_contact_summary_customer_id_required": ({"CUSTOMER_ID": " "}, "CUSTOMER_ID", True),
    "customer_contact_summary_email_format": ({"EMAIL_ADDRESS": "x@y"}, "EMAIL_ADDRESS", False),
    "customer_account_profile_summary_account_id_required": ({"ACCOUNT_ID": ""}, "ACCOUNT_ID", True),
    "customer_account_profile_summary_display_name_required": ({"CUSTOMER_DISPLAY_NAME": " "},
                                                               "CUSTOMER_DISPLAY_NAME", True),
}
RULES = {r.name: r for r in SILVER.rules + GOLD.rules}


def test_every_shipped_rule_has_a_case():
    assert set(CASES) == set(RULES) and len(RULES) == 18


@pytest.mark.parametrize("name", sorted(CASES))
def test_rule_pass_fail_null(spark, name):
    rule = RULES[name]
    change, null_col, null_fails = CASES[name]
    base = BASE[rule.table]
    cols = list(base)
    rows = [tuple(base[c] for c in cols),
            tuple(change.get(c, base[c]) for c in cols),
            tuple(None if c == null_col else base[c] for c in cols)]
    df = spark.createDataFrame(rows, SCHEMAS[rule.table])
    got = [r.f for r in df.select(fails(rule, spark).alias("f")).collect()]
    assert got == [False, True, null_fails]
