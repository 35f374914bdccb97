"""DuckDB oracle SQL for the correctness gate (independent restatement of the semantics).

The driver pre-registers the parquet tables as views; these strings build the
bronze fixtures, the per-rule failure flags, silver, gold, SCD and ledgers in
plain DuckDB SQL.  A rule fails a row only when its predicate is FALSE
(``coalesce(NOT p, false)``); NULL passes.
"""

from __future__ import annotations

EMAIL_RE = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"

BRONZE = r"""
bronze_account AS (
  SELECT
    CASE WHEN o_orderkey % 97 = 0 THEN NULL
         WHEN o_orderkey % 89 = 0 THEN 'acc' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0')
         ELSE 'ACC' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') END AS ACCOUNT_ID,
    'CUST' || lpad(CAST(CASE WHEN o_orderkey % 53 = 0 THEN 90000000 ELSE 0 END + o_custkey AS VARCHAR), 8, '0') AS CUSTOMER_ID,
    CASE WHEN o_orderkey % 71 = 0 THEN 'PENDING' WHEN o_orderkey % 73 = 0 THEN ' active '
         WHEN o_orderstatus = 'O' THEN 'ACTIVE' WHEN o_orderstatus = 'P' THEN 'INACTIVE' ELSE 'CLOSED' END AS ACCOUNT_STATUS,
    CASE WHEN o_orderkey % 83 = 0 THEN 'xx' ELSE chr(CAST(65 + o_custkey % 26 AS INTEGER)) || 'X' END AS SERVICE_STATE,
    CASE WHEN o_orderkey % 79 = 0 THEN DATE '2999-01-01' ELSE CAST(o_orderdate AS DATE) END AS OPEN_DATE
  FROM orders),
bronze_profile AS (
  SELECT
    'CUST' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS CUSTOMER_ID,
    CASE WHEN b THEN NULL ELSE 'First' || c_custkey END AS FIRST_NAME,
    CASE WHEN b OR c_custkey % 37 = 0 THEN NULL ELSE 'Last' || c_custkey END AS LAST_NAME,
    CASE WHEN b THEN c_name END AS ORG_NAME,
    CASE WHEN c_custkey % 43 = 0 THEN 'GOVT' WHEN b AND c_custkey % 41 = 0 THEN 'business '
         WHEN b THEN 'BUSINESS' ELSE 'RESIDENTIAL' END AS CUSTOMER_TYPE
  FROM (SELECT *, c_mktsegment IN ('MACHINERY', 'BUILDING', 'AUTOMOBILE') AS b FROM customer)),
bronze_email AS (
  SELECT
    'ACC' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS ACCOUNT_ID,
    CASE WHEN event_id % 101 = 0 THEN 'user@domain' WHEN event_id % 103 = 0 THEN NULL
         ELSE 'user' || user_id || '.' || (event_id % 3) || '@example.com' END AS EMAIL_ADDRESS,
    CASE WHEN event_id % 113 = 0 THEN ' valid ' WHEN event_type = 'error' THEN 'BOUNCED'
         WHEN event_type = 'signup' THEN 'INVALID' ELSE 'VALID' END AS EMAIL_STATUS,
    CASE WHEN event_id % 109 = 0 THEN 'maybe' WHEN value >= 10 THEN 'Y' ELSE 'N' END AS PREFERRED_EMAIL_FLAG,
    CASE WHEN event_id % 107 = 0 THEN TIMESTAMP '2999-01-01' ELSE ts END AS UPDATED_AT
  FROM events)"""

# (rule name, criticality, DuckDB predicate that holds for a good row)
RULES = {
    "customer_account": [
        ("customer_account_account_id_format", "error",
         "ACCOUNT_ID IS NOT NULL AND regexp_matches(trim(ACCOUNT_ID), '^ACC[0-9]{8}$')"),
        ("customer_account_customer_id_format", "error",
         "CUSTOMER_ID IS NOT NULL AND regexp_matches(trim(CUSTOMER_ID), '^CUST[0-9]{8}$')"),
        ("customer_account_status_allowed_values", "error",
         "ACCOUNT_STATUS IS NOT NULL AND upper(trim(ACCOUNT_STATUS)) IN ('ACTIVE', 'INACTIVE', 'CLOSED')"),
        ("customer_account_service_state_format", "warn",
         "SERVICE_STATE IS NOT NULL AND regexp_matches(SERVICE_STATE, '^[A-Z]{2}$')"),
        ("customer_account_open_date_not_future", "error",
         "OPEN_DATE IS NOT NULL AND OPEN_DATE <= current_date"),
        ("customer_account_schema_validation", "error", "true"),
    ],
    "customer_profile": [
        ("customer_profile_customer_id_format", "error",
         "CUSTOMER_ID IS NOT NULL AND regexp_matches(trim(CUSTOMER_ID), '^CUST[0-9]{8}$')"),
        ("customer_profile_customer_type_allowed_values", "error",
         "CUSTOMER_TYPE IS NOT NULL AND upper(trim(CUSTOMER_TYPE)) IN ('RESIDENTIAL', 'BUSINESS')"),
        ("customer_profile_name_required_by_type", "error",
         "(upper(trim(CUSTOMER_TYPE)) = 'RESIDENTIAL' AND FIRST_NAME IS NOT NULL AND trim(FIRST_NAME) <> '' "
         "AND LAST_NAME IS NOT NULL AND trim(LAST_NAME) <> '') OR "
         "(upper(trim(CUSTOMER_TYPE)) = 'BUSINESS' AND ORG_NAME IS NOT NULL AND trim(ORG_NAME) <> '')"),
        ("customer_profile_schema_validation", "error", "true"),
    ],
    "customer_email_contact": [
        ("customer_email_contact_account_id_format", "error",
         "ACCOUNT_ID IS NOT NULL AND regexp_matches(trim(ACCOUNT_ID), '^ACC[0-9]{8}$')"),
        ("customer_email_contact_email_required", "error", "EMAIL_ADDRESS IS NOT NULL AND trim(EMAIL_ADDRESS) <> ''"),
        ("customer_email_contact_email_format", "error", f"regexp_matches(EMAIL_ADDRESS, '{EMAIL_RE}')"),
        ("customer_email_contact_email_status_allowed_values", "error",
         "EMAIL_STATUS IS NOT NULL AND upper(trim(EMAIL_STATUS)) IN ('VALID', 'INVALID', 'BOUNCED', 'OPTED_OUT')"),
        ("customer_email_contact_preferred_flag_allowed_values", "error",
         "PREFERRED_EMAIL_FLAG IS NOT NULL AND upper(trim(PREFERRED_EMAIL_FLAG)) IN ('Y', 'N')"),
        ("customer_email_contact_updated_at_not_future", "error",
         "UPDATED_AT IS NOT NULL AND UPDATED_AT <= CAST(now() AS TIMESTAMP)"),
        ("customer_email_contact_schema_validation", "error", "true"),
    ],
    "customer_contact_summary": [
        ("customer_contact_summary_customer_id_required", "error", "CUSTOMER_ID IS NOT NULL AND trim(CUSTOMER_ID) <> ''"),
        ("customer_contact_summary_email_format", "error",
         f"EMAIL_ADDRESS IS NULL OR regexp_matches(EMAIL_ADDRESS, '{EMAIL_RE}')"),
    ],
    "customer_account_profile_summary": [
        ("customer_account_profile_summary_account_id_required", "error",
         "ACCOUNT_ID IS NOT NULL AND trim(ACCOUNT_ID) <> ''"),
        ("customer_account_profile_summary_display_name_required", "error",
         "CUSTOMER_DISPLAY_NAME IS NOT NULL AND trim(CUSTOMER_DISPLAY_NAME) <> ''"),
    ],
}

SILVER_COLS = {
    "customer_account": "ACCOUNT_ID, CUSTOMER_ID, ACCOUNT_STATUS, SERVICE_STATE, OPEN_DATE",
    "customer_profile": "CUSTOMER_ID, FIRST_NAME, LAST_NAME, ORG_NAME, CUSTOMER_TYPE",
    "customer_email_contact": "ACCOUNT_ID, EMAIL_ADDRESS, EMAIL_STATUS, PREFERRED_EMAIL_FLAG, UPDATED_AT",
}
SHORT = {"customer_account": "account", "customer_profile": "profile", "customer_email_contact": "email",
         "customer_contact_summary": "contact", "customer_account_profile_summary": "summary"}


def _flags_cte(table: str, source: str) -> str:
    flags = ",\n    ".join(f'coalesce(NOT ({p}), false) AS "f_{n}"' for n, _, p in RULES[table])
    return f"{SHORT[table]}_f AS (\n  SELECT *,\n    {flags}\n  FROM {source})"


def _any(table: str, criticality: str) -> str:
    names = [f'"f_{n}"' for n, c, _ in RULES[table] if c == criticality]
    return "(" + " OR ".join(names) + ")" if names else "false"


def _names(table: str, criticality: str) -> str:
    parts = [f"CASE WHEN \"f_{n}\" THEN '{n}' END" for n, c, _ in RULES[table] if c == criticality]
    return "concat_ws(',', " + ", ".join(parts) + ")" if parts else "''"


GOLD_CONTACT = """
contact_staged AS (
  SELECT DISTINCT a.CUSTOMER_ID AS CUSTOMER_ID, sha256(a.CUSTOMER_ID) AS CUSTOMER_ID_ENCRYPTED,
    a.ACCOUNT_ID AS ACCOUNT_ID, p.FIRST_NAME AS FIRST_NAME,
    trim(coalesce(p.LAST_NAME, '') || coalesce(p.ORG_NAME, '')) AS DISPLAY_NAME,
    p.CUSTOMER_TYPE AS CUSTOMER_TYPE, e.EMAIL_ADDRESS AS EMAIL_ADDRESS, a.ACCOUNT_STATUS AS ACCOUNT_STATUS,
    a.SERVICE_STATE AS SERVICE_STATE, a.OPEN_DATE AS ACCOUNT_OPEN_DATE
  FROM silver_account a
  LEFT JOIN silver_profile p ON p.CUSTOMER_ID = a.CUSTOMER_ID
  LEFT JOIN silver_email e ON e.ACCOUNT_ID = a.ACCOUNT_ID
  WHERE a.ACCOUNT_STATUS = 'ACTIVE' AND e.EMAIL_STATUS = 'VALID' AND e.PREFERRED_EMAIL_FLAG = 'Y'),
summary_staged AS (
  SELECT DISTINCT a.ACCOUNT_ID AS ACCOUNT_ID, a.CUSTOMER_ID AS CUSTOMER_ID, p.FIRST_NAME AS FIRST_NAME,
    p.LAST_NAME AS LAST_NAME, p.ORG_NAME AS ORG_NAME,
    CASE WHEN p.CUSTOMER_TYPE = 'BUSINESS' THEN p.ORG_NAME
         ELSE trim(coalesce(p.FIRST_NAME, '') || ' ' || coalesce(p.LAST_NAME, '')) END AS CUSTOMER_DISPLAY_NAME,
    p.CUSTOMER_TYPE AS CUSTOMER_TYPE, a.ACCOUNT_STATUS AS ACCOUNT_STATUS, a.SERVICE_STATE AS SERVICE_STATE,
    a.OPEN_DATE AS ACCOUNT_OPEN_DATE
  FROM silver_account a LEFT JOIN silver_profile p ON p.CUSTOMER_ID = a.CUSTOMER_ID
  WHERE a.ACCOUNT_STATUS = 'ACTIVE')"""


def ctes() -> str:
    parts = [BRONZE]
    for t, src in (("customer_account", "bronze_account"), ("customer_profile", "bronze_profile"),
                   ("customer_email_contact", "bronze_email")):
        parts.append(_flags_cte(t, src))
        parts.append(f"silver_{SHORT[t]} AS (SELECT {SILVER_COLS[t]} FROM {SHORT[t]}_f WHERE NOT {_any(t, 'error')})")
    parts.append(GOLD_CONTACT)
    parts.append(_flags_cte("customer_contact_summary", "contact_staged"))
    parts.append(_flags_cte("customer_account_profile_summary", "summary_staged"))
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


def q(body: str) -> str:
    return ctes() + body


def quarantine_report(table: str, cols: str) -> str:
    s = SHORT[table]
    return q(f"SELECT {cols}, {_names(table, 'error')} AS error_names, {_names(table, 'warn')} AS warning_names "
             f"FROM {s}_f WHERE {_any(table, 'error')}")


def counts(table: str) -> str:
    s = SHORT[table]
    e, w = _any(table, "error"), _any(table, "warn")
    return q(f"SELECT count(*) AS input_row_count, count(*) FILTER (WHERE NOT ({e} OR {w})) AS valid_row_count, "
             f"count(*) FILTER (WHERE {e}) AS error_row_count, count(*) FILTER (WHERE {w}) AS warning_row_count "
             f"FROM {s}_f")


def rule_counts(table: str) -> str:
    s = SHORT[table]
    parts = [f"SELECT '{n}' AS rule_name, '{c}' AS criticality, count(*) FILTER (WHERE \"f_{n}\") AS failed_rows "
             f"FROM {s}_f" for n, c, _ in RULES[table]]
    return q(" UNION ALL ".join(parts))


def metrics_select(table: str, out_loc: str, q_loc: str) -> str:
    """The long-format ledger entry of one checked table, without run_id / run_time."""
    s = SHORT[table]
    e, w = _any(table, "error"), _any(table, "warn")
    items = ", ".join(
        f"{{'check_name': '{n}', "
        f"'error_count': {f'count(*) FILTER (WHERE \"f_{n}\")' if c == 'error' else 'CAST(0 AS BIGINT)'}, "
        f"'warning_count': {f'count(*) FILTER (WHERE \"f_{n}\")' if c == 'warn' else 'CAST(0 AS BIGINT)'}}}"
        for n, c, _ in RULES[table]
    )
    agg = (f"SELECT CAST(count(*) AS VARCHAR) AS i, CAST(count(*) FILTER (WHERE NOT ({e} OR {w})) AS VARCHAR) AS v, "
           f"CAST(count(*) FILTER (WHERE {e}) AS VARCHAR) AS er, CAST(count(*) FILTER (WHERE {w}) AS VARCHAR) AS wa, "
           f"CAST(to_json([{items}]) AS VARCHAR) AS cm FROM {s}_f")
    return (f"SELECT '{out_loc}' AS output_location, '{q_loc}' AS quarantine_location, metric_name, metric_value "
            f"FROM ({agg}) m, LATERAL (VALUES ('input_row_count', m.i), ('valid_row_count', m.v), "
            f"('error_row_count', m.er), ('warning_row_count', m.wa), ('check_metrics', m.cm)) t(metric_name, metric_value)")


def silver_metrics_select() -> str:
    return " UNION ALL ".join(
        metrics_select(t, f"silver.{t}", f"quarantine.{t}_quarantine")
        for t in ("customer_account", "customer_profile", "customer_email_contact"))


def gold_metrics_select() -> str:
    return " UNION ALL ".join(
        metrics_select(t, f"gold.{t}", f"quarantine.{t}_gold_quarantine")
        for t in ("customer_contact_summary", "customer_account_profile_summary"))


EMAIL_COLS = "ACCOUNT_ID, EMAIL_ADDRESS, EMAIL_STATUS, PREFERRED_EMAIL_FLAG, UPDATED_AT"

SCD1 = q(f"""SELECT {EMAIL_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY ACCOUNT_ID ORDER BY UPDATED_AT DESC, EMAIL_ADDRESS DESC NULLS LAST,
    EMAIL_STATUS DESC NULLS LAST, PREFERRED_EMAIL_FLAG DESC NULLS LAST) AS rn
  FROM silver_email WHERE ACCOUNT_ID IS NOT NULL AND UPDATED_AT IS NOT NULL) WHERE rn = 1""")

SCD1_ENRICHED = q(f"""SELECT {EMAIL_COLS}, ACCOUNT_STATUS FROM (
  SELECT e.*, a.ACCOUNT_STATUS, row_number() OVER (PARTITION BY e.ACCOUNT_ID ORDER BY e.UPDATED_AT DESC, EMAIL_ADDRESS DESC NULLS LAST,
    EMAIL_STATUS DESC NULLS LAST, PREFERRED_EMAIL_FLAG DESC NULLS LAST, a.ACCOUNT_STATUS DESC NULLS LAST) AS rn
  FROM silver_email e JOIN silver_account a ON a.ACCOUNT_ID = e.ACCOUNT_ID WHERE e.UPDATED_AT IS NOT NULL) WHERE rn = 1""")


def scd2(tracked: list[str]) -> str:
    prev = ", ".join(f"lag({c}) OVER w AS p_{c}" for c in tracked)
    same = " AND ".join(f"p_{c} IS NOT DISTINCT FROM {c}" for c in tracked)
    return ctes().rstrip() + f""",
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ACCOUNT_ID, UPDATED_AT ORDER BY
      EMAIL_ADDRESS DESC NULLS LAST, EMAIL_STATUS DESC NULLS LAST, PREFERRED_EMAIL_FLAG DESC NULLS LAST) AS rn
    FROM silver_email WHERE ACCOUNT_ID IS NOT NULL AND UPDATED_AT IS NOT NULL) WHERE rn = 1),
l AS (SELECT *, {prev}, row_number() OVER w AS pos FROM d WINDOW w AS (PARTITION BY ACCOUNT_ID ORDER BY UPDATED_AT)),
c AS (SELECT *, CASE WHEN pos = 1 OR NOT ({same}) THEN 1 ELSE 0 END AS chg FROM l),
i AS (SELECT *, sum(chg) OVER (PARTITION BY ACCOUNT_ID ORDER BY UPDATED_AT ROWS UNBOUNDED PRECEDING) AS island FROM c),
s AS (SELECT ACCOUNT_ID, island, min(UPDATED_AT) AS __START_AT FROM i GROUP BY ACCOUNT_ID, island),
r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ACCOUNT_ID, island ORDER BY UPDATED_AT DESC) AS rk
      FROM i) WHERE rk = 1)
SELECT r.ACCOUNT_ID, r.EMAIL_ADDRESS, r.EMAIL_STATUS, r.PREFERRED_EMAIL_FLAG, r.UPDATED_AT, s.__START_AT,
  lead(s.__START_AT) OVER (PARTITION BY s.ACCOUNT_ID ORDER BY s.island) AS __END_AT
FROM r JOIN s ON r.ACCOUNT_ID = s.ACCOUNT_ID AND r.island = s.island"""


def hot(sql: str) -> str:
    """The same query over events where every third event belongs to user 0 (a hot account)."""
    marker = "  FROM events)"
    assert sql.count(marker) == 1
    return sql.replace(marker, "  FROM (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id) "
                               "FROM events))")


def unvalidated(sql: str) -> str:
    """The same query with the gold statements over bronze rows: no silver rule applied."""
    assert sql.count(GOLD_CONTACT.strip()) == 1
    return sql.replace(GOLD_CONTACT.strip(), GOLD_CONTACT.strip().replace("silver_", "bronze_"))
