"""Bronze inputs derived from the driver's TPC-H-like tables.

The mapping (FIXTURES.md §3) turns ``orders``, ``customer`` and ``events`` into
the three bronze tables the contracts talk about, with deliberate dirty rows.
Every function returns a lazy DataFrame over the whole source table; they work
equally on a streaming DataFrame (all expressions are row-local).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values of the fixture mapping: id prefixes and width, the "far future"
# date used to plant not-in-the-future failures, and the business segments.
ACCOUNT_PREFIX = "ACC"
CUSTOMER_PREFIX = "CUST"
ID_WIDTH = 8
FAR_FUTURE = "2999-01-01"
BUSINESS_SEGMENTS = ["MACHINERY", "BUILDING", "AUTOMOBILE"]


def _padded(prefix: str, key: str) -> str:
    return f"concat('{prefix}', lpad(CAST({key} AS STRING), {ID_WIDTH}, '0'))"


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


_READS: dict = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's parquet table (the footer is read once per session and path)."""
    key = (id(spark), table_path(sf_dir, name))
    df = _READS.get(key)
    if df is None or df.sparkSession is not spark:
        df = _READS[key] = spark.read.parquet(key[1])
    return df


# The mapping is written as SQL expressions: one parse per column on the JVM side.
_SEGMENTS = ", ".join(f"'{s}'" for s in BUSINESS_SEGMENTS)

ACCOUNT_EXPRS = [
    f"""CASE WHEN o_orderkey % 97 = 0 THEN CAST(NULL AS STRING)
         WHEN o_orderkey % 89 = 0 THEN {_padded(ACCOUNT_PREFIX.lower(), 'o_orderkey')}
         ELSE {_padded(ACCOUNT_PREFIX, 'o_orderkey')} END AS ACCOUNT_ID""",
    # some accounts name a customer that has no profile: account -> profile has orphans
    f"{_padded(CUSTOMER_PREFIX, 'IF(o_orderkey % 53 = 0, 90000000, 0) + o_custkey')} AS CUSTOMER_ID",
    """CASE WHEN o_orderkey % 71 = 0 THEN 'PENDING' WHEN o_orderkey % 73 = 0 THEN ' active '
         WHEN o_orderstatus = 'O' THEN 'ACTIVE' WHEN o_orderstatus = 'P' THEN 'INACTIVE'
         ELSE 'CLOSED' END AS ACCOUNT_STATUS""",
    "CASE WHEN o_orderkey % 83 = 0 THEN 'xx' ELSE concat(chr(o_custkey % 26 + 65), 'X') END AS SERVICE_STATE",
    f"CASE WHEN o_orderkey % 79 = 0 THEN DATE'{FAR_FUTURE}' ELSE CAST(o_orderdate AS DATE) END AS OPEN_DATE",
]

PROFILE_EXPRS = [
    f"{_padded(CUSTOMER_PREFIX, 'c_custkey')} AS CUSTOMER_ID",
    "CASE WHEN _b THEN CAST(NULL AS STRING) ELSE concat('First', CAST(c_custkey AS STRING)) END AS FIRST_NAME",
    "CASE WHEN _b OR c_custkey % 37 = 0 THEN CAST(NULL AS STRING) "
    "ELSE concat('Last', CAST(c_custkey AS STRING)) END AS LAST_NAME",
    "CASE WHEN _b THEN c_name END AS ORG_NAME",
    """CASE WHEN c_custkey % 43 = 0 THEN 'GOVT' WHEN _b AND c_custkey % 41 = 0 THEN 'business '
         WHEN _b THEN 'BUSINESS' ELSE 'RESIDENTIAL' END AS CUSTOMER_TYPE""",
]

EMAIL_EXPRS = [
    f"{_padded(ACCOUNT_PREFIX, 'user_id')} AS ACCOUNT_ID",
    """CASE WHEN event_id % 101 = 0 THEN 'user@domain' WHEN event_id % 103 = 0 THEN CAST(NULL AS STRING)
         ELSE concat('user', CAST(user_id AS STRING), '.', CAST(event_id % 3 AS STRING), '@example.com')
         END AS EMAIL_ADDRESS""",
    """CASE WHEN event_id % 113 = 0 THEN ' valid ' WHEN event_type = 'error' THEN 'BOUNCED'
         WHEN event_type = 'signup' THEN 'INVALID' ELSE 'VALID' END AS EMAIL_STATUS""",
    "CASE WHEN event_id % 109 = 0 THEN 'maybe' WHEN value >= 10 THEN 'Y' ELSE 'N' END AS PREFERRED_EMAIL_FLAG",
    # driver timestamps are timestamp_ntz; contracts speak TIMESTAMP (session time zone is UTC)
    f"CASE WHEN event_id % 107 = 0 THEN TIMESTAMP'{FAR_FUTURE} 00:00:00' ELSE CAST(ts AS TIMESTAMP) END AS UPDATED_AT",
]


def account_from_orders(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(*ACCOUNT_EXPRS)


def profile_from_customer(customer: DataFrame) -> DataFrame:
    return customer.selectExpr("*", f"c_mktsegment IN ({_SEGMENTS}) AS _b").selectExpr(*PROFILE_EXPRS)


def email_from_events(events: DataFrame) -> DataFrame:
    return events.selectExpr(*EMAIL_EXPRS)


BRONZE_SOURCES = {
    "customer_account": ("orders", account_from_orders),
    "customer_profile": ("customer", profile_from_customer),
    "customer_email_contact": ("events", email_from_events),
}


def bronze(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One bronze table as a batch DataFrame."""
    src, fn = BRONZE_SOURCES[table]
    return fn(read_table(spark, sf_dir, src))


def bronze_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: bronze(spark, sf_dir, t) for t in BRONZE_SOURCES}


def bronze_stream(spark: SparkSession, sf_dir: str, table: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """One bronze table as a streaming DataFrame over the driver's parquet file."""
    src, fn = BRONZE_SOURCES[table]
    schema = read_table(spark, sf_dir, src).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{src}.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return fn(reader.parquet(sf_dir))
