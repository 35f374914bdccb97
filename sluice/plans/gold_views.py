"""Gold views of the customer example as DataFrame builders (registry key ``builder``).

A builder takes the silver frames by table name and the entry's ``sql_parameters``.  Output columns are fixed values.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _filled(*columns: str, between: str = "") -> Column:
    """Texts put together, absent ones as nothing, without blanks at the ends."""
    return F.trim(F.array_join(F.array(*[F.coalesce(F.col(c), F.lit("")) for c in columns]), between))


def _with_profile(account: DataFrame, profile: DataFrame, *extra: Column) -> DataFrame:
    person = profile.select("CUSTOMER_ID", "FIRST_NAME", "LAST_NAME", "ORG_NAME", "CUSTOMER_TYPE", *extra)
    return account.withColumnRenamed("OPEN_DATE", "ACCOUNT_OPEN_DATE").join(person, "CUSTOMER_ID", "left")


def account_profile_summary(silver: Mapping[str, DataFrame], params: Mapping[str, str]) -> DataFrame:
    """Active accounts with their profile; a business goes by its organisation, a person by the full name."""
    active = silver["customer_account"].where(F.col("ACCOUNT_STATUS") == "ACTIVE")
    known = _with_profile(active, silver["customer_profile"])
    business = F.coalesce(F.col("CUSTOMER_TYPE") == "BUSINESS", F.lit(False))
    person = _filled("FIRST_NAME", "LAST_NAME", between=" ")
    named = known.withColumn("CUSTOMER_DISPLAY_NAME", F.when(business, F.col("ORG_NAME")).otherwise(person))
    return named.select("ACCOUNT_ID", "CUSTOMER_ID", "FIRST_NAME", "LAST_NAME", "ORG_NAME", "CUSTOMER_DISPLAY_NAME",
                        "CUSTOMER_TYPE", "ACCOUNT_STATUS", "SERVICE_STATE", "ACCOUNT_OPEN_DATE").distinct()


def contact_summary(silver: Mapping[str, DataFrame], params: Mapping[str, str]) -> DataFrame:
    """Accounts with profile and email contact; the filters are predicates over ``ACCOUNT`` and ``EMAIL``."""
    account, email = silver["customer_account"].alias("ACCOUNT"), silver["customer_email_contact"].alias("EMAIL")
    reached = account.join(email, F.col("EMAIL.ACCOUNT_ID") == F.col("ACCOUNT.ACCOUNT_ID"), "left")
    wanted = reached.where(F.expr(params["ACCOUNT_FILTER"]) & F.expr(params["EMAIL_FILTER"])).select("ACCOUNT.*", "EMAIL.EMAIL_ADDRESS")
    known = _with_profile(wanted, silver["customer_profile"])
    hashed = F.sha2("CUSTOMER_ID", int(params["HASH_BITS"])).alias("CUSTOMER_ID_ENCRYPTED")
    shown = _filled("LAST_NAME", "ORG_NAME").alias("DISPLAY_NAME")
    return known.select("CUSTOMER_ID", hashed, "ACCOUNT_ID", "FIRST_NAME", shown, "CUSTOMER_TYPE", "EMAIL_ADDRESS",
                        "ACCOUNT_STATUS", "SERVICE_STATE", "ACCOUNT_OPEN_DATE").distinct()


BUILDERS = {"account_profile_summary": account_profile_summary, "contact_summary": contact_summary}
