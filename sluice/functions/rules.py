"""Rule expressions -> Spark columns.

A check fails a row only when its expression is FALSE; NULL (unknown) passes,
as a SQL CHECK constraint does.  Everything stays a built-in expression, so the
checks of one table become a single projection inside whole-stage codegen.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .contract import Rule


def literal_text(expression: str, spark: SparkSession | None = None) -> str:
    """Keep lone backslashes in string literals as the contract author wrote them.

    Spark's default parser unescapes ``'\\.'`` to ``'.'``, which silently turns a regex "literal dot" into "any
    character".  A lone backslash is therefore doubled; a pair is already escaped and stays.  The session setting
    ``sluice.contract.backslashes`` = ``spark`` takes contracts exactly as Spark parses them.
    """
    if spark is not None and (spark.conf.get("spark.sql.parser.escapedStringLiterals", "false").lower() == "true"
                              or spark.conf.get("sluice.contract.backslashes", "text") == "spark"):
        return expression
    return re.sub(r"\\\\|\\", lambda m: "\\\\", expression)


def passes(rule: Rule, spark: SparkSession | None = None) -> Column:
    """TRUE/NULL -> passes, FALSE -> fails; the result is never NULL."""
    return F.coalesce(F.expr(literal_text(rule.expression, spark)), F.lit(True))


def fails(rule: Rule, spark: SparkSession | None = None) -> Column:
    return ~passes(rule, spark)


def schema_mismatches(df: DataFrame, expected: T.StructType, strict: bool = False) -> list[str]:
    """Differences between a frame's schema and the contract's (driver-side metadata only).

    Non-strict: every declared column must exist with the declared type; extra
    columns are allowed.  Strict additionally forbids extra columns.
    """
    actual = {f.name.lower(): f.dataType for f in df.schema.fields}
    problems = []
    for f in expected.fields:
        got = actual.get(f.name.lower())
        if got is None:
            problems.append(f"missing column {f.name}")
        elif got != f.dataType:
            problems.append(f"column {f.name} has type {got.simpleString()}, expected {f.dataType.simpleString()}")
    if strict:
        declared = {f.name.lower() for f in expected.fields}
        problems += [f"unexpected column {f.name}" for f in df.schema.fields if f.name.lower() not in declared]
    return problems


def schema_rule(table: str, df: DataFrame, expected: T.StructType, strict: bool = False) -> Rule:
    """Schema validation as a rule: a mismatch concerns every row, so it is a constant column."""
    problems = schema_mismatches(df, expected, strict)
    verdict = "false" if problems else "true"
    return Rule(
        name=f"{table}_schema_validation",
        expression=verdict,
        criticality="error",
        table=table,
        message="; ".join(problems) or "schema matches the contract",
    )
