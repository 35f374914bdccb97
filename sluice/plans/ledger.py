"""Metrics ledgers: per system, per gold domain, and the global roll-up.

All ledgers share the 6-column long format; unions are by name and lazy.
Discovery lists table folders (metadata only) and keeps ``*_quality_metrics``
except the global ledger itself; the gold ledgers (``*_gold_quality_metrics``)
match the suffix too and are included.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import METRICS_SCHEMA, empty_metrics
from ..sources.tables import Layout

SUFFIX = "_quality_metrics"
GLOBAL = "global_quality_metrics"
COLUMNS = [f.name for f in METRICS_SCHEMA.fields]


def union_ledgers(spark: SparkSession, frames: list[DataFrame]) -> DataFrame:
    frames = [f.select(*COLUMNS) for f in frames]
    if not frames:
        return empty_metrics(spark)
    return reduce(DataFrame.unionByName, frames)


def system_ledger_name(system: str) -> str:
    return f"{system}{SUFFIX}"


def gold_ledger_name(domain: str) -> str:
    return f"{domain}_gold{SUFFIX}"


def discover_ledgers(spark: SparkSession, layout: Layout) -> list[str]:
    return [t for t in layout.list_tables(spark, "metrics") if t.endswith(SUFFIX) and t != GLOBAL]


def global_ledger(spark: SparkSession, layout: Layout) -> DataFrame:
    return union_ledgers(spark, [layout.read(spark, "metrics", t) for t in discover_ledgers(spark, layout)])


CHECK_METRICS_TYPE = T.ArrayType(T.StructType([
    T.StructField("check_name", T.StringType()),
    T.StructField("error_count", T.LongType()),
    T.StructField("warning_count", T.LongType()),
]))
COUNTS = ("input_row_count", "valid_row_count", "error_row_count", "warning_row_count")


def totals(ledger: DataFrame, run_id: str = "total") -> DataFrame:
    """Fold per-run entries (e.g. one per micro-batch) into one entry per table.

    Row counts are summed; ``check_metrics`` is summed per check, in the order
    the checks first appear.  The result has the ledger layout again.
    """
    keys = ["output_location", "quarantine_location"]
    counts = (
        ledger.where(F.col("metric_name").isin(*COUNTS))
        .groupBy(*keys, "metric_name")
        .agg(F.sum(F.col("metric_value").cast("long")).cast("string").alias("metric_value"),
             F.max("run_time").alias("run_time"))
    )
    checks = (
        ledger.where(F.col("metric_name") == "check_metrics")
        .select(*keys, "run_time", F.posexplode(F.from_json("metric_value", CHECK_METRICS_TYPE)).alias("pos", "c"))
        .groupBy(*keys, F.col("c.check_name").alias("check_name"))
        .agg(F.min("pos").alias("pos"), F.sum("c.error_count").alias("error_count"),
             F.sum("c.warning_count").alias("warning_count"), F.max("run_time").alias("run_time"))
        .groupBy(*keys)
        .agg(F.to_json(F.transform(
                 F.array_sort(F.collect_list(F.struct("pos", "check_name", "error_count", "warning_count"))),
                 lambda x: F.struct(x["check_name"].alias("check_name"), x["error_count"].alias("error_count"),
                                    x["warning_count"].alias("warning_count")))).alias("metric_value"),
             F.max("run_time").alias("run_time"))
        .withColumn("metric_name", F.lit("check_metrics"))
    )
    out = counts.unionByName(checks)
    return out.select(*keys, F.lit(run_id).alias("run_id"), "run_time", "metric_name", "metric_value")
