"""Classify rows against rules once; derive valid rows, quarantine and metrics from that.

``check(df, rules)`` adds one boolean "failed" column per rule in a single
projection.  Everything else is a lazy view of that frame:

* ``valid()``      rows without an error (warn-only rows stay), result columns dropped
* ``quarantine()`` rows with at least one error (optionally also warn-only rows),
                   with ``_errors`` / ``_warnings`` = array<struct<name, message>>
* ``counts()``     one aggregate: input / valid / error / warning rows and one
                   failure count per rule (``count_if``), partial-aggregated per
                   partition, so its cost does not grow with the number of failures
* ``metrics()``    the 6-column long ledger format built from ``counts()``

When several outputs are written, ``persist()`` the checked frame first (done
per micro-batch by the streaming fan-out) so the rules run once per row.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.contract import ERROR, WARN, Rule
from ..functions.rules import fails

FLAG = "__dq_failed_{}"
ERRORS = "_errors"
WARNINGS = "_warnings"
RESULT_ITEM = T.StructType([T.StructField("name", T.StringType()), T.StructField("message", T.StringType())])
RESULT_TYPE = T.ArrayType(RESULT_ITEM)

# The long-format metrics ledger (fixed layout shared by every ledger).
METRICS_SCHEMA = T.StructType([
    T.StructField("output_location", T.StringType()),
    T.StructField("quarantine_location", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("run_time", T.TimestampType()),
    T.StructField("metric_name", T.StringType()),
    T.StructField("metric_value", T.StringType()),
])
METRIC_NAMES = ("input_row_count", "valid_row_count", "error_row_count", "warning_row_count", "check_metrics")


def _any(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols, F.lit(False))


def _results(pairs: list[tuple[Rule, Column]]) -> Column:
    """array<struct<name,message>> of the failed rules, in rule order (codegen friendly)."""
    empty = F.array().cast(RESULT_TYPE)
    if not pairs:
        return empty
    parts = [
        F.when(flag, F.array(F.struct(F.lit(r.name).alias("name"), F.lit(r.message or r.expression).alias("message"))))
        .otherwise(empty)
        for r, flag in pairs
    ]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


class Checked:
    """A frame with one failure flag per rule; all outputs are lazy views of it."""

    def __init__(self, df: DataFrame, rules: list[Rule], quarantine_warnings: bool = False, _flagged=None):
        if not rules:
            raise ValueError("check() needs at least one rule")
        names = [r.name for r in rules]
        if len(set(names)) != len(names):
            raise ValueError(f"duplicate rule names: {sorted(n for n in set(names) if names.count(n) > 1)}")
        self.rules = list(rules)
        self.columns = [c for c in df.columns if not c.startswith("__dq_failed_")]
        self.flags = [FLAG.format(i) for i in range(len(rules))]
        self.quarantine_warnings = quarantine_warnings
        if _flagged is None:
            spark = df.sparkSession
            cols = [F.col(f"`{c}`") for c in self.columns]
            try:
                _flagged = df.select(*cols, *[fails(r, spark).alias(f) for r, f in zip(rules, self.flags)])
            except Exception as exc:  # name the rule that cannot be evaluated on this frame
                for r in rules:
                    try:
                        df.select(fails(r, spark))
                    except Exception as one:
                        where = f" of table '{r.table}'" if r.table else ""
                        raise ValueError(f"rule '{r.name}'{where} cannot be evaluated: {one}") from one
                raise exc
        self.flagged = _flagged

    # -- flag helpers -------------------------------------------------------
    def _pairs(self, criticality: str) -> list[tuple[Rule, Column]]:
        return [(r, F.col(f)) for r, f in zip(self.rules, self.flags) if r.criticality == criticality]

    @property
    def has_error(self) -> Column:
        return _any([c for _, c in self._pairs(ERROR)])

    @property
    def has_warning(self) -> Column:
        return _any([c for _, c in self._pairs(WARN)])

    def _data_cols(self) -> list[Column]:
        return [F.col(f"`{c}`") for c in self.columns]

    # -- outputs ------------------------------------------------------------
    def valid(self) -> DataFrame:
        return self.flagged.where(~self.has_error).select(*self._data_cols())

    def quarantine(self) -> DataFrame:
        cond = self.has_error | self.has_warning if self.quarantine_warnings else self.has_error
        return self.flagged.where(cond).select(
            *self._data_cols(),
            _results(self._pairs(ERROR)).alias(ERRORS),
            _results(self._pairs(WARN)).alias(WARNINGS),
        )

    def annotated(self) -> DataFrame:
        """Every row with its ``_errors`` / ``_warnings`` (empty arrays when clean)."""
        return self.flagged.select(
            *self._data_cols(),
            _results(self._pairs(ERROR)).alias(ERRORS),
            _results(self._pairs(WARN)).alias(WARNINGS),
        )

    def _count_columns(self) -> list[Column]:
        err, warn = self.has_error, self.has_warning
        return [
            F.count(F.lit(1)).alias("input_row_count"),
            F.count_if(~err & ~warn).alias("valid_row_count"),
            F.count_if(err).alias("error_row_count"),
            F.count_if(warn).alias("warning_row_count"),
            *[F.count_if(F.col(f)).alias(f"failed_{i}") for i, f in enumerate(self.flags)],
        ]

    def counts(self) -> DataFrame:
        """One row: row counts plus one ``failed_<i>`` count per rule."""
        return self.flagged.agg(*self._count_columns())

    def rule_counts(self) -> DataFrame:
        """Long form: (rule_name, criticality, failed_rows), one row per rule."""
        items = [
            F.struct(F.lit(r.name).alias("rule_name"), F.lit(r.criticality).alias("criticality"),
                     F.col(f"failed_{i}").alias("failed_rows"))
            for i, r in enumerate(self.rules)
        ]
        return self.counts().select(F.explode(F.array(*items)).alias("r")).select("r.*")

    def check_metrics_json(self) -> Column:
        items = [
            F.struct(
                F.lit(r.name).alias("check_name"),
                (F.col(f"failed_{i}") if r.criticality == ERROR else F.lit(0).cast("long")).alias("error_count"),
                (F.col(f"failed_{i}") if r.criticality == WARN else F.lit(0).cast("long")).alias("warning_count"),
            )
            for i, r in enumerate(self.rules)
        ]
        return F.to_json(F.array(*items))

    def metrics(self, output_location: str, quarantine_location: str, run_id: str | None = None,
                run_time: Column | None = None) -> DataFrame:
        """The 5-row long-format ledger entry for this check run."""
        run_id = run_id or str(uuid.uuid4())
        run_time = run_time if run_time is not None else F.current_timestamp()
        values = {
            "input_row_count": F.col("input_row_count").cast("string"),
            "valid_row_count": F.col("valid_row_count").cast("string"),
            "error_row_count": F.col("error_row_count").cast("string"),
            "warning_row_count": F.col("warning_row_count").cast("string"),
            "check_metrics": self.check_metrics_json(),
        }
        rows = F.array(*[F.struct(F.lit(k).alias("metric_name"), v.alias("metric_value")) for k, v in values.items()])
        return self.counts().select(
            F.lit(output_location).alias("output_location"),
            F.lit(quarantine_location).alias("quarantine_location"),
            F.lit(run_id).alias("run_id"),
            run_time.cast("timestamp").alias("run_time"),
            F.inline(rows),
        )

    def observed(self, name: str | None = None):
        """(valid rows observed on the way, Observation): the counts arrive with the write of valid rows.

        The observation sits before the filter, so it sees every input row; only
        the aggregated counts (one number per rule) reach the driver.
        """
        from pyspark.sql import Observation

        obs = Observation(name or f"dq_{uuid.uuid4().hex[:8]}")
        watched = self.flagged.observe(obs, *self._count_columns())
        return watched.where(~self.has_error).select(*self._data_cols()), obs

    def metrics_from_counts(self, spark, counts: dict, output_location: str, quarantine_location: str,
                            run_id: str | None = None) -> DataFrame:
        """The ledger entry from already observed counts (no further pass over the data)."""
        import datetime as _dt
        import json as _json

        items = [
            {"check_name": r.name,
             "error_count": int(counts[f"failed_{i}"]) if r.criticality == ERROR else 0,
             "warning_count": int(counts[f"failed_{i}"]) if r.criticality == WARN else 0}
            for i, r in enumerate(self.rules)
        ]
        values = [str(int(counts[k])) for k in METRIC_NAMES[:4]] + [_json.dumps(items, separators=(",", ":"))]
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        run_id = run_id or str(uuid.uuid4())
        rows = [(output_location, quarantine_location, run_id, now, k, v) for k, v in zip(METRIC_NAMES, values)]
        return spark.createDataFrame(rows, METRICS_SCHEMA)

    # -- execution helpers ----------------------------------------------------
    def persist(self, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> "Checked":
        return Checked(self.flagged, self.rules, self.quarantine_warnings, _flagged=self.flagged.persist(level))

    def unpersist(self) -> None:
        self.flagged.unpersist()

    def checkpointed(self) -> "Checked":
        """Materialize the checked rows once (reliable checkpoint in the shared folder).

        For inputs that are expensive to recompute (joins, DISTINCT), so the
        valid and quarantine writes do not each run the whole plan again.
        """
        from ..session import materialize

        return Checked(self.flagged, self.rules, self.quarantine_warnings, _flagged=materialize(self.flagged))


def check(df: DataFrame, rules: list[Rule], quarantine_warnings: bool = False) -> Checked:
    return Checked(df, rules, quarantine_warnings)


def empty_metrics(spark) -> DataFrame:
    """Typed empty ledger (nothing configured)."""
    return spark.createDataFrame([], METRICS_SCHEMA)
