"""Gold: parameterised SQL over silver, an optional quality gate, SCD tables.

Batch builders return lazy DataFrames; ``build_gold`` dispatches on the
registry's ``operation_type`` (materialized_view / delta_type1 / delta_type2).
The streaming CDC form lives in ``sluice.streaming.cdc``.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..functions.binding import bind_sql, read_sql, source_tables
from ..functions.contract import load_contract
from ..operators.quality import Checked, check
from ..operators.scd import scd1, scd2
from ..sources.tables import Layout
from .gold_views import BUILDERS
from .silver import resource

OPERATIONS = ("materialized_view", "delta_type1", "delta_type2")


@dataclass
class GoldSpec:
    name: str
    cfg: dict
    sql: str
    origin: str
    sources: list[str] = field(default_factory=list)
    gate_key: str = "quality_gate"

    @property
    def operation(self) -> str:
        op = self.cfg.get("operation_type", "materialized_view")
        if op not in OPERATIONS:
            raise ValueError(f"gold table '{self.name}': operation_type is {op!r}, expected one of {', '.join(OPERATIONS)}")
        return op

    @property
    def target(self) -> str:
        return self.cfg.get("target_table", self.name)

    @property
    def cdc_target(self) -> str:
        return self.cfg.get("cdc_target_table", f"{self.target}_cdc_internal")

    @property
    def apply_gate(self) -> bool:
        return bool(self.cfg.get(self.gate_key, False))


KNOWN_KEYS = {
    "operation_type", "target_table", "cdc_target_table", "sql_file", "source_table", "source_tables", "sql_parameters",
    "contract_file", "keys", "sequence_by", "except_columns", "track_history_columns", "track_history_except_columns",
    "quarantine_warnings", "cdc_mode", "cdc_compact_every", "cdc_keep_versions", "cdc_keep_seconds", "cdc_buckets", "watermarks", "builder", "description", "comment",
}


def gold_specs(registry: dict, domain: str, sql_dir: str, gate_key: str = "quality_gate") -> list[GoldSpec]:
    """Registry entries; ``gate_key`` names the key that switches the gate on.  Unknown keys are errors."""
    entries = ((registry or {}).get("tables") or {}).get(domain) or {}
    if not entries:
        raise ValueError(f"the registry has no gold tables in domain '{domain}'")
    out = []
    for name, cfg in entries.items():
        cfg = dict(cfg or {})
        unknown = sorted(set(cfg) - KNOWN_KEYS - {gate_key})
        if unknown:
            raise ValueError(f"gold table '{name}': unknown registry keys {unknown}")
        path = os.path.join(sql_dir, cfg.get("sql_file", f"{name}.sql"))
        if cfg.get("builder") and cfg["builder"] not in BUILDERS:
            raise ValueError(f"gold table '{name}': no builder {cfg['builder']!r}")
        spec = GoldSpec(name=name, cfg=cfg, sql="" if cfg.get("builder") else read_sql(path), origin=path, sources=source_tables(name, cfg), gate_key=gate_key)
        spec.operation  # validate early
        out.append(spec)
    return out


def default_gold_specs() -> dict[str, GoldSpec]:
    import yaml

    with open(resource("registry", "gold.yml")) as fh:
        registry = yaml.safe_load(fh)
    return {s.name: s for s in gold_specs(registry, "customer", resource("sql", "gold"))}


def gold_rules(spec: GoldSpec, contract_dir: str | None = None, domain: str = "customer"):
    contract_dir = contract_dir or resource("contracts")
    path = os.path.join(contract_dir, spec.cfg.get("contract_file", f"{domain}.yml"))
    return load_contract(path).rules_for(spec.name)


def gold_source(spark: SparkSession, spec: GoldSpec, silver: dict[str, DataFrame],
                gold: dict[str, DataFrame] | None = None) -> DataFrame:
    """The gold SQL with parameters rendered and ``__silver__`` / ``__gold__`` bound."""
    frames = {"silver": {t: silver[t] for t in spec.sources if t in silver}}
    if spec.cfg.get("builder"):
        return BUILDERS[spec.cfg["builder"]](frames["silver"], spec.cfg.get("sql_parameters") or {})
    if gold:
        frames["gold"] = {t: gold[t] for t in spec.sources if t in gold}
    return bind_sql(spark, spec.sql, frames, spec.cfg.get("sql_parameters") or {}, origin=spec.origin)


@dataclass
class GoldView:
    spec: GoldSpec
    staged: DataFrame
    checked: Checked | None

    def output(self) -> DataFrame:
        return self.checked.valid() if self.checked else self.staged

    def quarantine(self) -> DataFrame:
        if not self.checked:
            raise ValueError(f"'{self.spec.name}' has no quality gate (quality_gate is false)")
        return self.checked.quarantine()

    def metrics(self, layout: Layout, run_id: str | None = None) -> DataFrame:
        if not self.checked:
            raise ValueError(f"'{self.spec.name}' has no quality gate (quality_gate is false)")
        return self.checked.metrics(
            layout.name("gold", self.spec.target),
            layout.name("quarantine", f"{self.spec.target}_gold_quarantine"),
            run_id,
        )


def gold_view(spark: SparkSession, spec: GoldSpec, silver: dict[str, DataFrame], rules=None,
              gold: dict[str, DataFrame] | None = None, layout: Layout | None = None) -> GoldView:
    staged = gold_source(spark, spec, silver, gold)
    checked = None
    if spec.apply_gate:
        if layout is not None and not layout.names.get("quarantine"):
            raise ValueError(f"gold table '{spec.name}' is gated but has nowhere to put its quarantine")
        checked = check(staged, rules if rules is not None else gold_rules(spec),
                        quarantine_warnings=bool(spec.cfg.get("quarantine_warnings", False)))
    return GoldView(spec, staged, checked)


def build_gold(spark: SparkSession, spec: GoldSpec, silver: dict[str, DataFrame], rules=None) -> DataFrame:
    """Batch result of one registry entry."""
    op = spec.operation
    if op == "materialized_view":
        return gold_view(spark, spec, silver, rules).output()
    source = gold_source(spark, spec, silver)
    if spec.apply_gate:
        source = check(source, rules if rules is not None else gold_rules(spec)).valid()
    return apply_cdc(spec, source)


def apply_cdc(spec: GoldSpec, source: DataFrame) -> DataFrame:
    """Type 1 or type 2 result of a (checked) source."""
    op = spec.operation
    keys, seq = spec.cfg.get("keys"), spec.cfg.get("sequence_by")
    if not keys:
        raise ValueError(f"gold table '{spec.name}': {op} needs keys")
    if not seq:
        raise ValueError(f"gold table '{spec.name}': {op} needs sequence_by")
    excluded = spec.cfg.get("except_columns") or []
    if op == "delta_type1":
        return scd1(source, keys, seq, excluded)
    return scd2(
        source, keys, seq, excluded,
        track_history_columns=spec.cfg.get("track_history_columns"),
        track_history_except_columns=spec.cfg.get("track_history_except_columns"),
    )
