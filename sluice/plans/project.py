"""Load an existing project folder: registries, contracts and SQL in their usual places.

    <base>/config/silver.yml                               silver registry (tables per source system)
    <base>/config/gold.yml                                 gold registry (tables per domain)
    <base>/contracts/01_silver/<system>/<system>.yml       silver contract
    <base>/contracts/02_gold/<domain>/<contract_file>      gold contract (default <domain>.yml)
    <base>/src/01_silver/sql/<system>/<table>.sql          silver projection
    <base>/src/02_gold/sql/<domain>/<sql_file>             gold SQL (default <table>.sql)

``Project.silver_tables(system)`` / ``Project.gold_specs(domain)`` give the
definitions the runners take; gold rules are resolved per table from the
configured contract file.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

import yaml

from ..functions.contract import load_contract
from .gold import GoldSpec, gold_rules, gold_specs
from .silver import SilverTable, silver_tables


def _yaml(path: str) -> dict:
    if not os.path.exists(path):
        raise FileNotFoundError(f"Expected configuration file not found at: {path}")
    with open(path) as fh:
        return yaml.safe_load(fh) or {}


@dataclass
class Project:
    base: str
    gate_key: str = "quality_gate"  # the gold registry's key that switches a table's gate on

    def silver_tables(self, system: str) -> list[SilverTable]:
        registry = _yaml(os.path.join(self.base, "config", "silver.yml"))
        contract = load_contract(os.path.join(self.base, "contracts", "01_silver", system, f"{system}.yml"))
        return silver_tables(registry, system, contract, os.path.join(self.base, "src", "01_silver", "sql", system))

    def gold_specs(self, domain: str) -> list[GoldSpec]:
        registry = _yaml(os.path.join(self.base, "config", "gold.yml"))
        return gold_specs(registry, domain, os.path.join(self.base, "src", "02_gold", "sql", domain), self.gate_key)

    def gold_rules(self, spec: GoldSpec, domain: str):
        return gold_rules(spec, os.path.join(self.base, "contracts", "02_gold", domain), domain)
