"""Data contracts: YAML (open data contract standard layout) -> rules and expected schema.

Only the fields the checks need are read: ``schema[].name``,
``schema[].properties[].{name, physicalType}`` and each property's
``quality[].implementation.{name, criticality, check.function,
check.arguments.expression}`` plus its ``description``.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

import yaml
from pyspark.sql import types as T

ERROR = "error"
WARN = "warn"
CRITICALITIES = (ERROR, WARN)

# contract physical type -> Spark type (the types the contracts use)
PHYSICAL_TYPES = {
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "INT": T.IntegerType(),
    "INTEGER": T.IntegerType(),
    "BIGINT": T.LongType(),
    "LONG": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
}


@dataclass(frozen=True)
class Rule:
    """One row-level check: the row fails when ``expression`` is FALSE (NULL passes)."""

    name: str
    expression: str
    criticality: str = ERROR
    table: str | None = None
    column: str | None = None
    message: str | None = None

    def __post_init__(self):
        if self.criticality not in CRITICALITIES:
            raise ValueError(f"rule {self.name!r}: criticality must be one of {CRITICALITIES}, got {self.criticality!r}")
        if not self.expression or not self.expression.strip():
            raise ValueError(f"rule {self.name!r}: empty expression")


@dataclass
class Contract:
    rules: list[Rule] = field(default_factory=list)
    schemas: dict[str, T.StructType] = field(default_factory=dict)
    source: str = "<dict>"

    def rules_for(self, table: str) -> list[Rule]:
        """Rules of one table; a table without rules is a configuration error."""
        chosen = [r for r in self.rules if r.table == table]
        if not chosen:
            raise ValueError(
                f"No rules found for table '{table}' in contract '{self.source}'. "
                f"Check that schema.name in the contract matches the table name."
            )
        return chosen

    def schema_for(self, table: str) -> T.StructType:
        if table not in self.schemas:
            raise ValueError(f"Table '{table}' is not declared in contract '{self.source}'")
        return self.schemas[table]


def parse_contract(doc: dict, source: str = "<dict>", default_criticality: str = ERROR) -> Contract:
    """Turn a parsed contract document into rules and expected schemas."""
    contract = Contract(source=source)
    for table in doc.get("schema") or []:
        tname = table.get("name")
        fields = []
        for prop in table.get("properties") or []:
            pname = prop.get("name")
            ptype = str(prop.get("physicalType") or prop.get("logicalType") or "STRING").upper()
            if ptype not in PHYSICAL_TYPES:
                raise ValueError(f"{source}: unsupported physicalType {ptype!r} for {tname}.{pname}")
            fields.append(T.StructField(pname, PHYSICAL_TYPES[ptype], True))
            for q in prop.get("quality") or []:
                impl = q.get("implementation") or {}
                check = impl.get("check") or {}
                fn = check.get("function", "sql_expression")
                if fn != "sql_expression":
                    raise ValueError(f"{source}: check function {fn!r} of {tname}.{pname} is not supported")
                expr = ((check.get("arguments") or {}).get("expression") or "").strip()
                contract.rules.append(
                    Rule(
                        name=impl.get("name") or f"{tname}_{pname}_{len(contract.rules)}",
                        expression=expr,
                        criticality=impl.get("criticality", default_criticality),
                        table=tname,
                        column=pname,
                        message=q.get("description"),
                    )
                )
        contract.schemas[tname] = T.StructType(fields)
    return contract


def load_contract(path: str, default_criticality: str = ERROR) -> Contract:
    if not os.path.exists(path):
        raise FileNotFoundError(f"Contract file not found: {path}")
    with open(path) as fh:
        doc = yaml.safe_load(fh) or {}
    return parse_contract(doc, source=path, default_criticality=default_criticality)
