"""sluice: layered (bronze / silver / gold) quality and CDC tables on Apache Spark.

Everything is DataFrame, SQL and Structured Streaming code: contract checks are
built-in column expressions, quarantine and metrics are views of one checked
frame, slowly changing dimensions are aggregates and range-chunked windows.
"""

from .functions.binding import bind_sql
from .functions.contract import Contract, Rule, load_contract, parse_contract
from .operators.joins import left_join_many
from .operators.quality import Checked, check, empty_metrics
from .operators.scd import latest_per_key, scd1, scd2
from .plans.project import Project
from .plans.runner import run_global, run_gold, run_silver
from .sources.tables import CatalogLayout, Layout

__all__ = [
    "CatalogLayout", "Checked", "Contract", "Layout", "Project", "Rule", "bind_sql", "check", "empty_metrics",
    "latest_per_key", "left_join_many", "load_contract", "parse_contract", "run_global", "run_gold", "run_silver",
    "scd1", "scd2",
]
