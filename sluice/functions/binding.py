"""SQL text with layer placeholders and ``${PARAM}`` parameters -> ``spark.sql``.

* ``__bronze__.t`` / ``__silver__.t`` / ``__gold__.t`` are bound to DataFrames
  (batch or streaming) with ``spark.sql(text, **frames)``; the placeholder must
  be a whole identifier (``t`` does not match ``t_x``) and every placeholder
  left unresolved is an error.
* ``${NAME}`` parameters: a numeric value becomes a bound named parameter
  (``:NAME``); any other value is trusted configuration text (a predicate such
  as ``EMAIL.EMAIL_STATUS = 'VALID'``) and is substituted.  A ``${X}`` without a
  value is an error naming the parameter and the file.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession

LAYERS = ("bronze", "silver", "gold")
_PARAM = re.compile(r"\$\{([A-Za-z0-9_]+)\}")
_PLACEHOLDER = re.compile(r"__(bronze|silver|gold)__\.([A-Za-z_][A-Za-z0-9_]*)\b")
_NUMBER = re.compile(r"^[+-]?\d+(\.\d+)?$")


def read_sql(path: str) -> str:
    if not os.path.exists(path):
        raise FileNotFoundError(f"SQL file not found: {path}")
    with open(path) as fh:
        return check_not_empty(fh.read(), path)


def check_not_empty(text: str, origin: str = "<sql>") -> str:
    """Empty text, or a single comment line, is not a query."""
    t = (text or "").strip()
    if not t or (t.startswith("--") and len(t.splitlines()) == 1):
        raise ValueError(f"{origin} holds no query")
    return t


# string literals (either quote) and comments: text inside them is never a place for a bound number
_OPAQUE = re.compile(r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/""", re.S)


def render_parameters(text: str, params: dict | None, origin: str = "<sql>") -> tuple[str, dict]:
    """Returns (text, args).

    A numeric value standing alone outside quotes and comments becomes the marker ``:NAME`` bound by ``args``.  Anything
    else (predicates, lists, parts of names or literals) is substituted as the text given.
    """
    params = {str(k): v for k, v in (params or {}).items()}
    missing = sorted({m for m in _PARAM.findall(text) if m not in params})
    if missing:
        raise ValueError(f"{origin} uses parameters without a value: {', '.join(missing)} (given: {', '.join(params) or 'none'})")
    opaque = [m.span() for m in _OPAQUE.finditer(text)]
    args = {}

    def sub(m):
        value = params[m.group(1)]
        if isinstance(value, bool):
            return "true" if value else "false"
        inside = any(a <= m.start() < b for a, b in opaque)
        near = text[m.start() - 1 : m.start()] + text[m.end() : m.end() + 1]
        alone = not inside and not re.search(r"[\w$.{}]", near)
        s = str(value).strip()
        if alone and (isinstance(value, (int, float)) or _NUMBER.match(s)):
            args[m.group(1)] = float(s) if re.search(r"[.eE]", s) else int(s)
            return f":{m.group(1)}"
        return str(value)

    return _PARAM.sub(sub, text), args


def placeholders(text: str) -> list[tuple[str, str]]:
    return [(m.group(1), m.group(2)) for m in _PLACEHOLDER.finditer(text)]


def bind_sql(
    spark: SparkSession,
    text: str,
    frames: dict[str, dict[str, DataFrame]],
    params: dict | None = None,
    origin: str = "<sql>",
) -> DataFrame:
    """Run SQL text with ``__layer__.table`` bound to DataFrames.

    ``frames`` maps layer -> table -> DataFrame.  Works for streaming frames too
    (the result of SQL over a streaming frame is streaming).
    """
    text = check_not_empty(text, origin)
    text, args = render_parameters(text, params, origin)
    # DataFrame binding formats the text: escape our braces first (regex {2,} etc.)
    escaped = text.replace("{", "{{").replace("}", "}}")
    kwargs: dict[str, DataFrame] = {}

    def sub(m):
        layer, table = m.group(1), m.group(2)
        df = (frames.get(layer) or {}).get(table)
        if df is None:
            configured = {lay: sorted(t) for lay, t in frames.items()}
            raise ValueError(
                f"{origin} reads __{layer}__.{table}, which is no source of it (sources: {configured})"
            )
        key = f"{layer}_{table}"
        kwargs[key] = df
        return "{" + key + "}"

    bound = _PLACEHOLDER.sub(sub, escaped)
    leftover = re.search(r"__(bronze|silver|gold)__\.", bound)
    if leftover:
        raise ValueError(f"Unresolved {leftover.group(0)} placeholder in {origin}")
    if kwargs:
        return spark.sql(bound, args or None, **kwargs)
    # nothing to format: undo the brace escaping
    return spark.sql(text, args or None)


def source_tables(name: str, cfg: dict) -> list[str]:
    """``source_tables`` -> else ``source_table`` -> else the entry's own name."""
    listed = cfg.get("source_tables")
    if listed:
        if isinstance(listed, str):
            raise ValueError(f"source_tables of '{name}' must be a list, got a string")
        return list(listed)
    return [cfg.get("source_table", name)]


def exclude_list(raw) -> list[str]:
    """Comma list (or YAML list) of columns to drop; blanks ignored."""
    if not raw:
        return []
    items = raw if isinstance(raw, (list, tuple)) else str(raw).split(",")
    return [c.strip() for c in items if c and str(c).strip()]
