"""Left outer join that stays balanced when the right side has a hot key.

AQE splits skewed partitions of an inner join on either side, but for a LEFT
OUTER join only the left side; a right-side key holding a third of all rows
would be buffered by a single task.  ``left_join_many`` rewrites

    left LEFT JOIN right ON k

as ``left JOIN right ON k`` (skew-splittable) plus the left rows whose key has
no partner (``LEFT ANTI`` against the map-side de-duplicated right keys), with
the right columns NULL.  Same rows, same NULL-key behaviour (a NULL key never
matches, the left row stays).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_many(left: DataFrame, right: DataFrame, on: list[str] | str) -> DataFrame:
    on = [on] if isinstance(on, str) else list(on)
    right_cols = [c for c in right.columns if c not in on]
    matched = left.join(right, on, "inner")
    keys = right.select(*on).where(" AND ".join(f"`{k}` IS NOT NULL" for k in on)).distinct()
    unmatched = left.join(keys, on, "left_anti").select(
        *[F.col(f"`{c}`") for c in left.columns],
        *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in right_cols],
    )
    cols = [c for c in left.columns] + right_cols
    return matched.select(*[F.col(f"`{c}`") for c in cols]).unionByName(unmatched.select(*cols))
