"""Commit log of tables that streams write: which (writer, run, batch) of which table a reader sees.

Streams write each micro-batch into partitions ``_run=<writer>@<number>/_batch_id=<batch>`` of their tables.  Several
writers may feed one table; each owns its runs only.  A *run* is one checkpoint of a writer: a new checkpoint
reads its source from the start, so it gets the next number, and from its first commit on its rows stand for those of the writer's
earlier runs.  These are hidden, not deleted: :meth:`CommitLog.retire` deletes them on request.

A commit is an empty marker file created after all tables of the unit (say silver, quarantine and metrics) are
written, so a batch becomes visible in all of them at once, and what a dead run left half-written is never
read.  Its replay overwrites the same partitions.  The log holds names only: readers list one folder and prune partitions.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import Layout, delete_path, list_dirs, marker_names, path_exists, run_token, touch

RUN, BATCH = "_run", "_batch_id"


@dataclass(frozen=True)
class Commit:
    """Place of one micro-batch: the values of its two partition columns."""

    run: str
    batch: int

    def stamp(self, df: DataFrame) -> DataFrame:
        return df.withColumn(RUN, F.lit(self.run)).withColumn(BATCH, F.lit(int(self.batch)))


class CommitLog:
    """Log of one unit: the tables (layer, name) that are written and become visible together."""

    def __init__(self, spark: SparkSession, layout: Layout, unit: str, tables: Iterable[tuple[str, str]] = ()):
        self.spark, self.layout, self.tables = spark, layout, list(tables)
        self.root = layout.state_path(f"commits/{unit}")
        for layer, name in self.tables:
            pointer = f"{layout.state_path('commits')}/_TABLE_{layer}.{name}"
            if not path_exists(spark, f"{pointer}/{unit}"):
                touch(spark, f"{pointer}/{unit}")

    @classmethod
    def of_table(cls, spark: SparkSession, layout: Layout, layer: str, name: str) -> "CommitLog | None":
        units = marker_names(spark, f"{layout.state_path('commits')}/_TABLE_{layer}.{name}", "")
        units = [u for u in units if not u.endswith(".crc")]
        return cls(spark, layout, units[0]) if units else None

    # -- writing ---------------------------------------------------------------
    def claim(self, reset: bool = False) -> None:
        """Refuse tables whose rows this log doesn't know (a batch run's, say), unless they may be deleted."""
        for layer, name in self.tables:
            if self.layout.exists(self.spark, layer, name) and self.layout.rows_outside(self.spark, layer, name, RUN):
                if not reset:
                    raise ValueError(f"{layer}.{name} holds rows that no stream has written; pass reset=True to delete them")
                self.layout.clear(self.spark, layer, name)

    def reset(self, run: str) -> None:
        """Delete everything that earlier runs of the writer of ``run`` have written."""
        writer, number = run.split("@")
        for folder in list_dirs(self.spark, f"{self.root}/{writer}", prefix="run="):
            if int(folder[4:]) < int(number):
                for layer, name in self.tables:
                    self.layout.drop_partition(self.spark, layer, name, RUN, f"{writer}@{folder[4:]}")
                delete_path(self.spark, f"{self.root}/{writer}/{folder}")

    def run(self, writer: str, checkpoint: str) -> str:
        """Name of the run of ``writer`` that owns ``checkpoint``; the next number if the log doesn't know it yet."""
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", writer):
            raise ValueError(f"a writer's name is made of letters, digits, '_', '.' and '-': {writer!r}")
        token = run_token(self.spark, checkpoint)
        mine = marker_names(self.spark, f"{self.root}/{writer}", "_RUN_")
        numbers = {m.split("_", 3)[3]: int(m.split("_", 3)[2]) for m in mine if not m.endswith(".crc")}
        if token not in numbers:
            numbers[token] = max(numbers.values(), default=-1) + 1
            touch(self.spark, f"{self.root}/{writer}/_RUN_{numbers[token]}_{token}")
        return f"{writer}@{numbers[token]}"

    def commit(self, at: Commit) -> None:
        writer, number = at.run.split("@")
        touch(self.spark, f"{self.root}/{writer}/run={number}/{int(at.batch)}")

    # -- reading ----------------------------------------------------------------
    def committed(self) -> dict[str, dict[int, list[int]]]:
        """Batches by writer and run number."""
        out: dict[str, dict[int, list[int]]] = {}
        for writer in list_dirs(self.spark, self.root):
            for folder in list_dirs(self.spark, f"{self.root}/{writer}", prefix="run="):
                batches = [int(b) for b in marker_names(self.spark, f"{self.root}/{writer}/{folder}", "") if b.isdigit()]
                if batches:
                    out.setdefault(writer, {})[int(folder[4:])] = sorted(batches)
        return out

    def visible(self, df: DataFrame) -> DataFrame:
        """The rows of the newest committed run of every writer (partition filters only)."""
        if RUN not in df.columns:
            return df
        seen = F.lit(False)
        for writer, runs in self.committed().items():
            number = max(runs)
            seen = seen | ((F.col(RUN) == f"{writer}@{number}") & _within(F.col(BATCH), runs[number]))
        return df.where(seen).drop(RUN)

    def superseded(self) -> list[str]:
        """Runs that a newer committed run of their writer stands for."""
        known = self.committed()
        out = []
        for writer, runs in known.items():
            started = [int(m.split("_", 3)[2]) for m in marker_names(self.spark, f"{self.root}/{writer}", "_RUN_") if not m.endswith(".crc")]
            out += [f"{writer}@{n}" for n in sorted({*started, *runs}) if n < max(runs)]
        return out

    def retire(self, writer: str | None = None) -> list[str]:
        """Delete the rows of superseded runs (of one writer); what readers see doesn't change."""
        gone = [r for r in self.superseded() if writer in (None, r.split("@")[0])]
        for run in gone:
            for layer, name in self.tables:
                self.layout.drop_partition(self.spark, layer, name, RUN, run)
        return gone


def _within(batch, numbers: list[int]):
    """Batches are committed in order, so ranges describe them."""
    spans, first = [], numbers[0]
    for a, b in zip(numbers, [*numbers[1:], None]):
        if b != a + 1:
            spans.append((first, a))
            first = b
    out = F.lit(False)
    for lo, hi in spans:
        out = out | batch.between(lo, hi)
    return out
