"""Versioned state of CDC targets: immutable bucket folders and a manifest that one rename swaps in.

A state has *parts* (``current``, or ``log`` and ``history``), each cut into buckets.  A merge writes the new content of
the buckets it touches into a folder of its own, ``data/<part>/<folder>/_bucket=<b>``, and then publishes a manifest:
one small file that names the folder of every bucket of every part.  Nothing is ever rewritten in place, so

* a reader resolves one manifest and sees one whole version, all parts of it, whatever is being written;
* a merge that dies leaves a folder that no manifest names; its replay writes another;
* a batch that is already applied is recognised by its name in the manifest.

``prune`` deletes folders that none of the newest manifests names.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .tables import delete_path, file_times, list_dirs, marker_names, path_exists, read_text, write_text

BUCKET = "_bucket"


@dataclass
class Manifest:
    version: int = 0
    batch: str | None = None
    buckets: int | None = None
    parts: dict[str, dict[str, list[int]]] = field(default_factory=dict)  # part -> folder -> its buckets

    def folder_of(self, part: str) -> dict[int, str]:
        return {b: folder for folder, ids in self.parts.get(part, {}).items() for b in ids}


class VersionedState:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.log = spark, root, f"{root}/manifests"

    # -- reading -----------------------------------------------------------------
    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in marker_names(self.spark, self.log, "") if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest manifest, or an empty one of version 0."""
        if version is None:
            version = max(self.versions(), default=0)
        if not version:
            return Manifest()
        return Manifest(**json.loads(read_text(self.spark, f"{self.log}/{version}.json")))

    def rows(self, part: str, buckets: list[int] | None = None, version: int | None = None) -> DataFrame | None:
        """Rows of a part (of some buckets of it) in one version; None if there are none."""
        where = self.manifest(version).folder_of(part)
        wanted = where if buckets is None else {b: where[b] for b in buckets if b in where}
        if not wanted:
            return None
        return self.spark.read.parquet(*[f"{self.root}/data/{part}/{folder}/{BUCKET}={b}" for b, folder in sorted(wanted.items())])

    # -- writing -----------------------------------------------------------------
    def write(self, df: DataFrame, part: str) -> str:
        """Write bucketed rows into a new folder and return its name.

        AQE sizes the files per bucket: without the hint every task writes a file into every bucket it holds.
        """
        folder = uuid.uuid4().hex[:16]
        df.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.root}/data/{part}/{folder}")
        return folder

    def written(self, part: str, folder: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/data/{part}/{folder}")

    def publish(self, base: Manifest, batch: str | None, folders: dict[str, str], touched: list[int], buckets: int) -> Manifest:
        """Make the new folders the content of the touched buckets, all parts at once."""
        parts = {}
        for part in {*base.parts, *folders}:
            where = base.folder_of(part)
            if part in folders:
                where |= dict.fromkeys(touched, folders[part])
            parts[part] = {}
            for b, folder in sorted(where.items()):
                parts[part].setdefault(folder, []).append(b)
        new = Manifest(base.version + 1, batch, buckets, parts)
        write_text(self.spark, f"{self.log}/{new.version}.json", json.dumps(new.__dict__, sort_keys=True))
        return new

    # -- retention ----------------------------------------------------------------
    def prune(self, keep: int = 1, min_age_s: float = 0) -> list[str]:
        """Delete older manifests than the newest and ``keep`` before it, and folders that no kept manifest names.

        Only what is at least ``min_age_s`` seconds old goes: readers that are still running, and a merge that has not been published, keep theirs.
        """
        versions = self.versions()
        now, gone = time.time(), []
        ages = file_times(self.spark, self.log)
        kept = [v for i, v in enumerate(reversed(versions)) if i <= keep or now - ages.get(f"{v}.json", now) < min_age_s]
        named: dict[str, set[str]] = {}
        for v in kept:
            for part, folders in self.manifest(v).parts.items():
                named.setdefault(part, set()).update(folders)
        for part in list_dirs(self.spark, f"{self.root}/data"):
            times = file_times(self.spark, f"{self.root}/data/{part}")
            gone += [f"{self.root}/data/{part}/{f}" for f in list_dirs(self.spark, f"{self.root}/data/{part}")
                     if f not in named.get(part, ()) and now - times.get(f, now) >= min_age_s]
        for path in [f"{self.log}/{v}.json" for v in versions if v not in kept] + gone:
            delete_path(self.spark, path)
        return gone


def has_versions(spark: SparkSession, root: str) -> bool:
    return path_exists(spark, f"{root}/manifests")
