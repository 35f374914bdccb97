"""Where layers live: a ``Layout`` maps (layer, table) to a logical name and a parquet path.

Layers: bronze, silver, quarantine, gold, metrics (plus private state and
checkpoint folders for streams).  Tables are parquet directories under one
root, which on a cluster is a shared file system or object store path.
"""

from __future__ import annotations

import uuid

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAYERS = ("bronze", "silver", "quarantine", "gold", "metrics")


@dataclass
class Layout:
    root: str
    # logical schema name per layer, used in ledger locations ("silver.customer_account")
    names: dict = field(default_factory=lambda: {layer: layer for layer in LAYERS})

    def name(self, layer: str, table: str) -> str:
        return f"{self.names.get(layer, layer)}.{table}"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def state_path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/_state/{name}"

    def checkpoint_path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/_checkpoints/{name}"

    def query_name(self, name: str) -> str:
        """Streaming query name: stable for one layout (restarts), distinct across layouts (concurrent runs)."""
        import zlib

        return f"{name}_{zlib.crc32(self.root.encode()):08x}"

    def read(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        """The table's rows; of a table that streams write, those committed by each writer's newest run."""
        from .commits import CommitLog

        log = CommitLog.of_table(spark, self, layer, table)
        df = self._stored(spark, layer, table)
        return log.visible(df) if log else df

    def _stored(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        return spark.read.parquet(self.path(layer, table))

    def exists(self, spark: SparkSession, layer: str, table: str) -> bool:
        return path_exists(spark, self.path(layer, table))

    def write(self, df: DataFrame, layer: str, table: str, mode: str = "overwrite", partition_by=None) -> None:
        w = df.write.mode(mode)
        if partition_by:
            # only the partitions present in df are replaced, whatever the session default
            w = w.option("partitionOverwriteMode", "dynamic")
            w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
        w.parquet(self.path(layer, table))

    def clear(self, spark: SparkSession, layer: str, table: str) -> None:
        """Remove all rows of a table."""
        delete_path(spark, self.path(layer, table))

    def drop_partition(self, spark: SparkSession, layer: str, table: str, column: str, value: str) -> None:
        delete_path(spark, f"{self.path(layer, table)}/{column}={value}")

    def rows_outside(self, spark: SparkSession, layer: str, table: str, column: str) -> bool:
        """Whether the table has files that aren't partitioned by ``column``."""
        p, fs = _fs(spark, self.path(layer, table))
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return any(not n.startswith((f"{column}=", "_SUCCESS", ".", "_temporary")) for n in names)

    def list_tables(self, spark: SparkSession, layer: str) -> list[str]:
        return list_dirs(spark, f"{self.root.rstrip('/')}/{layer}")

    def stream(self, spark: SparkSession, layer: str, table: str, options: dict | None = None) -> DataFrame:
        """The table as a file stream; options such as ``maxBytesPerTrigger`` bound each micro-batch.

        Of a table that streams write, runs that are superseded when the stream starts are left out.
        """
        from .commits import RUN, CommitLog

        df = self._stream(spark, layer, table, options)
        log = CommitLog.of_table(spark, self, layer, table)
        if not log or RUN not in df.columns:
            return df
        return df.where(~F.col(RUN).isin(log.superseded())).drop(RUN)

    def _stream(self, spark: SparkSession, layer: str, table: str, options: dict | None = None) -> DataFrame:
        path = self.path(layer, table)
        reader = spark.readStream.schema(spark.read.parquet(path).schema)
        for k, v in (options or {}).items():
            reader = reader.option(k, v)
        return reader.parquet(path)


@dataclass
class CatalogLayout(Layout):
    """Tables in the session catalog: each layer is a database (``names[layer]``, may be ``catalog.schema``).

    Reads use ``spark.read.table`` / ``readStream.table``, discovery lists the
    database (``SHOW TABLES``); ``root`` only holds stream checkpoints and CDC state.
    """

    @classmethod
    def from_conf(cls, spark: SparkSession, root: str, prefix: str = "pipeline.") -> "CatalogLayout":
        """Layer databases from session settings ``<prefix><layer>_catalog`` / ``<prefix><layer>_schema``.

        A layer without settings keeps its own name as database.
        """
        names = {}
        for layer in LAYERS:
            schema = spark.conf.get(f"{prefix}{layer}_schema", "") or layer
            catalog = spark.conf.get(f"{prefix}{layer}_catalog", "")
            names[layer] = f"{catalog}.{schema}" if catalog else schema
        return cls(root, names)

    def _stored(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        return spark.read.table(self.name(layer, table))

    def exists(self, spark: SparkSession, layer: str, table: str) -> bool:
        return bool(spark.catalog.tableExists(self.name(layer, table)))

    def write(self, df: DataFrame, layer: str, table: str, mode: str = "overwrite", partition_by=None) -> None:
        name = self.name(layer, table)
        parts = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
        if parts and mode == "overwrite" and df.sparkSession.catalog.tableExists(name):
            # replace only the partitions present in df (positional insert: use the table's column order)
            cols = df.sparkSession.read.table(name).columns
            df.select(*cols).write.option("partitionOverwriteMode", "dynamic").insertInto(name, overwrite=True)
            return
        w = df.write.mode(mode).format("parquet")
        if parts:
            w = w.partitionBy(*parts)
        w.saveAsTable(name)

    def clear(self, spark: SparkSession, layer: str, table: str) -> None:
        name = self.name(layer, table)
        if spark.catalog.tableExists(name):
            spark.sql(f"TRUNCATE TABLE {name}")

    def drop_partition(self, spark: SparkSession, layer: str, table: str, column: str, value: str) -> None:
        name = self.name(layer, table)
        if spark.catalog.tableExists(name):
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({column} = '{value}')")
            # a catalog that doesn't track partitions leaves the files
            place = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
            delete_path(spark, f"{place.data_type}/{column}={value}")
            spark.catalog.refreshTable(name)

    def rows_outside(self, spark: SparkSession, layer: str, table: str, column: str) -> bool:
        df = spark.read.table(self.name(layer, table))
        return column not in df.columns and not df.isEmpty()

    def list_tables(self, spark: SparkSession, layer: str) -> list[str]:
        db = self.names.get(layer, layer)
        return sorted(t.name for t in spark.catalog.listTables(db) if not t.isTemporary)

    def _stream(self, spark: SparkSession, layer: str, table: str, options: dict | None = None) -> DataFrame:
        reader = spark.readStream
        for k, v in (options or {}).items():
            reader = reader.option(k, v)
        return reader.table(self.name(layer, table))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str, prefix: str | None = None) -> list[str]:
    """Names of the sub-folders of ``path`` (metadata listing, one call).

    Without ``prefix`` hidden names (``_x``, ``.x``) are skipped; with it, exactly the names starting with it.
    """
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    if prefix is not None:
        return sorted(n for n in names if n.startswith(prefix))
    return sorted(n for n in names if not n.startswith(("_", ".")))


def marker_names(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names of files in ``path`` starting with ``prefix`` (small metadata markers)."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().startswith(prefix))


def touch(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.create(p, True).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file under its final name by one rename; it must not exist yet."""
    target, fs = _fs(spark, path)
    if fs.exists(target):
        raise FileExistsError(path)
    draft, _ = _fs(spark, f"{path}.{uuid.uuid4().hex[:8]}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(draft, target):
        raise OSError(f"cannot rename {draft} to {target}")


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def file_times(spark: SparkSession, path: str) -> dict[str, float]:
    """Modification time (seconds) of everything in a folder, by name."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return {}
    return {s.getPath().getName(): s.getModificationTime() / 1000 for s in fs.listStatus(p)}


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def run_token(spark: SparkSession, checkpoint: str) -> str:
    """Name of the streaming run that owns ``checkpoint``: kept inside it, so a new checkpoint folder is a new run."""
    found = marker_names(spark, checkpoint, "_RUN_")
    if not found:
        found = [f"_RUN_{uuid.uuid4().hex[:12]}"]
        touch(spark, f"{checkpoint}/{found[0]}")
    return found[0][5:]
