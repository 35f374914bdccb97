"""Session helpers: a sensibly configured local session and the shared scratch root."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this library wants: UTC wall clock (contract checks
# compare against current_date()/current_timestamp()), AQE for runtime
# re-planning of joins and skew, and no web UI.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # remove checkpoint files once no DataFrame refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # the contract checks of a table become one large generated predicate; let
    # the JIT compile methods above 8 KB of bytecode instead of interpreting them
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("sluice")
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for state, checkpoints and lineage cuts.

    On a cluster this is the folder named by ``spark.checkpoint.dir``.  Only
    when the session has none (local tests) do we create one and register it.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() if sc.getCheckpointDir() else None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="sluice-scratch-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def materialize(df, label: str = "table"):
    """Cut lineage: write ``df`` as Parquet into the shared scratch folder and read it back.

    Survives lost executors (unlike a local checkpoint), and consumers read only the columns they need.
    """
    path = new_scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused sub-folder of the scratch root."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def strip_scheme(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path
