"""A training-data pipeline: language ID, near-dedup, decontamination, mixing, sharding.

Each stage works on all rows its predecessor kept and returns the columns of ``documents``; the last adds ``shard`` and
``slot``.  Stage results are Parquet tables, so a lost executor costs at most a part of one stage.

Defined cases: rows with a null text, or without a letter, go in the first stage; repeated rows are near duplicates of
each other, so one stays; repeated doc_ids with different texts are told apart; the mix repeats a document as often
as its share of the target asks (rounded: a document cut by the end of its source's share counts from one half),
and leaves out documents beyond it; further columns pass through unchanged (but for ``shard`` and ``slot``, which the last
stage sets); an empty table passes through as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import common as C
from sluice.llm import decontam, language_id, mixing, near_dedup, sharding


def _unpacked(df: DataFrame, row: str = "row") -> DataFrame:
    return df.select(f"{row}.*")


def _unique_ids(docs: DataFrame) -> bool:
    counts = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter("n > 1 OR doc_id IS NULL").isEmpty()


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents rejected by every language model go."""
    model = language_id.learn(docs.filter(language_id.remainder() != 1).select("doc_id", "text", "lang"))
    return _unpacked(language_id.predict(docs, model, keep_rows=True).filter("NOT rejected"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: the document with the least id of each group stays."""
    if _unique_ids(docs):
        rows = docs.select(F.col("doc_id").cast("long"), F.lit(0).cast("long").alias("tkey"), "text")
        gone = near_dedup.grouped(rows).filter("doc_id <> component_id").select(F.col("doc_id").alias("gone"))
        return docs.join(gone, F.col("doc_id") == F.col("gone"), "left_anti")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.xxhash64("text"), F.lit(0)).alias("tkey"), "text")
    groups = near_dedup.grouped(rows.select("doc_id", "tkey", "text")).distinct().alias("g")
    labelled = rows.alias("d").join(groups, C.same_row("d", "g")).select("d.row", "g.*")
    first = labelled.filter("comp IS NOT NULL").filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).dropDuplicates(["comp"])
    return _unpacked(first.select("row").unionByName(labelled.filter("comp IS NULL").select("row")))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that hold a window of a benchmark item go."""
    found = decontam.scan_documents(docs, C.table(spark, sf_dir, "benchmark"), keep_rows=True)
    return _unpacked(found.filter(F.size("hits") == 0))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: a copy for each pass of the mix's rows that takes half of a document or more."""
    unique = _unique_ids(docs)
    tkey = F.lit(0).cast("long") if unique else F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select("doc_id", tkey.alias("tkey"), "source", "text")
    passes = mixing.scheduled(*mixing.placed(keyed, keep=("tkey",))).groupBy("doc_id", "row.tkey", "src", "start", "pass", "size").agg(
        F.sum("words").alias("words"))
    taken = passes.filter("2 * words >= size").groupBy("doc_id", "tkey").agg(F.count(F.lit(1)).alias("copies"))
    if not unique:  # rows equal in everything are interchangeable: one of them with all copies
        docs = docs.dropDuplicates()
    rows = docs.select(F.struct("*").alias("row"), "doc_id", tkey.alias("tkey")).alias("d")
    chosen = rows.join(taken.alias("t"), C.same_row("d", "t")).select("d.row", "t.copies")
    return _unpacked(chosen.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: every row gets its shard and its place in it."""
    placed = sharding.shard_documents(docs)
    own = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c.lower() not in ("shard", "slot")]
    return placed.select(*own, "shard", "slot")


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# Trained models, signatures and drawn matrices aren't SQL; tests/llm compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = C.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = C.cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
