"""SCD operators against a brute-force reference, including hot keys spread over many chunks."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sluice.operators.scd import END_AT, START_AT, dedup_key_seq, latest_per_key, range_chunks, scd1, scd2

SCHEMA = "k string, v string, w string, seq timestamp"
T0 = dt.datetime(2024, 1, 1)


def ts(i):
    return T0 + dt.timedelta(minutes=i)


def brute_scd2(rows, tracked):
    """rows: (k, v, w, seq). Reference implementation in plain Python."""
    best = {}
    for k, v, w, s in rows:
        if k is None or s is None:
            continue
        cand = (v, w)
        key = (k, s)
        if key not in best or _gt(cand, best[key]):
            best[key] = cand
    out = []
    by_key = {}
    for (k, s), (v, w) in best.items():
        by_key.setdefault(k, []).append((s, v, w))
    for k, items in by_key.items():
        items.sort()
        versions = []
        for s, v, w in items:
            vals = {"v": v, "w": w, "seq": s}
            t = tuple(vals[c] for c in tracked)
            if versions and versions[-1]["t"] == t:
                versions[-1].update(v=v, w=w, seq=s, t=t)
            else:
                versions.append(dict(k=k, v=v, w=w, seq=s, start=s, t=t))
        for i, ver in enumerate(versions):
            end = versions[i + 1]["start"] if i + 1 < len(versions) else None
            out.append((k, ver["v"], ver["w"], ver["seq"], ver["start"], end))
    return sorted(out, key=repr)


def _gt(a, b):
    # struct ordering: NULL is the smallest value
    for x, y in zip(a, b):
        if x == y:
            continue
        if x is None:
            return False
        if y is None:
            return True
        return x > y
    return False


def run_scd2(spark, rows, tracked, chunks):
    df = spark.createDataFrame(rows, SCHEMA)
    track = None if tracked == ["v", "w", "seq"] else [c for c in tracked]
    got = scd2(df, ["k"], "seq", track_history_columns=track, chunks=chunks)
    return sorted([tuple(r) for r in got.select("k", "v", "w", "seq", START_AT, END_AT).collect()], key=repr)


row_st = st.tuples(
    st.sampled_from(["a", "b", "c", None]),
    st.sampled_from(["x", "y", None]),
    st.sampled_from(["p", "q"]),
    st.one_of(st.none(), st.integers(0, 30).map(ts)),
)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row_st, min_size=0, max_size=40), chunks=st.integers(1, 7),
       tracked=st.sampled_from([["v", "w", "seq"], ["v"], ["v", "w"]]))
def test_scd2_matches_brute_force(spark, rows, chunks, tracked):
    assert run_scd2(spark, rows, tracked, chunks) == brute_scd2(rows, tracked)


@pytest.mark.parametrize("chunks", [1, 4, 16])
def test_scd2_hot_key_spread_over_chunks(spark, chunks):
    rnd = random.Random(7)
    rows = [("hot", rnd.choice("xy"), "p", ts(i)) for i in range(600)]  # one key holds most rows
    rows += [(f"k{j}", rnd.choice("xy"), "p", ts(rnd.randint(0, 50))) for j in range(150)]
    rnd.shuffle(rows)
    assert run_scd2(spark, rows, ["v"], chunks) == brute_scd2(rows, ["v"])
    # one island spanning every chunk: a single version
    same = [("hot", "x", "p", ts(i)) for i in range(300)]
    got = run_scd2(spark, same, ["v"], chunks)
    assert got == [("hot", "x", "p", ts(299), ts(0), None)]


def test_scd2_late_row_splits_a_version(spark):
    rows = [("A", "v1", "p", ts(1)), ("A", "v3", "p", ts(3)), ("A", "v2", "p", ts(2))]
    got = run_scd2(spark, rows, ["v"], 2)
    assert [(r[4], r[5]) for r in sorted(got, key=lambda r: r[4])] == [(ts(1), ts(2)), (ts(2), ts(3)), (ts(3), None)]


def test_scd2_guards(spark):
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError, match="not both"):
        scd2(df, ["k"], "seq", track_history_columns=["v"], track_history_except_columns=["w"])
    with pytest.raises(ValueError, match="requires keys"):
        scd2(df, [], "seq")
    with pytest.raises(ValueError, match="requires sequence_by"):
        scd1(df, ["k"], "")
    with pytest.raises(ValueError, match="not found"):
        scd1(df, ["nope"], "seq")
    with pytest.raises(ValueError, match="cannot remove"):
        scd1(df, ["k"], "seq", except_columns=["seq"])


def test_scd1_latest_and_ties(spark):
    rows = [("a", "x", "p", ts(1)), ("a", "y", "p", ts(5)), ("a", "z", "p", ts(5)), ("a", "w", "p", ts(3)),
            ("b", "x", "p", None), (None, "x", "p", ts(9))]
    got = {tuple(r) for r in scd1(spark.createDataFrame(rows, SCHEMA), ["k"], "seq").collect()}
    assert got == {("a", "z", "p", ts(5))}  # tie at ts(5): greater remaining columns; NULL key/seq not applied


def test_scd1_except_columns(spark):
    rows = [("a", "x", "p", ts(1)), ("a", "y", "q", ts(2))]
    got = scd1(spark.createDataFrame(rows, SCHEMA), ["k"], "seq", except_columns=["w"])
    assert got.columns == ["k", "v", "seq"] and [tuple(r) for r in got.collect()] == [("a", "y", ts(2))]


def test_latest_per_key_keeps_null_groups(spark):
    rows = [(None, "x", "p", ts(1)), (None, "y", "p", ts(2)), ("a", "x", "p", None), ("a", "y", "p", ts(1))]
    got = {tuple(r) for r in latest_per_key(spark.createDataFrame(rows, SCHEMA), "k", "seq").collect()}
    assert got == {(None, "y", "p", ts(2)), ("a", "y", "p", ts(1))}


def test_range_chunks_split_a_hot_key(spark):
    from pyspark.sql import functions as F

    n_rows, chunks = 20000, 8
    df = spark.range(n_rows).select(
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("k"), F.col("id").cast("string"))).otherwise("hot").alias("k"),
        F.col("id").alias("seq"))
    sizes = {r["_chunk"]: r["count"] for r in range_chunks(df, "k", "seq", chunks).groupBy("_chunk").count().collect()}
    hot = range_chunks(df, "k", "seq", chunks).where("k = 'hot'").select("_chunk").distinct().count()
    assert hot >= chunks - 2  # the 90% key is spread over (almost) every chunk
    assert max(sizes.values()) <= 2 * n_rows / chunks  # no chunk is much larger than its share


def test_chunks_follow_the_measured_rows(spark, monkeypatch):
    """One row makes one chunk whatever Catalyst estimates; windows run on the chunk placement without another exchange."""
    import sluice.operators.scd as scd

    seen = []
    real = scd.range_chunks
    monkeypatch.setattr(scd, "range_chunks", lambda df, keys, order_by, n: seen.append(n) or real(df, keys, order_by, n))
    one = spark.createDataFrame([("k", 1, "a")], "id string, seq int, v string")
    assert scd.scd2(one, ["id"], "seq").count() == 1
    assert scd.scd2(spark.createDataFrame(one.rdd, one.schema).join(one.select("id"), "id"), ["id"], "seq").count() == 1
    monkeypatch.setattr(scd, "CHUNK_ROWS", 100)
    many = spark.range(1000).selectExpr("concat('k', id % 3) AS id", "CAST(id AS INT) AS seq", "CAST(id % 5 AS STRING) AS v")
    assert scd.scd2(many, ["id"], "seq").count() == 1000
    assert seen == [1, 1, 10]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.sampled_from([1, 2, None]),
                               st.sampled_from(["x", "y"]), st.integers(0, 20).map(ts)), min_size=1, max_size=40),
       chunks=st.integers(1, 6))
def test_scd2_composite_key_matches_brute_force(spark, rows, chunks):
    df = spark.createDataFrame(rows, "k1 string, k2 int, v string, seq timestamp")
    got = sorted((tuple(r) for r in scd2(df, ["k1", "k2"], "seq", track_history_columns=["v"], chunks=chunks)
                  .select("k1", "k2", "v", "seq", START_AT, END_AT).collect()), key=repr)
    # reuse the single-key reference by folding (k1, k2) into one key; NULL k2 means a NULL key -> not applied
    folded = [(None if k2 is None else f"{k1}|{k2}", v, "p", s) for k1, k2, v, s in rows]
    want = [(k.split("|")[0], int(k.split("|")[1]), v, s, a, e) for k, v, w, s, a, e in brute_scd2(folded, ["v"])]
    assert got == sorted(want, key=repr)


def test_group_of_copies_is_combined_before_chunking(spark):
    """A third of the rows are copies of one (key, seq): they collapse before the range partitioner sees them."""
    copies = [("hot", "x", "p", ts(1))] * 3000 + [("hot", "y", "p", ts(1))] * 10
    rows = copies + [(f"k{i % 50}", "x", "p", ts(i)) for i in range(6000)]
    df = spark.createDataFrame(rows, SCHEMA)
    d = dedup_key_seq(df, ["k"], "seq")
    assert d.where("k = 'hot'").collect()[0]["v"] == "y"  # greatest remaining columns win
    assert d.count() == 1 + 6000
    assert run_scd2(spark, rows, ["v"], 4) == brute_scd2(rows, ["v"])


def test_config_names_resolve_case_insensitively(spark):
    rows = [("a", "x", "p", ts(1)), ("a", "y", "p", ts(2))]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [tuple(r) for r in scd1(df, ["K"], "SEQ", except_columns=["W"]).collect()] == [("a", "y", ts(2))]
    got = scd2(df, ["K"], "Seq", except_columns=["W"], track_history_columns=["V"], chunks=2)
    assert got.count() == 2 and got.columns == ["k", "v", "seq", START_AT, END_AT]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row_st, min_size=0, max_size=40))
def test_scd1_matches_brute_force(spark, rows):
    best = {}
    for k, v, w, s in rows:
        if k is None or s is None:
            continue  # NULL key or sequence: not applied
        cand = (s, v, w)
        if k not in best or (cand[0] > best[k][0]) or (cand[0] == best[k][0] and _gt(cand[1:], best[k][1:])):
            best[k] = cand
    want = sorted(((k, v, w, s) for k, (s, v, w) in best.items()), key=repr)
    got = sorted((tuple(r) for r in scd1(spark.createDataFrame(rows, SCHEMA), ["k"], "seq").collect()), key=repr)
    assert got == want


def test_one_exchange_of_full_rows_after_the_deduplication(spark, monkeypatch):
    """Chunks are numbered in place and placed once; each is a partition of its own, and the windows run there."""
    import sluice.operators.scd as scd

    plans, real = {}, scd.materialize
    monkeypatch.setattr(scd, "materialize", lambda df, label: (plans.update({label: df._jdf.queryExecution().executedPlan().toString()}), real(df, label))[1])
    monkeypatch.setattr(scd, "CHUNK_ROWS", 50)
    rows = spark.range(600).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 7)) AS k", "CAST(id AS INT) AS seq", "CAST(id % 5 AS STRING) AS v")
    assert scd.scd2(rows, ["k"], "seq").count() == 600
    assert plans["scd2-windows"].count("Exchange ") == 1 and "direct_shuffle_partition_id(_chunk" in plans["scd2-windows"]
    placed = scd.range_chunks(rows, ["k"], "seq", 12)
    where = placed.repartitionById(12, "_chunk").selectExpr("spark_partition_id() AS p", "_chunk").distinct().collect()
    assert len(where) == 12 and all(r.p == r._chunk for r in where)
    # ranges follow the order: no key and sequence of a chunk lies before one of the chunk before it
    ends = placed.groupBy("_chunk").agg({"*": "count"}).count()
    edges = placed.selectExpr("_chunk", "struct(k, seq) AS at").groupBy("_chunk").agg({"at": "min"}).join(
        placed.selectExpr("_chunk + 1 AS _chunk", "struct(k, seq) AS at").groupBy("_chunk").agg({"at": "max"}), "_chunk")
    assert ends == 12 and edges.where("`min(at)` <= `max(at)`").count() == 0
