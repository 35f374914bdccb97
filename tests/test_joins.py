from sluice.operators.joins import left_join_many


def test_left_join_many_equals_left_outer_with_hot_key(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], "k int, l string")
    right = spark.createDataFrame([(1, i) for i in range(500)] + [(2, 7), (None, 9)], "k int, r int")
    got = sorted((tuple(r) for r in left_join_many(left, right, "k").collect()), key=repr)
    want = sorted((tuple(r) for r in left.join(right, "k", "left").select("k", "l", "r").collect()), key=repr)
    assert got == want and len(got) == 503


def test_left_join_many_plan_has_no_outer_join(spark):
    left = spark.createDataFrame([(1, "a")], "k int, l string")
    right = spark.createDataFrame([(1, 2)], "k int, r int")
    plan = left_join_many(left, right, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan and "LeftAnti" in plan and "Inner" in plan


def test_hot_right_key_is_split_by_aqe(spark):
    """left_join_many turns the 1:n join into an inner join, which AQE splits on a hot key."""
    from pyspark.sql import functions as F

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 200).select(F.col("id").alias("k"), (F.col("id") * 10).alias("l"))  # unique keys
        right = spark.range(0, 60000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 200).alias("k"),
                                              F.col("id").alias("r"))
        df = left_join_many(left, right, "k")
        qe = df._jdf.queryExecution()
        assert qe.toRdd().count() == 60000  # every right row has its left partner
        final = qe.executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in final, final[:3000]  # the hot key 7 was split
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
