"""Run in its own process: a session whose tasks may be retried (local[4,3]); the first attempt of one
partition fails on purpose.  Prints observed and written counts as JSON."""

import json
import sys
import tempfile

sys.path.insert(0, sys.argv[1])

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from sluice.functions.contract import Rule  # noqa: E402
from sluice.operators.quality import check  # noqa: E402
from sluice.plans.silver import write_checked  # noqa: E402
from sluice.sources.tables import Layout  # noqa: E402

spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("OFF")


MARKS = tempfile.mkdtemp()


@F.udf(T.LongType())
def flaky(x):  # test-only fault injection: the first attempt of partition 0 dies
    import os

    ctx = TaskContext.get()
    if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
        open(os.path.join(MARKS, f"failed-stage{ctx.stageId()}"), "w").close()
        raise RuntimeError("injected task failure")
    return x


df = spark.range(0, 40000, 1, 4).select(flaky("id").alias("a"))
c = check(df, [Rule("even", "a % 2 = 0"), Rule("small", "a < 30000", criticality="warn")])
lay = Layout(tempfile.mkdtemp())
write_checked(c, lay, "silver", "t", ("quarantine", "t_q"), "t_metrics", "silver.t", "quarantine.t_q", "r")
m = {r.metric_name: r.metric_value for r in lay.read(spark, "metrics", "t_metrics").collect()}
import os  # noqa: E402

print(json.dumps({"injected_failures": len(os.listdir(MARKS)), "metrics": m, "valid": lay.read(spark, "silver", "t").count(),
                  "quarantine": lay.read(spark, "quarantine", "t_q").count()}))
