"""Tasks lost mid-job (as when an executor dies) are retried by Spark and
give the same blocks: every stage is deterministic. Runs in its own process,
since it needs a session that allows task retries (local[4, 4])."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent("""
    import sys
    sys.path.insert(0, {repo!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F
    from pyspark.sql.window import Window
    from blockload.operators import blocks as B
    from blockload.sources.landing import read_landing, write_row_landing
    from blockload.session import new_path

    spark = (SparkSession.builder.master("local[4, 4]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "6").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")

    @F.udf("boolean")
    def keep(x):
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
            raise RuntimeError("task lost on its first attempt")
        return True

    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    flaky = ev.filter(keep(F.col("event_id")))
    want = ev.withColumn("_want", F.ntile(7).over(Window.orderBy("user_id", "event_id")))
    got = B.blocks_by_row(flaky, ["user_id", "event_id"], 7, num_partitions=6)
    j = want.join(got.select("event_id", "_block"), "event_id")
    assert j.count() == ev.count(), "rows lost or doubled"
    assert j.filter(F.col("_want") != F.col("_block")).count() == 0, "blocks differ"
    path = write_row_landing(flaky, ["user_id", "event_id"], new_path(spark, "landing"), 7, num_partitions=6)
    land = read_landing(spark, path).select("event_id", "_block")
    assert land.count() == ev.count()
    assert want.join(land, "event_id").filter(F.col("_want") != F.col("_block")).count() == 0
    print("OK")
""")


def test_blocks_survive_task_retries():
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO)], capture_output=True, text=True,
                         timeout=900)
    assert out.returncode == 0, out.stderr[-3000:]
    assert out.stdout.strip().endswith("OK")
