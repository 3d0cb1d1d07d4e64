"""Properties of block assignment."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from blockload.config import BLOCK_COL
from blockload.operators import blocks as B
from blockload.session import new_path
from conftest import SF001


def _ntile(df, order, k):
    return df.withColumn("_want", F.ntile(k).over(Window.orderBy(*order)))


@pytest.mark.parametrize("k", [1, 7, 64, 1001, 2000])
def test_blocks_by_row_equals_spark_ntile(spark, tables, k):
    ev = tables("events")  # 1,000 rows: k = 1001, 2000 exceed the rows
    got = B.blocks_by_row(ev, ["user_id", "event_id"], k, num_partitions=5)
    j = _ntile(ev, ["user_id", "event_id"], k).join(got.select("event_id", BLOCK_COL), "event_id")
    assert j.count() == ev.count()
    assert j.filter(F.col("_want") != F.col(BLOCK_COL)).count() == 0


def test_blocks_by_row_sizes_differ_by_one(spark, tables):
    li = tables("lineitem", SF001)
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    sizes = [r["n_rows"] for r in B.block_results(B.blocks_by_row(li, order, 13)).collect()]
    assert len(sizes) == 13 and sum(sizes) == li.count()
    assert max(sizes) - min(sizes) <= 1


def test_blocks_by_row_with_hot_key(spark, tables):
    """A third of all rows share one user_id: positions stay exact."""
    ev = tables("events", SF001).withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id")))
    got = B.blocks_by_row(ev, ["user_id", "event_id"], 16, num_partitions=8)
    j = _ntile(ev, ["user_id", "event_id"], 16).join(got.select("event_id", BLOCK_COL), "event_id")
    assert j.filter(F.col("_want") != F.col(BLOCK_COL)).count() == 0


def test_row_positions_in_groups(spark, tables):
    ev = tables("events")
    pos = B.row_positions(ev, ["event_id"], ["event_type"], num_partitions=3)
    want = ev.withColumn("_want", F.row_number().over(Window.partitionBy("event_type").orderBy("event_id")) - 1)
    j = want.join(pos.select("event_id", "_pos", "_gsize"), "event_id")
    assert j.filter(F.col("_want") != F.col("_pos")).count() == 0
    sizes = {r["event_type"]: r["n"] for r in ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).collect()}
    for r in j.select("event_type", "_gsize").distinct().collect():
        assert sizes[r["event_type"]] == r["_gsize"]


def test_blocks_by_key_one_block_per_key(spark, tables):
    o = tables("orders")
    got = B.blocks_by_key(o, "o_custkey", 8)
    assert got.count() == o.count()
    assert got.groupBy("o_custkey").agg(F.countDistinct(BLOCK_COL).alias("n")).filter("n > 1").count() == 0
    assert got.columns == o.columns + [BLOCK_COL]


def test_null_keys_keep_their_rows(spark, tables):
    o = tables("orders").withColumn(
        "o_custkey", F.when(F.col("o_custkey") % 10 == 3, F.lit(None)).otherwise(F.col("o_custkey")))
    got = B.blocks_by_key(o, "o_custkey", 8)
    assert got.count() == o.count()
    nulls = got.filter(F.col("o_custkey").isNull()).select(BLOCK_COL).distinct().collect()
    assert [r[0] for r in nulls] == [1]  # null sorts first


def test_key_not_first_column_keeps_order(spark, tables):
    o = tables("orders")
    got = B.blocks_by_key(o, "o_orderpriority", 3)
    assert got.columns[:-1] == o.columns
    assert got.filter(F.col("o_orderkey").isNull()).count() == 0


def test_more_blocks_than_keys(spark, tables):
    o = tables("orders").select("o_orderkey", F.col("o_orderstatus").alias("k"))
    n_keys = o.select("k").distinct().count()
    got = B.blocks_by_key(o, "k", n_keys + 5)
    assert sorted(r[0] for r in got.select(BLOCK_COL).distinct().collect()) == list(range(1, n_keys + 1))


def test_blocks_even_cover_every_row_once(spark, tables):
    o = tables("orders")
    got = B.blocks_even(o, 7)
    counts = {r["block_id"]: r["n_rows"] for r in B.block_results(got).collect()}
    assert sorted(counts) == list(range(1, 8))
    assert sum(counts.values()) == o.count()
    assert got.select("o_orderkey").distinct().count() == o.count()


def test_block_plan_of_empty_input(spark, tables):
    empty = tables("orders").limit(0)
    row = B.block_plan(empty, 500_000, 50_000_000).first()
    assert (row["total_rows"], row["n_blocks"], row["flow"]) == (0, 1, "DIRECT")
    forced = B.block_plan(empty, 10, 10**9, force=True).first()
    assert forced["flow"] == "LANDING"


def test_chunk_rows_sizes(spark, tables):
    ev = tables("events")
    blocked = B.blocks_by_row(ev, ["event_id"], 3)
    chunked = B.chunk_rows(blocked, 100, ["event_id"])
    per = chunked.groupBy(BLOCK_COL, "_chunk").agg(F.count(F.lit(1)).alias("n")).collect()
    by_block = {}
    for r in per:
        by_block.setdefault(r[BLOCK_COL], []).append((r["_chunk"], r["n"]))
    for chunks in by_block.values():
        chunks.sort()
        assert [c for c, _ in chunks] == list(range(len(chunks)))
        assert all(n == 100 for _, n in chunks[:-1]) and 0 < chunks[-1][1] <= 100
    one = B.chunk_rows(blocked, 0, ["event_id"])
    assert one.select("_chunk").distinct().collect()[0][0] == 0


def test_waves(spark):
    pend = spark.createDataFrame([(b,) for b in [9, 3, 4, 12, 1]], "block_id INT")
    got = {r["block_id"]: r["wave_no"] for r in B.waves(pend, 2).collect()}
    assert got == {1: 0, 3: 0, 4: 1, 9: 1, 12: 2}
    assert {r["wave_no"] for r in B.waves(pend, 0).collect()} == {0, 1, 2, 3, 4}


def test_ntile_arguments(spark, tables):
    with pytest.raises(ValueError):
        B.blocks_even(tables("orders"), 0)
    with pytest.raises(ValueError):
        B.block_plan(tables("orders"), 0, 1)


def test_paths_without_broadcast(spark, tables):
    """With broadcasts off, offsets are pinned and the key map is joined by
    a shuffle; results stay the same."""
    ev = tables("events")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = B.blocks_by_row(ev, ["user_id", "event_id"], 9)
        j = _ntile(ev, ["user_id", "event_id"], 9).join(got.select("event_id", BLOCK_COL), "event_id")
        assert j.filter(F.col("_want") != F.col(BLOCK_COL)).count() == 0
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        keyed = B.blocks_by_key(ev, "user_id", 5)
        assert keyed.count() == ev.count()
        assert keyed.groupBy("user_id").agg(F.countDistinct(BLOCK_COL).alias("n")).filter("n > 1").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_blocks_even_from_file_ranges(spark, tables):
    """No shuffle, sizes that differ by one row, the same rows each time; other
    frames are dealt out round-robin."""
    path = new_path(spark, "many")
    tables("events").repartition(13).write.parquet(path)
    ev = spark.read.parquet(path)
    for n in (1, 7, 40):
        b = B.blocks_even(ev, n)
        sizes = [r["count"] for r in b.groupBy("_block").count().collect()]
        assert sum(sizes) == ev.count() and len(sizes) == n and max(sizes) - min(sizes) <= 1
        top = b._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
        assert " Exchange" not in top
        again = B.blocks_even(spark.read.parquet(path).repartition(3).select("*"), n)
        assert again.columns == b.columns
        assert b.exceptAll(B.blocks_even(spark.read.parquet(path), n)).count() == 0
    for other in (ev.filter("event_id % 2 = 0"), ev.union(ev), spark.range(100).toDF("event_id")):
        assert B.file_rows(other) is None
        b = B.blocks_even(other, 4)
        assert b.count() == other.count() and {r[0] for r in b.select("_block").distinct().collect()} == {1, 2, 3, 4}
    none = spark.read.schema(ev.schema).parquet(path).limit(0)
    assert B.blocks_even(none, 3).count() == 0


def test_waves_by_size(spark, monkeypatch):
    rnd = random.Random(5)
    sizes = {b: rnd.choice([0, 1, 5, 30, 99, 100, 400, None]) for b in rnd.sample(range(1, 60_000), 500)}
    df = spark.createDataFrame(list(sizes.items()), "block_id int, n_rows long")
    got = {r.block_id: r.wave_no for r in B.waves_by_size(df, 100).collect()}
    waves = {}
    for b in sorted(got):
        waves.setdefault(got[b], []).append(b)
    size = lambda b: sizes[b] or 0
    assert sorted(b for w in waves.values() for b in w) == sorted(sizes)
    for w, blocks in waves.items():
        assert len(blocks) == 1 if size(blocks[0]) >= 100 else sum(map(size, blocks[:-1])) < 100
    small = sorted(w for w, b in waves.items() if size(b[0]) < 100)
    total = sum(size(b) for b in sizes if size(b) < 100)
    assert len(small) <= -(-total // 100) and small == sorted(small) and max(small) < min(set(waves) - set(small))
    assert B.waves_by_size(df.limit(0), 100).count() == 0
