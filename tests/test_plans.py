"""Plan shapes."""

from blockload.operators import blocks as B
from blockload.session import new_path
from blockload.sources.landing import read_landing, scan_blocks, write_landing


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_landing_prunes_range_partitions(spark, tables):
    from blockload.sources.landing import write_row_landing
    ev = tables("events")
    path = write_row_landing(ev, ["event_id"], new_path(spark, "landing"), 6, num_partitions=6)
    df = read_landing(spark, path, [2])
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(_p" in plan or "PartitionFilters: [_p" in plan
    assert df.count() == 167
    all_rows = read_landing(spark, path)
    assert all_rows.count() == 1000 and all_rows.select("event_id").distinct().count() == 1000


def test_scan_blocks_prunes_partitions(spark, tables):
    ev = tables("events")
    path = write_landing(B.blocks_by_row(ev, ["event_id"], 6), new_path(spark, "landing"), 6, cluster=False)
    df = scan_blocks(read_landing(spark, path), [2, 5], ["EVENT_ID", "value"])
    plan = _plan(df)
    assert "PartitionFilters: [_block" in plan and "IN (2,5)" in plan
    assert df.columns == ["event_id", "value"]
    assert df.count() == 333


def test_blocks_by_row_has_no_single_partition_exchange(spark, tables):
    df = B.blocks_by_row(tables("events"), ["user_id", "event_id"], 4)
    plan = _plan(df)
    assert "SinglePartition" not in plan
    assert "BroadcastHashJoin" in plan  # the small offsets table is broadcast


def test_small_key_map_is_broadcast(spark, tables):
    df = B.blocks_by_key(tables("orders"), "o_custkey", 4)
    assert "BroadcastHashJoin" in _plan(df)
