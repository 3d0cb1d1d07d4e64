"""Loads end to end: faults, resume, retry."""

import datetime as dt
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from blockload.config import LoadConfig
from blockload.operators import blocks as B
from blockload.operators import ledger as L
from blockload.operators.lease import LeaseHeld, LeaseLost, take_lease
from blockload.plans import flows
from blockload.plans.flows import (load_direct, load_landed, load_preblocked, load_preblocked_with_retry, run_load,
                                   run_load_with_retry, with_paths, with_retry)
from blockload.plans.routines import Routine, register_routine, run_routine
from blockload.session import create_exclusive, new_path, touch
from blockload.sources.landing import find_landing, write_landing
from blockload.sources.target import load_blocks, reject_view, run_key, run_key_col, target_view
from blockload.testing import failing_blocks

DAY = dt.date(2024, 2, 2)


def _cfg(spark, **kw):
    base = dict(target=new_path(spark, "target"), process_name="t", scope="s", run_date=DAY, retry_delay_s=0.0,
                max_retry_delay_s=0.0)
    base.update(kw)
    return with_paths(spark, LoadConfig(**base))


def _same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    assert a.count() == b.count()
    assert a.select(*cols).exceptAll(b.select(*cols)).count() == 0


def _state(spark, cfg):
    return {r["block_id"]: r for r in L.ledger_state(L.read_ledger(spark, cfg.ledger_path)).collect()}


def test_landed_resume_after_fault(spark, tables):
    o = tables("orders")
    cfg = _cfg(spark, block_key="o_custkey", blocks_on="keys", block_size=300)
    with failing_blocks({2: 100}):
        first = load_landed(o, cfg, 1500, 5)
    assert not first.success and first.failed_blocks == 1 and first.ok_blocks == 4
    assert first.error.startswith("block 2: ") and "injected failure" in first.error
    st = _state(spark, cfg)
    assert st[2]["status"] == "FAILED" and "injected" in st[2]["error_message"]
    second = load_landed(o, cfg, 1500, 5)
    assert second.success and second.landing == first.landing  # landing reused, not rewritten
    st2 = _state(spark, cfg)
    assert st2[2]["attempt"] == st[2]["attempt"] + 1
    assert all(st2[b]["seq"] == st[b]["seq"] for b in (1, 3, 4, 5))  # done blocks untouched (D11)
    _same(target_view(spark, cfg), o)


def test_empty_blocks_end_success_with_zero_rows(spark, tables):
    o = tables("orders").select("o_orderkey", "o_orderstatus")
    cfg = _cfg(spark, block_key="o_orderstatus", blocks_on="keys", block_size=100)
    res = load_landed(o, cfg, 1500, 8)  # 3 keys, 8 blocks
    assert res.success and res.ok_blocks == 8
    st = _state(spark, cfg)
    assert sorted(b for b, r in st.items() if r["row_count"] == 0) == [4, 5, 6, 7, 8]
    _same(target_view(spark, cfg), o)


def test_null_keys_are_loaded(spark, tables):
    o = tables("orders").withColumn(
        "o_custkey", F.when(F.col("o_custkey") % 10 == 3, F.lit(None)).otherwise(F.col("o_custkey")))
    cfg = _cfg(spark, block_key="O_CUSTKEY", blocks_on="keys", block_size=400)
    assert load_landed(o, cfg, 1500, 4).success
    _same(target_view(spark, cfg), o)


def test_run_load_with_retry_by_rows(spark, tables):
    ev = tables("events")
    cfg = _cfg(spark, threshold=500, block_size=200, blocks_on="rows", order_cols=["event_id"],
               block_retries=1)
    with failing_blocks({4: 6}):
        res = run_load_with_retry(ev, cfg)
    assert res.success and res.total_blocks == 5
    assert _state(spark, cfg)[4]["attempt"] == 7
    _same(target_view(spark, cfg), ev)


def test_retry_gives_up_after_max_retries(spark, tables):
    cfg = _cfg(spark, threshold=0, block_size=500, blocks_on="even", max_retries=1,
               block_retries=0)
    with failing_blocks({1: 100}):
        res = run_load_with_retry(tables("orders"), cfg)
    assert not res.success and res.needs_retry and res.failed_blocks == 1 and res.ok_blocks == 2


def test_invalid_request_is_not_retried(spark, tables):
    cfg = _cfg(spark, threshold=0, blocks_on="keys")  # no block_key
    with pytest.raises(ValueError):
        run_load_with_retry(tables("orders"), cfg)


def test_second_load_of_a_day_is_refused(spark, tables):
    """A complete run is not taken up again: other rows would be skipped with
    success."""
    c = tables("customer")
    for kw in (dict(), dict(threshold=0, blocks_on="even", block_size=60)):
        cfg = _cfg(spark, **kw)
        assert run_load(c.filter("c_custkey <= 40"), cfg).success
        with pytest.raises(ValueError, match="already holds a run"):
            run_load_with_retry(c.filter("c_custkey > 40"), cfg)
        assert run_load(c.filter("c_custkey > 40"), cfg.replace(run_date=DAY + dt.timedelta(days=1))).success
        _same(target_view(spark, cfg), c)


def test_repeated_direct_block_does_not_duplicate(spark, tables):
    c = tables("customer")
    cfg = _cfg(spark)
    with failing_blocks({1: 2}):
        assert load_direct(c, cfg).success
    _same(target_view(spark, cfg), c)


def test_a_pass_that_raises_is_repeated(spark, tables):
    calls = []

    def run(cfg):
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("the cluster went away")
        return run_load(tables("customer"), cfg)

    cfg = _cfg(spark)
    res = with_retry(run, cfg)
    assert res.is_complete and len(calls) == 3

    def never(cfg):
        raise RuntimeError("gone")

    res = with_retry(never, cfg)
    assert not res.success and not res.is_complete and res.needs_retry and "gone" in res.error


def test_hopeless_run_is_given_up(spark, tables):
    cfg = _cfg(spark, threshold=0, blocks_on="even", block_size=300, wave_size=2, block_retries=1, waves_in_flight=1)
    tries = {b: 1000 for b in range(1, 6)}
    with failing_blocks(tries):
        res = run_load_with_retry(tables("orders"), cfg)
    assert res.is_hopeless and res.failed_blocks == 5 and res.pending_blocks == 0
    assert sorted(r["attempt"] for r in _state(spark, cfg).values()) == [1, 1, 1, 3, 3]


def test_a_bad_first_wave_stops_no_other(spark, tables):
    """Every block is tried; what failed is retried while others are loaded."""
    o = tables("orders")
    cfg = _cfg(spark, threshold=0, blocks_on="even", block_size=375, wave_size=1, block_retries=0)
    with failing_blocks({1: 1000}):
        res = run_load(o, cfg)
        assert (res.ok_blocks, res.failed_blocks, res.is_hopeless) == (3, 1, False)
        again = run_load(o, cfg)
        assert again.failed_blocks == 1 and _state(spark, cfg)[1]["attempt"] == 2
    assert run_load(o, cfg).is_complete
    _same(target_view(spark, cfg), o)


@pytest.mark.parametrize("name", ["_run", "_BLOCK", "_attempt", "_p", "_rid"])
def test_reserved_names_are_refused(spark, tables, name):
    o = tables("orders").withColumnRenamed("o_orderstatus", name)
    cfg = _cfg(spark, threshold=0, block_size=500, blocks_on="rows", order_cols=["o_orderkey"])
    before = os.listdir(os.path.dirname(cfg.ledger_path)) if os.path.isdir(os.path.dirname(cfg.ledger_path)) else []
    for call in (lambda: run_load(o, cfg), lambda: load_direct(o, cfg), lambda: load_landed(o, cfg, 1500, 3),
                 lambda: run_load_with_retry(o, cfg)):
        with pytest.raises(ValueError, match="reserved name"):
            call()
    assert os.listdir(os.path.dirname(cfg.ledger_path)) == before      # no job ran
    src = new_path(spark, "pre")
    o.withColumn("blk", (F.col("o_orderkey") % 2 + 1)).write.parquet(src)
    with pytest.raises(ValueError, match="reserved name"):
        load_preblocked(spark, src, 2, "blk", ["o_orderkey", name], cfg)
    pinned = [lambda: B.blocks_by_row(o, ["o_orderkey"], 3)] if name in ("_p", "_rid", "_BLOCK") else []
    for call in pinned:
        with pytest.raises(ValueError, match="reserved name"):
            call()


def test_names_that_differ_by_case(spark, tables):
    """In one input they are refused; over days they are one column, and a
    load that cannot be written changes nothing for the readers."""
    c = tables("customer").select("c_custkey", "c_name")
    cfg = _cfg(spark)
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(ValueError, match="by case only"):
            run_load(c.withColumn("C_NAME", F.lit("x")), cfg)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    assert run_load(c.filter("c_custkey <= 70"), cfg).success
    next_day = cfg.replace(run_date=DAY + dt.timedelta(days=1))
    assert run_load(c.filter("c_custkey > 70").toDF("C_CUSTKEY", "C_Name"), next_day).success
    _same(target_view(spark, cfg), c)
    third = cfg.replace(run_date=DAY + dt.timedelta(days=2), block_retries=0)
    res = run_load(c.select(F.col("c_custkey").cast("string").alias("C_CUSTKEY"), F.lit(1).alias("more")), third)
    assert not res.success and "in the target" in res.error
    _same(target_view(spark, cfg), c)                                   # still readable, no column "more"


def test_a_preblocked_source_that_changes_is_refused(spark, tables):
    src, cfg = new_path(spark, "pre"), _cfg(spark, block_retries=0)
    ev = tables("events").select("event_id", "value", (F.col("event_id") % 4 + 1).alias("blk"))
    ev.write.parquet(src)
    with failing_blocks({4: 100}):
        assert load_preblocked(spark, src, 4, "blk", ["event_id", "value"], cfg).failed_blocks == 1
    changed = [ev.filter("event_id <> 7"), ev.union(ev.limit(1)),
               ev.withColumn("value", F.when(F.col("event_id") == 7, -1.0).otherwise(F.col("value")))]
    for other in changed:                            # fewer rows, more rows, as many with one other value
        other.write.mode("overwrite").parquet(src)
        spark.catalog.refreshByPath(src)
        with pytest.raises(ValueError, match="source changed"):
            load_preblocked_with_retry(spark, src, 4, "blk", ["event_id", "value"], cfg)
    ev.repartition(3).write.mode("overwrite").parquet(src)             # the same rows in another order
    spark.catalog.refreshByPath(src)
    assert load_preblocked(spark, src, 4, "blk", ["event_id", "value"], cfg).is_complete
    _same(target_view(spark, cfg), ev.drop("blk"))


def test_two_drivers_of_one_run(spark, tables):
    """While one driver loads, another is refused; each row is there once."""
    o, raised = tables("orders"), []
    cfg = _cfg(spark, threshold=0, blocks_on="even", block_size=300, wave_size=2)
    plain = flows.load_blocks

    def load_blocks(*args, **kwargs):
        def other():
            try:
                run_load_with_retry(o, cfg)
            except LeaseHeld as e:
                raised.append(str(e))
        second = threading.Thread(target=other)
        second.start()
        second.join()
        return plain(*args, **kwargs)

    flows.load_blocks = load_blocks
    try:
        assert run_load(o, cfg).is_complete
    finally:
        flows.load_blocks = plain
    assert len(raised) == 3 and all("another driver works on t/s (lease 1" in r for r in raised)
    _same(target_view(spark, cfg), o)


def test_a_lost_lease_is_fenced(spark, tables):
    """A driver that was given up and comes back records nothing that counts."""
    o = tables("orders")
    cfg = _cfg(spark, threshold=0, blocks_on="even", block_size=500, wave_size=1, waves_in_flight=1, lease_s=0.0)
    plain, done = flows.load_blocks, []

    def load_blocks(*args, **kwargs):
        flows.load_blocks = plain                      # the first driver hangs here, the second takes over
        second = threading.Thread(target=lambda: done.append(run_load(o, cfg)))
        second.start()
        second.join()
        return plain(*args, **kwargs)

    flows.load_blocks = load_blocks
    try:
        with pytest.raises(LeaseLost, match="taken over by lease 2"):
            run_load(o, cfg)
    finally:
        flows.load_blocks = plain
    assert done[0].is_complete
    state = _state(spark, cfg)
    assert {r["seq"] >> 40 for r in state.values()} == {2} and {r["status"] for r in state.values()} == {"SUCCESS"}
    _same(target_view(spark, cfg), o)
    late = spark.createDataFrame([(1,)], "block_id int")    # what it might still write
    L.ledger_record(spark, cfg.ledger_path, L.block_events(late, "t", "s", DAY, "FAILED", 9, fence=1))
    assert _state(spark, cfg)[1]["status"] == "SUCCESS"


def test_lease_files(spark):
    ledger = new_path(spark, "ledger")
    first = take_lease(spark, ledger, "p/q", "é", 60.0)
    with pytest.raises(LeaseHeld, match="p/q/é"):
        take_lease(spark, ledger, "p/q", "é", 60.0)
    other = take_lease(spark, ledger, "p", "q/é", 60.0)                 # another process and scope
    first.end()
    second = take_lease(spark, ledger, "p/q", "é", 60.0)
    assert (first.fence, second.fence, other.fence) == (1, 2, 1)
    with pytest.raises(LeaseLost):
        first.check()
    second.check()
    touch(spark, second.path, 1000.0)                                  # a driver that is gone
    third = take_lease(spark, ledger, "p/q", "é", 60.0)
    assert third.fence == 3 and not create_exclusive(spark, third.path)


def test_waves_run_at_once(spark, tables):
    """Two waves meet inside their loads."""
    o, gate = tables("orders"), threading.Barrier(2, timeout=120)
    cfg = _cfg(spark, threshold=0, blocks_on="even", block_size=375, wave_size=2, waves_in_flight=2)
    plain = flows.load_blocks

    def load_blocks(*args, **kwargs):
        gate.wait()
        return plain(*args, **kwargs)

    flows.load_blocks = load_blocks
    try:
        assert run_load(o, cfg).is_complete
    finally:
        flows.load_blocks = plain
    _same(target_view(spark, cfg), o)


def test_a_wave_that_hangs_is_cancelled(spark, tables):
    """Its blocks fail at the limit; the others are loaded meanwhile."""
    o = tables("orders").select("o_orderkey")
    cfg = _cfg(spark, threshold=0, blocks_on="even", block_size=500, wave_size=1, block_retries=0, wave_timeout_s=6.0)
    plain = flows.load_blocks

    @F.udf("boolean")
    def slow(x):
        import time
        time.sleep(120)
        return True

    def load_blocks(blocks, ids, *args, **kwargs):
        if 2 in ids:
            blocks = blocks.filter(slow("o_orderkey"))
        return plain(blocks, ids, *args, **kwargs)

    flows.load_blocks = load_blocks
    began = time.time()
    try:
        res = run_load(o, cfg)
    finally:
        flows.load_blocks = plain
    assert time.time() - began < 100
    assert (res.ok_blocks, res.failed_blocks) == (2, 1) and "cancelled after 6 s" in res.error
    assert run_load(o, cfg.replace(wave_timeout_s=0.0)).is_complete
    _same(target_view(spark, cfg), o)


@pytest.fixture
def loads(monkeypatch):
    """The blocks of each load, in order."""
    seen, plain = [], flows.load_blocks

    def load_blocks(blocks, ids, *args, **kwargs):
        seen.append(list(ids))
        return plain(blocks, ids, *args, **kwargs)

    monkeypatch.setattr(flows, "load_blocks", load_blocks)
    return seen


def test_waves_that_go_well_share_jobs(spark, tables, loads):
    """Jobs grow while they go well: their number does not follow the waves'."""
    o = tables("orders")
    cfg = _cfg(spark, threshold=0, blocks_on="even", block_size=125, wave_size=1, waves_in_flight=1)
    assert run_load(o, cfg).is_complete
    assert loads == [[1], [2, 3], [4, 5, 6, 7], [8, 9, 10, 11, 12]]
    assert {r["attempt"] for r in _state(spark, cfg).values()} == {1}
    _same(target_view(spark, cfg), o)


def test_a_bad_block_of_a_shared_job_stops_no_other(spark, tables, loads):
    o = tables("orders")
    cfg = _cfg(spark, threshold=0, blocks_on="even", block_size=125, wave_size=1, waves_in_flight=1, block_retries=0)
    with failing_blocks({6: 1000}):
        res = run_load(o, cfg)
    assert (res.ok_blocks, res.failed_blocks, res.is_hopeless) == (11, 1, False)
    assert loads == [[1], [2, 3], [4, 5, 6, 7], [4, 5], [6, 7], [6], [7], [8], [9, 10], [11, 12]]
    assert run_load(o, cfg).is_complete
    _same(target_view(spark, cfg), o)


@pytest.mark.parametrize("limit, value", [("JOB_BLOCKS", 2), ("JOB_ROWS", 300)])
def test_shared_jobs_are_bounded(spark, tables, loads, monkeypatch, limit, value):
    monkeypatch.setattr(flows, limit, value)
    cfg = _cfg(spark, threshold=0, blocks_on="even", block_size=125, wave_size=1, waves_in_flight=1)
    assert run_load(tables("orders"), cfg).is_complete
    assert loads[0] == [1] and max(map(len, loads)) == 2 and sorted(sum(loads, [])) == list(range(1, 13))


@pytest.mark.parametrize("kept", [{"wave_rows": 125}, {"wave_timeout_s": 600.0}])
def test_waves_that_the_caller_bounds_share_no_job(spark, tables, loads, kept):
    cfg = _cfg(spark, threshold=0, blocks_on="even", block_size=250, wave_size=1, waves_in_flight=1, **kept)
    assert run_load(tables("orders"), cfg).is_complete
    assert loads == [[b] for b in range(1, 7)]


def test_waves_by_rows(spark, tables):
    """A hot key's block is a wave by itself."""
    o = tables("orders").withColumn("k", F.when(F.col("o_orderkey") % 3 == 0, 7).otherwise(F.col("o_custkey")))
    cfg = _cfg(spark, threshold=0, block_key="k", blocks_on="keys", block_size=50, wave_rows=200)
    sizes = []
    plain = flows.load_blocks

    def load_blocks(blocks, ids, *args, **kwargs):
        sizes.append(list(ids))
        return plain(blocks, ids, *args, **kwargs)

    flows.load_blocks = load_blocks
    try:
        assert run_load(o, cfg).is_complete
    finally:
        flows.load_blocks = plain
    rows = {b: r["row_count"] for b, r in _state(spark, cfg).items()}
    hot = max(rows, key=rows.get)
    assert [hot] in sizes and rows[hot] >= 500 and sorted(b for w in sizes for b in w) == sorted(rows)
    assert all(sum(rows[b] for b in w[:-1]) < 200 for w in sizes) and len(sizes) < 10
    _same(target_view(spark, cfg), o)


@pytest.mark.parametrize("how", [dict(), dict(threshold=0, blocks_on="even", block_size=60)])
def test_too_long_values_are_kept_out(spark, how):
    """Target and rejects are the source together, also after a fault."""
    text = F.when(F.col("id") % 7 == 0, F.repeat(F.lit("é"), F.lit(4001))).when(
        F.col("id") % 7 == 1, F.repeat(F.lit("é"), F.lit(4000))).when(F.col("id") % 7 == 2, None).otherwise("short")
    blob = F.when(F.col("id") % 11 == 0, F.repeat(F.lit("x"), F.lit(8001)).cast("binary")).otherwise(F.lit(b"b"))
    df = spark.range(200).select(F.col("id").alias("k"), text.alias("t"), blob.alias("b"))
    path = new_path(spark, "long")
    df.write.parquet(path)
    df = spark.read.parquet(path)
    cfg = _cfg(spark, rejects_too_long=True, **how)
    long = F.coalesce(F.length("t") > 4000, F.lit(False)) | (F.octet_length("b") > 8000)
    with failing_blocks({1: 100}):
        assert not run_load(df, cfg).success
    res = run_load(df, cfg)
    assert res.is_complete and res.rows_rejected == df.where(long).count() > 0 and "rejected" in res.summary()
    assert res.rows_loaded + res.rows_rejected == 200
    _same(target_view(spark, cfg), df.where(~long))
    _same(reject_view(spark, cfg), df.where(long))


def test_row_digest_tells_rows_apart(spark):
    schema = "a int, b int, m map<string,int>, s struct<x:int,m:map<string,int>>"
    rows = [(1, None, {"k": 1}, (1, {"a": 1})), (None, 1, None, None), (1, None, {"k": 1}, (1, {"a": 1}))]

    def digest(data):
        df = spark.createDataFrame(data, schema)
        return df.agg(B.row_digest(df, df.columns)).first()[0]

    assert digest(rows) == digest(rows[::-1]) and digest(rows) != digest(rows[:2])
    assert digest([(1, None, None, None)]) != digest([(None, 1, None, None)])
    assert digest([(1, 1, {"k": 1}, None)]) != digest([(1, 1, {"k": 2}, None)])


def test_timestamps_keep_what_the_target_keeps(spark):
    df = spark.sql("SELECT 1 AS id, TIMESTAMP '2024-01-01 00:00:00.123456' AS t, TIMESTAMP_NTZ '2024-01-01 00:00:00.654321' AS n")
    for scale, want in ((None, (123456, 654321)), (6, (123456, 654321)), (3, (123000, 654000))):
        cfg = _cfg(spark, timestamp_scale=scale)
        assert run_load(df, cfg.replace(exclude_columns=())).success
        row = target_view(spark, cfg).first()
        assert (row.t.microsecond, row.n.microsecond) == want
    with pytest.raises(ValueError, match="timestamp_scale"):
        _cfg(spark, timestamp_scale=4).cuts_to_millis


def test_one_bad_block_costs_one_pause_a_round(spark, tables, monkeypatch):
    pauses = []
    monkeypatch.setattr("blockload.plans.flows._pause", pauses.append)
    cfg = _cfg(spark, threshold=0, blocks_on="even", block_size=100, retry_delay_s=5.0, block_retries=2)
    with failing_blocks({7: 1000}):
        res = run_load(tables("orders"), cfg)
    assert (res.ok_blocks, res.failed_blocks) == (14, 1) and pauses == [5.0, 10.0]


def test_run_keys_and_landings_do_not_collide(spark, tables):
    c = tables("customer")
    target = new_path(spark, "target")
    cfg = _cfg(spark, target=target, process_name="a:b", scope="c")
    other = cfg.replace(process_name="a", scope="b:c")
    assert run_load(c.filter("c_custkey <= 100"), cfg).success and run_load(c.filter("c_custkey > 100"), other).success
    _same(target_view(spark, cfg), c)
    one = _cfg(spark, target=target, process_name="a b", threshold=0, blocks_on="even", block_size=50)
    two = one.replace(process_name="a_b")
    assert run_load(c, one).landing != run_load(c, two).landing
    names = [("a:b", "c"), ("a", "b:c"), ("é~ *+%", "x/y"), ("..", "-_.")]
    df = spark.createDataFrame([(p, s, DAY) for p, s in names], "p string, s string, d date")
    keys = [r[0] for r in df.select(run_key_col(F.col("p"), F.col("s"), F.col("d"))).collect()]
    assert keys == [run_key(p, s, DAY) for p, s in names] and len(set(keys)) == 4


def test_changed_input_is_not_landed_short(spark, tables):
    """The landing must hold as many rows as were counted."""
    cfg = _cfg(spark, blocks_on="even", block_size=500)
    with pytest.raises(RuntimeError, match="holds 1500 rows"):
        load_landed(tables("orders"), cfg, 1400, 3)
    assert L.read_runs(spark, cfg.ledger_path).count() == 0


def test_explicit_run_date_is_the_only_one_loaded(spark, tables):
    c = tables("customer")
    cfg = _cfg(spark)
    with failing_blocks({1: 100}):
        assert not run_load(c.filter("c_custkey <= 50"), cfg).success
    later = cfg.replace(run_date=DAY + dt.timedelta(days=1))
    res = run_load(c.filter("c_custkey > 50"), later)
    assert res.success and res.run_date == later.run_date and res.rows_loaded == c.filter("c_custkey > 50").count()
    res = run_load(c.filter("c_custkey <= 50"), cfg.replace(run_date=None))
    assert res.success and res.run_date == DAY
    _same(target_view(spark, cfg), c)


def test_resume_follows_the_flow_of_the_run(spark, tables):
    c = tables("customer").limit(100)
    cfg = _cfg(spark, threshold=100, block_size=25, blocks_on="even")
    with failing_blocks({3: 100}):
        assert not run_load(c, cfg).success
    res = run_load(c.limit(99), cfg)
    assert res.success and res.total_blocks == 4 and res.rows_loaded == 100
    with pytest.raises(ValueError):
        run_load(c, cfg.replace(target=""))


def test_rows_outside_the_planned_blocks_are_refused(spark, tables):
    ev = tables("events").withColumn("BLOCK", F.when(F.col("event_id") % 100 > 0, F.col("event_id") % 4 + 1))
    for kind in ("int", "bigint", "string"):
        src = new_path(spark, "pre")
        ev.withColumn("BLOCK", F.col("BLOCK").cast(kind)).write.parquet(src)
        with pytest.raises(ValueError, match="^10 rows"):
            load_preblocked(spark, src, 4, "BLOCK", ["event_id"], _cfg(spark))


def test_target_takes_added_columns_and_refuses_other_types(spark, tables):
    c = tables("customer").select("c_custkey", "c_name")
    cfg = _cfg(spark)
    assert run_load(c.limit(10), cfg).success
    more = cfg.replace(run_date=DAY + dt.timedelta(days=1))
    assert run_load(tables("customer").select("c_custkey", "c_acctbal").limit(5), more).success
    view = target_view(spark, cfg)
    assert sorted(view.columns) == ["c_acctbal", "c_custkey", "c_name"] and view.count() == 15
    bad = cfg.replace(run_date=DAY + dt.timedelta(days=2), block_retries=0, max_retries=0)
    res = run_load(c.withColumn("c_custkey", F.col("c_custkey").cast("string")), bad)
    assert not res.success and "c_custkey is string" in res.error


def test_view_hides_unfinished_blocks_and_empty_repeats_clear(spark, tables):
    o = tables("orders").limit(100)
    cfg = _cfg(spark, blocks_on="even", block_size=50, block_retries=0)
    with failing_blocks({2: 100}):
        assert not load_landed(o, cfg, 100, 2).success
    done = target_view(spark, cfg).count()
    L.ledger_record(spark, cfg.ledger_path, L.block_events(
        spark.createDataFrame([(1,)], "block_id int"), "t", "s", DAY, "RUNNING", 9))
    assert done == 50 and target_view(spark, cfg).count() == 0
    empty = o.limit(0).withColumn("_block", F.lit(1))
    key = run_key("t", "s", DAY)
    counts = load_blocks(empty, [1], cfg, key, {1: 10})
    assert counts.collect() == []


def test_force_new_run_on_a_day_with_a_run_raises(spark, tables):
    c = tables("customer")
    cfg = _cfg(spark)
    assert run_load(c, cfg).success
    with pytest.raises(ValueError):
        run_load(c, cfg.replace(force_new_run=True))


def test_preblocked_by_name_and_path(spark, tables):
    ev = tables("events")
    src = new_path(spark, "pre")
    ev.withColumn("BLOCK", (F.col("event_id") % 4 + 1).cast("int")).write.partitionBy("BLOCK").parquet(src)
    cols = ["EVENT_ID", "user_id", "value"]
    cfg = _cfg(spark, block_retries=2)
    with failing_blocks({3: 8}):
        res = load_preblocked_with_retry(spark, src, 4, "block", cols + ["block"], cfg)
    assert res.success
    _same(target_view(spark, cfg), ev.select("event_id", "user_id", "value"))
    spark.read.parquet(src).createOrReplaceTempView("preblocked_events")
    cfg2 = _cfg(spark)
    assert load_preblocked(spark, "preblocked_events", 6, "BLOCK", cols, cfg2).success  # blocks 5, 6 empty
    _same(target_view(spark, cfg2), ev.select("event_id", "user_id", "value"))


def test_preblocked_checks_before_any_job(spark):
    cfg = _cfg(spark)
    with pytest.raises(ValueError):
        load_preblocked(spark, "x", 0, "BLOCK", ["a"], cfg)
    with pytest.raises(ValueError):
        load_preblocked(spark, "/root/testdata/sf0.001/orders.parquet", 2, "1bad", ["o_orderkey"], cfg)


def test_read_error_fails_the_block(spark, tables):
    """A block whose read raises is FAILED, never SUCCESS with 0 rows."""
    src = new_path(spark, "pre")
    tables("orders").withColumn("BLOCK", (F.col("o_orderkey") % 2 + 1).cast("int")).write.parquet(src)
    bad = spark.read.parquet(src).withColumn(
        "o_totalprice", F.when(F.col("BLOCK") == 2, F.raise_error(F.lit("bad row"))).otherwise(F.col("o_totalprice")))
    bad.createOrReplaceTempView("bad_orders")
    cfg = _cfg(spark, block_retries=0)
    res = load_preblocked(spark, "bad_orders", 2, "BLOCK", ["o_orderkey", "o_totalprice"], cfg)
    assert not res.success and res.failed_blocks == 1
    assert _state(spark, cfg)[2]["status"] == "FAILED"


def test_routine_out_values_results_and_failure(spark, tables):
    tables("orders").createOrReplaceTempView("orders_r")
    r = register_routine(Routine("status_count", out="SELECT COUNT(*) AS n, 0 AS return_code FROM IDENTIFIER(:t)",
                                 results=["SELECT o_orderstatus, COUNT(*) AS c FROM IDENTIFIER(:t) "
                                          "WHERE o_totalprice > :p GROUP BY o_orderstatus"]))
    res = run_routine(spark, "status_count", {"t": "orders_r", "p": 0.0})
    assert res.ok and res.return_code == 0 and res.out == {"n": 1500}
    assert sum(row["c"] for row in res.result_sets[0].collect()) == 1500
    bad = run_routine(spark, r, {"t": "no_such_table", "p": 0.0}, retries=1, delay_s=0.0)
    assert not bad.ok and bad.return_code == -1 and bad.error
    with pytest.raises(KeyError):
        run_routine(spark, "unknown", {})


def test_routine_binds_and_runs_before_it_is_ok(spark, tables):
    tables("orders").createOrReplaceTempView("orders_b")
    text = "SELECT date_format(o_orderdate, 'HH:mm:ss') AS t, o_orderkey::string AS k FROM orders_b WHERE o_orderkey < :n"
    res = run_routine(spark, Routine("times", results=[text]), {"n": 100, "unused": 1}, retries=0)
    assert res.ok and res.result_sets[0].count() == tables("orders").filter("o_orderkey < 100").count()
    boom = run_routine(spark, Routine("boom", results=["SELECT raise_error('boom') AS x"]), {}, retries=1, delay_s=0.0)
    assert not boom.ok and boom.return_code == -1 and "boom" in boom.error
    with pytest.raises(Exception, match="UNBOUND"):
        run_routine(spark, Routine("unbound", results=["SELECT :missing AS x"]), {}, retries=3, delay_s=60.0)


def test_routine_time_limit(spark):
    slow = Routine("slow", results=["SELECT java_method('java.lang.Thread', 'sleep', id * 0 + 20000L) AS x FROM range(1)"])
    res = run_routine(spark, slow, {}, retries=0, timeout_s=2.0)
    assert not res.ok and res.ms < 19_000


def test_lost_landing_raises(spark, tables):
    """An open run whose landing is gone raises; the input is not blocked
    anew."""
    o = tables("orders")
    cfg = _cfg(spark, block_key="o_custkey", blocks_on="keys", block_size=500)
    L.ensure_ledger(spark, cfg.ledger_path)
    L.begin_run(spark, cfg.ledger_path, "t", "s", DAY, "LANDING", 3, 1500, new_path(spark, "gone"))
    with pytest.raises(ValueError, match="no complete landing"):
        load_landed(o, cfg, 1500, 3)


def test_landing_is_kept_once_its_run_began(spark, tables):
    """A landing without a run record was never loaded and is left alone;
    a run keeps its landing even if no block was loaded."""
    o = tables("orders")
    cfg = _cfg(spark, block_key="o_custkey", blocks_on="keys", block_size=500, block_retries=0)
    with failing_blocks({1: 100, 2: 100, 3: 100}):
        first = load_landed(o, cfg, 1500, 3)
    assert first.ok_blocks == 0 and first.failed_blocks == 3
    second = load_landed(o, cfg, 1500, 3)
    assert second.success and second.landing == first.landing
    fresh = _cfg(spark, block_key="o_custkey", blocks_on="keys", block_size=500)
    root = f"{fresh.landing_path}/p-t/s-s/{DAY.isoformat()}"
    write_landing(B.blocks_even(o, 3), f"{root}/a1", 3, blocks_on="even", cluster=False)  # complete, never loaded
    res = load_landed(o, fresh, 1500, 3)
    assert res.success and res.landing.endswith("/a2")
    assert find_landing(spark, root) == (f"{root}/a2", f"{root}/a3")
    _same(target_view(spark, fresh), o)


@pytest.mark.parametrize("kw", [dict(), dict(threshold=0, block_key="o_custkey", blocks_on="keys"),
                                dict(threshold=0, blocks_on="rows", order_cols=["o_orderkey"]),
                                dict(threshold=0, blocks_on="even")])
def test_empty_input_loads_one_empty_block(spark, tables, kw):
    """Edge of SURVEY 5.4: an empty frame is one block of 0 rows, and the
    target still reads, with the source's columns."""
    o = tables("orders").limit(0)
    cfg = _cfg(spark, **kw)
    res = run_load(o, cfg)
    assert res.success and res.total_blocks == 1 and res.rows_loaded == 0
    view = target_view(spark, cfg)
    assert view.count() == 0 and sorted(view.columns) == sorted(o.columns)


def test_resume_takes_block_count_from_landing(spark, tables):
    """A resumed run keeps the landing's blocks, whatever a new count
    would say."""
    o = tables("orders")
    cfg = _cfg(spark, block_key="o_custkey", blocks_on="keys", block_size=300)
    with failing_blocks({4: 100}):
        first = load_landed(o, cfg, 1500, 5)
    assert not first.success and first.total_blocks == 5
    second = load_landed(o, cfg, 2700, 9)  # the input "grew": the run still has its 5 blocks
    assert second.success and second.total_blocks == 5
    _same(target_view(spark, cfg), o)


def test_names_with_quotes_and_slashes(spark, tables):
    """Process and scope reach Spark as values, never as SQL text."""
    c = tables("customer")
    cfg = _cfg(spark, process_name="o'brien; DROP TABLE x", scope="a/b=c", threshold=0, block_size=60,
               blocks_on="even")
    res = run_load(c, cfg)
    assert res.success and res.total_blocks == 3
    st = L.ledger_state(L.read_ledger(spark, cfg.ledger_path)).select("process_name", "scope").distinct().collect()
    assert [tuple(r) for r in st] == [("o'brien; DROP TABLE x", "a/b=c")]
    _same(target_view(spark, cfg), c)


def test_resume_from_compacted_ledger(spark, tables):
    """Compaction between runs keeps what resume needs: states and attempts."""
    o = tables("orders")
    cfg = _cfg(spark, block_key="o_custkey", blocks_on="keys", block_size=500)
    with failing_blocks({2: 100}):
        assert not load_landed(o, cfg, 1500, 3).success
    tried = _state(spark, cfg)[2]["attempt"]
    compact = L.compact_ledger(spark, cfg.ledger_path, new_path(spark, "ledger"))
    res = load_landed(o, cfg.replace(ledger_path=compact), 1500, 3)
    assert res.success
    assert L.ledger_state(L.read_ledger(spark, compact)).filter("block_id = 2").first()["attempt"] == tried + 1
    _same(target_view(spark, cfg.replace(ledger_path=compact)), o)
