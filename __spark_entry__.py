"""

``entry(spark)`` runs the flagship slice on sf0.001; ``queries()`` holds one
``sf_dir``; ``oracle_sql()`` holds the DuckDB text that must give the same
rows. Flow keys run a load with an injected failure, resume it, and return
what a reader of the target sees; their oracle is a plain SELECT of the
source.
"""

from __future__ import annotations

import datetime as dt
import importlib.util
import os
import sys
from collections.abc import Callable

# Importable by file path from any working directory.
if os.path.dirname(os.path.abspath(__file__)) not in sys.path:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockload.config import BLOCK_COL, LoadConfig
from blockload.functions.columns import check_request, exclude_columns, resolve_columns
from blockload.functions.target_types import fit_report, target_report, to_target_values
from blockload.operators import blocks as B
from blockload.operators import ledger as L
from blockload.operators.lease import LeaseHeld, take_lease
from blockload.plans.flows import (load_direct, load_landed, load_preblocked, run_load, run_load_with_retry,
                                   with_paths)
from blockload.plans.routines import Routine, run_routine
from blockload.session import new_path
from blockload.sources.landing import landing_state, read_landing, scan_blocks, write_landing, write_row_landing
from blockload.sources.read import read_source
from blockload.sources.target import load_blocks, reject_view, target_view
from blockload.testing import failing_blocks

SF0001 = "/root/testdata/sf0.001"
RUN_DAY = dt.date(2024, 1, 1)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null_keyed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with some keys made null, to show that null keys keep rows."""
    o = _t(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.when(F.col("o_custkey") % 10 == 3, F.lit(None))
                    .otherwise(F.col("o_custkey")).alias("block_key"))


def ledger_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger events derived from ``events`` (FIXTURES.md): grows with the
    scale factor."""
    e = _t(spark, sf_dir, "events")
    status = (F.when(F.col("event_type") == "purchase", "SUCCESS").when(F.col("event_type") == "error", "FAILED")
              .when(F.col("event_type") == "view", "RUNNING").otherwise("PENDING"))
    return e.select(
        F.concat(F.lit("p"), (F.col("user_id") % 3).cast("string")).alias("process_name"),
        F.concat(F.lit("c"), (F.col("user_id") % 5).cast("string")).alias("scope"),
        F.col("ts").cast("date").alias("run_date"),
        (F.col("event_id") % 4 + 1).cast("int").alias("block_id"),
        status.alias("status"),
        F.floor("value").cast("long").alias("row_count"),
        F.lit(0).alias("attempt"),
        F.lit(None).cast("string").alias("error_message"),
        F.col("ts").cast("timestamp").alias("last_update"),
        F.col("event_id").alias("seq"),
    )


def _state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.ledger_state(ledger_fixture(spark, sf_dir))


def _fixture_plan(state: DataFrame) -> DataFrame:
    return L.plan_blocks(state.select(*L.RUN_KEYS).distinct(), 4)


def _events_landing(spark: SparkSession, sf_dir: str) -> str:
    """Blocks by row over events, in the row layout (written once)."""
    ev = _t(spark, sf_dir, "events")
    return write_row_landing(ev, ["user_id", "event_id"], new_path(spark, "landing"), 16)


def _orders_key_landing(spark: SparkSession, sf_dir: str) -> str:
    o = _t(spark, sf_dir, "orders")
    return write_landing(B.blocks_by_key(o, "o_custkey", 8), new_path(spark, "landing"), 8, blocks_on="keys")


def _flow_cfg(spark: SparkSession, **kw) -> LoadConfig:
    base = dict(target=new_path(spark, "target"), process_name="orders_load", scope="all", run_date=RUN_DAY,
                retry_delay_s=0.0, max_retry_delay_s=0.0, wave_size=3)
    base.update(kw)
    return with_paths(spark, LoadConfig(**base))


# --- queries -----------------------------------------------------------------

def q_exclude_columns(spark, sf_dir):
    return exclude_columns(_t(spark, sf_dir, "orders"), ["O_ORDERSTATUS", "o_OrderPriority", "Id"])


def q_distinct_keys(spark, sf_dir):
    return B.distinct_keys(_null_keyed_orders(spark, sf_dir), "block_key")


def q_block_plan(spark, sf_dir):
    return B.block_plan(_t(spark, sf_dir, "orders"), 2000, 10000)


def q_blocks_by_key(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return B.blocks_by_key(o, "o_custkey", 8).select("o_orderkey", "o_custkey", F.col(BLOCK_COL).alias("block_id"))


def q_attach_blocks(spark, sf_dir):
    s = _null_keyed_orders(spark, sf_dir)
    return B.attach_blocks(s, B.key_blocks(s, "block_key", 8), "block_key").select(
        "o_orderkey", "block_key", F.col(BLOCK_COL).alias("block_id"))


def q_blocks_by_row(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return B.blocks_by_row(ev, ["user_id", "event_id"], 16).select(
        "event_id", "user_id", F.col(BLOCK_COL).alias("block_id"))


def q_blocks_even(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    path = write_landing(B.blocks_even(o, 7), new_path(spark, "landing"), 7, blocks_on="even", cluster=False)
    return B.block_results(read_landing(spark, path)).select(F.col("block_id").cast("int").alias("block_id"), "n_rows")


def q_block_results(spark, sf_dir):
    return B.block_results(read_landing(spark, _events_landing(spark, sf_dir)))


def q_landing_state(spark, sf_dir):
    return landing_state(spark, _events_landing(spark, sf_dir))


def q_scan_blocks(spark, sf_dir):
    return scan_blocks(_events_landing(spark, sf_dir), [2, 5], ["EVENT_ID", "user_id", "Value"])


def q_chunk_rows(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    blocked = B.blocks_by_row(ev, ["user_id", "event_id"], 16)
    chunked = B.chunk_rows(blocked, 300, ["event_id"])
    return chunked.groupBy(F.col(BLOCK_COL).alias("block_id"), F.col("_chunk").alias("chunk_no")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


def q_write_landing(spark, sf_dir):
    landing = read_landing(spark, _orders_key_landing(spark, sf_dir))
    return landing.select("o_orderkey", "o_custkey", F.col(BLOCK_COL).alias("block_id"))


def q_load_blocks(spark, sf_dir):
    landing = read_landing(spark, _orders_key_landing(spark, sf_dir))
    cfg = LoadConfig(target=new_path(spark, "target"))
    ids = list(range(1, 9))
    load_blocks(landing, ids, cfg, "q~~load_blocks", {b: 1 for b in ids}).collect()
    t = spark.read.parquet(cfg.target)
    return t.select("o_orderkey", "o_custkey", F.col(BLOCK_COL).alias("block_id"))


_LEDGER_COLS = ["process_name", "scope", "run_date", "block_id", "status", "row_count"]


def q_ledger_state(spark, sf_dir):
    return _state(spark, sf_dir).select(*_LEDGER_COLS)


def q_ledger_record(spark, sf_dir):
    path = new_path(spark, "ledger")
    L.ensure_ledger(spark, path)
    L.ledger_record(spark, path, ledger_fixture(spark, sf_dir), small=False)
    return L.ledger_state(L.read_ledger(spark, path)).select(*_LEDGER_COLS)


def q_completed_blocks(spark, sf_dir):
    return L.completed_blocks(L.for_run(_state(spark, sf_dir), "p0", "c0")).select("run_date", "block_id")


def q_pending_blocks(spark, sf_dir):
    st = _state(spark, sf_dir)
    return L.pending_blocks(_fixture_plan(st), st)


def q_ledger_init(spark, sf_dir):
    st = _state(spark, sf_dir)
    return L.ledger_init(_fixture_plan(st), st).select(*L.BLOCK_KEYS, "status")


def q_resume_run_date(spark, sf_dir):
    return L.resume_run_dates(_state(spark, sf_dir))


def q_ledger_summary(spark, sf_dir):
    return L.ledger_summary(_state(spark, sf_dir))


def q_run_result(spark, sf_dir):
    st = _state(spark, sf_dir)
    return L.run_result(_fixture_plan(st), st).drop("rows_loaded", "success", "needs_retry")


def q_run_metrics(spark, sf_dir):
    return L.run_metrics(_state(spark, sf_dir))


def q_ledger_merge(spark, sf_dir):
    o, li = _t(spark, sf_dir, "orders"), _t(spark, sf_dir, "lineitem")
    current = o.select(
        F.col("o_orderkey").alias("block_id"), F.lit("PENDING").alias("status"),
        F.lit(0).cast("long").alias("row_count"))
    updates = li.groupBy((F.col("l_orderkey") + 3).alias("block_id")).agg(  # some keys on either side only
        F.when(F.min("l_linenumber") == 1, "SUCCESS").otherwise("FAILED").alias("status"),
        F.count(F.lit(1)).alias("row_count"))
    return L.ledger_merge(current, updates, ["block_id"])


def q_waves(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    pending = ev.select(F.col("user_id").alias("block_id")).distinct()
    return B.waves(pending, 6)


def q_waves_by_size(spark, sf_dir):
    """Blocks of one customer each, packed into waves of about 20 orders."""
    sizes = _t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("int").alias("block_id")).agg(
        F.count(F.lit(1)).alias("n_rows"))
    return B.waves_by_size(sizes, 20)


def q_run_lease(spark, sf_dir):
    """While another driver holds the lease of a run nothing is loaded; once it
    ends, all rows are, and what the other records late does not count."""
    o = _t(spark, sf_dir, "orders")
    cfg = _flow_cfg(spark, threshold=0, block_size=5000, blocks_on="even")
    L.ensure_ledger(spark, cfg.ledger_path)
    other = take_lease(spark, cfg.ledger_path, cfg.process_name, cfg.scope, cfg.lease_s)
    try:
        run_load_with_retry(o, cfg)
        raise RuntimeError("two drivers worked on one run")
    except LeaseHeld:
        other.end()
    result = run_load_with_retry(o, cfg)
    late = spark.createDataFrame([(1,)], "block_id INT")
    L.ledger_record(spark, cfg.ledger_path, L.block_events(
        late, cfg.process_name, cfg.scope, RUN_DAY, "FAILED", 9, fence=other.fence))
    if not result.is_complete:
        raise RuntimeError(f"unexpected outcome: {result}")
    return target_view(spark, cfg)


def q_load_with_rejects(spark, sf_dir):
    """Documents longer than the target's strings go to the reject table in the
    same pass; target and rejects are the source together."""
    d = _t(spark, sf_dir, "documents")
    cfg = _flow_cfg(spark, threshold=0, block_size=max(1, d.count() // 5), blocks_on="even", rejects_too_long=True)
    with failing_blocks({2: 1}):
        result = run_load_with_retry(d, cfg)
    if not result.is_complete:
        raise RuntimeError(f"unexpected outcome: {result}")
    return target_view(spark, cfg).withColumn("rejected", F.lit(False)).unionByName(
        reject_view(spark, cfg).withColumn("rejected", F.lit(True)))


def q_to_target_values(spark, sf_dir):
    return to_target_values(_t(spark, sf_dir, "events"))


def q_fit_report(spark, sf_dir):
    return fit_report(_t(spark, sf_dir, "documents"))


def q_target_columns(spark, sf_dir):
    return target_report(_t(spark, sf_dir, "lineitem"))


ORDERS_BY_STATUS = Routine(
    name="orders_by_status",
    results=["SELECT o_orderstatus, COUNT(*) AS n_orders, "
             "CAST(SUM(CASE WHEN o_totalprice >= :big THEN 1 ELSE 0 END) AS BIGINT) AS n_big "
             "FROM IDENTIFIER(:tbl) GROUP BY o_orderstatus"],
)


def q_run_routine(spark, sf_dir):
    view = "blockload_orders_" + new_path(spark, "v").rsplit("-", 1)[-1]
    _t(spark, sf_dir, "orders").createOrReplaceTempView(view)
    res = run_routine(spark, ORDERS_BY_STATUS, {"tbl": view, "big": 100000.0}, retries=0)
    if not res.ok:
        raise RuntimeError(res.error)
    return res.result_sets[0]


def q_load_direct(spark, sf_dir):
    cfg = _flow_cfg(spark, threshold=10**12)
    with failing_blocks({1: 1}):
        result = load_direct(_t(spark, sf_dir, "customer"), cfg)
    if not result.success:
        raise RuntimeError(f"direct load failed: {result}")
    return target_view(spark, cfg)


def q_load_landed(spark, sf_dir):
    """Blocks by key; block 3 fails all its tries in the first pass, the
    resumed pass loads it."""
    o = _t(spark, sf_dir, "orders")
    n = o.count()
    size = max(1, -(-n // 8))
    cfg = _flow_cfg(spark, block_key="o_custkey", blocks_on="keys", block_size=size)
    with failing_blocks({3: 100}):
        first = load_landed(o, cfg, n, B.n_blocks_for(n, size))
    second = load_landed(o, cfg, n, B.n_blocks_for(n, size))
    if first.success or not second.success:
        raise RuntimeError(f"unexpected outcome: {first} / {second}")
    return target_view(spark, cfg)


def q_load_preblocked(spark, sf_dir):
    """A table that already has a BLOCK column (written here from events by
    NTILE over event_id); block 2 fails in the first pass."""
    ev = _t(spark, sf_dir, "events")
    src = new_path(spark, "preblocked")
    (B.blocks_by_row(ev, ["event_id"], 8).withColumnRenamed(BLOCK_COL, "BLOCK")
     .write.partitionBy("BLOCK").parquet(src))
    cfg = _flow_cfg(spark)
    cols = ["event_id", "TS", "user_id", "event_type", "value", "props"]
    with failing_blocks({2: 100}):
        first = load_preblocked(spark, src, 8, "block", cols, cfg)
    second = load_preblocked(spark, src, 8, "block", cols, cfg)
    if first.success or not second.success:
        raise RuntimeError(f"unexpected outcome: {first} / {second}")
    return target_view(spark, cfg)


def q_run_load(spark, sf_dir):
    """The row count picks the landing flow; blocks by row over lineitem's
    total order."""
    li = _t(spark, sf_dir, "lineitem")
    cfg = _flow_cfg(spark, block_size=5000, threshold=50000, blocks_on="rows",
                    order_cols=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                                "l_shipdate"], wave_size=50)
    with failing_blocks({1: 100}):
        first = run_load(li, cfg)
    second = run_load(li, cfg)
    if first.success or not second.success:
        raise RuntimeError(f"unexpected outcome: {first} / {second}")
    return target_view(spark, cfg)


def q_with_retry(spark, sf_dir):
    """Even blocks; block 2 fails in the first passes, and the retry loop
    finishes the load."""
    o = _t(spark, sf_dir, "orders")
    cfg = _flow_cfg(spark, block_size=2200, threshold=0, blocks_on="even", block_retries=0)
    with failing_blocks({2: 4}):
        result = run_load_with_retry(o, cfg)
    if not result.success:
        raise RuntimeError(f"retry did not finish the load: {result}")
    return target_view(spark, cfg)


def q_read_source(spark, sf_dir):
    """O1 by path and by name, over the same table."""
    by_path = read_source(spark, f"{sf_dir.rstrip('/')}/supplier.parquet")
    view = "blockload_source_" + new_path(spark, "v").rsplit("-", 1)[-1]
    _t(spark, sf_dir, "customer").createOrReplaceTempView(view)
    return by_path.unionByName(read_source(spark, view), allowMissingColumns=True)


def q_resolve_columns(spark, sf_dir):
    """O2: names in any case give the source's own, in the order asked for."""
    o = _t(spark, sf_dir, "orders")
    return o.select(*resolve_columns(o, [c.upper() for c in reversed(o.columns)]).fieldNames())


def q_check_request(spark, sf_dir):
    """A request that passes its checks leaves the frame as it is; one that
    does not raises before any job."""
    p = _t(spark, sf_dir, "part")
    check_request(p, columns=["P_PARTKEY"], n_blocks=1, path="x")
    for bad in (dict(n_blocks=0), dict(columns=["no_such_column"]), dict(path="")):
        try:
            check_request(p, **bad)
        except ValueError:
            continue
        raise RuntimeError(f"{bad} was accepted")
    return p


def q_load_twice(spark, sf_dir):
    """Two loads with other rows: the second on the same date is refused (never
    a success that loads nothing), on the next date it adds its rows."""
    o = _t(spark, sf_dir, "orders")
    first, second = o.filter("o_orderstatus = 'F'"), o.filter("o_orderstatus <> 'F'")
    cfg = _flow_cfg(spark)
    done = [run_load(first, cfg).success]
    try:
        run_load(second, cfg)
        raise RuntimeError("a second load of a date was taken")
    except ValueError:
        done.append(run_load(second, cfg.replace(run_date=RUN_DAY + dt.timedelta(days=1))).success)
    if not all(done):
        raise RuntimeError(f"unexpected outcome: {done}")
    return target_view(spark, cfg)


def q_resume_smaller_input(spark, sf_dir):
    """A landed run with a failed block, resumed with an input below the
    threshold of the landing flow: the run's own landing is finished."""
    o = _t(spark, sf_dir, "orders")
    n = o.count()
    cfg = _flow_cfg(spark, threshold=n, block_size=max(1, n // 4), blocks_on="even")
    with failing_blocks({3: 100}):
        first = run_load(o, cfg)
    second = run_load(o.limit(max(1, n - 1)), cfg)
    if first.success or not second.success:
        raise RuntimeError(f"unexpected outcome: {first} / {second}")
    return target_view(spark, cfg)


def q_preblocked_out_of_range(spark, sf_dir):
    """Rows with no block from 1 to n are refused with their number before any
    load; with all blocks planned the table is loaded whole."""
    ev = _t(spark, sf_dir, "events")
    src = new_path(spark, "preblocked")
    ev.withColumn("BLOCK", F.when(F.col("event_id") >= 0, F.col("event_id") % 5 + 1)).write.parquet(src)
    cfg = _flow_cfg(spark)
    cols = ev.columns
    try:
        load_preblocked(spark, src, 4, "BLOCK", cols, cfg)
        raise RuntimeError("rows outside the blocks were left out")
    except ValueError as e:
        refused = int(str(e).split(" ", 1)[0])
    if not load_preblocked(spark, src, 5, "BLOCK", cols, cfg).success:
        raise RuntimeError("the load failed")
    return target_view(spark, cfg).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("sum_ids")).select(
        F.lit(refused).cast("long").alias("n_refused"), "n_rows", "sum_ids")


def q_added_column(spark, sf_dir):
    """Two runs into one target, the second with a column more."""
    c = _t(spark, sf_dir, "customer")
    cfg = _flow_cfg(spark)
    run_load(c.drop("c_acctbal").filter("c_nationkey < 10"), cfg)
    run_load(c.filter("c_nationkey >= 10"),
             cfg.replace(run_date=RUN_DAY + dt.timedelta(days=1)))
    return target_view(spark, cfg)


def q_reserved_columns(spark, sf_dir):
    """A source column with a name that the library adds is refused before any
    job, in every flow; under another name all rows are loaded."""
    o = _t(spark, sf_dir, "orders")
    cfg = _flow_cfg(spark, threshold=0, block_size=5000, blocks_on="rows", order_cols=["o_orderkey"])
    for name in ("_run", "_Block", "_attempt", "_p", "_rid"):
        for flow in (run_load, load_direct):
            try:
                flow(o.withColumnRenamed("o_orderstatus", name), cfg)
            except ValueError:
                continue
            raise RuntimeError(f"a column {name} was accepted")
    if not run_load(o.withColumnRenamed("o_orderstatus", "run"), cfg).is_complete:
        raise RuntimeError("the load failed")
    return target_view(spark, cfg)


def q_same_name_other_case(spark, sf_dir):
    """Two days into one target, the second with its names in upper case: one
    column each."""
    c = _t(spark, sf_dir, "customer")
    cfg = _flow_cfg(spark)
    upper = c.filter("c_nationkey >= 10").toDF(*[n.upper() for n in c.columns])
    done = [run_load(c.filter("c_nationkey < 10"), cfg).is_complete,
            run_load(upper, cfg.replace(run_date=RUN_DAY + dt.timedelta(days=1))).is_complete]
    if not all(done):
        raise RuntimeError(f"unexpected outcome: {done}")
    return target_view(spark, cfg)


def q_preblocked_changed(spark, sf_dir):
    """A pre-blocked source that has other rows when a run is resumed is refused,
    as many rows or not; with the first rows again the run is finished."""
    ev = _t(spark, sf_dir, "events").withColumn("BLOCK", F.col("event_id") % 5 + 1)
    src, cols = new_path(spark, "preblocked"), ["event_id", "user_id", "value"]
    ev.write.parquet(src)
    cfg = _flow_cfg(spark)
    with failing_blocks({4: 100}):
        first = load_preblocked(spark, src, 5, "BLOCK", cols, cfg)
    for other in (ev.withColumn("value", F.col("value") + 1), ev.union(ev)):
        other.write.mode("overwrite").parquet(src)
        spark.catalog.refreshByPath(src)
        try:
            load_preblocked(spark, src, 5, "BLOCK", cols, cfg)
        except ValueError:
            continue
        raise RuntimeError("a changed source was taken")
    ev.write.mode("overwrite").parquet(src)
    spark.catalog.refreshByPath(src)
    second = load_preblocked(spark, src, 5, "BLOCK", cols, cfg)
    if first.ok_blocks != 4 or not second.is_complete:
        raise RuntimeError(f"unexpected outcome: {first} / {second}")
    return target_view(spark, cfg)


def q_all_waves_tried(spark, sf_dir):
    """The first wave fails whole in the first passes: the other waves are
    loaded all the same, and the retry loop ends the load."""
    o = _t(spark, sf_dir, "orders")
    size = min(3000, max(1, o.count() // 2))    # a run of one block has no other wave
    cfg = _flow_cfg(spark, block_size=size, threshold=0, blocks_on="even", block_retries=0, wave_size=1)
    with failing_blocks({1: 2}):
        first = run_load(o, cfg)
        result = run_load_with_retry(o, cfg)
    if first.failed_blocks != 1 or first.is_hopeless or not result.is_complete:
        raise RuntimeError(f"unexpected outcome: {first} / {result}")
    return target_view(spark, cfg)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "read_source": q_read_source,
    "resolve_columns": q_resolve_columns,
    "check_request": q_check_request,
    "load_twice": q_load_twice,
    "resume_smaller_input": q_resume_smaller_input,
    "preblocked_out_of_range": q_preblocked_out_of_range,
    "added_column": q_added_column,
    "reserved_columns": q_reserved_columns,
    "same_name_other_case": q_same_name_other_case,
    "preblocked_changed": q_preblocked_changed,
    "all_waves_tried": q_all_waves_tried,
    "exclude_columns": q_exclude_columns,
    "distinct_keys": q_distinct_keys,
    "block_plan": q_block_plan,
    "blocks_by_key": q_blocks_by_key,
    "attach_blocks": q_attach_blocks,
    "blocks_by_row": q_blocks_by_row,
    "blocks_even": q_blocks_even,
    "block_results": q_block_results,
    "landing_state": q_landing_state,
    "scan_blocks": q_scan_blocks,
    "chunk_rows": q_chunk_rows,
    "write_landing": q_write_landing,
    "load_blocks": q_load_blocks,
    "ledger_state": q_ledger_state,
    "ledger_record": q_ledger_record,
    "completed_blocks": q_completed_blocks,
    "pending_blocks": q_pending_blocks,
    "ledger_init": q_ledger_init,
    "resume_run_date": q_resume_run_date,
    "ledger_summary": q_ledger_summary,
    "run_result": q_run_result,
    "run_metrics": q_run_metrics,
    "ledger_merge": q_ledger_merge,
    "waves": q_waves,
    "waves_by_size": q_waves_by_size,
    "run_lease": q_run_lease,
    "load_with_rejects": q_load_with_rejects,
    "to_target_values": q_to_target_values,
    "fit_report": q_fit_report,
    "target_columns": q_target_columns,
    "run_routine": q_run_routine,
    "load_direct": q_load_direct,
    "load_landed": q_load_landed,
    "load_preblocked": q_load_preblocked,
    "run_load": q_run_load,
    "with_retry": q_with_retry,
}


# --- oracle texts ------------------------------------------------------------

_LEDGER_STATE_SQL = """
WITH led AS (SELECT 'p' || CAST(user_id % 3 AS VARCHAR(9)) AS process_name, 'c' || CAST(user_id % 5 AS VARCHAR(9)) AS scope,
                    CAST(ts AS DATE) AS run_date, CAST(1 + event_id % 4 AS INTEGER) AS block_id,
                    CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED'
                                    WHEN 'view' THEN 'RUNNING' ELSE 'PENDING' END AS status,
                    CAST(FLOOR(value) AS BIGINT) AS row_count, event_id AS seq FROM events)
SELECT process_name, scope, run_date, block_id, status, row_count
FROM (SELECT led.*, ROW_NUMBER() OVER (PARTITION BY process_name, scope, run_date, block_id ORDER BY seq DESC) AS rn FROM led) t
WHERE rn = 1
"""

_BLOCKS_BY_KEY_SQL = """
WITH k AS (SELECT o_custkey, CAST(NTILE(8) OVER (ORDER BY o_custkey) AS INTEGER) AS block_id
           FROM (SELECT DISTINCT o_custkey FROM orders) d)
SELECT o.o_orderkey, o.o_custkey, k.block_id FROM orders o JOIN k ON o.o_custkey = k.o_custkey
"""

_BLOCK_RESULTS_SQL = """
SELECT block_id, COUNT(*) AS n_rows
FROM (SELECT CAST(NTILE(16) OVER (ORDER BY user_id, event_id) AS INTEGER) AS block_id FROM events) t GROUP BY block_id
"""

_PLAN_SQL = """plan AS (SELECT d.process_name, d.scope, d.run_date, b.block_id
              FROM (SELECT DISTINCT process_name, scope, run_date FROM st) d
              CROSS JOIN (SELECT DISTINCT block_id FROM st) b)"""

# The target typing of lineitem's columns.
_TARGET_COLUMNS_SQL = """
WITH t AS (SELECT * FROM (VALUES
  (1, 'l_orderkey', 'BIGINT', -5, 19, 0), (2, 'l_partkey', 'BIGINT', -5, 19, 0),
  (3, 'l_suppkey', 'BIGINT', -5, 19, 0), (4, 'l_linenumber', 'INTEGER', 4, 10, 0),
  (5, 'l_quantity', 'DOUBLE', 8, 15, 0), (6, 'l_extendedprice', 'DOUBLE', 8, 15, 0),
  (7, 'l_discount', 'DOUBLE', 8, 15, 0), (8, 'l_tax', 'DOUBLE', 8, 15, 0),
  (9, 'l_returnflag', 'NVARCHAR', -9, 4000, 0), (10, 'l_linestatus', 'NVARCHAR', -9, 4000, 0),
  (11, 'l_shipdate', 'TIMESTAMP', 93, 23, 3)
) AS v(ordinal, column_name, jdbc_type, jdbc_code, precision, scale)),
c AS (
  SELECT 'l_orderkey' AS column_name, COUNT(l_orderkey) AS n_values FROM lineitem UNION ALL
  SELECT 'l_partkey', COUNT(l_partkey) FROM lineitem UNION ALL
  SELECT 'l_suppkey', COUNT(l_suppkey) FROM lineitem UNION ALL
  SELECT 'l_linenumber', COUNT(l_linenumber) FROM lineitem UNION ALL
  SELECT 'l_quantity', COUNT(l_quantity) FROM lineitem UNION ALL
  SELECT 'l_extendedprice', COUNT(l_extendedprice) FROM lineitem UNION ALL
  SELECT 'l_discount', COUNT(l_discount) FROM lineitem UNION ALL
  SELECT 'l_tax', COUNT(l_tax) FROM lineitem UNION ALL
  SELECT 'l_returnflag', COUNT(l_returnflag) FROM lineitem UNION ALL
  SELECT 'l_linestatus', COUNT(l_linestatus) FROM lineitem UNION ALL
  SELECT 'l_shipdate', COUNT(l_shipdate) FROM lineitem)
SELECT t.ordinal, t.column_name, t.jdbc_type, t.jdbc_code, t.precision, t.scale, c.n_values
FROM t JOIN c ON t.column_name = c.column_name
"""


def _with_state(body: str) -> str:
    return f"WITH st AS ({_LEDGER_STATE_SQL})\n{body}"


_ORACLE: dict[str, str] = {
    "read_source": "SELECT * FROM supplier UNION ALL BY NAME SELECT * FROM customer",
    "resolve_columns": "SELECT * FROM orders",
    "check_request": "SELECT * FROM part",
    "load_twice": "SELECT * FROM orders",
    "reserved_columns": "SELECT * RENAME (o_orderstatus AS run) FROM orders",
    "same_name_other_case": "SELECT * FROM customer",
    "preblocked_changed": "SELECT event_id, user_id, value FROM events",
    "all_waves_tried": "SELECT * FROM orders",
    "resume_smaller_input": "SELECT * FROM orders",
    "preblocked_out_of_range": """SELECT count(*) FILTER (event_id % 5 + 1 > 4) AS n_refused, count(*) AS n_rows,
                                         CAST(sum(event_id) AS BIGINT) AS sum_ids FROM events""",
    "added_column": "SELECT * REPLACE (CASE WHEN c_nationkey >= 10 THEN c_acctbal END AS c_acctbal) FROM customer",
    "exclude_columns": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders",
    "distinct_keys": "SELECT DISTINCT CASE WHEN o_custkey % 10 = 3 THEN NULL ELSE o_custkey END AS block_key FROM orders",
    "block_plan": """
SELECT COUNT(*) AS total_rows, CAST(GREATEST(1, CEIL(COUNT(*) / 2000.0)) AS INTEGER) AS n_blocks,
       CASE WHEN COUNT(*) >= 10000 THEN 'LANDING' ELSE 'DIRECT' END AS flow FROM orders""",
    "blocks_by_key": _BLOCKS_BY_KEY_SQL,
    "attach_blocks": """
WITH s AS (SELECT o_orderkey, CASE WHEN o_custkey % 10 = 3 THEN NULL ELSE o_custkey END AS block_key FROM orders),
     k AS (SELECT block_key, CAST(NTILE(8) OVER (ORDER BY block_key NULLS FIRST) AS INTEGER) AS block_id
           FROM (SELECT DISTINCT block_key FROM s) d)
SELECT s.o_orderkey, s.block_key, k.block_id FROM s JOIN k ON s.block_key IS NOT DISTINCT FROM k.block_key""",
    "blocks_by_row": "SELECT event_id, user_id, CAST(NTILE(16) OVER (ORDER BY user_id, event_id) AS INTEGER) AS block_id FROM events",
    "blocks_even": """
WITH b AS (SELECT NTILE(7) OVER (ORDER BY o_orderkey) AS block_id FROM orders)
SELECT CAST(block_id AS INTEGER) AS block_id, COUNT(*) AS n_rows FROM b GROUP BY block_id""",
    "waves_by_size": """
WITH b AS (SELECT CAST(o_custkey AS INTEGER) AS block_id, COUNT(*) AS n_rows FROM orders GROUP BY o_custkey),
     s AS (SELECT *, n_rows >= 20 AS big, CASE WHEN n_rows >= 20 THEN 0 ELSE n_rows END AS small FROM b),
     c AS (SELECT *, SUM(small) OVER (ORDER BY block_id) - small AS ahead, SUM(small) OVER () AS total,
                  SUM(CASE WHEN big THEN 1 ELSE 0 END) OVER (ORDER BY block_id) AS nth FROM s)
SELECT block_id, n_rows, CAST(CASE WHEN big THEN CEIL(total / 20.0) + nth - 1
       ELSE LEAST(FLOOR(ahead / 20.0), GREATEST(CEIL(total / 20.0) - 1, 0)) END AS INTEGER) AS wave_no FROM c""",
    "run_lease": "SELECT * FROM orders",
    "load_with_rejects": "SELECT *, coalesce(length(text) > 4000, false) AS rejected FROM documents",
    "block_results": _BLOCK_RESULTS_SQL,
    "landing_state": _BLOCK_RESULTS_SQL,
    "scan_blocks": """
SELECT event_id, user_id, value
FROM (SELECT event_id, user_id, value, NTILE(16) OVER (ORDER BY user_id, event_id) AS b FROM events) t WHERE b IN (2, 5)""",
    "chunk_rows": """
SELECT block_id, chunk_no, COUNT(*) AS n_rows, MIN(event_id) AS first_id, MAX(event_id) AS last_id
FROM (SELECT block_id, event_id,
             CAST(FLOOR((ROW_NUMBER() OVER (PARTITION BY block_id ORDER BY event_id) - 1) / 300.0) AS INTEGER) AS chunk_no
      FROM (SELECT event_id, CAST(NTILE(16) OVER (ORDER BY user_id, event_id) AS INTEGER) AS block_id FROM events) a) t
GROUP BY block_id, chunk_no""",
    "write_landing": _BLOCKS_BY_KEY_SQL,
    "load_blocks": _BLOCKS_BY_KEY_SQL,
    "ledger_state": _LEDGER_STATE_SQL,
    "ledger_record": _LEDGER_STATE_SQL,
    "completed_blocks": _with_state(
        "SELECT run_date, block_id FROM st WHERE process_name = 'p0' AND scope = 'c0' AND status = 'SUCCESS'"),
    "pending_blocks": _with_state(f""", {_PLAN_SQL}
SELECT p.process_name, p.scope, p.run_date, p.block_id FROM plan p
WHERE NOT EXISTS (SELECT 1 FROM st WHERE st.process_name = p.process_name AND st.scope = p.scope
                  AND st.run_date = p.run_date AND st.block_id = p.block_id AND st.status = 'SUCCESS')"""),
    "ledger_init": _with_state(f""", {_PLAN_SQL}
SELECT p.process_name, p.scope, p.run_date, p.block_id, 'PENDING' AS status FROM plan p
WHERE NOT EXISTS (SELECT 1 FROM st WHERE st.process_name = p.process_name AND st.scope = p.scope
                  AND st.run_date = p.run_date AND st.block_id = p.block_id)"""),
    "resume_run_date": _with_state("""
SELECT process_name, scope, MAX(run_date) AS run_date FROM st
WHERE status IN ('FAILED', 'PENDING', 'RUNNING') GROUP BY process_name, scope"""),
    "ledger_summary": _with_state("""
SELECT process_name, scope, run_date, status, COUNT(*) AS n_blocks, CAST(SUM(row_count) AS BIGINT) AS n_rows
FROM st GROUP BY process_name, scope, run_date, status"""),
    "run_result": _with_state("""
SELECT process_name, scope, run_date, CAST(4 AS BIGINT) AS total_blocks,
       CAST(SUM(CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END) AS BIGINT) AS ok_blocks,
       CAST(SUM(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS failed_blocks,
       CAST(4 - SUM(CASE WHEN status IN ('SUCCESS', 'FAILED') THEN 1 ELSE 0 END) AS BIGINT) AS pending_blocks
FROM st GROUP BY process_name, scope, run_date"""),
    "run_metrics": _with_state("""
SELECT CAST(SUM(CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END) AS BIGINT) AS ok_blocks,
       CAST(SUM(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS failed_blocks,
       CAST(SUM(CASE WHEN status = 'SUCCESS' THEN row_count ELSE 0 END) AS BIGINT) AS rows_loaded FROM st"""),
    "ledger_merge": """
WITH t AS (SELECT o_orderkey AS block_id, 'PENDING' AS status, CAST(0 AS BIGINT) AS row_count FROM orders),
     s AS (SELECT l_orderkey + 3 AS block_id, CASE WHEN MIN(l_linenumber) = 1 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
                  COUNT(*) AS row_count FROM lineitem GROUP BY l_orderkey + 3)
SELECT COALESCE(s.block_id, t.block_id) AS block_id, COALESCE(s.status, t.status) AS status,
       COALESCE(s.row_count, t.row_count) AS row_count FROM t FULL OUTER JOIN s ON t.block_id = s.block_id""",
    "waves": """
WITH b AS (SELECT DISTINCT user_id AS block_id FROM events)
SELECT block_id, CAST(FLOOR((ROW_NUMBER() OVER (ORDER BY block_id) - 1) / 6.0) AS INTEGER) AS wave_no FROM b""",
    "to_target_values": "SELECT * REPLACE (DATE_TRUNC('millisecond', ts) AS ts) FROM events",
    "fit_report": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) AS n_values, "
        f"CAST(SUM(CASE WHEN LENGTH({c}) > 4000 THEN 1 ELSE 0 END) AS BIGINT) AS n_too_long FROM documents"
        for c in ("text", "lang", "source")),
    "target_columns": _TARGET_COLUMNS_SQL,
    "run_routine": """
SELECT o_orderstatus, COUNT(*) AS n_orders,
       CAST(SUM(CASE WHEN o_totalprice >= 100000 THEN 1 ELSE 0 END) AS BIGINT) AS n_big
FROM orders GROUP BY o_orderstatus""",
    "load_direct": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "load_landed": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
    "load_preblocked": """
SELECT event_id, ts, user_id, event_type, value, props FROM events""",
    "run_load": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate FROM lineitem""",
    "with_retry": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship slice on sf0.001: plan -> blocks by key -> landing -> block
    report (block_id, n_rows) counted on what was written."""
    orders = _t(spark, SF0001, "orders")
    plan = B.block_plan(orders, 200, 1000).first()
    blocked = B.blocks_by_key(orders, "o_custkey", plan["n_blocks"])
    path = write_landing(blocked, new_path(spark, "landing"), plan["n_blocks"],
                         blocks_on="keys")
    landing = read_landing(spark, path)
    ids = list(range(1, plan["n_blocks"] + 1))
    return B.block_results(landing.filter(F.col(BLOCK_COL).isin(ids)))


# The training-data operators and their pipeline are one subpackage and one
# module, which are left out here where they are not there.
_LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_LLM_ORACLE: dict[str, str] = {}
if importlib.util.find_spec("blockload.llm") and importlib.util.find_spec("blockload.llm.queries"):
    from blockload.llm.queries import ORACLE_SQL, QUERIES

    _LLM_QUERIES.update(QUERIES)
    _LLM_ORACLE.update(ORACLE_SQL)
    if importlib.util.find_spec("corpus_pipeline"):
        import corpus_pipeline

        _LLM_QUERIES["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL:
            _LLM_ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES | _LLM_QUERIES


def oracle_sql() -> dict[str, str]:
    return _ORACLE | _LLM_ORACLE
