"""Ledger events, state, plan, merge."""

import dataclasses
import datetime as dt

from pyspark.sql import functions as F

from blockload.config import RunResult
from blockload.operators import ledger as L
from blockload.session import new_path

DAY = dt.date(2024, 5, 1)


def _events(spark, rows):
    df = spark.createDataFrame(rows, "block_id INT, status STRING, attempt INT, row_count BIGINT")
    return L.block_events(df, "p", "c", DAY, F.col("status"), F.col("attempt"), F.col("row_count"))


def test_state_takes_latest_event_by_seq(spark):
    ev = _events(spark, [(1, "PENDING", 0, 0), (1, "RUNNING", 1, 0), (1, "FAILED", 1, 0), (1, "RUNNING", 2, 0),
                         (1, "SUCCESS", 2, 10), (2, "PENDING", 0, 0), (2, "RUNNING", 1, 0)])
    st = {r["block_id"]: (r["status"], r["attempt"], r["row_count"]) for r in L.ledger_state(ev).collect()}
    assert st == {1: ("SUCCESS", 2, 10), 2: ("RUNNING", 1, 0)}


def test_record_and_read_back(spark):
    path = new_path(spark, "ledger")
    L.ensure_ledger(spark, path)
    assert L.read_ledger(spark, path).count() == 0
    L.ledger_record(spark, path, _events(spark, [(1, "SUCCESS", 1, 5)]))
    L.ensure_ledger(spark, path)  # a second call keeps the events
    L.ledger_record(spark, path, _events(spark, [(2, "FAILED", 1, 0)]))
    rows = L.ledger_state(L.read_ledger(spark, path)).collect()
    assert sorted((r["block_id"], r["status"]) for r in rows) == [(1, "SUCCESS"), (2, "FAILED")]


def test_error_message_is_cut(spark):
    df = spark.createDataFrame([(1,)], "block_id INT")
    ev = L.as_events(L.block_events(df, "p", "c", DAY, "FAILED", 1, 0, "x" * 900))
    assert len(ev.first()["error_message"]) == 500


def test_plan_pending_init_and_result(spark):
    st = L.ledger_state(_events(spark, [(1, "SUCCESS", 1, 7), (2, "FAILED", 1, 0), (3, "RUNNING", 1, 0)]))
    plan = L.run_plan(spark, "p", "c", DAY, 5)
    assert sorted(r["block_id"] for r in L.pending_blocks(plan, st).collect()) == [2, 3, 4, 5]
    assert sorted(r["block_id"] for r in L.ledger_init(plan, st).collect()) == [4, 5]
    r = L.run_result(plan, st).first()
    assert (r["total_blocks"], r["ok_blocks"], r["failed_blocks"], r["pending_blocks"], r["rows_loaded"]) == \
        (5, 1, 1, 3, 7)
    assert (r["success"], r["needs_retry"]) == (False, True)
    m = L.run_metrics(st).first()
    assert (m["ok_blocks"], m["failed_blocks"], m["rows_loaded"]) == (1, 1, 7)
    assert L.run_metrics(st, 2.0).first()["rows_per_s"] == 3.5
    assert L.run_metrics(st, 0.5).first()["rows_per_s"] == 0.0
    s = {r["status"]: (r["n_blocks"], r["n_rows"]) for r in L.ledger_summary(st).collect()}
    assert s == {"SUCCESS": (1, 7), "FAILED": (1, 0), "RUNNING": (1, 0)}


def test_resume_run_date(spark):
    early, late = dt.date(2024, 1, 1), dt.date(2024, 1, 9)
    df = spark.createDataFrame([(1, "FAILED", 1, 0)], "block_id INT, status STRING, attempt INT, row_count BIGINT")
    ev = L.block_events(df, "p", "c", early, "FAILED", 1).unionByName(
        L.block_events(df, "p", "c", late, "SUCCESS", 1))
    st = L.ledger_state(ev)
    today = dt.date(2030, 1, 1)
    assert L.resume_run_date(st, "p", "c", today) == early
    assert L.resume_run_date(st, "p", "c", today, force_new=True) == today
    assert L.resume_run_date(st, "other", "c", today) == today


def test_merge_takes_update_values_even_null(spark):
    cur = spark.createDataFrame([(1, "PENDING", 0), (2, "PENDING", 0)], "block_id INT, status STRING, n BIGINT")
    upd = spark.createDataFrame([(2, "SUCCESS", None), (3, "FAILED", 4)], "block_id INT, status STRING, n BIGINT")
    got = sorted(tuple(r) for r in L.ledger_merge(cur, upd, ["block_id"]).collect())
    assert got == [(1, "PENDING", 0), (2, "SUCCESS", None), (3, "FAILED", 4)]


def test_unreadable_ledger_fails(spark):
    """A ledger that cannot be read is an error, never "nothing done"."""
    import pytest
    path = new_path(spark, "ledger")
    spark.range(3).selectExpr("CAST(id AS STRING) AS v").write.text(path)
    with pytest.raises(Exception):
        L.read_ledger(spark, path).collect()


def test_compact_ledger_keeps_the_state(spark):
    path = new_path(spark, "ledger")
    L.ensure_ledger(spark, path)
    L.ledger_record(spark, path, _events(spark, [(1, "RUNNING", 1, 0), (2, "RUNNING", 1, 0)]))
    L.ledger_record(spark, path, _events(spark, [(1, "SUCCESS", 1, 4), (2, "FAILED", 1, 0)]))
    new = L.compact_ledger(spark, path, new_path(spark, "ledger"))
    before = sorted(tuple(r) for r in L.ledger_state(L.read_ledger(spark, path)).drop("last_update").collect())
    after = sorted(tuple(r) for r in L.ledger_state(L.read_ledger(spark, new)).drop("last_update").collect())
    assert before == after and L.read_ledger(spark, new).count() == 2


def test_run_result_summary():
    ok = RunResult(True, 5, 5, 0, 0, 100, None, dt.date(2024, 5, 1), "p", "s", 2.0)
    assert ok.is_complete and not ok.needs_retry and ok.rows_per_s == 50.0
    assert ok.summary() == "p/s 2024-05-01: 5 of 5 blocks; 100 rows in 2 s"
    part = dataclasses.replace(ok, success=False, ok_blocks=4, failed_blocks=1, error="block 2: boom")
    assert part.needs_retry and not part.is_complete and not part.is_hopeless
    assert part.summary().endswith("; 1 failed and 0 not tried; block 2: boom")
    none = RunResult(False, 0, 0, 0, 0, error="gone")
    assert none.needs_retry and not none.is_complete and not none.is_hopeless
    assert not dataclasses.replace(part, ok_blocks=0, failed_blocks=2, pending_blocks=3).is_hopeless  # 3 not tried
    assert dataclasses.replace(part, ok_blocks=0, failed_blocks=5, pending_blocks=0).is_hopeless
