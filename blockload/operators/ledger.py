"""The ledger: one event per change of a block's state, appended to a
Parquet dataset. The state of a block is its latest event by ``seq``.

Parquet takes no UPDATE or MERGE, so the reference's in-place updates become
appends, and its MERGE a read-side "latest event" aggregation. Every
function here is a DataFrame operation; values are never put in SQL text.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockload.config import ERROR_MAX_CHARS, FAILED, PENDING, RUNNING, SUCCESS
from blockload.session import path_exists

RUN_KEYS = ["process_name", "scope", "run_date"]
BLOCK_KEYS = RUN_KEYS + ["block_id"]
OPEN_STATUSES = [FAILED, PENDING, RUNNING]
LEDGER_SCHEMA = T.StructType([
    T.StructField("process_name", T.StringType()),
    T.StructField("scope", T.StringType()),
    T.StructField("run_date", T.DateType()),
    T.StructField("block_id", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("last_update", T.TimestampType()),
    T.StructField("seq", T.LongType()),
])
# Order of events inside one attempt.
_STATUS_RANK = {PENDING: 0, RUNNING: 1, FAILED: 2, SUCCESS: 3}


_FENCE = 1 << 40   # an attempt's number stays far below


def seq_of(attempt: Column, status: Column, fence: int = 0) -> Column:
    """Writer-given order of an event: the writer's fence (the number of its
    lease) first, then the attempt, then the state's rank (PENDING < RUNNING <
    FAILED/SUCCESS). The clock plays no part."""
    rank = F.coalesce(*[F.when(status == s, F.lit(r)) for s, r in _STATUS_RANK.items()])
    return (attempt.cast("long") * 4 + rank + F.lit(fence * _FENCE).cast("long")).cast("long")


def as_events(df: DataFrame) -> DataFrame:
    """Select the ledger columns of ``df`` in ledger order and types; a
    missing optional column becomes null."""
    cols = []
    for f in LEDGER_SCHEMA.fields:
        c = df[f.name] if f.name in df.columns else F.lit(None)
        if f.name == "error_message":
            c = F.substring(c.cast("string"), 1, ERROR_MAX_CHARS)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def ledger_exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/_SUCCESS")


def ensure_ledger(spark: SparkSession, path: str) -> None:
    """Create an empty ledger at ``path`` if there is none. The ledger is
    partitioned by run (process, scope, run date): reading one run's state
    prunes to its folder, however long the ledger's history."""
    if not ledger_exists(spark, path):
        spark.createDataFrame([], LEDGER_SCHEMA).write.mode("append").partitionBy(*RUN_KEYS).parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All events. A ledger that cannot be read fails the caller; it is never
    taken as "nothing done"."""
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def ledger_record(spark: SparkSession, path: str, events: DataFrame, *, small: bool = True) -> None:
    """Append events. ``small`` frames (one row per block of a wave) are
    written as one file."""
    out = as_events(events)
    if small:
        out = out.coalesce(1)
    out.write.mode("append").partitionBy(*RUN_KEYS).parquet(path)


def block_events(blocks: DataFrame, process_name: str, scope: str, run_date: dt.date, status: Column | str,
                 attempt: Column | int = 0, row_count: Column | int = 0,
                 error: Column | str | None = None, fence: int = 0) -> DataFrame:
    """Events for the blocks of ``blocks`` (a frame with ``block_id``)."""
    st = F.lit(status) if isinstance(status, str) else status
    at = F.lit(attempt) if isinstance(attempt, int) else attempt
    rc = F.lit(row_count) if isinstance(row_count, int) else row_count
    er = F.lit(error) if error is None or isinstance(error, str) else error
    return blocks.select(
        F.lit(process_name).alias("process_name"), F.lit(scope).alias("scope"),
        F.lit(run_date).cast("date").alias("run_date"), F.col("block_id").cast("int").alias("block_id"),
        st.alias("status"), rc.cast("long").alias("row_count"), at.cast("int").alias("attempt"),
        er.cast("string").alias("error_message"), F.current_timestamp().alias("last_update"),
        seq_of(at, st, fence).alias("seq"),
    )


def compact_ledger(spark: SparkSession, path: str, new_path: str) -> str:
    """Write the state of the ledger at ``path`` (one event per block) as a new
    ledger at ``new_path``, and return it. Run between loads, never during
    one; the old ledger is left as it is (nothing is overwritten)."""
    ledger_state(read_ledger(spark, path)).write.mode("errorifexists").partitionBy(*RUN_KEYS).parquet(new_path)
    read_runs(spark, path).coalesce(1).write.mode("errorifexists").json(f"{new_path}/{_RUNS}")
    return new_path


# --- runs -------------------------------------------------------------------

# What a run is, written before its first block is tried and never changed: a
# later call follows it, whatever its own input or settings would give.
RUN_SCHEMA = T.StructType([
    T.StructField("process_name", T.StringType()),
    T.StructField("scope", T.StringType()),
    T.StructField("run_date", T.DateType()),
    T.StructField("flow", T.StringType()),
    T.StructField("n_blocks", T.IntegerType()),
    T.StructField("total_rows", T.LongType()),
    T.StructField("landing", T.StringType()),
])
_RUNS = "_runs"   # a hidden folder beside the events


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The runs of a ledger, one row each."""
    if not path_exists(spark, f"{path}/{_RUNS}"):
        return spark.createDataFrame([], RUN_SCHEMA)
    return spark.read.schema(RUN_SCHEMA).json(f"{path}/{_RUNS}")


def begin_run(spark: SparkSession, path: str, process_name: str, scope: str, run_date: dt.date, flow: str,
              n_blocks: int, total_rows: int, landing: str | None) -> None:
    row = (process_name, scope, run_date, flow, int(n_blocks), int(total_rows), landing)
    spark.createDataFrame([row], RUN_SCHEMA).coalesce(1).write.mode("append").json(f"{path}/{_RUNS}")


def with_progress(runs: DataFrame, state: DataFrame) -> DataFrame:
    """``runs`` with ``ok_blocks``, the blocks of each that are SUCCESS."""
    done = completed_blocks(state).groupBy(*RUN_KEYS).agg(F.count(F.lit(1)).alias("ok_blocks")).alias("_d")
    cond = [F.col(f"_r.{k}") == F.col(f"_d.{k}") for k in RUN_KEYS]
    return runs.alias("_r").join(done, cond, "left").select("_r.*", F.coalesce("ok_blocks", F.lit(0)).alias("ok_blocks"))


# --- reading the state ------------------------------------------------------

def ledger_state(events: DataFrame) -> DataFrame:
    """The latest event per (process, scope, run date, block). Partial
    aggregation keeps one row per key and task before the shuffle. An event
    recorded without a lease has no fence and counts by attempt and state among
    those of the block's last holder."""
    rest = [c for c in events.columns if c not in BLOCK_KEYS]
    event, fenced = F.struct(*[F.col(c) for c in rest]), F.col("seq") >= _FENCE
    latest = events.groupBy(*BLOCK_KEYS).agg(F.max_by(event, F.when(fenced, F.col("seq"))).alias("_f"),
                                             F.max_by(event, F.when(~fenced, F.col("seq"))).alias("_u"))
    last = F.when(F.col("_f").isNull() | (F.col("_u.seq") > F.pmod(F.col("_f.seq"), F.lit(_FENCE))), F.col("_u")).otherwise(
        F.col("_f")).alias("_e")
    return latest.select(*BLOCK_KEYS, last).select(*BLOCK_KEYS, *[F.col(f"_e.{c}").alias(c) for c in rest])


def for_run(df: DataFrame, process_name: str, scope: str, run_date: dt.date | None = None) -> DataFrame:
    cond = (F.col("process_name") == F.lit(process_name)) & (F.col("scope") == F.lit(scope))
    if run_date is not None:
        cond = cond & (F.col("run_date") == F.lit(run_date).cast("date"))
    return df.filter(cond)


def completed_blocks(state: DataFrame) -> DataFrame:
    """Blocks whose latest state is SUCCESS."""
    return state.filter(F.col("status") == SUCCESS)


def plan_blocks(runs: DataFrame, n_blocks: int | Column) -> DataFrame:
    """The plan: blocks 1..n of each run in ``runs`` (process, scope, run
    date), made by a generator, not by a join."""
    n = F.lit(n_blocks) if isinstance(n_blocks, int) else n_blocks
    return runs.select(*RUN_KEYS, F.explode(F.sequence(F.lit(1), n.cast("int"))).alias("block_id"))


def run_plan(spark: SparkSession, process_name: str, scope: str, run_date: dt.date, n_blocks: int) -> DataFrame:
    runs = spark.range(1).select(F.lit(process_name).alias("process_name"), F.lit(scope).alias("scope"),
                                 F.lit(run_date).cast("date").alias("run_date"))
    return plan_blocks(runs, n_blocks)


def _on_block(left: str, right: str) -> Column:
    cond = None
    for k in BLOCK_KEYS:
        c = F.col(f"{left}.{k}") == F.col(f"{right}.{k}")
        cond = c if cond is None else cond & c
    return cond


def pending_blocks(plan: DataFrame, state: DataFrame) -> DataFrame:
    """Blocks of the plan that are not SUCCESS (no event, PENDING,
    RUNNING or FAILED)."""
    done = completed_blocks(state).select(*BLOCK_KEYS).alias("_d")
    return plan.alias("_p").join(done, _on_block("_p", "_d"), "left_anti").select(
        *[F.col(f"_p.{k}").alias(k) for k in BLOCK_KEYS])


def ledger_init(plan: DataFrame, state: DataFrame) -> DataFrame:
    """A PENDING event for each planned block that has no event yet.
    (Appending them is O26.)"""
    seen = state.select(*BLOCK_KEYS).alias("_s")
    new = plan.alias("_p").join(seen, _on_block("_p", "_s"), "left_anti").select(
        *[F.col(f"_p.{k}").alias(k) for k in BLOCK_KEYS])
    return new.select(*BLOCK_KEYS, F.lit(PENDING).alias("status"), F.lit(0).cast("long").alias("row_count"),
                      F.lit(0).alias("attempt"), F.lit(None).cast("string").alias("error_message"),
                      F.current_timestamp().alias("last_update"), F.lit(0).cast("long").alias("seq"))


def ledger_merge(current: DataFrame, updates: DataFrame, keys: Sequence[str],
                 values: Sequence[str] | None = None) -> DataFrame:
    """One-shot upsert on ``keys``: a matched row takes the values of
    ``updates`` (null included), the others are kept or inserted."""
    keys = list(keys)
    values = list(values) if values is not None else [c for c in updates.columns if c not in keys]
    u = updates.select(*keys, *values, F.lit(True).alias("_u")).alias("u")
    c = current.select(*keys, *values).alias("c")
    cond = None
    for k in keys:
        e = F.col(f"c.{k}") == F.col(f"u.{k}")
        cond = e if cond is None else cond & e
    j = c.join(u, cond, "full_outer")
    hit = F.col("u._u").isNotNull()
    return j.select(
        *[F.when(hit, F.col(f"u.{k}")).otherwise(F.col(f"c.{k}")).alias(k) for k in keys],
        *[F.when(hit, F.col(f"u.{v}")).otherwise(F.col(f"c.{v}")).alias(v) for v in values],
    )


def resume_run_dates(state: DataFrame) -> DataFrame:
    """Per (process, scope): the latest run date with a FAILED, PENDING or
    RUNNING block."""
    return (state.filter(F.col("status").isin(OPEN_STATUSES))
            .groupBy("process_name", "scope").agg(F.max("run_date").alias("run_date")))


def resume_run_date(state: DataFrame, process_name: str, scope: str, today: dt.date,
                    force_new: bool = False) -> dt.date:
    """The run to resume for one process and scope, else ``today``."""
    if force_new:
        return today
    row = resume_run_dates(for_run(state, process_name, scope)).select("run_date").first()
    return row["run_date"] if row and row["run_date"] is not None else today


def ledger_summary(state: DataFrame) -> DataFrame:
    """Per run and status, the number of blocks and the sum of rows."""
    return (state.groupBy(*RUN_KEYS, "status")
            .agg(F.count(F.lit(1)).alias("n_blocks"), F.sum("row_count").cast("long").alias("n_rows")))


def run_result(plan: DataFrame, state: DataFrame) -> DataFrame:
    """Per run, total, ok, failed and pending blocks. A planned block
    with no event, or PENDING or RUNNING, is pending."""
    s = state.select(*BLOCK_KEYS, "status", "row_count").alias("_s")
    j = plan.alias("_p").join(s, _on_block("_p", "_s"), "left").select(
        *[F.col(f"_p.{k}").alias(k) for k in BLOCK_KEYS], F.col("_s.status").alias("status"),
        F.col("_s.row_count").alias("row_count"))
    ok = F.count(F.when(F.col("status") == SUCCESS, 1))
    failed = F.count(F.when(F.col("status") == FAILED, 1))
    total = F.count(F.lit(1))
    out = j.groupBy(*RUN_KEYS).agg(
        total.alias("total_blocks"), ok.alias("ok_blocks"), failed.alias("failed_blocks"),
        (total - ok - failed).alias("pending_blocks"),
        F.coalesce(F.sum(F.when(F.col("status") == SUCCESS, F.col("row_count"))), F.lit(0)).cast("long")
        .alias("rows_loaded"),
    )
    complete = (F.col("failed_blocks") == 0) & (F.col("pending_blocks") == 0)
    return out.withColumn("success", complete).withColumn("needs_retry", ~complete)


def run_metrics(state: DataFrame, elapsed_s: float | None = None) -> DataFrame:
    """Blocks ok, blocks failed and rows loaded, in one aggregation;
    with the run's ``elapsed_s``, also ``rows_per_s`` (0 under a second)."""
    out = state.agg(
        F.count(F.when(F.col("status") == SUCCESS, 1)).alias("ok_blocks"),
        F.count(F.when(F.col("status") == FAILED, 1)).alias("failed_blocks"),
        F.coalesce(F.sum(F.when(F.col("status") == SUCCESS, F.col("row_count"))), F.lit(0)).cast("long")
        .alias("rows_loaded"),
    )
    if elapsed_s is None:
        return out
    rate = F.col("rows_loaded") / F.lit(float(elapsed_s)) if elapsed_s >= 1 else F.lit(0.0)
    return out.withColumn("rows_per_s", rate.cast("double"))
