"""Load flows: direct (O30), landed (O31), pre-blocked (O32), the choice
between them (O33) and the retry loop (O34).

The driver decides and loops over block numbers; every row moves inside
Spark jobs. A run is recorded before its first block is tried (flow, block
count, row count, landing), and later calls follow that record until every
block is SUCCESS; a complete run is never taken up again. A wave of blocks is
one job. If it fails, its blocks are tried again in one job and split while
that fails, so a bad block does not fail its neighbours. Where waves are small
and go well, several share a job, so that the number of jobs follows the rows
and not the number of waves. Order of events for
a block: RUNNING, write, count, then SUCCESS or FAILED. A crash between the
write and the count leaves RUNNING, which is pending and is repeated safely,
since a repeat replaces the block.
"""

from __future__ import annotations

import collections
import dataclasses
import datetime as dt
import threading
import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockload.config import BLOCK_COL, DIRECT, FAILED, LANDING, PREBLOCKED, RUNNING, SUCCESS, LoadConfig, RunResult
from blockload.functions.columns import check_block_column, check_request, exclude_columns, resolve_columns
from blockload.operators import ledger as L
from blockload.operators.blocks import (block_plan, blocks_by_key, blocks_by_row, blocks_even, range_partitions,
                                        row_digest, waves_by_size)
from blockload.operators.lease import leased
from blockload.session import new_path
from blockload.sources.landing import (block_sizes, find_landing, landing_plan, read_landing, write_landing,
                                       write_row_landing)
from blockload.sources.read import read_source
from blockload.sources.target import encoded, load_blocks, reject_view, run_key

_RESULT_SCHEMA = T.StructType([
    T.StructField("block_id", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("error_message", T.StringType()),
])


def _names(cfg: LoadConfig) -> tuple[str, str]:
    return cfg.process_name or "load", cfg.scope or "all"


def _today(cfg: LoadConfig) -> dt.date:
    return cfg.run_date or dt.date.today()


def _pause(seconds: float) -> None:
    time.sleep(seconds)


def with_paths(spark: SparkSession, cfg: LoadConfig) -> LoadConfig:
    """Fill in a run-private ledger and landing folder under the shared work
    folder when the caller named none, so that retries share them."""
    changes = {}
    if not cfg.ledger_path:  # a private ledger: nobody else writes to it
        changes["ledger_path"] = new_path(spark, "ledger")
        changes["process_name"], changes["scope"] = _names(cfg)
    if not cfg.landing_path:
        changes["landing_path"] = new_path(spark, "landing")
    return cfg.replace(**changes) if changes else cfg


# --- the run that a call follows ------------------------------------------------

def _open_run(spark: SparkSession, cfg: LoadConfig) -> tuple[Row | None, dt.date]:
    """The unfinished run that this call resumes, if there is one, and the date
    of the run that it works on.

    With ``cfg.run_date`` only that date counts, else the latest unfinished
    run of process and scope, else today. A date whose run is complete takes
    no second load: that raises, since it would look like a success.
    """
    p, s = _names(cfg)
    L.ensure_ledger(spark, cfg.ledger_path)
    state = L.for_run(L.ledger_state(L.read_ledger(spark, cfg.ledger_path)), p, s)
    runs = L.with_progress(L.for_run(L.read_runs(spark, cfg.ledger_path), p, s, cfg.run_date), state)
    day = cfg.run_date or dt.date.today()
    if not cfg.force_new_run:
        run = runs.filter("ok_blocks < n_blocks").orderBy(F.desc("run_date")).first()
        if run is not None:
            return run, run["run_date"]
    if runs.filter(F.col("run_date") == F.lit(day)).limit(1).count():
        raise ValueError(f"the ledger already holds a run of {p}/{s} on {day}; "
                         "give another run_date, process or scope to load again")
    if L.for_run(state, p, s, day).limit(1).count():
        raise ValueError(f"the ledger has blocks of {p}/{s} on {day} but no record of their run; "
                         "start a new run (another run_date, process or scope)")
    return None, day


def _follow(run: Row | None, flow: str) -> None:
    if run is not None and run["flow"] != flow:
        raise ValueError(f"the open run of {run['process_name']}/{run['scope']} on {run['run_date']} is a "
                         f"{run['flow']} load; finish it as such, or start another run")


def _check_target(cfg: LoadConfig) -> None:
    if not cfg.target:
        raise ValueError("a target is required")
    if cfg.target_format not in ("parquet", "jdbc"):
        raise ValueError(f"target_format must be parquet or jdbc, not {cfg.target_format!r}")


# --- one pass over the pending blocks of a run --------------------------------

Blocks = Callable[[list[int]], DataFrame]
JOB_ROWS = 5_000_000    # rows up to which waves share a job
JOB_BLOCKS = 1_000      # and their blocks: literals of the read, folders of the write


class _TimeLimit:
    """Cancels the Spark jobs that this thread begins inside, once the limit
    (seconds, 0: none) has passed."""

    def __init__(self, spark: SparkSession, seconds: float) -> None:
        self.sc, self.seconds, self.passed = spark.sparkContext, seconds, False
        self.tag = f"blockload-{uuid.uuid4().hex}"

    def _cancel(self) -> None:
        self.passed = True
        while not self.over.wait(0.2):   # a job that begins later is cancelled too
            self.sc.cancelJobsWithTag(self.tag)

    def __enter__(self) -> None:
        self.over = threading.Event()
        self.timer = threading.Timer(self.seconds, self._cancel) if self.seconds > 0 else None
        if self.timer:
            self.sc.setLocalProperty("spark.job.interruptOnCancel", "true")
            self.sc.addJobTag(self.tag)
            self.timer.daemon = True
            self.timer.start()

    def __exit__(self, *_) -> None:
        self.over.set()
        if self.timer:
            self.timer.cancel()
            self.sc.removeJobTag(self.tag)


class _Pass:
    """The pending blocks of one run, loaded wave by wave.

    ``blocks(ids)`` gives the rows of those blocks (with ``_block``),
    ``expected(ids)`` their row counts.
    """

    def __init__(self, spark: SparkSession, cfg: LoadConfig, run_date: dt.date, n_blocks: int, blocks: Blocks,
                 expected: Blocks) -> None:
        self.spark, self.cfg, self.run_date, self.blocks, self.expected = spark, cfg, run_date, blocks, expected
        self.writing = threading.Lock()   # appends to the ledger, one at a time
        self.taking = threading.Lock()    # the next job's waves
        self.names = _names(cfg)
        self.plan = L.run_plan(spark, *self.names, run_date, n_blocks)
        self.attempts: dict[int, int] = {}
        self.loaded = 0

    def state(self) -> DataFrame:
        return L.for_run(L.ledger_state(L.read_ledger(self.spark, self.cfg.ledger_path)), *self.names, self.run_date)

    def record(self, rows: list[tuple]) -> None:
        frame = self.spark.createDataFrame(rows, _RESULT_SCHEMA)
        with self.writing:
            self.lease.check()
            L.ledger_record(self.spark, self.cfg.ledger_path, L.block_events(
                frame, *self.names, self.run_date, F.col("status"), F.col("attempt"), F.col("row_count"),
                F.col("error_message"), self.lease.fence))

    def attempt(self, ids: list[int]) -> list[int]:
        """One job over ``ids``; returns those that failed."""
        for b in ids:
            self.attempts[b] += 1
        tries = {b: self.attempts[b] for b in ids}
        self.record([(b, RUNNING, 0, tries[b], None) for b in ids])
        limit = _TimeLimit(self.spark, self.cfg.wave_timeout_s)
        try:
            with limit:
                written = load_blocks(self.blocks(ids), ids, self.cfg, run_key(*self.names, self.run_date), tries)
                kept = F.coalesce(F.sum(F.when(F.col("block_id") > 0, F.col("n_rows"))), F.lit(0))
                written = written.groupBy(F.abs("block_id").alias("_b")).agg(F.sum("n_rows").alias("_w"), kept.alias("_ok"))
                counts = (self.expected(ids).join(written, F.col("block_id") == F.col("_b"), "left")
                          .select("block_id", "n_rows", F.coalesce("_w", F.lit(0)).alias("_w"),
                                  F.coalesce("_ok", F.lit(0)).alias("_ok")).collect())
        except Exception as e:  # noqa: BLE001 - the job failed: every block of it is FAILED
            text = f"cancelled after {self.cfg.wave_timeout_s:g} s" if limit.passed else f"{type(e).__name__}: {e}"
            self.record([(b, FAILED, 0, tries[b], text) for b in ids])
            return list(ids)
        got = {r["block_id"]: (r["n_rows"], r["_w"], r["_ok"]) for r in counts}
        rows = []
        for b in ids:
            want, wrote, loaded = got.get(b, (0, 0, 0))    # rejected rows were written too, beside the target
            text = None if want == wrote else f"wrote {wrote} rows, expected {want}"
            rows.append((b, FAILED if text else SUCCESS, int(loaded), tries[b], text))
        self.record(rows)
        with self.writing:
            self.loaded += sum(1 for r in rows if r[1] == SUCCESS)
        return [r[0] for r in rows if r[1] == FAILED]

    def isolate(self, ids: list[int]) -> list[int]:
        """Try ``ids`` in one job, and what fails of several in halves."""
        failed = self.attempt(ids)
        if len(failed) < 2:
            return failed if len(ids) == 1 else [b for b in failed if self.attempt([b])]
        half = len(failed) // 2
        return self.isolate(failed[:half]) + self.isolate(failed[half:])

    def wave(self, ids: list[int], retry: bool) -> list[int]:
        """Load a wave; with ``retry``, one linear pause before each round of
        repeats. Returns the blocks that failed."""
        failed = self.attempt(ids)
        for k in range(1, max(self.cfg.block_retries, len(ids) > 1) + 1):
            if not failed or (not retry and len(failed) == len(ids)):
                break
            _pause(self.cfg.retry_delay_s * k)
            failed = self.isolate(failed)
        return failed

    def packed(self, ids: list[int]) -> list[list[int]]:
        """The waves: by rows, or by number of blocks."""
        if self.cfg.wave_rows > 0 and ids:
            placed = waves_by_size(self.expected(ids), self.cfg.wave_rows).select("wave_no", "block_id").collect()
            found: dict[int, list[int]] = {}
            for wave, block in sorted(map(tuple, placed)):
                found.setdefault(wave, []).append(block)
            return list(found.values())
        size = max(1, self.cfg.wave_size)
        return [ids[i:i + size] for i in range(0, len(ids), size)]

    def shares_jobs(self) -> bool:
        """Whether waves may share a job: not where the caller sized them by rows
        or limited their time, nor for JDBC, where a failed job leaves rows behind."""
        return self.cfg.target_format == "parquet" and self.cfg.wave_rows <= 0 and self.cfg.wave_timeout_s <= 0

    def take(self) -> list[list[int]]:
        """The waves of the next job: as many as the last jobs' outcome allows, up
        to ``JOB_ROWS`` and ``JOB_BLOCKS``; none once all are taken."""
        with self.taking:
            job, rows, blocks = [], 0, 0
            while self.waves and len(job) < self.together:
                rows += sum(self.sizes.get(b, 0) for b in self.waves[0])
                blocks += len(self.waves[0])
                if job and (rows > JOB_ROWS or blocks > JOB_BLOCKS):
                    break
                job.append(self.waves.popleft())
            return job

    def job(self, waves: list[list[int]], retry: bool) -> list[int]:
        """Load waves in one job; if that fails, in halves down to single waves.
        Returns the blocks that failed."""
        if len(waves) == 1:
            return self.wave(waves[0], retry)
        failed = set(self.attempt([b for ids in waves for b in ids]))
        left = [ids for ids in ([b for b in ids if b in failed] for ids in waves) if ids]
        half = max(1, len(left) // 2)
        return [b for part in (left[:half], left[half:]) if part for b in self.job(part, retry)]

    def load(self, t0: float, **known) -> RunResult:
        with leased(self.spark, self.cfg.ledger_path, *self.names, self.cfg.lease_s) as self.lease:
            return self.load_leased(t0, **known)

    def load_leased(self, t0: float, **known) -> RunResult:
        L.ledger_record(self.spark, self.cfg.ledger_path, L.ledger_init(self.plan, self.state()))
        state = self.state()
        pending = L.pending_blocks(self.plan, state).join(state.select("block_id", "attempt"), "block_id", "left")
        todo = sorted((r["block_id"], r["attempt"] or 0) for r in pending.select("block_id", "attempt").collect())
        self.attempts = dict(todo)  # block numbers only, never rows
        self.loaded = L.completed_blocks(state).count()
        self.hopeful = True  # until a wave failed whole and nothing of the run is loaded

        self.waves = collections.deque(self.packed([b for b, _ in todo]))
        self.together, self.sizes = 1, {}  # waves that the next job takes, rows of the blocks
        in_flight = max(1, self.cfg.waves_in_flight)
        shares = self.shares_jobs() and len(self.waves) > in_flight
        if shares:
            self.sizes = {r["block_id"]: r["n_rows"] for r in self.expected([b for b, _ in todo]).collect()}

        def work() -> None:
            try:
                while waves := self.take():
                    failed = self.job(waves, self.hopeful)  # every block is tried; without hope once
                    self.hopeful = self.loaded > 0 or (self.hopeful and len(failed) < sum(map(len, waves)))
                    if shares:
                        with self.taking:
                            self.together = 1 if failed else max(self.together, 2 * len(waves))
            except BaseException:
                self.waves.clear()   # after a lost lease nothing more begins
                raise

        # Jobs run some at once: one fills what another's last tasks leave idle.
        # Each thread keeps the session's properties.
        with ThreadPoolExecutor(in_flight) as pool:
            for running in [pool.submit(inheritable_thread_target(work)) for _ in range(in_flight)]:
                running.result()
        return self.result(t0, **known)

    def result(self, t0: float, **known) -> RunResult:
        final = self.state()
        row = L.run_result(self.plan, final).first()
        error = None
        if row["failed_blocks"]:
            first = (final.filter(F.col("status") == FAILED).orderBy("block_id")
                     .select(F.concat(F.lit("block "), F.col("block_id").cast("string"), F.lit(": "),
                                      F.coalesce("error_message", F.lit("?")))).first())
            error = first[0] if first else None
        p, s = self.names
        rejected = 0
        if self.cfg.rejects_too_long and row["ok_blocks"]:
            rejected = reject_view(self.spark, self.cfg, final).count()
        return RunResult(
            success=row["success"], total_blocks=row["total_blocks"], ok_blocks=row["ok_blocks"],
            failed_blocks=row["failed_blocks"], pending_blocks=row["pending_blocks"], rows_loaded=row["rows_loaded"],
            rows_rejected=rejected, error=error, run_date=self.run_date, process_name=p, scope=s, elapsed_s=time.time() - t0, **known)


def _dropped(df: DataFrame, src: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in df.columns if c not in src.columns)


# --- O30 ----------------------------------------------------------------------

def load_direct(df: DataFrame, cfg: LoadConfig, total_rows: int | None = None) -> RunResult:
    """No landing; the whole load is one block, written and counted
    under the same rules as any block, so a repeat cannot duplicate rows. A
    resumed direct load writes its current input: nothing of it was loaded."""
    spark = df.sparkSession
    _check_target(cfg)
    check_request(loads=df)
    src = exclude_columns(df, cfg.exclude_columns)
    cfg = with_paths(spark, cfg)
    with leased(spark, cfg.ledger_path, *_names(cfg), cfg.lease_s):
        return _direct(df, src, cfg, total_rows)


def _direct(df: DataFrame, src: DataFrame, cfg: LoadConfig, total_rows: int | None) -> RunResult:
    spark = df.sparkSession
    t0 = time.time()
    run, run_date = _open_run(spark, cfg)
    _follow(run, DIRECT)
    n = src.count() if total_rows is None else int(total_rows)
    if run is None:
        L.begin_run(spark, cfg.ledger_path, *_names(cfg), run_date, DIRECT, 1, n, None)
    one = src.withColumn(BLOCK_COL, F.lit(1))

    def expected(ids: list[int]) -> DataFrame:
        return spark.createDataFrame([(1, n)], "block_id INT, n_rows BIGINT")

    return _Pass(spark, cfg, run_date, 1, lambda ids: one, expected).load(t0, dropped_columns=_dropped(df, src))


# --- O31 ----------------------------------------------------------------------

def _blocks_on(cfg: LoadConfig) -> str:
    how = cfg.blocks_on or ("keys" if cfg.block_key else "even")
    if how not in ("keys", "rows", "even"):
        raise ValueError(f"blocks_on must be keys, rows or even, not {how!r}")
    return how


_UNSORTED = (T.MapType, T.VariantType)


def _row_order(df: DataFrame, cfg: LoadConfig) -> list[str]:
    order = list(cfg.order_cols) or ([cfg.block_key] if cfg.block_key else [])
    if not order:
        raise ValueError("blocks_on='rows' needs order_cols")
    first = resolve_columns(df, order).fieldNames()
    # The other sortable columns break ties, so that a hot first value spreads.
    ties = [f.name for f in df.schema.fields if f.name not in first and not isinstance(f.dataType, _UNSORTED)]
    return first + ties


def assign_blocks(df: DataFrame, cfg: LoadConfig, n_blocks: int) -> tuple[DataFrame, bool, str]:
    """Blocks by key, by row or even, per ``cfg``: (frame, needs clustering
    before the landing write, how)."""
    how = _blocks_on(cfg)
    if how == "keys":
        if not cfg.block_key:
            raise ValueError("blocks_on='keys' needs block_key")
        key = resolve_columns(df, [cfg.block_key]).fieldNames()[0]
        return blocks_by_key(df, key, n_blocks), True, how
    if how == "rows":
        return blocks_by_row(df, _row_order(df, cfg), n_blocks), False, how
    return blocks_even(df, n_blocks), False, how


def _new_landing(src: DataFrame, cfg: LoadConfig, run_date: dt.date, total_rows: int, n_blocks: int) -> str:
    """The input's blocks in the next free landing folder of the run."""
    spark = src.sparkSession
    p, s = _names(cfg)
    root = f"{cfg.landing_path.rstrip('/')}/p-{encoded(p)}/s-{encoded(s)}/{run_date.isoformat()}"
    _, path = find_landing(spark, root)
    if _blocks_on(cfg) == "rows":  # written once, in the layout of its positions
        write_row_landing(src, _row_order(src, cfg), path, n_blocks, num_partitions=range_partitions(spark, total_rows))
    else:
        blocked, cluster, how = assign_blocks(src, cfg, n_blocks)
        write_landing(blocked, path, n_blocks, blocks_on=how, cluster=cluster)
    return path


def load_landed(df: DataFrame, cfg: LoadConfig, total_rows: int, n_blocks: int) -> RunResult:
    """Blocks, landing, ledger, waves. The landing must hold as many rows
    as were counted in the input, else nothing is loaded. A resumed run reads
    its own landing, with the block count it was written with."""
    spark = df.sparkSession
    _check_target(cfg)
    check_request(loads=df)
    src = exclude_columns(df, cfg.exclude_columns)
    cfg = with_paths(spark, cfg)
    with leased(spark, cfg.ledger_path, *_names(cfg), cfg.lease_s):
        return _landed(df, src, cfg, total_rows, n_blocks)


def _landed(df: DataFrame, src: DataFrame, cfg: LoadConfig, total_rows: int, n_blocks: int) -> RunResult:
    spark = df.sparkSession
    t0 = time.time()
    run, run_date = _open_run(spark, cfg)
    _follow(run, LANDING)
    if run is None:
        landing = _new_landing(src, cfg, run_date, total_rows, n_blocks)
        landed = landing_plan(spark, landing)["total_rows"]
        if landed != total_rows:
            raise RuntimeError(f"the landing {landing} holds {landed} rows, the input was counted as {total_rows}: "
                               "it changed in between")
        L.begin_run(spark, cfg.ledger_path, *_names(cfg), run_date, LANDING, n_blocks, total_rows, landing)
    else:
        landing = run["landing"]
    plan = landing_plan(spark, landing)
    if plan is None:
        # New blocks from the current input would not match the blocks
        # already loaded: rows would be lost or loaded twice.
        raise ValueError(f"the open run of {run_date} has no complete landing at {landing}; "
                         "start a new run (another run_date, process or scope)")

    def blocks(ids: list[int]) -> DataFrame:
        return read_landing(spark, landing, ids, plan=plan)

    def expected(ids: list[int]) -> DataFrame:
        return block_sizes(spark, landing, ids, plan=plan)

    return _Pass(spark, cfg, run_date, plan["n_blocks"], blocks, expected).load(
        t0, landing=landing, dropped_columns=_dropped(df, src))


# --- O32 ----------------------------------------------------------------------

def load_preblocked(spark: SparkSession, source: str, n_blocks: int, block_col: str, columns: Sequence[str],
                    cfg: LoadConfig, fmt: str | None = None) -> RunResult:
    """The source already has a block column with blocks 1..n; each wave
    reads only its blocks (a literal IN list on that column)."""
    check_request(path=source, n_blocks=n_blocks, columns=columns, uses_ledger=cfg.uses_ledger,
                  process_name=cfg.process_name, scope=cfg.scope)
    _check_target(cfg)
    cfg = with_paths(spark, cfg)
    with leased(spark, cfg.ledger_path, *_names(cfg), cfg.lease_s):
        return _preblocked(spark, source, n_blocks, block_col, columns, cfg, fmt)


def _preblocked(spark: SparkSession, source: str, n_blocks: int, block_col: str, columns: Sequence[str],
                cfg: LoadConfig, fmt: str | None) -> RunResult:
    t0 = time.time()
    df = read_source(spark, source, fmt)
    bc = check_block_column(df.schema, block_col)
    cols = [c for c in columns if c.lower() != bc.lower()]
    check_request(columns=cols)
    fields = resolve_columns(df, cols).fieldNames()
    check_request(loads=df.select(*fields))
    run, run_date = _open_run(spark, cfg)
    _follow(run, PREBLOCKED)
    if run is not None and run["n_blocks"] != n_blocks:
        raise ValueError(f"the open run of {run_date} has {run['n_blocks']} blocks, not {n_blocks}")
    counts = _preblocked_counts(df, bc, n_blocks, fields)
    if run is None:
        # The counts and digests stay with the run: a later pass must find the same.
        kept = new_path(spark, "counts", below=f"{cfg.ledger_path}/_counts")
        counts.coalesce(1).write.parquet(kept)
        total = counts.agg(F.sum("n_rows")).first()[0] or 0
        L.begin_run(spark, cfg.ledger_path, *_names(cfg), run_date, PREBLOCKED, n_blocks, total, kept)
    elif run["landing"]:
        _same_source(spark.read.schema(counts.schema).parquet(run["landing"]), counts, run_date)
    kind = df.schema[bc].dataType

    def blocks(ids: list[int]) -> DataFrame:
        # Literals of the column's own type, so the filter reaches the source.
        part = df.filter(F.col(bc).isin([F.lit(b).cast(kind) for b in ids]))
        return part.select(*fields, F.col(bc).cast("int").alias(BLOCK_COL)).hint("rebalance", BLOCK_COL)

    def expected(ids: list[int]) -> DataFrame:
        want = spark.createDataFrame([(int(b),) for b in ids], "block_id INT")
        return want.join(counts, "block_id", "left").select(
            "block_id", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"))

    return _Pass(spark, cfg, run_date, n_blocks, blocks, expected).load(t0)


def _preblocked_counts(df: DataFrame, block_col: str, n_blocks: int, columns: Sequence[str]) -> DataFrame:
    """Rows per block and a digest of their values that no order changes, from
    one pass over the source, kept as a table. Rows with no block, or one that
    is not 1 to n, would be left out by every wave, so they raise before
    anything is loaded."""
    spark = df.sparkSession
    number = F.expr("try_cast(b AS INT)")

    def counted(digest: Column) -> DataFrame:
        counts = (df.groupBy(F.col(block_col).alias("b")).agg(F.count(F.lit(1)).alias("n_rows"), digest.alias("digest"))
                  .withColumn("block_id", number)
                  .withColumn("fits", F.coalesce(F.col("block_id").between(1, n_blocks)
                                                 & (F.col("block_id").cast(df.schema[block_col].dataType) == F.col("b")),
                                                 F.lit(False))))
        path = new_path(spark, "block-counts")
        counts.select("block_id", "n_rows", "digest", "fits").write.parquet(path)
        return spark.read.parquet(path)

    try:
        kept = counted(row_digest(df, columns))
    except Exception:  # noqa: BLE001 - a row that cannot be read fails its block, not the run: counts alone
        kept = counted(F.max(F.lit(None).cast("decimal(38,0)")))
    outside = kept.filter("NOT fits").agg(F.sum("n_rows")).first()[0]
    if outside:
        raise ValueError(f"{outside} rows have no block from 1 to {n_blocks} in {block_col}")
    return kept.select("block_id", "n_rows", "digest")


def _same_source(then: DataFrame, now: DataFrame, run_date: dt.date) -> None:
    """Blocks of one run must be of one state of the source."""
    both = then.alias("t").join(now.alias("n"), "block_id", "full_outer").where(
        ~F.col("t.n_rows").eqNullSafe(F.col("n.n_rows")) | (F.col("t.digest") != F.col("n.digest")))
    found = both.agg(F.count(F.lit(1)).alias("n"), F.min("block_id").alias("first")).first()
    if found["n"]:
        raise ValueError(f"the source changed since the run of {run_date} began: {found['n']} blocks differ, the first "
                         f"is block {found['first']}; start a new run (another run_date, process or scope)")


# --- O33, O34 -----------------------------------------------------------------

def run_load(df: DataFrame, cfg: LoadConfig) -> RunResult:
    """An open run is finished as it was begun; else count, plan, then
    DIRECT or LANDING."""
    check_request(uses_ledger=cfg.uses_ledger, process_name=cfg.process_name, scope=cfg.scope, loads=df)
    _check_target(cfg)
    cfg = with_paths(df.sparkSession, cfg)
    with leased(df.sparkSession, cfg.ledger_path, *_names(cfg), cfg.lease_s):
        return _chosen(df, cfg)


def _chosen(df: DataFrame, cfg: LoadConfig) -> RunResult:
    run, _ = _open_run(df.sparkSession, cfg)
    if run is not None and run["flow"] != DIRECT:
        return load_landed(df, cfg, run["total_rows"], run["n_blocks"])
    plan = block_plan(df, cfg.block_size, cfg.threshold, cfg.force_landing).first()
    if run is not None or plan["flow"] == DIRECT:
        return load_direct(df, cfg, plan["total_rows"])
    return load_landed(df, cfg, plan["total_rows"], plan["n_blocks"])


def _one_pass(run: Callable[[LoadConfig], RunResult], cfg: LoadConfig, before: RunResult | None) -> RunResult:
    """A pass, or what is known of the run when the pass itself raised. An
    invalid request raises here too."""
    try:
        return run(cfg)
    except (ValueError, TypeError):
        raise
    except Exception as e:  # noqa: BLE001 - an unfinished pass, to be repeated like any other
        text = f"{type(e).__name__}: {e}"
        known = before or RunResult(False, 0, 0, 0, 0, process_name=cfg.process_name, scope=cfg.scope)
        return dataclasses.replace(known, success=False, error=text)


def with_retry(run: Callable[[LoadConfig], RunResult], cfg: LoadConfig) -> RunResult:
    """Passes over one run until no block of it is unfinished, at most
    ``max_retries`` after the first, each after a pause that grows with its
    number up to ``max_retry_delay_s``. The ledger tells each pass what is
    left. A run of which nothing could be loaded is given up."""
    outcome = _one_pass(run, cfg, None)
    for k in range(1, max(0, cfg.max_retries) + 1):
        if outcome.is_complete or outcome.is_hopeless:
            break
        _pause(min(cfg.max_retry_delay_s, cfg.retry_delay_s * k))
        outcome = _one_pass(run, cfg.replace(force_new_run=False), outcome)
    return outcome


def run_load_with_retry(df: DataFrame, cfg: LoadConfig) -> RunResult:
    cfg = with_paths(df.sparkSession, cfg)
    return with_retry(lambda c: run_load(df, c), cfg)


def load_preblocked_with_retry(spark: SparkSession, source: str, n_blocks: int, block_col: str,
                               columns: Sequence[str], cfg: LoadConfig, fmt: str | None = None) -> RunResult:
    cfg = with_paths(spark, cfg)
    return with_retry(lambda c: load_preblocked(spark, source, n_blocks, block_col, columns, c, fmt), cfg)
