"""Named, parameterised Spark SQL routines over tables.

Re-aimed from a stored-procedure call in a remote database: the routine is
Spark SQL that runs on the cluster. IN values are bound as named parameters
(``:name``; table names through ``IDENTIFIER(:name)``), never pasted into
the text. OUT values are the columns of a one-row statement; every other
statement gives a result DataFrame, read from the table it was written to.
"""

from __future__ import annotations

import dataclasses
import threading
import time
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession

from blockload.session import new_path


@dataclasses.dataclass(frozen=True)
class Routine:
    name: str
    results: Sequence[str] = ()
    out: str | None = None


@dataclasses.dataclass(frozen=True)
class RoutineResult:
    ok: bool
    return_code: int = 0
    out: Mapping[str, Any] = dataclasses.field(default_factory=dict)
    result_sets: Sequence[DataFrame] = ()
    error: str | None = None
    ms: int = 0


_ROUTINES: dict[str, Routine] = {}


def register_routine(routine: Routine) -> Routine:
    _ROUTINES[routine.name.lower()] = routine
    return routine


def _is_request_error(e: Exception) -> bool:
    """Whether the request itself is wrong, so that no repeat can change it. A
    table that is not there may come."""
    if isinstance(e, AnalysisException):
        return e.getCondition() != "TABLE_OR_VIEW_NOT_FOUND"
    return isinstance(e, (ParseException, ValueError, TypeError, KeyError))


def _sql(spark: SparkSession, text: str, args: Mapping[str, Any], frames: Mapping[str, DataFrame]) -> DataFrame:
    """The statement with Spark's own binding; names it does not use are fine."""
    return spark.sql(text, args=dict(args), **frames)


def _staged(df: DataFrame, path: str, deadline: float | None) -> DataFrame:
    """The result, computed now and kept as a table in the shared work folder.
    A job still running at ``deadline`` is cancelled."""
    spark = df.sparkSession
    tag = path.rsplit("/", 1)[-1]
    timer = None
    if deadline is not None:
        timer = threading.Timer(max(0.0, deadline - time.time()), spark.sparkContext.cancelJobsWithTag, [tag])
        timer.daemon = True
        timer.start()
    spark.sparkContext.addJobTag(tag)
    try:
        df.write.parquet(path)
    finally:
        spark.sparkContext.removeJobTag(tag)
        if timer is not None:
            timer.cancel()
    return spark.read.schema(df.schema).parquet(path)


def run_routine(spark: SparkSession, routine: Routine | str, args: Mapping[str, Any] | None = None, *,
                frames: Mapping[str, DataFrame] | None = None, retries: int = 3, delay_s: float = 2.0,
                timeout_s: float | None = None) -> RoutineResult:
    """Run ``routine`` with ``args``: OUT values first, then every result is
    computed and kept as a table, so ``ok`` means that all of it ran. What
    fails while running is repeated with a linear pause (``delay_s x
    attempt``), return code -1 when every try failed or ``timeout_s`` (of one
    try) ran out in each; a request that Spark cannot analyse raises."""
    r = _ROUTINES[routine.lower()] if isinstance(routine, str) else routine
    args, frames = dict(args or {}), dict(frames or {})
    last, began = "", time.time()
    for attempt in range(max(0, retries) + 1):
        if attempt:
            time.sleep(delay_s * attempt)
        began = time.time()
        deadline = began + timeout_s if timeout_s else None
        try:
            out: dict[str, Any] = {}
            if r.out:
                one = _staged(_sql(spark, r.out, args, frames).limit(2), new_path(spark, "routine"), deadline).collect()
                if len(one) != 1:
                    raise ValueError(f"OUT statement of {r.name} gave {len(one)} rows, not 1")
                out = one[0].asDict()
            sets = [_staged(_sql(spark, t, args, frames), new_path(spark, "routine"), deadline) for t in r.results]
            return RoutineResult(True, int(out.pop("return_code", 0) or 0), out, sets, None, _ms(began))
        except Exception as e:  # noqa: BLE001 - what is not the request's fault may go right next time
            if _is_request_error(e):
                raise
            last = f"{type(e).__name__}: {e}"
    return RoutineResult(False, -1, {}, (), last, _ms(began))


def _ms(began: float) -> int:
    return int((time.time() - began) * 1000)
