"""blockload: load large Spark tables into a target in numbered blocks, with
a ledger that makes a failed load resumable without lost or repeated rows."""

from blockload.config import LoadConfig, RunResult
from blockload.plans import load_direct, load_landed, load_preblocked, run_load, run_load_with_retry, with_retry

__all__ = ["LoadConfig", "RunResult", "load_direct", "load_landed", "load_preblocked", "run_load",
           "run_load_with_retry", "with_retry"]
