"""Settings of a load and the result of a run.

Only the driver holds these: numbers, names and paths. Rows never pass
through here.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Mapping, Sequence

# Block states, flows and the default settings of a load.
PENDING = "PENDING"
RUNNING = "RUNNING"
SUCCESS = "SUCCESS"
FAILED = "FAILED"
STATUSES = (PENDING, RUNNING, SUCCESS, FAILED)
DIRECT = "DIRECT"
LANDING = "LANDING"
PREBLOCKED = "PREBLOCKED"
DEFAULT_EXCLUDE = ("Id",)
DEFAULT_BLOCK_SIZE = 500_000
DEFAULT_THRESHOLD = 50_000_000
DEFAULT_MAX_CONNECTIONS = 6
DEFAULT_WAVE_SIZE = 50
DEFAULT_WAVES_IN_FLIGHT = 2
DEFAULT_LEASE_S = 300.0
DEFAULT_MAX_RETRIES = 3
DEFAULT_BLOCK_RETRIES = 2
DEFAULT_QUERY_TIMEOUT_S = 1_800
ERROR_MAX_CHARS = 500

BLOCK_COL = "_block"
RUN_COL = "_run"
ATTEMPT_COL = "_attempt"
POSITION_COLS = ("_p", "_rid")
# Names that a landing or a target adds to the rows; no source column may have one.
RESERVED_COLS = (BLOCK_COL, RUN_COL, ATTEMPT_COL, *POSITION_COLS)


@dataclasses.dataclass(frozen=True)
class LoadConfig:
    """What to load, where, and how to split it.

    ``blocks_on`` chooses how rows get a block: ``"keys"`` (NTILE over the
    distinct values of ``block_key``; all rows of a key share a block),
    ``"rows"`` (NTILE over all rows in ``order_cols`` order) or ``"even"``
    (about equal blocks, no key). With no ``block_key`` the default is even.
    """

    target: str = ""
    target_format: str = "parquet"  # "parquet" (a path) or "jdbc"
    jdbc_options: Mapping[str, str] = dataclasses.field(default_factory=dict)
    exclude_columns: Sequence[str] = DEFAULT_EXCLUDE
    block_size: int = DEFAULT_BLOCK_SIZE
    threshold: int = DEFAULT_THRESHOLD
    force_landing: bool | None = None
    block_key: str = ""
    blocks_on: str = ""
    order_cols: Sequence[str] = ()
    landing_path: str = ""
    chunk_rows: int = 0
    max_connections: int = DEFAULT_MAX_CONNECTIONS
    wave_size: int = DEFAULT_WAVE_SIZE
    # Rows that a wave is filled up to, instead of wave_size blocks; 0: not.
    wave_rows: int = 0
    waves_in_flight: int = DEFAULT_WAVES_IN_FLIGHT
    # Seconds that one try of a wave may take; 0: no limit.
    wave_timeout_s: float = 0.0
    # Seconds after which a lease that is not renewed can be taken over.
    lease_s: float = DEFAULT_LEASE_S
    ledger_path: str = ""
    process_name: str = ""
    scope: str = ""
    force_new_run: bool = False
    max_retries: int = DEFAULT_MAX_RETRIES
    block_retries: int = DEFAULT_BLOCK_RETRIES
    retry_delay_s: float = 5.0
    max_retry_delay_s: float = 30.0
    query_timeout_s: int = DEFAULT_QUERY_TIMEOUT_S
    # A date given here is the only one loaded or resumed; without one the
    # latest open run of process and scope is resumed, or today's is begun.
    run_date: dt.date | None = None
    # Digits of a second that the target keeps: 3 cuts timestamps to
    # milliseconds, 6 keeps them. None is 3 for JDBC and 6 for Parquet.
    timestamp_scale: int | None = None
    # Keep rows out of the target that hold a value longer than its type (4000
    # characters, 8000 bytes): they go to a reject table in the same pass, for
    # Parquet beside the target's blocks, for JDBC to ``rejects_path``.
    rejects_too_long: bool = False
    rejects_path: str = ""
    # JDBC only, for a table that cannot take the run, block and attempt
    # columns: rows are appended as they are, at least once.
    plain_append: bool = False

    @property
    def cuts_to_millis(self) -> bool:
        scale = self.timestamp_scale if self.timestamp_scale is not None else (3 if self.target_format == "jdbc" else 6)
        if scale not in (3, 6):
            raise ValueError(f"timestamp_scale must be 3 or 6, not {scale!r}")
        return scale == 3

    @property
    def uses_ledger(self) -> bool:
        return bool(self.ledger_path)

    def replace(self, **changes) -> "LoadConfig":
        return dataclasses.replace(self, **changes)


@dataclasses.dataclass(frozen=True)
class RunResult:
    """Outcome of one pass over a run, counted from the ledger. A pass that
    raised before it had a run holds no block and only its error."""

    success: bool
    total_blocks: int
    ok_blocks: int
    failed_blocks: int
    pending_blocks: int
    rows_loaded: int = 0
    error: str | None = None
    run_date: dt.date | None = None
    process_name: str = ""
    scope: str = ""
    elapsed_s: float = 0.0
    landing: str | None = None
    dropped_columns: tuple[str, ...] = ()
    rows_rejected: int = 0

    @property
    def is_complete(self) -> bool:
        """Every planned block of the run is in the target."""
        return self.success and self.ok_blocks == self.total_blocks

    @property
    def needs_retry(self) -> bool:
        return not self.is_complete

    @property
    def is_hopeless(self) -> bool:
        """Every block of the run was tried and failed: repeating will not help."""
        return 0 < self.failed_blocks == self.total_blocks

    @property
    def rows_per_s(self) -> float:
        return self.rows_loaded / self.elapsed_s if self.elapsed_s >= 1 else 0.0

    def summary(self) -> str:
        """One line for a log."""
        parts = [f"{self.process_name}/{self.scope} {self.run_date}: {self.ok_blocks} of {self.total_blocks} blocks",
                 f"{self.rows_loaded} rows in {self.elapsed_s:.0f} s"]
        if self.failed_blocks or self.pending_blocks:
            parts.append(f"{self.failed_blocks} failed and {self.pending_blocks} not tried")
        if self.rows_rejected:
            parts.append(f"{self.rows_rejected} rows with too long values rejected")
        if self.dropped_columns:
            parts.append(f"without columns {', '.join(self.dropped_columns)}")
        return "; ".join(parts + ([self.error] if self.error else []))
