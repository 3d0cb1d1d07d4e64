"""Relational operators: block assignment and the ledger."""

from blockload.operators.blocks import (attach_blocks, block_plan, block_results, blocks_by_key, blocks_by_row,
                                        blocks_even, chunk_rows, distinct_keys, key_blocks, ntile_of,
                                        row_positions, waves)
from blockload.operators.ledger import (completed_blocks, ledger_init, ledger_merge, ledger_record,
                                        ledger_state, ledger_summary, pending_blocks, plan_blocks,
                                        resume_run_date, resume_run_dates, run_metrics, run_result)

__all__ = ["attach_blocks", "block_plan", "block_results", "blocks_by_key", "blocks_by_row", "blocks_even",
           "chunk_rows", "distinct_keys", "key_blocks", "ntile_of", "row_positions", "waves",
           "completed_blocks", "ledger_init", "ledger_merge", "ledger_record", "ledger_state",
           "ledger_summary", "pending_blocks", "plan_blocks", "resume_run_date", "resume_run_dates",
           "run_metrics", "run_result"]
