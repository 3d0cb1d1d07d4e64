"""Flows that chain the operators into loads, and SQL routines."""

from blockload.plans.flows import (assign_blocks, load_direct, load_landed, load_preblocked,
                                   load_preblocked_with_retry, run_load, run_load_with_retry, with_paths,
                                   with_retry)
from blockload.plans.routines import Routine, RoutineResult, register_routine, run_routine

__all__ = ["assign_blocks", "load_direct", "load_landed", "load_preblocked", "load_preblocked_with_retry",
           "run_load", "run_load_with_retry", "with_paths", "with_retry", "Routine", "RoutineResult",
           "register_routine", "run_routine"]
