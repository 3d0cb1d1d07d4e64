"""Sources and sinks: read a source, the landing, the target."""

from blockload.sources.landing import (find_landing, landing_plan, landing_state, read_landing, scan_blocks,
                                       write_landing, write_row_landing)
from blockload.sources.read import read_source
from blockload.sources.target import load_blocks, target_view

__all__ = ["read_source", "write_landing", "landing_plan", "find_landing", "read_landing",
           "landing_state", "scan_blocks", "write_row_landing", "load_blocks", "target_view"]
