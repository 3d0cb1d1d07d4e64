"""Fault injection for tests: blocks whose write raises inside a Spark task."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Mapping

from pyspark.sql import functions as F

from blockload.plans import flows


@contextlib.contextmanager
def failing_blocks(tries: Mapping[int, int]) -> Iterator[None]:
    """While this holds, the first ``tries[b]`` writes of block b raise."""
    left, plain = dict(tries), flows.load_blocks

    def load_blocks(blocks, block_ids, *args, **kwargs):
        bad = [b for b in block_ids if left.get(b, 0) > 0]
        for b in bad:
            left[b] -= 1
        if bad:
            message = F.concat(F.lit("injected failure in block "), F.col(flows.BLOCK_COL).cast("string"))
            blocks = blocks.filter(F.when(F.col(flows.BLOCK_COL).isin(bad), F.raise_error(message)).isNull())
        return plain(blocks, block_ids, *args, **kwargs)

    flows.load_blocks = load_blocks
    try:
        yield
    finally:
        flows.load_blocks = plain
