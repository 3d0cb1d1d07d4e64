"""Connected components by alternating stars, for the operators on links.

Each round rewires every node's larger neighbours to its smallest one (large
star), then every node with its smaller neighbours to the smallest (small
star), until the links are stars around the smallest node of each component.
Rounds are logarithmic in practice. Each round is a table in the shared work
folder, so lineage ends there; the driver sees two numbers a round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockload.llm.runtime import ship, staged, tidy, unstage

LINKS = "a long, b long"
FOLD_ROWS = 500_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (least member, member) of the components of the links given."""
    nodes, ids = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = np.arange(len(nodes))
    x, y = ids[:len(a)], ids[len(a):]
    while True:
        least = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], least)
        np.minimum.at(new, label[y], least)
        new = new[new]
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            break
        label = new[label]
    far = label != np.arange(len(nodes))
    return nodes[label[far]], nodes[far]


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links to a spanning forest, a bounded number at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0

    def out() -> pa.RecordBatch:
        a, b = forest(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        held.append((batch.column("a").to_numpy(), batch.column("b").to_numpy()))
        n += batch.num_rows
        if n >= FOLD_ROWS:
            yield out()
            held, n = [], 0
    if n:
        yield out()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); the component is
    its smallest node. Links of a node to itself keep it as a node."""
    ship(links.sparkSession)
    # Stored first: the links are read twice, and may cost much to make.
    links = staged(links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")), "links")
    alone = links.where("a = b").select("a")
    now = staged(links.where("a <> b").mapInArrow(tidy(_folded), LINKS).distinct(), "links")
    seen = None
    while True:
        # Large star: (node, neighbour) both ways; larger neighbours go to the least.
        both = now.select("a", "b").union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()
        # Small star: every node to its least neighbour, that one to the others.
        small = large.groupBy("b").agg(F.min("a").alias("m"))
        rewired = large.join(small, "b").select(F.col("m"), F.explode(F.array("a", "b")).alias("b"))
        after = staged(rewired.where("b <> m").select(F.col("m").alias("a"), "b").distinct(), "links")
        unstage(now)
        now = after
        mark = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head())
        if mark == seen:
            break
        seen = mark
    member = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    root = now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    single = alone.distinct().select(F.col("a").alias("node"), F.col("a").alias("component"))
    linked = member.union(root)
    return linked.union(single.join(linked.select("node"), "node", "left_anti").select("node", "component"))
