"""Exact top-k search (operator 2) with vector-approximation files.

Components are turned into whole numbers, floor(64 x). The approximation file
stores each component's cell, one byte, in blocks of vectors; the exact file
stores the numbers. A first scan reads only cells: with a component known to
lie in its cell, a query's score lies within a fixed distance of the score of
the cell's middle, the same for all vectors of a scale. Each block keeps, for
each query, every candidate that its own k best lower bounds do not rule out.
Over all blocks, the k-th best lower bound rules out more. The rest is read
exactly in the order of its bounds: first the k most promising, whose k-th
exact score then decides which others can still matter, and only those are
read. So the result is certain, not approximate.

Scale: queries are packed in blocks too and meet each block of cells once (a
stated query set against all rows, in blocks). What leaves a scan is a few
rows per query and block. Nothing is broadcast.

Defined results: a vector that is null, empty, or holds null or non-finite
components takes no part; vectors are compared with those of their own
length; every row is a candidate of every other one, so repeated rows and rows
of one id are told apart (a null id ranks last among equal scores); equal scores
go to the smaller id. Whole numbers of any size are kept exactly, as doubles,
which hold them; scores are added up in whole numbers. A best score that does not
fit 64 bits raises, as does a component of 2^490 or more.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blockload.llm.runtime import partitions_for, pick, ship, staged

SCALE = 64
BLOCK_VECTORS = 4096
QUERY_VECTORS = 256
CELLS = 256

BLOCK = "dim int, block long, ids binary, low double, width double, cells binary"
QUERIES = "dim int, qblock long, qids binary, numbers binary"
BOUNDS = "query long, row long, low double, high double"
SCORES = "query long, row long, query_id long, vec_id long, score decimal(38,0)"
EXACT = 2.0 ** 50        # whole numbers below it are far from the limit of doubles
MOST = 10 ** 38 - 1      # scores beyond it are all alike: they fit no result


def whole_numbers(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """row (a key), vec_id, dim, numbers (array of floor(64 x), as doubles, which
    hold them exactly) of the vectors that take part."""
    usable = F.forall(column, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = pick(vectors, "vec_id", column).where(F.col(column).isNotNull()).where((F.size(column) > 0) & usable)
    # floor() to whole doubles: from 2^53 on a double is whole already.
    number = lambda v: F.when(F.abs(v) < EXACT, F.floor(v * SCALE).cast("double")).otherwise(v * SCALE)
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                       F.size(column).alias("dim"), F.transform(column, lambda v: number(v.cast("double"))).alias("numbers"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    m = np.asarray(batch.column("numbers").flatten()).reshape(batch.num_rows, -1)
    if np.abs(m).max(initial=0) >= 2.0 ** 496:
        raise OverflowError("a component of 2^490 or more")
    return m


def _packed(kind: str, size: int):
    """Rows sorted by (dim, block) to one packed row per block and scale."""
    def pack(ids: np.ndarray, m: np.ndarray, dim: int, block: int) -> list:
        if kind == "queries":
            return [dim, block, ids.tobytes(), m.astype("<f8").tobytes()]
        low, high = float(m.min()), float(m.max())
        width = max(1.0, float(np.ceil((high - low + 1) / CELLS)))
        cells = np.clip((m - low) // width, 0, CELLS - 1)
        return [dim, block, ids.tobytes(), low, width, cells.astype(np.uint8).tobytes()]

    names = [c.split()[0] for c in (QUERIES if kind == "queries" else BLOCK).split(", ")]
    types = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    kinds = [types[c.split()[1]] for c in (QUERIES if kind == "queries" else BLOCK).split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, rows = None, [], []

        def out() -> pa.RecordBatch:
            row = pack(np.concatenate(ids), np.concatenate(rows), *key)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names=names)

        for batch in batches:
            dims, blocks = batch.column("dim").to_numpy(), batch.column("block").to_numpy()
            cuts = np.flatnonzero((np.diff(dims) != 0) | (np.diff(blocks) != 0)) + 1
            for a, z in zip([0, *cuts], [*cuts, batch.num_rows]):
                if a == z:
                    continue
                now = (int(dims[a]), int(blocks[a]))
                if key is not None and now != key:
                    yield out()
                    ids, rows = [], []
                key = now
                part = batch.slice(a, z - a)
                ids.append(part.column("row").to_numpy().astype("<i8"))
                rows.append(_matrix(part))
        if key is not None:
            yield out()
    return run


def _blocks(rows: DataFrame, kind: str, size: int, n_rows: int) -> DataFrame:
    n = partitions_for(n_rows, size)
    keyed = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n)))
    parts = keyed.repartition(n, "dim", "block").sortWithinPartitions("dim", "block", "row")
    return parts.mapInArrow(_packed(kind, size), QUERIES if kind == "queries" else BLOCK)


def _scan(k: int):
    """Bounds of the candidates that a block of cells cannot rule out."""
    names = [c.split()[0] for c in BOUNDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dim, ids = row["dim"], np.frombuffer(row["ids"], "<i8")
                cells = np.frombuffer(row["cells"], np.uint8).reshape(-1, dim).astype(np.float64)
                qids = np.frombuffer(row["qids"], "<i8")
                q = np.frombuffer(row["numbers"], "<f8").reshape(-1, dim)
                low, width = row["low"], row["width"]
                span = abs(low) + width * CELLS           # no number of the block is larger
                # Small numbers lie in their cell exactly; large ones but for rounding.
                half = (width - 1) / 2 if span < EXACT else width / 2 + span * 1e-14
                middle = q @ (cells * width + low + (width - 1) / 2).T
                reach = np.abs(q).sum(axis=1)
                slack = reach * half + reach * span * 1e-15 * (dim + 16)
                middle[qids[:, None] == ids[None, :]] = -np.inf
                n = min(k, len(ids))
                kth = np.partition(middle, len(ids) - n, axis=1)[:, len(ids) - n]
                qi, ci = np.nonzero((middle + 2 * slack[:, None] >= kth[:, None]) & (middle > -np.inf))
                score = middle[qi, ci]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qids[qi]), pa.array(ids[ci]),
                     pa.array(score - slack[qi]), pa.array(score + slack[qi])], names=names)
    return run


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact inner products: in doubles where no sum can pass 2^53, else in
    whole numbers of any size."""
    names = [c.split()[0] for c in SCORES.split(", ")]
    for batch in batches:
        scores: list = [None] * batch.num_rows
        dims = batch.column("dim").to_numpy()
        q, v = (np.asarray(batch.column(c).flatten()) for c in ("q", "v"))
        begin = np.cumsum(dims) - dims
        for dim in np.unique(dims):
            rows = np.flatnonzero(dims == dim)
            at = begin[rows][:, None] + np.arange(dim)
            a, b = q[at], v[at]
            small = np.abs(a).max(axis=1) * np.abs(b).max(axis=1) * dim < 2.0 ** 53
            for i, s in zip(rows[small], (a[small] * b[small]).sum(axis=1)):
                scores[i] = Decimal(int(s))
            for i, x, y in zip(rows[~small], a[~small], b[~small]):
                scores[i] = Decimal(max(-MOST, min(MOST, sum(int(m) * int(n) for m, n in zip(x, y)))))
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names[:-1]], pa.array(scores, pa.decimal128(38, 0))],
                                         names=names)


def exact_scores(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """``pairs`` (query, row) with their ids and ``score``, their inner product."""
    q = vectors.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"), F.col("numbers").alias("q"), "dim")
    v = vectors.select("row", "vec_id", F.col("numbers").alias("v"))
    both = pairs.select("query", "row").join(q, "query").join(v, "row")
    return both.mapInArrow(_products, SCORES)


def top_k(vectors: DataFrame, query_step: int = 20, k: int = 20, column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every row whose id is
    divisible by ``query_step``, over all other rows."""
    spark = vectors.sparkSession
    ship(spark)
    exact = staged(whole_numbers(vectors, column), "exact-file")
    n = exact.count()
    cells = staged(_blocks(exact, "cells", BLOCK_VECTORS, n), "va-file")
    asked = exact.where(F.col("vec_id") % query_step == 0)
    queries = _blocks(asked, "queries", QUERY_VECTORS, asked.count()).withColumnRenamed("dim", "qdim")
    # Each block of queries goes to each block of cells, by number.
    every = F.sequence(F.lit(0).cast("long"), F.lit(partitions_for(n, BLOCK_VECTORS) - 1).cast("long"))
    sent = queries.withColumn("qto", F.explode(every))
    met = sent.join(cells, (F.col("qdim") == F.col("dim")) & (F.col("qto") == F.col("block"))).drop("qdim", "qto")
    bounds = staged(met.mapInArrow(_scan(k), BOUNDS), "va-bounds")

    best = Window.partitionBy("query")
    kth = lambda name: F.max(F.when(F.col("_at") == k, F.col(name))).over(best)
    left = (bounds.withColumn("_at", F.row_number().over(best.orderBy(F.desc("low"), "row")))
            .withColumn("_kth", kth("low")).where(F.col("_kth").isNull() | (F.col("high") >= F.col("_kth")))
            .withColumn("_at", F.row_number().over(best.orderBy(F.desc("high"), F.desc("low"), "row")))
            .select("query", "row", "high", "_at"))
    left = staged(left, "va-left")
    first = staged(exact_scores(left.where(F.col("_at") <= k), exact), "va-first")
    reach = first.groupBy("query").agg(F.min("score").alias("_reach"))
    rest = left.where(F.col("_at") > k).join(reach, "query").where(
        F.col("high") >= F.col("_reach").cast("double") * F.when(F.col("_reach") > 0, 1 - 1e-15).otherwise(1 + 1e-15))
    scored = first.unionByName(exact_scores(rest, exact))
    order = best.orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score"))
