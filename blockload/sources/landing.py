"""The landing: blocked rows written once as Parquet.

Two layouts. Blocks by key and even blocks are partitioned by ``_block``.
Blocks by row keep the layout in which their positions were computed:
partitioned by range partition ``_p``, with a ``_rid`` per row and a small
``_offsets`` table; the block of a row is arithmetic on those, and a read of
some blocks prunes to the ``_p`` folders that overlap them. That layout
saves writing the data a second time.

A landing is complete only when its ``_SUCCESS`` marker and its ``_plan``
record are there. Nothing is overwritten: a run that finds an incomplete
landing writes the next attempt folder beside it.
"""

from __future__ import annotations

import bisect
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockload.config import BLOCK_COL
from blockload.functions.columns import resolve_columns
from blockload.operators.blocks import block_results, ntile_of, ntile_range, pin_ranged, range_offsets
from blockload.session import path_exists

_PLAN_SCHEMA = T.StructType([
    T.StructField("n_blocks", T.IntegerType(), False),
    T.StructField("total_rows", T.LongType(), False),
    T.StructField("blocks_on", T.StringType(), False),
    T.StructField("n_parts", T.IntegerType(), True),
    T.StructField("schema", T.StringType(), True),
])
ROWS = "rows"
_COUNTS = "_counts"   # rows per block of a landing by block


def write_landing(df: DataFrame, path: str, n_blocks: int, *, blocks_on: str = "", cluster: bool = True,
                  block_col: str = BLOCK_COL) -> str:
    """Write ``df`` (with its block column) to a new landing at ``path``,
    partitioned by block; raises if ``path`` exists. The rows per block are
    counted on what was written and kept in ``_counts``.

    ``cluster`` brings the rows of a block together first (a rebalance on
    the block column, which AQE splits where a block is big), so a task
    writes few block folders. Frames whose partitions already hold
    contiguous blocks (by row, even) pass ``cluster=False`` and are written
    with no shuffle.
    """
    spark = df.sparkSession
    out = df.hint("rebalance", block_col) if cluster else df
    out.write.mode("errorifexists").partitionBy(block_col).parquet(path)
    written = spark.read.schema(out.schema).parquet(path)
    block_results(written, block_col).coalesce(1).write.mode("errorifexists").parquet(f"{path}/{_COUNTS}")
    total = spark.read.parquet(f"{path}/{_COUNTS}").agg(F.sum("n_rows")).first()[0] or 0
    _write_plan(spark, path, n_blocks, total, blocks_on, 0, out.schema)
    return path


def _write_plan(spark: SparkSession, path: str, n_blocks: int, total_rows: int, blocks_on: str,
                n_parts: int, schema: T.StructType) -> None:
    """The plan record; it also keeps the schema of the rows, so an empty
    landing (no data file) still reads with its columns."""
    row = (int(n_blocks), int(total_rows), blocks_on, int(n_parts), schema.json())
    spark.createDataFrame([row], _PLAN_SCHEMA).coalesce(1).write.mode("errorifexists").json(f"{path}/_plan")


def write_row_landing(df: DataFrame, order_cols: Sequence[str], path: str, n_blocks: int, *,
                      num_partitions: int | None = None) -> str:
    """O22 for blocks by row (O16): NTILE(n) over ``order_cols``, written once.
    The rows are range-partitioned and stored by partition; ``_offsets``
    (one row per partition) and the row count complete the landing."""
    if n_blocks <= 0:
        raise ValueError("block count must be > 0")
    spark = df.sparkSession
    pinned = pin_ranged(df, list(order_cols), path, num_partitions)
    offsets = range_offsets(pinned).drop("_gsize")
    offsets.coalesce(1).write.mode("errorifexists").parquet(f"{path}/_offsets")
    written = spark.read.parquet(f"{path}/_offsets")
    agg = written.agg(F.count(F.lit(1)).alias("p"), F.sum("_n").alias("n")).first()
    _write_plan(spark, path, n_blocks, int(agg["n"] or 0), ROWS, int(agg["p"]), pinned.schema)
    return path


def landing_plan(spark: SparkSession, path: str) -> dict | None:
    """The plan of a complete landing (n_blocks, total_rows, blocks_on), or
    None if ``path`` holds no complete landing."""
    if not (path_exists(spark, f"{path}/_SUCCESS") and path_exists(spark, f"{path}/_plan/_SUCCESS")):
        return None
    row = spark.read.schema(_PLAN_SCHEMA).json(f"{path}/_plan").first()
    return row.asDict() if row else None


def find_landing(spark: SparkSession, root: str) -> tuple[str | None, str]:
    """(latest complete landing under ``root`` or None, next free attempt
    folder). Attempts are ``a1``, ``a2``, ... and are never overwritten."""
    latest, n = None, 1
    while True:
        attempt = f"{root}/a{n}"
        # Markers first (two small listings); only a folder that is not a
        # complete landing is listed as a whole.
        if landing_plan(spark, attempt) is not None:
            latest = attempt
        elif not path_exists(spark, attempt):
            return latest, attempt
        n += 1


def read_landing(spark: SparkSession, path: str, block_ids: Sequence[int] | None = None, *,
                 plan: dict | None = None) -> DataFrame:
    """The rows of a complete landing with their ``_block``, only of
    ``block_ids`` if given (read with partition pruning in both layouts).
    ``plan`` is the landing's ``_plan`` record if the caller has read it."""
    plan = plan or landing_plan(spark, path)
    if plan is None:
        raise ValueError(f"no complete landing at {path}")
    ids = sorted({int(b) for b in block_ids}) if block_ids is not None else None
    # The landing never changes: its files are listed once per plan.
    if "_rows" not in plan:
        reader = spark.read.schema(T.StructType.fromJson(json.loads(plan["schema"]))) if plan["schema"] else spark.read
        plan["_rows"] = reader.parquet(path)
    rows = plan["_rows"]
    if plan["blocks_on"] != ROWS:
        return rows.filter(F.col(BLOCK_COL).isin(ids)) if ids is not None else rows
    n, k = int(plan["total_rows"]), int(plan["n_blocks"])
    if "_offsets" not in plan:
        plan["_offsets"] = spark.read.parquet(f"{path}/_offsets")
    offsets = plan["_offsets"]
    if ids is not None:
        # Range partitions that overlap the positions of the wanted blocks,
        # from the offsets table (one row per partition, read once per plan).
        if "_parts" not in plan:
            plan["_parts"] = sorted((r["_off"], r["_n"], r["_p"]) for r in offsets.select("_off", "_n", "_p").collect())
        rows = rows.filter(F.col("_p").isin(overlapping(plan["_parts"], [ntile_range(n, k, b) for b in ids if 1 <= b <= k])))
    o = offsets.select("_p", "_first", "_off").alias("_o")  # a stored table: Spark knows its size
    j = rows.join(o, rows["_p"] == o["_p"], "inner")
    data = [c for c in rows.columns if c not in ("_rid", "_p")]
    out = j.select(*[rows[c] for c in data],
                   ntile_of(rows["_rid"] - o["_first"] + o["_off"], F.lit(n), k).alias(BLOCK_COL))
    return out.filter(F.col(BLOCK_COL).isin(ids)) if ids is not None else out


def overlapping(parts: Sequence[tuple[int, int, int]], spans: Sequence[tuple[int, int]]) -> list[int]:
    """Partitions (offset, rows, number; by offset) that hold positions of the
    spans [start, end)."""
    found = set()
    for start, end in spans:
        i = max(0, bisect.bisect_right(parts, (start, float("inf"), 0)) - 1)
        while i < len(parts) and parts[i][0] < end:
            if parts[i][0] + parts[i][1] > start:
                found.add(parts[i][2])
            i += 1
    return sorted(found)


def block_sizes(spark: SparkSession, path: str, block_ids: Sequence[int], *, plan: dict | None = None) -> DataFrame:
    """(block_id, n_rows) of some blocks of a complete landing. Row layout:
    exact arithmetic on the counted rows (NTILE sizes); block layout: the
    counts stored with the landing."""
    plan = plan or landing_plan(spark, path)
    if plan is None:
        raise ValueError(f"no complete landing at {path}")
    ids = sorted({int(b) for b in block_ids})
    schema = "block_id INT, n_rows BIGINT"
    if plan["blocks_on"] == ROWS:
        n, k = int(plan["total_rows"]), int(plan["n_blocks"])
        sizes = [(b, (lambda r: r[1] - r[0])(ntile_range(n, k, b)) if 1 <= b <= k else 0) for b in ids]
        return spark.createDataFrame(sizes, schema)
    want = spark.createDataFrame([(b,) for b in ids], "block_id INT")
    return want.join(_counts(spark, path), "block_id", "left").select(
        "block_id", F.coalesce(F.col("n_rows"), F.lit(0)).cast("long").alias("n_rows"))


def _counts(spark: SparkSession, path: str) -> DataFrame:
    """The rows per block that were counted when the landing was written."""
    return spark.read.schema("block_id INT, n_rows BIGINT").parquet(f"{path}/{_COUNTS}")


def landing_state(spark: SparkSession, path: str) -> DataFrame:
    """(block_id, n_rows) for every planned block of a complete landing,
    0 for an empty block; empty if there is no complete landing. Row
    layout: NTILE sizes of the counted rows; block layout: the counts stored
    with the landing. Neither scans the rows."""
    schema = "block_id INT, n_rows BIGINT"
    plan = landing_plan(spark, path)
    if plan is None:
        return spark.createDataFrame([], schema)
    k = int(plan["n_blocks"])
    blocks = spark.range(1, k + 1).select(F.col("id").cast("int").alias("block_id"))
    if plan["blocks_on"] == ROWS:
        q, m = divmod(int(plan["total_rows"]), k)
        size = F.when(F.col("block_id") <= m, F.lit(q + 1)).otherwise(F.lit(q))
        return blocks.select("block_id", size.cast("long").alias("n_rows"))
    j = blocks.join(_counts(spark, path), "block_id", "left")
    return j.select(F.col("block_id"), F.coalesce(F.col("n_rows"), F.lit(0)).cast("long").alias("n_rows"))


def scan_blocks(landing: DataFrame | str, block_ids: Sequence[int], cols: Sequence[str] | None = None, *,
                block_col: str = BLOCK_COL, keep_block: bool = False) -> DataFrame:
    """O3: only the named blocks (a literal IN list, so Spark prunes
    partitions), columns selected by name ignoring case. ``landing`` is a
    frame with a block column, or the path of a complete landing (then the
    read prunes in either layout)."""
    ids = sorted({int(b) for b in block_ids})
    if isinstance(landing, str):
        landing = read_landing(SparkSession.active(), landing, ids)
    part = landing.filter(F.col(block_col).isin(ids))
    names = [c for c in landing.columns if c != block_col] if cols is None else list(cols)
    fields = resolve_columns(landing, names).fieldNames()
    return part.select(*fields, *([block_col] if keep_block else []))
