"""Block assignment: the plan, NTILE by key or by row, even blocks, chunks,
waves.

Spark's ``ntile`` needs a window ordered over the whole frame, which puts
every row into one task. ``row_positions`` gives the same global position
with no such task: the frame is range-partitioned on its order, each
partition is sorted, and ``monotonically_increasing_id`` numbers the rows of
a partition in that order (its upper bits are the partition index). The
partitioned rows are written once to the shared work folder, so the range
bounds, which Spark samples, stay fixed for every later read. A small table
of per-partition counts, stored too, then gives each partition its offset by
a join that Spark plans on its known size. Positions inside a group work the
same way with the group columns leading the order. Partitions follow the
number of rows, never the number of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from blockload.config import BLOCK_COL, DIRECT, LANDING, POSITION_COLS
from blockload.functions.columns import check_names
from blockload.session import new_path

# Bits of monotonically_increasing_id that hold the row index in a partition.
_ROW_BITS = 33


# --- O10, O11 ---------------------------------------------------------------

def distinct_keys(df: DataFrame, key: str | Column, alias: str | None = None) -> DataFrame:
    """The distinct values of the block key, null included.
    Spark aggregates partially before the shuffle, so a hot key costs one
    row per task."""
    c = df[key] if isinstance(key, str) else key
    return df.select(c.alias(alias) if alias else c).distinct()


def block_plan(df: DataFrame, block_size: int, threshold: int, force: bool | None = None) -> DataFrame:
    """One row: ``total_rows``, ``n_blocks`` = max(1, ceil(n / size)) and
    ``flow`` (LANDING if forced or ``n >= threshold``, else DIRECT)."""
    if block_size <= 0:
        raise ValueError("block_size must be > 0")
    n = F.count(F.lit(1))
    if force is None:
        flow = F.when(n >= F.lit(threshold), F.lit(LANDING)).otherwise(F.lit(DIRECT))
    else:
        flow = F.lit(LANDING if force else DIRECT)
    return df.agg(
        n.alias("total_rows"),
        F.greatest(F.lit(1), F.ceil(n / F.lit(float(block_size)))).cast("int").alias("n_blocks"),
        flow.alias("flow"),
    )


def n_blocks_for(total_rows: int, block_size: int) -> int:
    return max(1, math.ceil(total_rows / block_size))


BROADCAST_FILES = 100_000   # files whose table (a path and a number each) is small enough to broadcast
BLOCKS_A_RANGE = 4096   # blocks whose sizes are summed up together

# Rows per range partition above which more partitions are used.
ROWS_PER_RANGE_PARTITION = 1_000_000


def range_partitions(spark, n_rows: int) -> int:
    """Range partitions for positions over ``n_rows`` rows: at least the
    session's shuffle partitions, and enough that none holds more than about
    ``ROWS_PER_RANGE_PARTITION`` rows (AQE does not split range partitions, so
    the count must grow with the data). A partition may hold many blocks, or
    part of one."""
    default = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    wanted = max(default, math.ceil(n_rows / ROWS_PER_RANGE_PARTITION))
    return max(1, min(wanted, n_rows))  # never more partitions than rows


def ntile_range(n_rows: int, k: int, block: int) -> tuple[int, int]:
    """Positions [start, end) of tile ``block`` (1-based) of NTILE(k) over
    ``n_rows`` rows."""
    q, m = divmod(n_rows, k)
    if block <= m:
        start = (block - 1) * (q + 1)
        return start, start + q + 1
    start = m * (q + 1) + (block - 1 - m) * q
    return start, start + q


# --- positions --------------------------------------------------------------

def pin_ranged(df: DataFrame, keys: Sequence[str], path: str, num_partitions: int | None = None) -> DataFrame:
    """Write ``df`` range-partitioned on ``keys`` and sorted inside each
    partition, with ``_rid`` (partition in the upper bits, row in the lower)
    and ``_p`` (the partition, also the folder), to ``path``; return the
    written rows. Reads of ``path`` always see the same partitions, while a
    recomputed range exchange would sample new bounds."""
    check_names(df, POSITION_COLS)
    ranged = (
        (df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys))
        .sortWithinPartitions(*keys)
        .withColumn("_rid", F.monotonically_increasing_id())
        .withColumn("_p", F.shiftright("_rid", _ROW_BITS).cast("int"))
    )
    ranged.write.mode("errorifexists").partitionBy("_p").parquet(path)
    return df.sparkSession.read.schema(ranged.schema).parquet(path)  # no inference: empty input has no file


def range_offsets(pinned: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Per (range partition, group): rows ``_n``, first ``_rid``, rows of the
    group in earlier partitions ``_off``, and rows of the group ``_gsize``.
    At most partitions + groups rows; the window runs on this table only."""
    group_cols = list(group_cols)
    stats = pinned.groupBy("_p", *group_cols).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_rid").alias("_first"))
    before = Window.partitionBy(*group_cols).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group_cols)
    return stats.select(
        "_p", *group_cols, "_n", "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
        F.sum("_n").over(whole).alias("_gsize"),
    )


def _positions(df: DataFrame, order_cols: Sequence[str], group_cols: Sequence[str] = (),
               num_partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    check_names(df, (*POSITION_COLS, "_pos", "_gsize"))
    group_cols, order_cols = list(group_cols), list(order_cols)
    if not order_cols:
        raise ValueError("order_cols is empty")
    stage = new_path(spark, "stage")
    pinned = pin_ranged(df, group_cols + order_cols, f"{stage}/rows", num_partitions)
    range_offsets(pinned, group_cols).write.mode("errorifexists").parquet(f"{stage}/offsets")
    o = spark.read.parquet(f"{stage}/offsets").alias("_o")
    cond = pinned["_p"] == o["_p"]
    for g in group_cols:
        cond = cond & pinned[g].eqNullSafe(o[g])
    joined = pinned.join(o, cond, "inner")
    return joined.select(
        *[pinned[c] for c in df.columns],
        (pinned["_rid"] - o["_first"] + o["_off"]).alias("_pos"),
        o["_gsize"].cast("long").alias("_gsize"),
    )


def row_positions(
    df: DataFrame,
    order_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    *,
    num_partitions: int | None = None,
) -> DataFrame:
    """0-based position of each row in ``order_cols`` order inside its group
    (``_pos``) and the size of its group (``_gsize``), with no window over
    the data. The order must be total for the result to be stable.

    Columns of ``df`` come first; ``_pos`` and ``_gsize`` are longs.
    """
    return _positions(df, order_cols, group_cols, num_partitions)


def ntile_of(pos: Column, n_rows: Column, k: int) -> Column:
    """NTILE(k) from a 0-based position in a set of ``n_rows`` rows: the first
    ``n_rows mod k`` tiles get one row more. 1-based, as Spark's ``ntile``."""
    if k <= 0:
        raise ValueError("block count must be > 0")
    q = F.floor(n_rows / k)
    m = n_rows - q * k
    big = m * (q + 1)
    small_q = F.greatest(q, F.lit(1))
    return F.when(pos < big, F.floor(pos / (q + 1)) + 1).otherwise(
        m + F.floor((pos - big) / small_q) + 1).cast("int")


# --- O15, O16, O7, O18 ------------------------------------------------------

def key_blocks(df: DataFrame, key: str, n_blocks: int, *, num_partitions: int | None = None) -> DataFrame:
    """The key map of O15: (key, ``_block``) with NTILE(n) over the distinct
    keys in ascending order (null first). The keys are stored once, so their
    number sizes the range exchange; as many as one range partition may hold
    are numbered in one."""
    spark = df.sparkSession
    path = new_path(spark, "keys")
    distinct_keys(df, key).write.mode("errorifexists").parquet(path)
    keys = spark.read.schema(df.select(key).schema).parquet(path)
    n = keys.count()
    if num_partitions is None and n <= ROWS_PER_RANGE_PARTITION:
        return keys.select(key, F.ntile(n_blocks).over(Window.orderBy(F.asc_nulls_first(key))).alias(BLOCK_COL))
    parts = num_partitions or range_partitions(spark, n)
    pos = row_positions(keys, [key], num_partitions=parts)
    return pos.select(pos[key], ntile_of(F.col("_pos"), F.col("_gsize"), n_blocks).alias(BLOCK_COL))


def attach_blocks(df: DataFrame, key_map: DataFrame, key: str, map_key: str | None = None) -> DataFrame:
    """Give each row the block of its key; null keys match null
    (null-safe equality), so no row is lost. Spark plans the join on the
    sizes it measures: a small map is broadcast under the session's limit,
    else both sides are shuffled and AQE splits a hot key's partition. A
    row whose key is not in the map raises. Column order of ``df`` is kept,
    ``_block`` is added last."""
    check_names(df, (BLOCK_COL,))
    map_key = map_key or key
    m = key_map.select(key_map[map_key].alias("_k"), key_map[BLOCK_COL].alias("_kb"))
    joined = df.join(m, df[key].eqNullSafe(m["_k"]), "left")
    lost = F.raise_error(F.lit(f"a value of {key} is not in the key map: the input changed")).cast("int")
    return joined.select(*[df[c] for c in df.columns], F.coalesce(m["_kb"], lost).alias(BLOCK_COL))


def blocks_by_key(df: DataFrame, key: str, n_blocks: int, *, num_partitions: int | None = None) -> DataFrame:
    """NTILE(n) over the distinct keys, so all rows of a key share a
    block (1-based)."""
    return attach_blocks(df, key_blocks(df, key, n_blocks, num_partitions=num_partitions), key)


def blocks_by_row(df: DataFrame, order_cols: Sequence[str], n_blocks: int, *,
                  num_partitions: int | None = None) -> DataFrame:
    """NTILE(n) over all rows in ``order_cols`` order; blocks differ by at
    most one row. Equal to Spark's ``ntile`` over an unpartitioned window
    when the order is total, without that window's single task."""
    check_names(df, (BLOCK_COL,))
    if num_partitions is None:  # range partitions are never split by AQE: size them by the rows
        num_partitions = range_partitions(df.sparkSession, df.count())
    pos = row_positions(df, order_cols, num_partitions=num_partitions)
    return pos.select(*[pos[c] for c in df.columns],
                      ntile_of(F.col("_pos"), F.col("_gsize"), n_blocks).alias(BLOCK_COL))


def file_rows(df: DataFrame) -> DataFrame | None:
    """(path, rows, before) of the files that ``df`` scans, ``before`` being the
    rows of the files ahead of each in path order; None if its rows have no
    fixed places in files, or if it leaves some of them out. One row a file."""
    try:
        places = df.select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:   # not a scan of files, or one whose rows are not numbered
        return None
    spark = df.sparkSession
    path = new_path(spark, "file-rows")
    places.groupBy("_path").agg(F.count(F.lit(1)).alias("_n"), F.max("_row").alias("_last")).write.parquet(path)
    files = spark.read.parquet(path)
    if not files.where("_last IS NULL OR _n <> _last + 1").isEmpty():
        return None
    # Running sums in two levels, so that many files are no single task.
    files = files.withColumn("_bucket", F.substring(F.md5("_path"), 1, 3))
    order = Window.partitionBy("_bucket").orderBy("_path")
    inside = files.withColumn("_in", F.sum("_n").over(order) - F.col("_n"))
    ahead = files.groupBy("_bucket").agg(F.sum("_n").alias("_b")).withColumn(
        "_ahead", F.sum("_b").over(Window.orderBy("_bucket")) - F.col("_b"))    # at most 4096 rows
    told = inside.join(ahead, "_bucket").select("_path", "_n", (F.col("_in") + F.col("_ahead")).alias("_before"))
    return F.broadcast(told) if files.count() <= BROADCAST_FILES else told


def blocks_even(df: DataFrame, n_blocks: int) -> DataFrame:
    """``n`` blocks of about equal size with no key, which differ by one
    row at most where ``df`` is a scan of files that number their rows
    (Parquet): files in a fixed order are cut into ``n`` ranges of rows, without
    a shuffle, and a repeat deals the same rows. Another frame is dealt out
    round-robin into ``n`` partitions; write that at once (O22), as a recomputed
    plan may deal rows to other blocks."""
    if n_blocks <= 0:
        raise ValueError("block count must be > 0")
    check_names(df, (BLOCK_COL, "_path", "_before"))
    files = file_rows(df)
    if files is None:
        return df.repartition(n_blocks).withColumn(BLOCK_COL, (F.spark_partition_id() + 1).cast("int"))
    total = files.agg(F.sum("_n")).first()[0] or 0
    placed = df.select(*[df[c] for c in df.columns], F.col("_metadata.file_path").alias("_path"),
                       F.col("_metadata.row_index").alias("_row"))
    block = ntile_of(F.col("_row") + F.col("_before"), F.lit(total), n_blocks)
    return placed.join(files.select("_path", "_before"), "_path").select(*df.columns, block.alias(BLOCK_COL))


# --- O12, O19, O20 ----------------------------------------------------------

def block_results(df: DataFrame, block_col: str = BLOCK_COL) -> DataFrame:
    """Rows per block, counted on what is there: (block_id, n_rows)."""
    return df.groupBy(F.col(block_col).alias("block_id")).agg(F.count(F.lit(1)).alias("n_rows"))


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """An aggregate over rows that no order changes: the sum of two 64-bit
    digests of each row, as decimals. Equal rows count as often as they are
    there. Types that Spark's hash refuses are digested as JSON text."""
    def plain(f: T.StructField) -> Column:
        unhashed = any(kind in f.dataType.simpleString() for kind in ("map<", "variant"))
        return F.to_json(df[f.name]) if unhashed else df[f.name]

    values = [plain(df.schema[c]) for c in columns]
    values += [v.isNull() for v in values]   # the hash skips nulls
    total = F.lit(0).cast("decimal(38,0)")
    for k, seed in enumerate((F.lit(1), F.lit(2))):
        total = total + F.xxhash64(seed, *values).cast("decimal(20,0)") * F.lit(1 if k == 0 else 3)
    return F.sum(total).cast("decimal(38,0)")


def chunk_rows(df: DataFrame, limit: int, order_cols: Sequence[str], block_col: str = BLOCK_COL, *,
               num_partitions: int | None = None) -> DataFrame:
    """Number the rows of each block in chunks of ``limit`` rows in
    ``order_cols`` order (``_chunk``, 0-based; the last chunk may be short).
    ``limit <= 0`` means one chunk per block. A big block is spread over
    several tasks, since the position comes from ``row_positions``."""
    check_names(df, ("_chunk",))
    if limit <= 0:
        return df.withColumn("_chunk", F.lit(0))
    if num_partitions is None:  # range partitions are never split by AQE: size them by the rows
        num_partitions = range_partitions(df.sparkSession, df.count())
    pos = row_positions(df, order_cols, [block_col], num_partitions=num_partitions)
    return pos.select(*[pos[c] for c in df.columns], F.floor(F.col("_pos") / limit).cast("int").alias("_chunk"))


def waves_by_size(blocks: DataFrame, target: int, size_col: str = "n_rows", block_col: str = "block_id") -> DataFrame:
    """Pending blocks packed into waves (``wave_no``, 0-based) by their
    sizes. Small blocks in order fill waves of about ``target`` (a wave takes
    the blocks that begin inside it); a block of that size or more is a wave by
    itself, behind the others. Running sums are made inside ranges of blocks and
    over the ranges' totals, so no task sees all blocks."""
    target = max(1, int(target))
    big = F.coalesce(F.col(size_col), F.lit(0)) >= target
    rows = blocks.select(*[blocks[c] for c in blocks.columns], F.when(big, 0).otherwise(
        F.coalesce(F.col(size_col), F.lit(0))).cast("long").alias("_small"), F.when(big, 1).otherwise(0).alias("_big"),
        F.floor(F.col(block_col) / BLOCKS_A_RANGE).alias("_range"))
    totals = rows.groupBy("_range").agg(F.sum("_small").alias("_ts"), F.sum("_big").alias("_tb"))
    ahead = Window.orderBy("_range")   # a row for each BLOCKS_A_RANGE blocks
    totals = totals.select("_range", (F.sum("_ts").over(ahead) - F.col("_ts")).alias("_as"),
                           (F.sum("_tb").over(ahead) - F.col("_tb")).alias("_ab"), F.sum("_ts").over(
                               Window.partitionBy()).alias("_all"))
    inside = Window.partitionBy("_range").orderBy(block_col)
    small = F.floor((F.col("_as") + F.col("_is") - F.col("_small")) / target)
    last = F.ceil(F.col("_all") / target)       # no small block begins in a later wave
    placed = rows.withColumn("_is", F.sum("_small").over(inside)).withColumn("_ib", F.sum("_big").over(inside)).join(
        totals, "_range")
    wave = F.when(F.col("_big") == 1, last + F.col("_ab") + F.col("_ib") - 1).otherwise(F.least(small, F.greatest(
        last - 1, F.lit(0))))
    return placed.select(*blocks.columns, wave.cast("int").alias("wave_no"))


def waves(pending: DataFrame, wave_size: int, block_col: str = "block_id") -> DataFrame:
    """Pending blocks in order, grouped into waves of ``wave_size``
    (``wave_no``, 0-based). A wave is what one Spark job loads."""
    size = max(1, int(wave_size))
    pos = row_positions(pending, [block_col])
    return pos.select(*[pos[c] for c in pending.columns], F.floor(F.col("_pos") / size).cast("int").alias("wave_no"))
