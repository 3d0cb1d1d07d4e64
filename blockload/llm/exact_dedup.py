"""Exact dedup (operator 13) by a content sort, with DataFrame functions only.

Texts are equal when they are identical without their white space. Sampled
splitters range-partition the rows by their normalised bytes, Spark's external
sort places equals beside each other, and each row is compared with its
neighbour in full (the window operator compares whole keys of neighbouring
rows). Of a run of equals the row with the most code points in its own text,
then the least doc_id, stays.

Scale: one shuffle of the normalised texts, sorted with spilling. The driver
sees the splitters only, which are short: the first ``PREFIX`` characters of
the normalised text and a 64-bit digest of it, so texts with a common start
are split too. A group of equals larger than ``GROUP_BYTES`` would fill one
task; such groups, found by counting digests over all rows, are dealt over
several ranges (``__piece``), each of which elects its own row, and the runs of
a group, one row each, are put together afterwards. No group is ever gathered
or cut short. ``GROUP_BYTES`` grows where it must, so that no more than
``MOST_LARGE`` groups are dealt, which bounds the digests in the plan; a group
just below it is sorted in one task, which spills.

Defined results: a null text is empty, and empty and blank texts are one group;
a null doc_id comes after all others; of repeated rows one stays; an empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockload.llm.runtime import partitions_for, pick, sheltered, staged

# Fixed value: the white space that does not count (space, code points 9 to 13).
BLANK = " \t\n\x0b\x0c\r"

PREFIX = 16                  # characters of a text in a splitter
PARTITION_BYTES = 64 << 20   # normalised text of a range, on average
GROUP_BYTES = 1 << 20        # a larger group of equals is dealt over ranges
MOST_LARGE = 4096


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), BLANK, "")


def _large_groups(rows: DataFrame) -> tuple[dict[int, list[int]], int]:
    """Digests of the groups over the limit (bounded), by the ranges that they
    are dealt over (powers of two), and the bytes of all rows."""
    sizes = staged(rows.groupBy("__digest").agg(F.sum("__bytes").alias("b")), "sort-sizes")
    total = sizes.agg(F.sum("b")).head()[0] or 0
    limit = max(GROUP_BYTES, -(-total // MOST_LARGE))
    large: dict[int, list[int]] = {}
    for digest, size in sizes.where(F.col("b") > limit).collect():
        large.setdefault(1 << (size // limit).bit_length(), []).append(digest)
    return large, total


def _compared(docs: DataFrame, carried: list[str]) -> DataFrame:
    """The ``carried`` columns of every row with keep_id, group_size, kept and
    text_sha256."""
    norm = normalised(F.col("text"))
    keys = docs.select(F.xxhash64(norm).alias("__digest"), (F.octet_length(norm) + 64).cast("long").alias("__bytes"))
    large, total = _large_groups(keys)
    spread = F.xxhash64("doc_id", F.monotonically_increasing_id())
    rows = docs.select(*carried, F.col("doc_id").cast("long").alias("__id"),
                       F.length(F.coalesce("text", F.lit(""))).alias("__chars"), norm.alias("__norm"), spread.alias("__spread"))
    rows = rows.withColumn("__digest", F.xxhash64("__norm"))
    piece = F.lit(0)
    for pieces, digests in large.items():
        piece = F.when(F.col("__digest").isin(digests), F.pmod("__spread", F.lit(pieces)) + 1).otherwise(piece)
    rows = rows.withColumn("__start", F.left("__norm", F.lit(PREFIX))).withColumn("__piece", piece.cast("long"))

    place = ["__start", "__digest", *(["__piece"] if large else [])]
    ranges = max(partitions_for(total, PARTITION_BYTES), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # The window asks for rows clustered by these columns, which the ranges
    # already are: Spark adds the sort, and no other shuffle.
    run = Window.partitionBy(*place, "__norm").orderBy(F.desc("__chars"), F.asc_nulls_last("__id"))
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = rows.repartitionByRange(ranges, *place).select(
        *carried, F.first("__id").over(whole).alias("keep_id"), F.count(F.lit(1)).over(whole).alias("group_size"),
        (F.row_number().over(run) == 1).alias("kept"), F.sha2("__norm", 256).alias("text_sha256"),
        F.first("__chars").over(whole).alias("__most"), "__piece", "__norm")
    told = [*carried, "keep_id", "group_size", "kept", "text_sha256"]
    if not large:
        return found.select(*told)

    # The runs of a dealt group are put together by the whole text, one row each.
    dealt = F.col("__piece") > 0
    found = staged(found.withColumn("__norm", F.when(dealt & F.col("kept"), F.col("__norm"))), "sort-found")
    best = F.min(F.struct((-F.col("__most")).alias("m"), F.col("keep_id").isNull().alias("u"), "keep_id", "__piece"))
    groups = found.where(dealt & F.col("kept")).groupBy("__norm").agg(
        best.alias("__best"), F.sum("group_size").alias("__size"), F.first("text_sha256").alias("__sha"))
    # One row for each dealt digest: at most MOST_LARGE, so a small table.
    groups = F.broadcast(staged(groups.drop("__norm"), "sort-groups"))
    both = found.join(groups, dealt & (F.col("text_sha256") == F.col("__sha")), "left")
    one = F.col("__sha").isNotNull()
    return both.select(
        *carried, F.when(one, F.col("__best.keep_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(one, F.col("__size")).otherwise(F.col("group_size")).alias("group_size"),
        (F.col("kept") & (~one | (F.col("__best.__piece") == F.col("__piece")))).alias("kept"), "text_sha256")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of ``docs``
    (doc_id, text)."""
    found = _compared(pick(docs, "doc_id", "text"), ["doc_id"])
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with all their columns."""
    plain, restored = sheltered(docs, "doc_id", "text")
    return _compared(plain, plain.columns).where("kept").select(*restored)
