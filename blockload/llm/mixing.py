"""Mixing sources to target weights (operator 10), with DataFrame functions only.

Weighted fair queueing: the documents of a source are shuffled by a digest of
their id and text, and each copy of a document gets a virtual finish time, the words
of its source up to and including it divided by the source's target. Sorted
by that time over all sources, the documents are taken until the total budget
is spent; so every source advances at the rate of its target.

Targets: sources in code point order, null last, weigh 3, 1, 2, repeating.
They share ``budget`` times all words; no target exceeds ``max_repeat`` times
its source's words, and the excess is reshared by weight until none does.

Scale: the texts are read once; each row's size and place in the shuffle are
stored beside it, and everything else works on (source, digest, size). Running
sums are made in two levels, inside buckets of the digest (or of the finish
time) and over the buckets' totals, so that neither a source with most of the
documents nor the whole mix is ever one task. Rows that repeat (source, doc_id,
text) are numbered, part by part of the stored rows, and get places of their
own, so that they spread too.

Defined results: a null or empty text has size 0, is never short of its own
size, and is taken with 0 words; a source without words has target 0; rows of
equal or null ids with different texts are documents of their own; which of
several repeated rows is taken more often is not defined, how many are is; an
empty table gives an empty result. Extra columns are kept, except those with the
names of the columns that are added, which are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockload.llm.runtime import WORD, partitions_for, sheltered, staged

WEIGHTS = (3, 1, 2)
BUDGET = (3, 2)       # 150% of all words, as a fraction
MAX_REPEAT = 2
BUCKET_ROWS = 1024    # rows of a digest or finish-time bucket, on average
DIGEST_BITS = 32


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, budget: tuple[int, int] = BUDGET,
                   max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per source from (source, source_size): rank, weight, target.

    Resharing the excess until no target is above its cap ends at one level,
    the target per unit of weight of the sources below their caps. Sorted by
    cap over weight, the capped sources are a prefix; the level after each
    prefix follows from running sums. These windows see one row per source.
    """
    num, den = budget
    ranked = sizes.withColumn("source_rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("source_rank") - 1) % len(weights) + 1)
    ranked = ranked.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * max_repeat)
    by_ratio = Window.orderBy((F.col("cap") / F.col("weight")).asc(), "source_rank")
    everything = Window.partitionBy()
    ranked = (ranked
              .withColumn("cap_before", F.coalesce(F.sum("cap").over(
                  by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("weight_left", F.sum("weight").over(
                  by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
              .withColumn("total", F.sum("source_size").over(everything)))
    # The first source in that order that stays below its cap fixes the level.
    spare = F.col("total") * num - F.col("cap_before") * den
    open_ = F.col("cap") * F.col("weight_left") * den > F.col("weight") * spare
    level = F.min(F.when(open_, F.struct(F.col("cap") / F.col("weight"), "source_rank", spare.alias("spare"),
                                         "weight_left"))).over(everything)
    ranked = ranked.withColumn("level", level)
    share = (F.col("weight") * F.col("level.spare")).cast("double") / (F.col("level.weight_left") * den).cast("double")
    capped = F.col("level").isNull() | (
        F.struct(F.col("cap") / F.col("weight"), "source_rank")
        < F.struct(F.col("level.col1"), F.col("level.source_rank")))
    return ranked.select("source", "source_rank", "source_size",
                         F.when(capped, F.col("cap").cast("double")).otherwise(share).alias("target"), "total")


def _own_places(small: DataFrame) -> DataFrame:
    """``__order`` of its own for each row: rows that repeat one are numbered, by
    the parts that they are stored in and inside them."""
    same = ["__source", "__order"]
    many = staged(small.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*same), "mix-repeats")
    if many.isEmpty():
        return small
    repeats = small.join(many, same, "left_semi")
    before = Window.partitionBy(*same).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = repeats.groupBy(*same, "__part").agg(F.count(F.lit(1)).alias("n")).select(
        *same, "__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__skip"))
    inside = F.row_number().over(Window.partitionBy(*same, "__part").orderBy("__rid"))
    number = F.col("__skip") + F.col("__inside") - 1
    own = F.when(number == 0, F.col("__order")).otherwise(F.md5(F.concat_ws(":", "__order", number)))
    numbered = repeats.withColumn("__inside", inside).join(parts, [*same, "__part"]).withColumn("__order", own)
    return small.join(many, same, "left_anti").unionByName(numbered.select(*small.columns))


def _placed(docs: DataFrame, carried: list[str], weights: Sequence[int], budget: tuple[int, int],
            max_repeat: int) -> tuple[DataFrame, DataFrame]:
    """The stored ``carried`` columns by __rid, and for each __rid size,
    source_size, target, taken and finish_times."""
    order = F.md5(F.concat_ws(":", F.lit("mix"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                              F.md5(F.coalesce(F.col("text"), F.lit("")))))
    name = F.col("source").cast("string")
    source = F.coalesce(F.concat(F.lit("="), name), F.lit(""))       # null has a name too
    rows = staged(docs.select(
        *carried, source.alias("__source"), word_count(F.col("text")).alias("size"), order.alias("__order"),
        F.monotonically_increasing_id().alias("__rid"), F.spark_partition_id().alias("__part")), "mix-rows")
    n_buckets = min(partitions_for(rows.count(), BUCKET_ROWS), 1 << 20)
    small = _own_places(rows.select("__rid", "__part", "__source", "size", "__order")).withColumn("__bucket", F.floor(
        F.conv(F.substring("__order", 1, DIGEST_BITS // 4), 16, 10).cast("long") * n_buckets / float(1 << DIGEST_BITS)))

    totals = small.groupBy("__source", "__bucket").agg(F.sum("size").alias("__words"))
    running = Window.partitionBy("__source").orderBy("__bucket")
    totals = totals.select("__source", "__bucket", (F.sum("__words").over(running) - F.col("__words")).alias("__before"))
    sizes = small.groupBy("__source").agg(F.sum("size").alias("source_size"))
    named = F.when(F.col("__source") != "", F.substring("__source", 2, 1 << 30))
    targets = source_targets(sizes.withColumn("source", named), weights, budget, max_repeat).withColumnsRenamed(
        {"source_rank": "__rank", "total": "__total"})
    targets = targets.withColumn("__source", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))).drop("source")
    offsets = totals.join(targets, "__source")

    inside = Window.partitionBy("__source", "__bucket").orderBy("__order")
    placed = small.withColumn("__inside", F.sum("size").over(inside)).join(offsets, ["__source", "__bucket"])
    cum = F.col("__before") + F.col("__inside")
    for copy in range(max_repeat):
        finish = (cum + copy * F.col("source_size")).cast("double") / F.col("target")
        placed = placed.withColumn(f"__f{copy}", F.when(F.col("size") > 0, finish))
    placed = staged(placed.select("__rid", "__rank", "__order", "__total", "size", "source_size", "target",
                                  *[f"__f{c}" for c in range(max_repeat)]), "mix-placed")

    last = _cut(placed, budget, max_repeat, n_buckets)
    copies = [F.when(_key(F.col(f"__f{c}")) <= last, F.col(f"__f{c}")) for c in range(max_repeat)]
    placed = placed.withColumn("finish_times", F.filter(F.array(*copies), lambda x: x.isNotNull()))
    taken = (F.col("size") * F.size("finish_times")).cast("long")
    return rows.select(*carried, "__rid"), placed.select("__rid", "size", "source_size", "target", taken.alias("taken"),
                                                         "finish_times")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, budget: tuple[int, int] = BUDGET,
        max_repeat: int = MAX_REPEAT, columns: Sequence[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (all of them, if not given) with size,
    source_size, target, taken and ``finish_times`` (the virtual finish times of
    the copies taken, in order).

    Needs columns doc_id, text and source. The order depends on them and the
    sizes alone, so reruns agree.
    """
    added = ("size", "source_size", "target", "taken", "finish_times")
    keep = [c for c in (docs.columns if columns is None else columns) if c.lower() not in added]
    rows, placed = _placed(docs, keep, weights, budget, max_repeat)
    return rows.join(placed, "__rid").drop("__rid")


def _key(finish: Column) -> Column:
    return F.when(finish.isNotNull(), F.struct(finish.alias("f"), F.col("__rank").alias("s"),
                                               F.col("__order").alias("o")))


def _cut(placed: DataFrame, budget: tuple[int, int], max_repeat: int, n_buckets: int) -> Column:
    """The last place in the global order within the budget, as a literal.

    Finish times are range-bucketed; the running total of the buckets and the
    one inside them give every copy's running total.
    """
    num, den = budget
    finishes = F.explode(F.array(*[_key(F.col(f"__f{c}")) for c in range(max_repeat)]))
    copies = placed.where("size > 0").select("size", "__total", finishes.alias("k"))
    copies = copies.withColumn("__r", F.floor(F.col("k.f") * n_buckets))
    ranges = copies.groupBy("__r").agg(F.sum("size").alias("__words"))
    ranges = ranges.select(F.col("__r").alias("__rr"), (F.sum("__words").over(Window.orderBy("__r"))
                                                      - F.col("__words")).alias("__before"))
    inside = Window.partitionBy("__r").orderBy("k")
    run = (copies.withColumn("__inside", F.sum("size").over(inside))
           .join(ranges, F.col("__r") == F.col("__rr"))
           .where((F.col("__before") + F.col("__inside")) * den <= F.col("__total") * num)
           .agg(F.max("k").alias("k")).head())
    if run is None or run.k is None:
        return F.lit(None)
    return F.struct(F.lit(run.k.f).alias("f"), F.lit(run.k.s).alias("s"), F.lit(run.k.o).alias("o"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: every taken copy of every document as a row of
    ``docs``, range-sorted by virtual finish time."""
    plain, restored = sheltered(docs, "doc_id", "text", "source")
    rows, placed = _placed(plain, plain.columns, WEIGHTS, BUDGET, MAX_REPEAT)
    copies = rows.join(placed.where(F.size("finish_times") > 0).select("__rid", "finish_times"), "__rid").select(
        *plain.columns, F.explode("finish_times").alias("__finish"))
    return copies.orderBy("__finish", "doc_id").select(*restored)
