"""Load blocks into the target, once per block.

Parquet target: partitioned by run and block and written with dynamic
partition overwrite, so a repeated block replaces its own folder and leaves
the others alone.

JDBC target: Spark commits each task by itself, so a failed job can leave
part of a block behind. Rows therefore carry run, block and attempt, and a
reader sees a row only if the ledger holds that attempt of that block as
SUCCESS (``target_view``). The rows of an attempt are counted after the
write; a count that differs from the landing fails the block, which is then
tried again under a new attempt.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
from collections.abc import Mapping, Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockload.config import ATTEMPT_COL, BLOCK_COL, RUN_COL, SUCCESS, LoadConfig
from blockload.functions.columns import check_names
from blockload.functions.target_types import declared_types, to_target_values, too_long
from blockload.operators.ledger import ledger_state, read_ledger
from blockload.session import existing, path_exists, remove_path


def encoded(part: str) -> str:
    """A name as one folder or key part: letters, digits, ``_``, ``-`` and ``.``
    stay, every other byte becomes ``~`` and two hex digits."""
    return quote(part, safe="").replace("~", "%7E").replace("%", "~")


def run_key(process_name: str, scope: str, run_date: dt.date) -> str:
    """One key for each (process, scope, date): ``~~`` is in no encoded part."""
    return f"{encoded(process_name)}~~{encoded(scope)}~~{run_date.isoformat()}"


def _encoded_col(c: Column) -> Column:
    out = F.url_encode(c)
    for a, b in (("%", "~"), ("+", "~20"), ("*", "~2A")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def run_key_col(process: Column, scope: Column, run_date: Column) -> Column:
    return F.concat_ws("~~", _encoded_col(process), _encoded_col(scope), F.date_format(run_date, "yyyy-MM-dd"))


def _jdbc_writer_options(cfg: LoadConfig, schema: T.StructType) -> dict[str, str]:
    opts = dict(cfg.jdbc_options)
    opts.setdefault("dbtable", cfg.target)
    opts.setdefault("numPartitions", str(cfg.max_connections))
    opts.setdefault("queryTimeout", str(cfg.query_timeout_s))
    # Used only if Spark creates the table: strings of a length, and a comparable
    # run key (some databases store Spark strings as CLOB, which takes no filter).
    own = [declared_types(T.StructType([f for f in schema.fields if f.name != RUN_COL])),
           f"{RUN_COL} VARCHAR(400)" if RUN_COL in schema.names else ""]
    if any(own):
        opts.setdefault("createTableColumnTypes", ", ".join(t for t in own if t))
    if cfg.chunk_rows > 0:
        opts.setdefault("batchsize", str(cfg.chunk_rows))
    return opts


def _attempt_of(block: Column, attempts: Mapping[int, int]) -> Column:
    pairs = []
    for b, a in sorted(attempts.items()):
        pairs += [F.lit(int(b)), F.lit(int(a))]
    return F.element_at(F.create_map(*pairs), block) if pairs else F.lit(0)


def load_blocks(blocks: DataFrame, block_ids: Sequence[int], cfg: LoadConfig, key: str,
                attempts: Mapping[int, int], *, block_col: str = BLOCK_COL) -> DataFrame:
    """Write the blocks ``block_ids`` of ``blocks`` (a frame with a block
    column) to the target as one Spark job. Returns, lazily, the rows per
    block now in the target for this run (and attempt): (block_id, n_rows)."""
    spark = blocks.sparkSession
    ids = sorted({int(b) for b in block_ids})
    part = blocks.filter(F.col(block_col).isin(ids))
    data_cols = [c for c in part.columns if c != block_col]
    check_names(part.select(*data_cols).schema, (RUN_COL, BLOCK_COL, ATTEMPT_COL))
    part = to_target_values(part.select(*data_cols, F.col(block_col).alias(BLOCK_COL)), cfg.cuts_to_millis)
    if cfg.rejects_too_long:
        part = _rejected(part, cfg, key, ids, attempts)
    if cfg.target_format == "jdbc" and cfg.plain_append:
        rows = part.drop(BLOCK_COL)
        rows.write.format("jdbc").options(**_jdbc_writer_options(cfg, rows.schema)).mode("append").save()
        # Nothing in the table tells these rows from others: what was sent counts.
        return part.groupBy(F.col(BLOCK_COL).alias("block_id")).agg(F.count(F.lit(1)).alias("n_rows"))
    out = part.withColumn(RUN_COL, F.lit(key))
    if cfg.target_format == "jdbc":
        out = out.withColumn(ATTEMPT_COL, _attempt_of(F.col(BLOCK_COL), attempts).cast("int"))
        out.write.format("jdbc").options(**_jdbc_writer_options(cfg, out.schema)).mode("append").save()
    else:
        known = _target_schema(spark, cfg.target)
        out = _as_the_target_spells(out, known)
        _replace_blocks(out, cfg.target, key, ids, attempts)
        _record_schema(spark, cfg.target, known, out.schema)
    return written_counts(spark, cfg, key, ids, attempts)


def _replace_blocks(rows: DataFrame, target: str, key: str, ids: Sequence[int], attempts: Mapping[int, int]) -> None:
    spark = rows.sparkSession
    again = [b for b in ids if attempts.get(b, 1) > 1]  # a repeat that has no rows would leave the last try's behind
    for folder in existing(spark, [_block_path(target, key, b) for a in again for b in (a, -a)]):
        remove_path(spark, folder)
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(RUN_COL, BLOCK_COL).parquet(target))


def _rejected(part: DataFrame, cfg: LoadConfig, key: str, ids: Sequence[int], attempts: Mapping[int, int]) -> DataFrame:
    """Rows with too long values go under the negative number of their block:
    into the target's own folders with the same write, or, for JDBC, into
    ``rejects_path``, and only the others are returned."""
    long = too_long(part)
    if cfg.target_format != "jdbc":
        return part.withColumn(BLOCK_COL, F.when(long, -F.col(BLOCK_COL)).otherwise(F.col(BLOCK_COL)))
    if not cfg.rejects_path:
        raise ValueError("rejects_too_long needs a rejects_path for a JDBC target")
    out = part.where(long).withColumn(BLOCK_COL, -F.col(BLOCK_COL)).withColumn(RUN_COL, F.lit(key))
    known = _target_schema(part.sparkSession, cfg.rejects_path)
    out = _as_the_target_spells(out, known)
    _replace_blocks(out, cfg.rejects_path, key, ids, attempts)
    _record_schema(part.sparkSession, cfg.rejects_path, known, out.schema)
    return part.where(~long)


def _block_path(target: str, key: str, block: int) -> str:
    return f"{target}/{RUN_COL}={key}/{BLOCK_COL}={block}"


_SCHEMA_RECORD = "_schema"
_RECORDING = threading.Lock()


def _as_the_target_spells(rows: DataFrame, known: T.StructType | None) -> DataFrame:
    """``rows`` with the target's spelling of the columns that it has (names
    are the same whatever their case). A column with another type than there
    raises, before anything is written: the target could not be read any more."""
    fields = {f.name.lower(): f for f in known.fields} if known else {}
    cols = []
    for f in rows.schema.fields:
        there = fields.get(f.name.lower(), f)
        if there.dataType != f.dataType:
            raise ValueError(f"column {f.name} is {f.dataType.simpleString()} here and "
                             f"{there.dataType.simpleString()} in the target")
        cols.append(rows[f.name].alias(there.name))
    return rows.select(*cols)


def _record_schema(spark: SparkSession, target: str, known: T.StructType | None, schema: T.StructType) -> None:
    """Keep the target's schema beside its data (a hidden folder Spark does
    not read as data): blocks with no rows write no file, and a target of
    empty blocks must still read with its columns. Columns that a run adds are
    added to the record, once their first rows are written."""
    names = {f.name for f in known.fields} if known else set()
    with _RECORDING:   # waves of one driver append one after the other
        _append_schema(spark, target, known, schema, names)


def _append_schema(spark: SparkSession, target: str, known: T.StructType | None, schema: T.StructType,
                   names: set[str]) -> None:
    new = [T.StructField(f.name, f.dataType) for f in schema.fields if f.name not in names]
    if known is None or new:
        merged = T.StructType([*(known.fields if known else []), *new])
        (spark.createDataFrame([(len(merged), merged.json())], "width INT, schema STRING").coalesce(1)
         .write.mode("append").json(f"{target}/{_SCHEMA_RECORD}"))


def _target_schema(spark: SparkSession, target: str) -> T.StructType | None:
    """What the records say together: each holds the columns known then and
    those that it adds, so the widest comes first and others only add."""
    if not path_exists(spark, f"{target}/{_SCHEMA_RECORD}"):
        return None
    rows = (spark.read.schema("width INT, schema STRING").json(f"{target}/{_SCHEMA_RECORD}").distinct()
            .orderBy(F.desc("width"), "schema").collect())   # a row for each time that columns were added
    fields: dict[str, T.StructField] = {}
    for row in rows:
        for f in T.StructType.fromJson(json.loads(row["schema"])).fields:
            fields.setdefault(f.name.lower(), f)
    return T.StructType(list(fields.values())) if fields else None


def _read_jdbc(spark: SparkSession, cfg: LoadConfig, **extra: str) -> DataFrame:
    opts = {k: v for k, v in cfg.jdbc_options.items() if not (k == "dbtable" and "query" in extra)}
    if "query" not in extra:
        opts.setdefault("dbtable", cfg.target)
    return spark.read.format("jdbc").options(**(opts | extra)).load()


def _read_parquet(spark: SparkSession, target: str, paths: Sequence[str] = ()) -> DataFrame:
    schema = _target_schema(spark, target)
    reader = (spark.read.schema(schema) if schema else spark.read).option("basePath", target)
    return reader.parquet(*(paths or [target]))


def jdbc_count_query(spark: SparkSession, cfg: LoadConfig, key: str, attempts: Mapping[int, int]) -> str:
    """Rows per block of these attempts, counted in the database. The key and
    the numbers are of a closed alphabet; names are quoted by the dialect."""
    dialect = spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(cfg.jdbc_options["url"])
    run, block, attempt = (dialect.quoteIdentifier(c) for c in (RUN_COL, BLOCK_COL, ATTEMPT_COL))
    tries = " OR ".join(f"({block} = {int(b)} AND {attempt} = {int(a)})" for b, a in sorted(attempts.items()))
    table = cfg.jdbc_options.get("dbtable", cfg.target)
    return (f"SELECT {block} AS block_id, COUNT(*) AS n_rows FROM {table} "
            f"WHERE {run} = '{key}' AND ({tries}) GROUP BY {block}")


def written_counts(spark: SparkSession, cfg: LoadConfig, key: str, block_ids: Sequence[int],
                   attempts: Mapping[int, int]) -> DataFrame:
    """Rows per block of this run in the target, counted on what is there: only
    the folders of these blocks are listed, or the database counts. Rejected
    rows count under the negative number of their block."""
    ids = [int(b) for b in block_ids]
    if cfg.target_format == "jdbc":
        t = _read_jdbc(spark, cfg, query=jdbc_count_query(spark, cfg, key, {b: attempts[b] for b in ids}))
        t = t.toDF("block_id", "n_rows").select(F.col("block_id").cast("int"), F.col("n_rows").cast("long"))
        return t.unionByName(_counted(spark, cfg.rejects_path, key, [-b for b in ids])) if cfg.rejects_too_long else t
    return _counted(spark, cfg.target, key, ids + ([-b for b in ids] if cfg.rejects_too_long else []))


def _counted(spark: SparkSession, target: str, key: str, folders: Sequence[int]) -> DataFrame:
    paths = existing(spark, [_block_path(target, key, b) for b in folders])
    if not paths:
        return spark.createDataFrame([], "block_id INT, n_rows BIGINT")
    t = _read_parquet(spark, target, paths)
    return t.groupBy(F.col(BLOCK_COL).cast("int").alias("block_id")).agg(F.count(F.lit(1)).alias("n_rows"))


def _loaded(spark: SparkSession, cfg: LoadConfig, state: DataFrame | None) -> DataFrame:
    """Run key, block and attempt of the blocks that are SUCCESS."""
    if state is None:
        if not cfg.ledger_path:
            raise ValueError("a target is read through its ledger: give the state or cfg.ledger_path")
        state = ledger_state(read_ledger(spark, cfg.ledger_path))
    return state.filter(F.col("status") == SUCCESS).select(
        run_key_col(F.col("process_name"), F.col("scope"), F.col("run_date")).alias("_k"),
        F.col("block_id").alias("_b"), F.col("attempt").alias("_a"))


def reject_view(spark: SparkSession, cfg: LoadConfig, state: DataFrame | None = None) -> DataFrame:
    """The rejected rows of the blocks that are SUCCESS, source columns only."""
    ok = _loaded(spark, cfg, state)
    t = _read_parquet(spark, cfg.rejects_path if cfg.target_format == "jdbc" else cfg.target).where(F.col(BLOCK_COL) < 0)
    return t.join(ok, (t[RUN_COL] == ok["_k"]) & (-t[BLOCK_COL] == ok["_b"]), "left_semi").drop(RUN_COL, BLOCK_COL)


def target_view(spark: SparkSession, cfg: LoadConfig, state: DataFrame | None = None) -> DataFrame:
    """What a reader of the target sees: source columns only, of blocks that
    the ledger ``state`` (by default that of ``cfg.ledger_path``) holds as
    SUCCESS; for JDBC, only the attempt that succeeded."""
    ok = _loaded(spark, cfg, state)
    if cfg.target_format == "jdbc":
        last = ok.withColumnRenamed("_b", "block_id").agg(F.max("block_id")).first()[0] or 1
        t = _read_jdbc(spark, cfg, partitionColumn=BLOCK_COL, lowerBound="1", upperBound=str(last + 1),
                       numPartitions=str(max(1, cfg.max_connections)))
        t = t.join(ok, (t[RUN_COL] == ok["_k"]) & (t[BLOCK_COL] == ok["_b"]) & (t[ATTEMPT_COL] == ok["_a"]),
                   "left_semi")
        return t.drop(RUN_COL, BLOCK_COL, ATTEMPT_COL)
    t = _read_parquet(spark, cfg.target)
    t = t.join(ok, (t[RUN_COL] == ok["_k"]) & (t[BLOCK_COL] == ok["_b"]), "left_semi")
    return t.drop(RUN_COL, BLOCK_COL)
