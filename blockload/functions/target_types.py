"""Target typing: the JDBC type of each column, and a projection that makes
values fit those types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Java.sql.Types codes, and target type, precision and scale
# per Spark type (a decimal keeps its own precision and scale).
JDBC_CODES = {
    "INTEGER": 4, "BIGINT": -5, "DOUBLE": 8, "REAL": 7, "DECIMAL": 3, "DATE": 91,
    "TIMESTAMP": 93, "BIT": -7, "NVARCHAR": -9, "VARBINARY": -3, "TINYINT": -6,
    "SMALLINT": 5,
}
TARGET_TYPES = {
    T.IntegerType: ("INTEGER", 10, 0),
    T.LongType: ("BIGINT", 19, 0),
    T.DoubleType: ("DOUBLE", 15, 0),
    T.FloatType: ("REAL", 7, 0),
    T.DateType: ("DATE", 10, 0),
    T.TimestampType: ("TIMESTAMP", 23, 3),
    T.TimestampNTZType: ("TIMESTAMP", 23, 3),
    T.BooleanType: ("BIT", 1, 0),
    T.StringType: ("NVARCHAR", 4000, 0),
    T.BinaryType: ("VARBINARY", 8000, 0),
    T.ByteType: ("TINYINT", 3, 0),
    T.ShortType: ("SMALLINT", 5, 0),
}
NESTED = (T.ArrayType, T.MapType, T.StructType)
MAX_STRING_CHARS = 4000
MAX_BINARY_BYTES = 8000


def target_type(dtype: T.DataType) -> tuple[str, int, int]:
    if isinstance(dtype, T.DecimalType):
        return ("DECIMAL", dtype.precision, dtype.scale)
    if isinstance(dtype, NESTED):
        return ("NVARCHAR", MAX_STRING_CHARS, 0)  # sent as JSON text
    for cls, spec in TARGET_TYPES.items():
        if isinstance(dtype, cls):
            return spec
    raise TypeError(f"type {dtype.simpleString()} has no target type")


def target_columns(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """One row per column: ordinal (1-based), name, target type, its
    JDBC code, precision and scale. Raises for types with no target."""
    rows = []
    for i, f in enumerate(schema.fields, start=1):
        name, precision, scale = target_type(f.dataType)
        rows.append((i, f.name, name, JDBC_CODES[name], precision, scale))
    out = T.StructType([
        T.StructField("ordinal", T.IntegerType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("jdbc_type", T.StringType(), False),
        T.StructField("jdbc_code", T.IntegerType(), False),
        T.StructField("precision", T.IntegerType(), False),
        T.StructField("scale", T.IntegerType(), False),
    ])
    return spark.createDataFrame(rows, out)


def target_report(df: DataFrame) -> DataFrame:
    """O27 over data: the target typing of each column of ``df`` with its
    number of non-null values, from one aggregation over the whole frame."""
    spark = df.sparkSession
    counts = df.agg(*[F.count(df[c]).alias(f"_c{i}") for i, c in enumerate(df.columns)])
    per_column = counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("_name"), F.col(f"_c{i}").alias("n_values")) for i, c in enumerate(df.columns)
    ])))
    types = target_columns(spark, df.schema)
    return types.join(F.broadcast(per_column), types["column_name"] == per_column["_name"], "inner").drop("_name")


def truncate_to_millis(c: Column) -> Column:
    """Cut a timestamp (with or without time zone) to milliseconds, keeping
    its type. Pure arithmetic on the micros of the second, so no time zone
    conversion takes place."""
    micros_of_ms = (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long") % 1000
    return F.timestamp_add("MICROSECOND", -micros_of_ms, c)


def to_target_values(df: DataFrame, millis: bool = True) -> DataFrame:
    """Values that fit the target types. Bytes and shorts widen to int,
    timestamps are cut to milliseconds (unless the target keeps more,
    ``millis=False``), arrays, maps and structs become JSON text, null stays
    null. Other types are refused before any job runs."""
    cols = []
    for f in df.schema.fields:
        c, t = df[f.name], f.dataType
        if isinstance(t, (T.ByteType, T.ShortType)):
            c = c.cast("int")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = truncate_to_millis(c) if millis else c
        elif isinstance(t, NESTED):
            c = F.to_json(c)
        else:
            target_type(t)  # raises for unsupported types
        cols.append(c.alias(f.name))
    return df.select(*cols)


def too_long(df: DataFrame) -> Column:
    """Whether a row (of target values) has a string or binary value longer than
    the target's type."""
    found = F.lit(False)
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            found = found | F.coalesce(F.length(df[f.name]) > MAX_STRING_CHARS, F.lit(False))
        elif isinstance(f.dataType, T.BinaryType):
            found = found | F.coalesce(F.octet_length(df[f.name]) > MAX_BINARY_BYTES, F.lit(False))
    return found


def declared_types(schema: T.StructType) -> str:
    """The string columns with their length, as Spark's JDBC writer takes types
    for a table that it creates."""
    return ", ".join(f"`{f.name}` VARCHAR({MAX_STRING_CHARS})" for f in schema.fields
                     if isinstance(f.dataType, T.StringType))


def fit_report(df: DataFrame) -> DataFrame:
    """Per string or binary column, the number of values and how many
    are longer than the target allows (4000 characters, 8000 bytes).
    One aggregation over the whole frame, then one row per column."""
    checks = [
        (f.name, MAX_STRING_CHARS if isinstance(f.dataType, T.StringType) else MAX_BINARY_BYTES)
        for f in df.schema.fields
        if isinstance(f.dataType, (T.StringType, T.BinaryType))
    ]
    if not checks:
        raise ValueError("no string or binary column to check")
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, (name, limit) in enumerate(checks):
        aggs.append(F.count(F.when(F.length(df[name]) > limit, 1)).alias(f"_x{i}"))
    totals = df.agg(*aggs)
    rows = F.inline(F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col("_n").alias("n_values"),
                 F.col(f"_x{i}").alias("n_too_long"))
        for i, (name, _) in enumerate(checks)
    ]))
    return totals.select(rows)
