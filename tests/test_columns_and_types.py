"""Names, checks and target typing."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockload.functions.columns import check_block_column, check_request, exclude_columns, resolve_columns
from blockload.functions.target_types import fit_report, target_columns, to_target_values
from blockload.sources.read import read_source


def test_resolve_columns_ignores_case_and_keeps_order(tables):
    o = tables("orders")
    s = resolve_columns(o, ["O_TOTALPRICE", "o_orderkey"])
    assert s.fieldNames() == ["o_totalprice", "o_orderkey"]
    assert isinstance(s["o_orderkey"].dataType, T.LongType)


def test_resolve_columns_errors(spark, tables):
    with pytest.raises(ValueError, match="not found"):
        resolve_columns(tables("orders"), ["nope"])
    df = spark.createDataFrame([(1, 2)], "a INT, b INT").toDF("Col", "col")
    with pytest.raises(ValueError, match="ambiguous"):
        resolve_columns(df, ["COL"])


def test_exclude_columns(tables):
    o = tables("orders")
    assert exclude_columns(o, ["O_ORDERSTATUS", "missing", "Id"]).columns == [
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"]
    assert exclude_columns(o).columns == o.columns


def test_check_request(tables):
    o = tables("orders")
    check_request(o, path="x", n_blocks=3, columns=["o_orderkey"], block_col="o_custkey")
    for kwargs in [dict(path=""), dict(n_blocks=0), dict(columns=[]), dict(uses_ledger=True, scope="s")]:
        with pytest.raises(ValueError):
            check_request(o, **kwargs)
    with pytest.raises(ValueError):
        check_block_column(o.schema, "bad name; drop")
    with pytest.raises(ValueError):
        check_block_column(o.schema, "no_such_col")
    assert check_block_column(o.schema, "O_CUSTKEY") == "o_custkey"


def test_read_source_by_name_and_path(spark, tables):
    tables("nation").createOrReplaceTempView("nation_t")
    assert read_source(spark, "nation_t").count() == 25
    assert read_source(spark, "/root/testdata/sf0.001/nation.parquet").count() == 25
    with pytest.raises(ValueError):
        read_source(spark, "")


ALL_TYPES = T.StructType([
    T.StructField("b", T.ByteType()), T.StructField("s", T.ShortType()), T.StructField("i", T.IntegerType()),
    T.StructField("l", T.LongType()), T.StructField("f", T.FloatType()), T.StructField("d", T.DoubleType()),
    T.StructField("dec", T.DecimalType(18, 4)), T.StructField("dt", T.DateType()),
    T.StructField("ts", T.TimestampType()), T.StructField("ntz", T.TimestampNTZType()),
    T.StructField("bo", T.BooleanType()), T.StructField("str", T.StringType()),
    T.StructField("bin", T.BinaryType()), T.StructField("arr", T.ArrayType(T.IntegerType())),
])


def _one_of_each(spark):
    ts = dt.datetime(2024, 3, 1, 12, 30, 45, 123456)
    row = (-1, -300, 7, 2**40, 1.5, 2.25, decimal.Decimal("12.3456"), dt.date(2024, 3, 1), ts, ts, True, "x",
           b"\x00\x01", [1, 2])
    return spark.createDataFrame([row, tuple([None] * len(row))], ALL_TYPES)


def test_target_columns(spark):
    rows = target_columns(spark, ALL_TYPES).collect()
    got = {r["column_name"]: (r["jdbc_type"], r["precision"], r["scale"]) for r in rows}
    assert got["b"] == ("TINYINT", 3, 0) and got["s"] == ("SMALLINT", 5, 0)
    assert got["dec"] == ("DECIMAL", 18, 4) and got["ntz"] == ("TIMESTAMP", 23, 3)
    assert got["arr"] == ("NVARCHAR", 4000, 0)
    assert [r["ordinal"] for r in rows] == list(range(1, len(ALL_TYPES.fields) + 1))


def test_to_target_values(spark):
    out = to_target_values(_one_of_each(spark))
    types = {f.name: f.dataType for f in out.schema.fields}
    assert isinstance(types["b"], T.IntegerType) and isinstance(types["s"], T.IntegerType)
    assert isinstance(types["ntz"], T.TimestampNTZType) and isinstance(types["ts"], T.TimestampType)
    full, empty = sorted(out.collect(), key=lambda r: r["i"] is None)
    assert full["b"] == -1 and full["s"] == -300
    assert full["ntz"] == dt.datetime(2024, 3, 1, 12, 30, 45, 123000)
    assert full["ts"] == dt.datetime(2024, 3, 1, 12, 30, 45, 123000)
    assert full["arr"] == "[1,2]"
    assert all(v is None for v in empty.asDict().values())


def test_to_target_values_refuses_intervals(spark):
    df = spark.range(1).select(F.expr("INTERVAL '1' DAY").alias("iv"))
    with pytest.raises(TypeError):
        to_target_values(df)


def test_fit_report(spark):
    df = spark.createDataFrame([("a" * 4001, b"x" * 8001), ("b", None), (None, b"y")], "t STRING, bin BINARY")
    got = {r["column_name"]: (r["n_values"], r["n_too_long"]) for r in fit_report(df).collect()}
    assert got == {"t": (3, 1), "bin": (3, 1)}
