"""JDBC target: Derby in memory, inside the Spark JVM (no server, no port).
Only this process sees that database, which is all a test needs."""

import datetime as dt

from pyspark.sql import functions as F

from blockload.config import LoadConfig
from blockload.operators import ledger as L
from blockload.plans.flows import run_load_with_retry, with_paths
from blockload.sources.target import jdbc_count_query, run_key, target_view
from blockload.testing import failing_blocks

DERBY = {"url": "jdbc:derby:memory:blockload_t;create=true",
         "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_jdbc_load_with_fault_and_retry(spark, tables):
    o = tables("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    cfg = with_paths(spark, LoadConfig(
        target="ORDERS_T", target_format="jdbc", jdbc_options=DERBY, threshold=0, block_size=400,
        block_key="o_custkey", blocks_on="keys", process_name="jdbc", scope="s", run_date=dt.date(2024, 3, 3),
        retry_delay_s=0.0, max_retry_delay_s=0.0, max_connections=2))
    with failing_blocks({2: 8}):
        res = run_load_with_retry(o, cfg)
    assert res.success and res.total_blocks == 4
    state = L.ledger_state(L.read_ledger(spark, cfg.ledger_path))
    view = target_view(spark, cfg, state)
    cols = sorted(o.columns)
    assert view.count() == o.count()
    assert view.select(*cols).exceptAll(o.select(*cols)).count() == 0


def test_jdbc_view_hides_rows_of_unfinished_attempts(spark, tables):
    """Rows of an attempt that is not SUCCESS in the ledger stay invisible."""
    c = tables("customer").select("c_custkey", "c_name")
    cfg = with_paths(spark, LoadConfig(target="CUST_T", target_format="jdbc", jdbc_options=DERBY,
                                       process_name="j2", scope="s", run_date=dt.date(2024, 3, 4)))
    assert run_load_with_retry(c, cfg).success
    # A stray copy of every row under an attempt the ledger never finished.
    stray = c.withColumn("_run", F.lit(run_key("j2", "s", dt.date(2024, 3, 4)))).withColumn("_block", F.lit(1)).withColumn(
        "_attempt", F.lit(99))
    stray.write.format("jdbc").options(**DERBY).option("dbtable", "CUST_T").mode("append").save()
    state = L.ledger_state(L.read_ledger(spark, cfg.ledger_path))
    assert target_view(spark, cfg, state).count() == c.count()
    raw = spark.read.format("jdbc").options(**DERBY).option("dbtable", "CUST_T").load()
    assert raw.count() == 2 * c.count()


def test_plain_append_to_an_existing_table(spark, tables):
    """A table without the run, block and attempt columns, only when asked."""
    c = tables("customer").select("c_custkey", "c_name")
    c.limit(0).write.format("jdbc").options(**DERBY).option("dbtable", "PLAIN_T").mode("append").save()
    cfg = with_paths(spark, LoadConfig(target="PLAIN_T", target_format="jdbc", jdbc_options=DERBY, plain_append=True,
                                       process_name="j3", scope="s", run_date=dt.date(2024, 3, 5)))
    assert run_load_with_retry(c, cfg).success
    raw = spark.read.format("jdbc").options(**DERBY).option("dbtable", "PLAIN_T").load()
    assert sorted(raw.columns) == ["c_custkey", "c_name"] and raw.exceptAll(c).count() == 0 and raw.count() == c.count()


def test_counts_are_grouped_in_the_database(spark):
    cfg = LoadConfig(target="T", target_format="jdbc", jdbc_options=DERBY)
    key = run_key("a'b", "c", dt.date(2024, 1, 1))
    text = jdbc_count_query(spark, cfg, key, {1: 2, 5: 1})
    assert text == ('SELECT "_block" AS block_id, COUNT(*) AS n_rows FROM T WHERE "_run" = '
                    f"\'{key}\'" ' AND (("_block" = 1 AND "_attempt" = 2) OR ("_block" = 5 AND "_attempt" = 1)) '
                    'GROUP BY "_block"')
    assert "'" not in key
