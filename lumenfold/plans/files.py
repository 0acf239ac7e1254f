"""Sources and sinks: tables written in each format and read back, a Python source, a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumenfold.plans.registry import query
from lumenfold.sources import files
from lumenfold.sources.tables import scratch_path, table
from lumenfold.streaming import events as E

ORDERS = "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"


def _round_trip(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    path = scratch_path(spark, f"orders-{kind}")
    files.write(orders, path, kind)
    return files.read(spark, path, kind, orders.schema)


for _kind in ("csv", "json", "orc", "parquet"):
    query(f"src2_{_kind}", ORDERS)(lambda spark, sf_dir, kind=_kind: _round_trip(spark, sf_dir, kind))


@query("src2_text", "SELECT p_name AS value FROM part")
def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "names-text")
    files.write(table(spark, sf_dir, "part").selectExpr("p_name AS value"), path, "text")
    return files.read(spark, path, "text")


@query("src2_partitioned", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus <> 'O' GROUP BY o_orderstatus")
def partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders by status: the filter picks folders, and no file of the others is opened."""
    path = scratch_path(spark, "orders-by-status")
    files.write(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), path, "parquet", partition_by=("o_orderstatus",))
    return files.read(spark, path, "parquet").where("o_orderstatus <> 'O'").groupBy("o_orderstatus").count().withColumnRenamed("count", "n")


@query("src3_custom_source", "SELECT n::BIGINT AS n, (n * n)::BIGINT AS square FROM range(900, 1000) t(n) WHERE n % 7 <> 0")
def custom_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source takes the bounds on n into its partitions; Spark applies the rest of the filter."""
    spark.dataSource.register(files.BoundedSquares)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("bounded_squares").option("rows", "1000").load().where("n >= 900 AND n % 7 <> 0")


@query("src4_stream_files", "SELECT event_id, user_id, event_type, value FROM events")
def stream_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = E.event_stream(spark, sf_dir).select("event_id", "user_id", "event_type", "value")
    return E.run_through_files(spark, stream, scratch_path(spark, "src4"))


@query("src3_row_groups", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 300000 AND o_orderstatus <> 'P'")
def row_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders by a source in Python, which takes the bound on the price and leaves the other filter to Spark."""
    spark.dataSource.register(files.RowGroups)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("row_groups").load(f"{sf_dir}/orders.parquet").where("o_totalprice > 300000 AND o_orderstatus <> 'P'").select("o_orderkey", "o_custkey", "o_totalprice")
