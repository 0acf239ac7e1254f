"""TPC-H-shaped queries over the columns that the tables have."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.plans.registry import query
from lumenfold.sources.tables import table

Q1_SQL = """
SELECT l_returnflag, l_linestatus,
       round(sum(l_quantity), 2) AS sum_qty,
       round(sum(l_extendedprice), 2) AS sum_base_price,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price,
       round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge,
       round(avg(l_quantity), 4) AS avg_qty,
       round(avg(l_extendedprice), 4) AS avg_price,
       round(avg(l_discount), 6) AS avg_disc,
       count(*) AS count_order
FROM lineitem
WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00'
GROUP BY l_returnflag, l_linestatus
"""


def when(text: str):
    """A time without zone, as the tables have them."""
    return F.lit(text).cast("timestamp_ntz")


def discounted():
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


@query("q1_pricing_summary", Q1_SQL)
def q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_shipdate") <= when("1998-09-02 00:00:00"))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
            F.round(F.sum("l_extendedprice"), 2).alias("sum_base_price"),
            F.round(F.sum(discounted()), 2).alias("sum_disc_price"),
            F.round(F.sum(discounted() * (1 + F.col("l_tax"))), 2).alias("sum_charge"),
            F.round(F.avg("l_quantity"), 4).alias("avg_qty"),
            F.round(F.avg("l_extendedprice"), 4).alias("avg_price"),
            F.round(F.avg("l_discount"), 6).alias("avg_disc"),
            F.count(F.lit(1)).alias("count_order"),
        )
    )


Q3_SQL = """
SELECT l_orderkey, o_orderdate, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
WHERE c_mktsegment = 'BUILDING' AND o_orderdate < TIMESTAMP '1998-03-15 00:00:00' AND l_shipdate > TIMESTAMP '1998-03-15 00:00:00'
GROUP BY l_orderkey, o_orderdate
ORDER BY revenue DESC, o_orderdate, l_orderkey LIMIT 10
"""


@query("q3_shipping_priority", Q3_SQL)
def q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderdate") < when("1998-03-15 00:00:00"))
    lines = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") > when("1998-03-15 00:00:00"))
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customer, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    revenue = joined.groupBy("l_orderkey", "o_orderdate").agg(F.round(F.sum(discounted()), 2).alias("revenue"))
    return revenue.orderBy(F.desc("revenue"), "o_orderdate", "l_orderkey").limit(10)


Q5_SQL = """
SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name = 'ASIA' GROUP BY n_name
"""


@query("q5_local_supplier_volume", Q5_SQL)
def q5(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda name: table(spark, sf_dir, name)
    nations = read("nation").join(read("region").where("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    suppliers = read("supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    orders = read("orders").join(read("customer"), F.col("c_custkey") == F.col("o_custkey"))
    joined = read("lineitem").join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(orders, (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("c_nationkey") == F.col("s_nationkey")))
    return joined.groupBy("n_name").agg(F.round(F.sum(discounted()), 2).alias("revenue"))


Q6_SQL = """
SELECT round(sum(l_extendedprice * l_discount), 2) AS revenue FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1996-01-01 00:00:00' AND l_shipdate < TIMESTAMP '1997-01-01 00:00:00'
  AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24
"""


@query("q6_forecast_revenue", Q6_SQL)
def q6(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where((F.col("l_shipdate") >= when("1996-01-01 00:00:00")) & (F.col("l_shipdate") < when("1997-01-01 00:00:00")))
    return lines.where("l_discount BETWEEN 0.05D AND 0.07D AND l_quantity < 24").agg(F.round(F.sum(F.col("l_extendedprice") * F.col("l_discount")), 2).alias("revenue"))


Q14_SQL = """
SELECT round(100.0 * sum(CASE WHEN p_type LIKE 'PROMO%' THEN l_extendedprice * (1 - l_discount) ELSE 0 END) / sum(l_extendedprice * (1 - l_discount)), 6) AS promo_revenue
FROM lineitem JOIN part ON l_partkey = p_partkey
"""


@query("q14_promotion_effect", Q14_SQL)
def q14(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    promo = F.sum(F.when(F.col("p_type").startswith("PROMO"), discounted()).otherwise(0.0))
    return joined.agg(F.round(100.0 * promo / F.sum(discounted()), 6).alias("promo_revenue"))


Q18_SQL = """
SELECT c_name, c_custkey, o_orderkey, o_orderdate, o_totalprice, round(sum(l_quantity), 2) AS sum_qty
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING sum(l_quantity) > 200)
GROUP BY c_name, c_custkey, o_orderkey, o_orderdate, o_totalprice
"""


@query("q18_large_orders", Q18_SQL)
def q18(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The sum is needed per order anyway: one aggregation serves the filter and the output.
    sums = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("qty")).where("qty > 200")
    joined = sums.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    return joined.select("c_name", "c_custkey", "o_orderkey", "o_orderdate", "o_totalprice", F.round("qty", 2).alias("sum_qty"))
