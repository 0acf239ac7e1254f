"""Joins, set operations, sorts and recursive queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.operators.joins import as_of_join, band_join
from lumenfold.operators.windows import top_k_per_group
from lumenfold.plans.registry import query
from lumenfold.sources.tables import table


SE4_ALL = """
WITH RECURSIVE c AS (SELECT (year(o_orderdate) * 12 + month(o_orderdate) - 1)::INTEGER AS m, count(*) AS n FROM orders GROUP BY ALL),
months(m) AS (SELECT min(m) FROM c UNION ALL SELECT m + 1 FROM months WHERE m < (SELECT max(m) FROM c))
SELECT months.m, coalesce(n, 0) AS n FROM months LEFT JOIN c ON months.m = c.m
"""


@query("prj1_filter_project", "SELECT o_orderkey, upper(o_orderpriority) AS priority, o_totalprice * 1.5 AS with_tax FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000")
def filter_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'F' AND o_totalprice > 1000")
    return orders.select("o_orderkey", F.upper("o_orderpriority").alias("priority"), (F.col("o_totalprice") * 1.5).alias("with_tax"))


@query("prj2_sample")
def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stratified sample: other shares of each event type, the same rows for the same seed."""
    return table(spark, sf_dir, "events").sampleBy("event_type", {"click": 0.1, "purchase": 0.5, "view": 0.2}, seed=7)


@query("prj2_tablesample", "SELECT 100::BIGINT AS n")
def tablesample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql("SELECT count(*) AS n FROM (SELECT * FROM {events} TABLESAMPLE (100 ROWS))", events=table(spark, sf_dir, "events"))


@query("prj2_bottom_k", "SELECT event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY md5('7:' || event_id), event_id) <= 50")
def bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stratified sample of exact size: the fifty least salted hashes of each event type. Tasks keep fifty rows a
    type before the shuffle, and samples of parts merge into the sample of the whole."""
    events = table(spark, sf_dir, "events").select("event_type", "event_id")
    salted = F.md5(F.concat(F.lit("7:"), F.col("event_id")))
    return top_k_per_group(events, ["event_type"], [salted, F.col("event_id")], 50).select("event_type", "event_id")


@query("se4_all_months", SE4_ALL)
def all_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recursion to the last month that has orders, whichever it is; orders meet the months by number."""
    orders = table(spark, sf_dir, "orders")
    number = (F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1).alias("m")
    counts = orders.select(number).groupBy("m").agg(F.count(F.lit(1)).alias("n"))
    # Recursion gives up after 100 rounds by default.
    months = spark.sql("WITH RECURSIVE span AS (SELECT min(m) AS first, max(m) AS last FROM {counts}), months(m, last) MAX RECURSION LEVEL 5000 AS (SELECT first, last FROM span UNION ALL SELECT m + 1, last FROM months WHERE m < last) SELECT m FROM months", counts=counts)
    return months.join(counts, "m", "left").select("m", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


@query("prj3_pipe_sql", "SELECT event_type, count(*) AS n FROM events WHERE value > 10 GROUP BY event_type")
def pipe_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql("FROM {events} |> WHERE value > 10 |> AGGREGATE count(*) AS n GROUP BY event_type", events=table(spark, sf_dir, "events"))


@query("jn1_inner", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 200000")
def inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where("o_totalprice > 200000")
    return orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query("jn2_left_outer", "SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 300000 GROUP BY c_custkey")
def left_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The right side is counted before the join: at most one row a customer meets it.
    counts = table(spark, sf_dir, "orders").where("o_totalprice > 300000").groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"))
    joined = table(spark, sf_dir, "customer").join(counts, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


@query("jn2_full_outer", "SELECT c_custkey, s_suppkey FROM customer FULL JOIN supplier ON c_custkey = 20 * s_suppkey")
def full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """There are 15 customers to a supplier, so at every scale both sides have rows without a partner."""
    customers, suppliers = table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "supplier").select("s_suppkey")
    return customers.join(suppliers, F.col("c_custkey") == 20 * F.col("s_suppkey"), "full")


@query("jn3_left_semi", "SELECT o_orderkey, o_totalprice FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity >= 50)")
def left_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where("l_quantity >= 50")
    return table(spark, sf_dir, "orders").join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").select("o_orderkey", "o_totalprice")


@query("jn4_left_anti", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def left_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'")
    return table(spark, sf_dir, "customer").join(orders, F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey", "c_name")


JN4 = "SELECT c_custkey FROM {customer} WHERE nullif(c_nationkey, 3) NOT IN (SELECT s_nationkey FROM {supplier} WHERE s_acctbal > 9000)"


@query("jn4_not_in", JN4.format(customer="customer", supplier="supplier"))
def not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NOT IN with nulls on the left: neither in nor not in, so such rows go."""
    return spark.sql(JN4, customer=table(spark, sf_dir, "customer"), supplier=table(spark, sf_dir, "supplier"))


@query("jn4_not_in_nulls", "SELECT c_custkey FROM customer WHERE c_nationkey NOT IN (SELECT nullif(s_nationkey, 3) FROM supplier)")
def not_in_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NOT IN with nulls on the right: no row passes."""
    return spark.sql("SELECT c_custkey FROM {customer} WHERE c_nationkey NOT IN (SELECT nullif(s_nationkey, 3) FROM {supplier})", customer=table(spark, sf_dir, "customer"), supplier=table(spark, sf_dir, "supplier"))


@query("jn5_band_join", "SELECT s_suppkey, p_partkey FROM supplier JOIN part ON s_acctbal BETWEEN p_retailprice - 1 AND p_retailprice + 1")
def band(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = band_join(table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part"), F.col("s_acctbal"), F.col("p_retailprice") - 1, F.col("p_retailprice") + 1, width=8.0)
    return joined.select("s_suppkey", "p_partkey")


@query("jn6_cross_join", "SELECT r_name, n_name FROM region CROSS JOIN nation")
def cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").crossJoin(table(spark, sf_dir, "nation")).select("r_name", "n_name")


@query("jn7_natural_join", "SELECT n_name, r_name FROM (SELECT n_name, n_regionkey AS k FROM nation) NATURAL JOIN (SELECT r_name, r_regionkey AS k FROM region)")
def natural(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        "SELECT n_name, r_name FROM (SELECT n_name, n_regionkey AS k FROM {nation}) NATURAL JOIN (SELECT r_name, r_regionkey AS k FROM {region})",
        nation=table(spark, sf_dir, "nation"), region=table(spark, sf_dir, "region"),
    )


JN8 = "SELECT o_orderkey, o_totalprice FROM {orders} o WHERE o_totalprice > (SELECT 1.5 * avg(i.o_totalprice) FROM {orders} i WHERE i.o_custkey = o.o_custkey)"


@query("jn8_correlated_scalar", JN8.format(orders="orders"))
def correlated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(JN8, orders=table(spark, sf_dir, "orders"))


JN8_LATERAL = "SELECT c_custkey, n, dearest FROM {customer}, LATERAL (SELECT count(*) AS n, max(o_totalprice) AS dearest FROM {orders} WHERE o_custkey = c_custkey)"


@query("jn8_lateral_sql", JN8_LATERAL.format(customer="customer", orders="orders"))
def lateral_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(JN8_LATERAL, customer=table(spark, sf_dir, "customer"), orders=table(spark, sf_dir, "orders"))


@query("jn8_lateral_join", "SELECT event_id, part FROM (SELECT event_id, unnest([event_type, event_type || '!']) AS part FROM events)")
def lateral_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table function that reads the row on its left."""
    kind = F.col("event_type").outer()
    parts = spark.tvf.explode(F.array(kind, F.concat(kind, F.lit("!")))).toDF("part")
    return table(spark, sf_dir, "events").lateralJoin(parts).select("event_id", "part")


@query("jn8_lateral", "SELECT c_custkey, o_orderkey FROM (SELECT c_custkey, o_orderkey, row_number() OVER (PARTITION BY c_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM customer JOIN orders ON o_custkey = c_custkey) WHERE r <= 2")
def lateral(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two dearest orders of each customer: a lateral limit as a ranking, which decorrelates it."""
    orders = top_k_per_group(table(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 2)
    return table(spark, sf_dir, "customer").join(orders, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "o_orderkey")


@query("jn9_as_of", """
SELECT e.event_id, p.event_id AS purchase_id, p.value AS purchase_value
FROM (SELECT * FROM events WHERE event_type <> 'purchase') e
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON e.user_id = p.user_id AND e.ts >= p.ts
""")
def as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    bought = events.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("bought_at"), F.col("event_id").alias("id"), F.col("event_id").alias("purchase_id"), F.col("value").alias("purchase_value"))
    others = events.where("event_type <> 'purchase'").select("event_id", "user_id", "ts")
    return as_of_join(others, bought, ["user_id"], "ts", "bought_at", ["id"], ["purchase_id", "purchase_value"], bucket_seconds=7 * 86400).drop("user_id", "ts")


@query("so1_global_sort", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def global_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey")


@query("so2_top_k", "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 25")
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "value").orderBy(F.desc("value"), "event_id").limit(25)


@query("so3_top_k_per_group", "SELECT event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS r FROM events) WHERE r <= 5")
def top_k_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k_per_group(table(spark, sf_dir, "events"), ["event_type"], [F.desc("value"), F.asc("event_id")], 5).select("event_type", "event_id", "value")


@query("se1_union_distinct", "SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey")).unionByName(suppliers).distinct()


@query("se1_union_all", "SELECT c_nationkey AS nationkey, c_acctbal AS balance FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier")
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("balance"))
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("balance")).unionByName(suppliers)


@query("se2_intersect_all", "SELECT c_nationkey AS k FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier")
def intersect_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")).intersectAll(table(spark, sf_dir, "supplier").select("s_nationkey"))


@query("se3_except_all", "SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier")
def except_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")).exceptAll(table(spark, sf_dir, "supplier").select("s_nationkey"))


SE4 = """
WITH RECURSIVE months(m, start) AS (
  SELECT 0, TIMESTAMP '1995-01-01 00:00:00'
  UNION ALL
  SELECT m + 1, start + INTERVAL '1' MONTH FROM months WHERE m < 23
)
SELECT m, count(o_orderkey) AS n FROM months LEFT JOIN orders ON o_orderdate >= start AND o_orderdate < start + INTERVAL '1' MONTH GROUP BY m
"""


@query("se4_recursive_cte", SE4)
def recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recursion makes the months; orders meet them by an equi-join on the month's number."""
    months = spark.sql("WITH RECURSIVE months(m) AS (SELECT 0 UNION ALL SELECT m + 1 FROM months WHERE m < 23) SELECT m FROM months")
    number = ((F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate") - 1).alias("m")
    counts = table(spark, sf_dir, "orders").select(number).groupBy("m").agg(F.count(F.lit(1)).alias("n"))
    return months.join(counts, "m", "left").select("m", F.coalesce("n", F.lit(0).cast("long")).alias("n"))
