"""Scalar, array, map and JSON functions, and user-defined ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.functions.udfs import SessionTable, TokenLengths, TokenLengthTable, arrow_log_bucket, centered, dearest_orders, gaps, letters_e, log_bucket, paired_counts
from lumenfold.functions.vectors import dot
from lumenfold.operators.vector_index import nearest
from lumenfold.plans.registry import query
from lumenfold.sources.tables import table


@query("fn1_strings", """
SELECT doc_id, substr(lower(text), 1, 20) AS head, upper(lang) AS lang, strpos(text, ' ')::BIGINT AS space, length(text) AS n, string_split(text, ' ')[1] AS word FROM documents
""")
def strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.substring(F.lower("text"), 1, 20).alias("head"), F.upper("lang").alias("lang"), F.instr("text", " ").cast("long").alias("space"), F.length("text").cast("long").alias("n"), F.split("text", " ")[0].alias("word"))


@query("fn2_regex", "SELECT page_id, regexp_replace(url, '[0-9]+', '#', 'g') AS shape, regexp_extract(url, '^([a-zA-Z]+):', 1) AS scheme FROM pages")
def regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", "[0-9]+", "#").alias("shape"), F.regexp_extract("url", "^([a-zA-Z]+):", 1).alias("scheme"))


@query("fn3_hashes", "SELECT c_custkey, md5(c_name) AS m, sha256(c_name) AS s FROM customer")
def hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", F.md5("c_name").alias("m"), F.sha2("c_name", 256).alias("s"))


@query("fn4_dates", "SELECT o_orderkey, year(o_orderdate) AS y, date_trunc('month', o_orderdate)::TIMESTAMP AS m, (o_orderdate + INTERVAL '10' DAY) AS later FROM orders")
def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").cast("long").alias("y"), F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("m"), (F.col("o_orderdate") + F.expr("INTERVAL '10' DAY")).alias("later"))


@query("fn5_math", "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / l_quantity AS unit, l_partkey % 7 AS m, round(ln(l_extendedprice), 6) AS l FROM lineitem")
def maths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit"), (F.col("l_partkey") % 7).alias("m"), F.round(F.ln("l_extendedprice"), 6).alias("l"))


@query("fn6_json", "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("fn6_variant", "SELECT event_id, json_extract_string(props, '$.k')::INTEGER AS k FROM events")
def variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.variant_get(F.parse_json("props"), "$.k", "int").alias("k"))


@query("fn7_explode", "SELECT vec_id, unnest(range(0, 64)) AS at, unnest(embedding)::DOUBLE AS x FROM embeddings")
def exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("at", "x")).select("vec_id", F.col("at").cast("long").alias("at"), F.col("x").cast("double").alias("x"))


@query("fn8_dot_product", """
SELECT a.vec_id, round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS dot
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id - a.vec_id % 10
""")
def dots(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    firsts = vectors.select(F.col("vec_id").alias("first"), F.col("embedding").alias("other"))
    joined = vectors.join(firsts, F.col("first") == F.col("vec_id") - F.col("vec_id") % 10)
    return joined.select("vec_id", F.round(dot("embedding", "other"), 6).alias("dot"))


@query("fn9_maps", "SELECT user_id, count(DISTINCT event_type) FILTER (event_type <> 'error') AS kinds, max(value) FILTER (event_type = 'view') * 2 AS twice FROM events GROUP BY user_id")
def maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.max("value").alias("value"))
    as_map = best.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "value"))).alias("best"))
    as_map = as_map.withColumn("best", F.transform_values(F.map_filter("best", lambda k, v: k != "error"), lambda k, v: v * 2))
    return as_map.select("user_id", F.size("best").cast("long").alias("kinds"), F.try_element_at("best", F.lit("view")).alias("twice"))


UD1 = "SELECT event_id, floor(log2(1 + abs(value)))::BIGINT AS bucket FROM events"


@query("ud1_pandas_udf", UD1)
def pandas_udfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", log_bucket("value").alias("bucket"))


@query("ud1_arrow_udf", UD1)
def arrow_udfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", arrow_log_bucket("value").alias("bucket"))


@query("ud1_plain_udf", "SELECT DISTINCT event_type, length(event_type) - length(replace(event_type, 'e', '')) AS es FROM events")
def plain_udfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A function called once a row: applied to the few distinct values only."""
    return table(spark, sf_dir, "events").select("event_type").distinct().select("event_type", letters_e("event_type").alias("es"))


@query("ud2_udtf", "SELECT doc_id, len(w) AS length, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents) GROUP BY doc_id, len(w)")
def udtfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.udtf.register("token_lengths", TokenLengths)
    return spark.sql("SELECT doc_id, t.length, t.n FROM {documents}, LATERAL token_lengths(text) t", documents=table(spark, sf_dir, "documents"))


@query("ud2_arrow_udtf", "SELECT doc_id, len(w) AS length, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents) GROUP BY doc_id, len(w)")
def arrow_udtfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table function on Arrow batches of a table argument; a document's row is in one batch, so its counts are whole."""
    spark.udtf.register("token_length_table", TokenLengthTable)
    return spark.sql("SELECT * FROM token_length_table(TABLE(SELECT doc_id, text FROM {documents}))", documents=table(spark, sf_dir, "documents"))


@query("ud2_table_argument", """
WITH marked AS (SELECT user_id, epoch_us(ts) AS us, CASE WHEN epoch_us(ts) > lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) + 1800000000 THEN 1 ELSE 0 END AS fresh FROM events),
numbered AS (SELECT user_id, us, sum(fresh) OVER (PARTITION BY user_id ORDER BY us) AS s FROM marked)
SELECT user_id, min(us) AS first, max(us) AS last, count(*) AS n FROM numbered GROUP BY user_id, s
""")
def table_argument(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions by a table function over a partitioned and ordered table argument."""
    spark.udtf.register("session_table", SessionTable)
    events = table(spark, sf_dir, "events").select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    return spark.sql("SELECT * FROM session_table(TABLE({events}) PARTITION BY (user_id) ORDER BY (at), 1800)", events=events)


@query("ud3_grouped_map", "SELECT event_id, round(value - avg(value) OVER (PARTITION BY event_type), 4) AS centered FROM events")
def grouped_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centered(table(spark, sf_dir, "events"), "event_type", "event_id", "value")


@query("ud3_apply_in_pandas", "SELECT event_id, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS gap FROM events")
def apply_in_pandas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps(table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")))


@query("ud3_apply_in_arrow", "SELECT o_custkey, max(o_totalprice) AS dearest, count(*) AS n FROM orders GROUP BY o_custkey")
def apply_in_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dearest_orders(table(spark, sf_dir, "orders"))


@query("ud3_cogroup", """
SELECT n_nationkey AS nation, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS customers, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS suppliers
FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier)
""")
def cogroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paired_counts(table(spark, sf_dir, "customer"), "c_nationkey", table(spark, sf_dir, "supplier"), "s_nationkey")


@query("tx1_exact_dedup", "SELECT min(doc_id) AS doc_id, count(*) AS copies, md5(text) AS digest FROM documents GROUP BY md5(text)")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each distinct text: the digests are aggregated before they are shuffled, the texts stay."""
    return table(spark, sf_dir, "documents").groupBy(F.md5("text").alias("digest")).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))


@query("tx4_vector_top_k", """
SELECT query_id, vec_id, cosine FROM (
  SELECT q.vec_id AS query_id, v.vec_id, round(list_dot_product(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 6) AS cosine,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_dot_product(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 6) DESC, v.vec_id) AS place
  FROM embeddings q JOIN embeddings v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id
) WHERE place <= 10
""")
def vector_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one; vectors have unit norm, so the dot product is the cosine.

    The stated queries meet all rows in blocks: a task multiplies one block of each."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where("vec_id % 100 = 0"), 10).select("query_id", F.col("id").alias("vec_id"), F.col("likeness").alias("cosine"))
