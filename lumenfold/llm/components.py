"""Connected components of an edge table by alternating large and small stars.

Every round is two aggregations (with partial sums, so a node with many edges is no hot spot) and two
joins, whose skewed sides adaptive execution splits; rounds grow with the logarithm of a component's
size. Each round is written to the shared folder, so lineage stays short; nothing is collected but
a count and a checksum."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.llm import shared


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(u, v) long edges -> (node, root): root is the least node of the component, for all nodes but roots."""
    oriented = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    path = shared.new_path(spark, "edges")
    now, seen = shared.write_table(spark, oriented, "edges", path), None
    while True:
        # A sum of hashes as decimal: no overflow under ANSI arithmetic.
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if (mark["n"], mark["h"]) == seen or not mark["n"]:
            break
        seen = (mark["n"], mark["h"])
        new = shared.new_path(spark, "edges")
        now = shared.write_table(spark, _small(_large(now).distinct()).distinct(), "edges", new)
        shared.drop_path(spark, path)
        path = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
