"""Recursion over tables by semi-naive evaluation.

Each round joins only the rows that the round before found (the frontier) with the edges, and keeps those
that no round has found. Rounds are stored, so lineage stays short and a lost executor costs one task; the
edges are stored once in buckets of their source and are not shuffled again. The driver gets one count a
round."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.sources.tables import scratch_path


def reach(spark: SparkSession, edges: DataFrame, seeds: DataFrame, max_hops: int | None = None) -> DataFrame:
    """(node, hops): all nodes that edges (src, dst) lead to from seeds (node), with the fewest hops.

    Null nodes and edges with a null end lead nowhere. Cycles, self-loops and repeated edges change nothing."""
    path, name = scratch_path(spark, "fixpoint"), f"edges_{uuid.uuid4().hex}"
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Dealt by source before the repeats go: edges are shuffled once.
    known = edges.where("src IS NOT NULL AND dst IS NOT NULL").select("src", "dst").repartition(buckets, "src").distinct()
    known.write.bucketBy(buckets, "src").sortBy("src").option("path", f"{path}/edges").saveAsTable(name)
    try:
        seeds.select("node").where("node IS NOT NULL").distinct().write.parquet(f"{path}/found/hops=0")
        kind, hops = seeds.select("node").schema, 0
        while max_hops is None or hops < max_hops:
            frontier = spark.read.schema(kind).parquet(f"{path}/found/hops={hops}")
            found = spark.read.schema(kind).parquet(*[f"{path}/found/hops={i}" for i in range(hops + 1)])
            stepped = frontier.join(spark.table(name), F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct()
            hops += 1
            stepped.join(found, "node", "left_anti").write.parquet(f"{path}/found/hops={hops}")
            if not spark.read.schema(kind).parquet(f"{path}/found/hops={hops}").count():
                break
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files stay under the checkpoint folder
    parts = [spark.read.schema(kind).parquet(f"{path}/found/hops={i}").withColumn("hops", F.lit(i).cast("long")) for i in range(hops + 1)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
