"""Window forms that Spark SQL lacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def groups_frame(df: DataFrame, partition: list[str], order: str, aggregate: Column, before: int, after: int, name: str) -> DataFrame:
    """An aggregate over a GROUPS frame: peers count as one step. dense_rank numbers the groups of
    peers, and a RANGE frame over those numbers is the GROUPS frame."""
    numbered = df.withColumn("_group", F.dense_rank().over(Window.partitionBy(*partition).orderBy(order)))
    return numbered.withColumn(name, aggregate.over(Window.partitionBy(*partition).orderBy("_group").rangeBetween(-before, after))).drop("_group")


def qualify(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which a condition over window columns holds, as QUALIFY does."""
    return df.withColumn("_keep", condition).where("_keep").drop("_keep")


def top_k_per_group(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group; the limit is pushed below the shuffle by Spark (WindowGroupLimit)."""
    return qualify(df, F.row_number().over(Window.partitionBy(*by).orderBy(*order)) <= k)
