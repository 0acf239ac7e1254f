"""Operators on small frames: nulls, ties, empty input."""

from datetime import datetime, timedelta

import duckdb
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumenfold.functions.vectors import cosine
from lumenfold.operators.joins import as_of_join, band_join
from lumenfold.operators.windows import groups_frame, top_k_per_group
from lumenfold.sources import files

START = datetime(2024, 1, 1)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("bucket", [None, 3, 1000])
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 12)), max_size=12), right=st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 12)), max_size=12))
def test_as_of(spark, bucket, left, right):
    at = lambda s: START + timedelta(seconds=s)
    lefts = [(i, k, at(s)) for i, (k, s) in enumerate(left)]
    rights = [(i, k, at(s)) for i, (k, s) in enumerate(right)]
    a, b = frame(spark, lefts, "i int, k string, t timestamp_ntz"), frame(spark, rights, "j int, k string, u timestamp_ntz")
    got = as_of_join(a, b, ["k"], "t", "u", ["j"], ["j"], bucket)
    expected = []
    for i, k, t in lefts:
        match = max(((u, j) for j, q, u in rights if q == k and u <= t), default=(None, None))
        expected.append((i, k, t, match[1]))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)


def test_band_join(spark):
    a = frame(spark, [(1, -3.5), (2, 0.0), (3, 7.0), (4, None)], "i int, x double")
    b = frame(spark, [(1, -4.0, -3.0), (2, 0.0, 7.0), (3, 5.0, 4.0), (4, None, 9.0)], "j int, lo double, hi double")
    got = band_join(a, b, F.col("x"), F.col("lo"), F.col("hi"), 2.0).select("i", "j").collect()
    assert sorted(map(tuple, got)) == [(1, 1), (2, 2), (3, 2)]
    assert band_join(a.limit(0), b, F.col("x"), F.col("lo"), F.col("hi"), 2.0).count() == 0


def test_groups_frame_with_nulls_and_ties(spark):
    rows = pd.DataFrame({"g": ["a", "a", "a", "a", "b", None], "v": pd.array([1, 1, 2, None, 5, 6], "Int64"), "i": range(6)})
    got = groups_frame(frame(spark, [tuple(None if pd.isna(x) else x for x in r) for r in rows.astype(object).itertuples(index=False)], "g string, v int, i int"), ["g"], "v", F.count(F.lit(1)), 1, 0, "n")
    expected = duckdb.query("SELECT i, count(*) OVER (PARTITION BY g ORDER BY v NULLS FIRST GROUPS BETWEEN 1 PRECEDING AND CURRENT ROW) AS n FROM rows").fetchall()
    assert sorted((r["i"], r["n"]) for r in got.collect()) == sorted(expected)


def test_top_k(spark):
    df = frame(spark, [("a", 1), ("a", 2), ("a", 2), (None, 5), (None, 6)], "g string, v int")
    got = top_k_per_group(df, ["g"], [F.desc("v")], 2).collect()
    assert sorted(map(tuple, got), key=str) == sorted([("a", 2), ("a", 2), (None, 5), (None, 6)], key=str)


def test_cosine(spark):
    df = frame(spark, [([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 2.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    assert [r[0] for r in df.select(cosine("a", "b")).collect()] == [1.0, 0.0, None]


@pytest.mark.parametrize("kind", ["parquet", "csv", "json", "orc"])
def test_formats(spark, kind, tmp_path):
    df = frame(spark, [(1, 'quo"te, and\nline', 2.5), (2, None, None), (3, "é", -1.0)], "i int, s string, x double")
    files.write(df, str(tmp_path / kind), kind)
    got = files.read(spark, str(tmp_path / kind), kind, df.schema)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_text_partitions_and_bad_formats(spark, tmp_path):
    files.write(frame(spark, [("x",), ("y z",)], "value string"), str(tmp_path / "t"), "text")
    assert sorted(r[0] for r in files.read(spark, str(tmp_path / "t"), "text").collect()) == ["x", "y z"]
    files.write(frame(spark, [(1, "a"), (2, "b")], "i int, p string"), str(tmp_path / "p"), "parquet", partition_by=("p",))
    only = spark.read.parquet(str(tmp_path / "p")).where("p = 'a'")
    assert [r["i"] for r in only.collect()] == [1]
    with pytest.raises(ValueError):
        files.read(spark, "x", "csv")
    with pytest.raises(ValueError):
        files.read(spark, "x", "xml")


def test_python_source(spark):
    spark.dataSource.register(files.Squares)
    df = spark.read.format("squares").option("rows", 10).option("parts", 3).load()
    assert df.rdd.getNumPartitions() == 3
    assert sorted(map(tuple, df.collect())) == [(n, n * n) for n in range(10)]


def test_filters_reach_the_python_source(spark):
    from pyspark.sql.datasource import GreaterThan, LessThanOrEqual

    from lumenfold.sources import files

    reader = files.BoundedSquares({"rows": "50", "parts": "3"}).reader(None)
    assert list(reader.pushFilters([GreaterThan(("n",), 9), LessThanOrEqual(("n",), 20), GreaterThan(("square",), 4)])) == [GreaterThan(("square",), 4)]
    assert [r for p in reader.partitions() for r in reader.read(p)] == [(n, n * n) for n in range(10, 21)]
