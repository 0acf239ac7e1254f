"""The Python source over Parquet files: row groups as partitions, comparisons pushed down."""

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, LessThan, StringContains

from lumenfold.sources.files import RowGroups, _RowGroupsReader


def write(path, n=100, group=10):
    pq.write_table(pa.table({"a": pa.array(range(n), pa.int64()), "s": [f"s{i % 3}" if i % 5 else None for i in range(n)]}), path, row_group_size=group)


def test_bounds_skip_row_groups(tmp_path):
    write(tmp_path / "x.parquet")
    reader = _RowGroupsReader({"path": str(tmp_path)})
    left = list(reader.pushFilters([GreaterThanOrEqual(("a",), 25), LessThan(("a",), 41), StringContains(("s",), "1"), EqualTo(("s", "t"), 1)]))
    assert [type(f) for f in left] == [StringContains, EqualTo]
    parts = reader.partitions()
    assert [p.group for p in parts] == [2, 3, 4]
    assert [x for p in parts for b in reader.read(p) for x in b.column("a").to_pylist()] == list(range(25, 41))


def test_read(spark, tmp_path):
    spark.dataSource.register(RowGroups)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for i in range(2):
        write(tmp_path / f"{i}.parquet", 50)
    df = spark.read.format("row_groups").load(str(tmp_path))
    assert df.count() == 100 and df.rdd.getNumPartitions() == 10
    assert sorted(r["a"] for r in df.where("a >= 12 AND s = 's1'").collect()) == sorted(2 * [i for i in range(12, 50) if i % 3 == 1 and i % 5])
    assert df.where("a > 1000").count() == 0
