"""File formats other than Parquet, with explicit schemas on the way in, and a generated source."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

FORMATS = ("parquet", "csv", "json", "orc", "text")


def write(df: DataFrame, path: str, kind: str, mode: str = "error", partition_by: tuple[str, ...] = ()) -> None:
    if kind not in FORMATS:
        raise ValueError(f"unknown format {kind}")
    options = {"header": True, "escape": '"'} if kind == "csv" else {}
    df.write.mode(mode).options(**options).partitionBy(*partition_by).format(kind).save(path)


def read(spark: SparkSession, path: str, kind: str, schema: StructType | str | None = None) -> DataFrame:
    """Read files; csv and json need a schema, as inferring one reads everything twice."""
    if kind not in FORMATS:
        raise ValueError(f"unknown format {kind}")
    if kind in ("csv", "json") and schema is None:
        raise ValueError(f"{kind} needs a schema")
    reader = spark.read.format(kind)
    if kind == "csv":
        reader = reader.options(header=True, escape='"', multiLine=True)
    return (reader.schema(schema) if schema is not None and kind != "text" else reader).load(path)


class _Range(InputPartition):
    def __init__(self, start: int, stop: int):
        self.start, self.stop = start, stop


class _SquaresReader(DataSourceReader):
    def __init__(self, options: dict):
        self.start, self.stop, self.parts = 0, int(options.get("rows", 100)), int(options.get("parts", 4))

    def partitions(self) -> list[InputPartition]:
        rows = max(0, self.stop - self.start)
        cuts = [self.start + rows * i // self.parts for i in range(self.parts + 1)]
        return [_Range(a, b) for a, b in zip(cuts, cuts[1:])]

    def read(self, partition: _Range) -> Iterator[tuple[int, int]]:
        return ((n, n * n) for n in range(partition.start, partition.stop))


class _BoundedSquaresReader(_SquaresReader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Take bounds on n; return what Spark must still apply."""
        for f in filters:
            n = getattr(f, "value", None) if getattr(f, "attribute", None) == ("n",) else None
            if isinstance(f, (GreaterThan, GreaterThanOrEqual)) and n is not None:
                self.start = max(self.start, n + isinstance(f, GreaterThan))
            elif isinstance(f, (LessThan, LessThanOrEqual)) and n is not None:
                self.stop = min(self.stop, n + isinstance(f, LessThanOrEqual))
            elif isinstance(f, EqualTo) and n is not None:
                self.start, self.stop = max(self.start, n), min(self.stop, n + 1)
            else:
                yield f


class Squares(DataSource):
    """A source in Python: numbers and their squares, each partition made by its own task."""

    @classmethod
    def name(cls) -> str:
        return "squares"

    def schema(self) -> str:
        return "n long, square long"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _SquaresReader(self.options)


class BoundedSquares(Squares):
    """Squares that take filters on n; the session needs spark.sql.python.filterPushdown.enabled."""

    @classmethod
    def name(cls) -> str:
        return "bounded_squares"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _BoundedSquaresReader(self.options)


class _Group(InputPartition):
    def __init__(self, path: str, group: int):
        self.path, self.group = path, group


class _RowGroupsReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.bounds = options["path"], []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Take comparisons of a column with a value: they skip row groups by their statistics, and rows."""
        compare = {GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", EqualTo: "=="}
        for f in filters:
            if type(f) in compare and len(f.attribute) == 1:
                self.bounds.append((f.attribute[0], compare[type(f)], f.value))
            else:
                yield f

    def _filter(self):
        import pyarrow.parquet as pq

        return pq.filters_to_expression([self.bounds]) if self.bounds else None

    def partitions(self) -> list[InputPartition]:
        import pyarrow.dataset as ds

        data = ds.dataset(self.path, format="parquet")
        parts = [_Group(f.path, g.id) for x in data.get_fragments() for f in x.split_by_row_group(self._filter()) for g in f.row_groups]
        return parts or [_Group("", 0)]  # Spark asks for one partition at least

    def read(self, partition: _Group) -> Iterator:
        import pyarrow.dataset as ds

        if partition.path:
            fragment = next(iter(ds.dataset(partition.path, format="parquet").get_fragments()))
            yield from fragment.subset(row_group_ids=[partition.group]).to_batches(filter=self._filter(), use_threads=False)


class RowGroups(DataSource):
    """Parquet files read by a source in Python, a task for each row group; comparisons are pushed to the source.

    The path must be one that Arrow can open on the driver and the executors."""

    @classmethod
    def name(cls) -> str:
        return "row_groups"

    def schema(self) -> StructType:
        import pyarrow.dataset as ds
        from pyspark.sql.pandas.types import from_arrow_schema

        return from_arrow_schema(ds.dataset(self.options["path"], format="parquet").schema)

    def reader(self, schema: StructType) -> DataSourceReader:
        return _RowGroupsReader(self.options)
