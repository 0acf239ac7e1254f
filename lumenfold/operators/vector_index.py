"""Nearest vectors by inverted lists over k-means cells, and exactly by blocks of the same kind.

Cells are fitted by k-means on a bounded sample (the vectors of least hash of their id); every vector is
assigned to its nearest cell, and a query looks into the cells whose centres are nearest to it. Rows and
queries of a cell are cut into blocks of bounded size, by counts of each cell, and a task multiplies one
block of queries by one block of rows. With one cell this is the exact search.

Equal vectors are searched as one, their least id standing for them, and put back afterwards, so a vector
that makes up a third of all rows is one row of its cell. Vectors are compared by dot product, which for
unit vectors is the cosine. Null vectors and ids are left out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.operators.windows import top_k_per_group

#: Vectors that cells are fitted on and rounds of k-means, at most; rows and queries of a block, about.
SAMPLE_ROWS, ROUNDS = 20_000, 12
BLOCK_ROWS, BLOCK_QUERIES = 4096, 256


def fit_cells(vectors: DataFrame, cells: int, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Centres of at most so many cells; the driver gets at most sample_rows vectors."""
    picked = vectors.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("vector").toArrow().column(0)
    if not len(picked):
        return np.zeros((0, 0))
    points = _matrix(picked.combine_chunks())
    centres = points[np.linspace(0, len(points) - 1, min(cells, len(points))).astype(int)].copy()
    for _ in range(ROUNDS if len(centres) > 1 else 0):
        near = _nearest(points, centres, 1)[:, 0]
        sums, sizes = np.zeros_like(centres), np.bincount(near, minlength=len(centres))
        np.add.at(sums, near, points)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64) if len(column) else np.zeros((0, 0))


def _nearest(points: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The n nearest centres of each point, by Euclidean distance."""
    far = (centres**2).sum(axis=1) - 2 * points @ centres.T
    return np.argsort(far, axis=1, kind="stable")[:, :n]


def assign(vectors: DataFrame, centres: np.ndarray, n: int) -> DataFrame:
    """(cell, id, vector): a row for each of the n nearest cells of a vector."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                near = _nearest(_matrix(b.column("vector")), centres, n)
                rows = np.repeat(np.arange(b.num_rows), near.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(near.ravel().astype(np.int32)), b.column("id").take(pa.array(rows)), b.column("vector").take(pa.array(rows))], ["cell", "id", "vector"])

    return vectors.select("id", "vector").mapInArrow(each, f"cell int, id long, vector {vectors.schema['vector'].dataType.simpleString()}")


def _search(k: int):
    def search(key: tuple, queries: pa.Table, rows: pa.Table) -> pa.Table:
        kinds = {"query_id": pa.int64(), "id": pa.int64(), "likeness": pa.float64()}
        if not queries.num_rows or not rows.num_rows:
            return pa.table({c: pa.array([], t) for c, t in kinds.items()})
        qs, ids = queries.column("id").to_numpy(), rows.column("id").to_numpy()
        likeness = _matrix(queries.column("vector").combine_chunks()) @ _matrix(rows.column("vector").combine_chunks()).T
        out = [[], [], []]
        for q, line in zip(qs, likeness):
            best = np.argpartition(-line, k)[:k] if len(line) > k else np.arange(len(line))
            best = np.flatnonzero(line >= line[best].min() - 1e-6)  # ties after rounding are decided later
            for c, x in zip(out, (np.full(len(best), q), ids[best], line[best])):
                c.append(x)
        return pa.table({c: pa.array(np.concatenate(x), t) for (c, t), x in zip(kinds.items(), out)})

    return search


def nearest(vectors: DataFrame, queries: DataFrame, k: int, cells: int = 1, probes: int = 1, digits: int = 6, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, id, likeness): each query's k nearest other vectors, ties to the smaller id.

    vectors and queries have the same columns; queries are rows of vectors. cells=1 is exact."""
    plain = lambda df: df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).where("id IS NOT NULL AND vector IS NOT NULL")
    rows, asked = plain(vectors), plain(queries)
    classes = rows.groupBy("vector").agg(F.min("id").alias("least"))
    distinct = classes.select(F.col("least").alias("id"), "vector")
    centres = fit_cells(distinct, cells)
    wanted = asked.select("vector").distinct().join(classes, "vector").select(F.col("least").alias("id"), "vector")

    held, looked = assign(distinct, centres, 1), assign(wanted, centres, probes)
    # One row for each cell on both sides.
    sizes = held.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).join(looked.groupBy("cell").agg(F.count(F.lit(1)).alias("m")), "cell")
    blocks = F.broadcast(sizes.select("cell", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("r"), F.ceil(F.col("m") / BLOCK_QUERIES).cast("int").alias("q")))
    own = lambda by: F.pmod(F.xxhash64("id"), F.col(by)).cast("int")
    every = lambda by: F.explode(F.sequence(F.lit(0), F.col(by) - 1))
    left = looked.join(blocks, "cell").select("cell", own("q").alias("q"), every("r").alias("r"), "id", "vector")
    right = held.join(blocks, "cell").select("cell", every("q").alias("q"), own("r").alias("r"), "id", "vector")
    key = ["cell", "q", "r"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_search(k + 1), "query_id long, id long, likeness double")
    rounded = found.withColumn("likeness", F.round("likeness", digits))
    best = top_k_per_group(rounded, ["query_id"], [F.desc("likeness"), F.asc("id")], k + 1)

    # Back from classes to rows: of each class the k + 1 least ids can be among the nearest.
    members = top_k_per_group(rows.join(classes, "vector").select("least", "id"), ["least"], [F.asc("id")], k + 1)
    askers = asked.join(classes, "vector").select("least", F.col("id").alias("asker"))
    spread = best.join(members.withColumnRenamed("id", "member"), F.col("id") == F.col("least")).select("query_id", F.col("member"), "likeness")
    expanded = spread.join(askers, F.col("query_id") == F.col("least")).where("asker <> member").select(F.col("asker").alias("query_id"), F.col("member").alias("id"), "likeness")
    return top_k_per_group(expanded, ["query_id"], [F.desc("likeness"), F.asc("id")], k)
