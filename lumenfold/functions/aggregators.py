"""User-defined aggregates in two phases: partial states in the tasks that read the rows, merged by key.

A state is a row of numbers that merge by sum, min or max, so Spark merges them with partial sums, and a
hot key arrives as one state from each task rather than as its rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: States that a task holds, about; with more keys than half of these it sends them on.
HELD = 200_000
MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


class TwoPhase:
    """step: a batch's values by key -> states by key, a frame with the state columns and the key as index;
    state: column -> how it merges; finish: SQL for the result from the merged state columns."""

    def __init__(self, step: Callable[[pd.DataFrame, str], pd.DataFrame], state: dict[str, str], finish: str):
        self.step, self.state, self.finish = step, state, finish

    def __call__(self, df: DataFrame, by: str, name: str, **inputs: Column) -> DataFrame:
        step, state = self.step, self.state
        kind = df.schema[by].dataType.simpleString()

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pd.DataFrame] = []

            def merged() -> pd.DataFrame:
                return pd.concat(held).groupby(level=0, dropna=False).agg(state)

            def out(states: pd.DataFrame) -> pa.RecordBatch:
                keys = pa.array(states.index.tolist(), kind_of, from_pandas=True)
                return pa.RecordBatch.from_arrays([keys, *[pa.array(states[c].to_numpy(np.float64)) for c in state]], [by, *state])

            for b in batches:
                kind_of = b.schema.field(by).type
                rows = b.to_pandas()
                if pa.types.is_integer(kind_of):  # beside nulls these would be floats, and large keys meet
                    rows[by] = b.column(by).cast(pa.int64()).to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
                held.append(step(rows, by)[list(state)])
                if sum(map(len, held)) > HELD:
                    held = [merged()]
                    if len(held[0]) > HELD // 2:
                        yield out(held.pop())
            if held and len(states := merged()):
                yield out(states)

        rows = df.select(by, *[c.alias(k) for k, c in inputs.items()])
        states = rows.mapInArrow(partial, ", ".join([f"{by} {kind}", *[f"{c} double" for c in state]]))
        return states.groupBy(by).agg(*[MERGE[how](c).alias(c) for c, how in state.items()]).select(by, F.expr(self.finish).alias(name))


def _logs(batch: pd.DataFrame, by: str) -> pd.DataFrame:
    x = batch[batch["x"] > 0]
    return pd.DataFrame({by: x[by], "logs": np.log(x["x"]), "n": 1.0}).groupby(by, dropna=False).sum()


#: The geometric mean of positive values; groups without one have no row.
geometric_mean = TwoPhase(_logs, {"logs": "sum", "n": "sum"}, "exp(logs / nullif(n, 0))")


def _all_logs(batch: pd.DataFrame, by: str) -> pd.DataFrame:
    x = batch["x"].astype(float)
    return pd.DataFrame({by: batch[by], "logs": np.log(x.where(x > 0)), "n": (x > 0).astype(float)}).groupby(by, dropna=False).sum()


#: The same with a row, and a null, for groups without positive values.
geometric_mean_or_null = TwoPhase(_all_logs, {"logs": "sum", "n": "sum"}, "exp(logs / nullif(n, 0))")


def _moments(batch: pd.DataFrame, by: str) -> pd.DataFrame:
    x = batch.dropna(subset=["x", "w"])
    return pd.DataFrame({by: x[by], "w": x["w"], "wx": x["w"] * x["x"], "wxx": x["w"] * x["x"] ** 2, "least": x["x"]}).groupby(by, dropna=False).agg({"w": "sum", "wx": "sum", "wxx": "sum", "least": "min"})


#: The weighted variance of a group's values.
weighted_variance = TwoPhase(_moments, {"w": "sum", "wx": "sum", "wxx": "sum", "least": "min"}, "wxx / nullif(w, 0) - power(wx / nullif(w, 0), 2)")


@F.pandas_udf(T.DoubleType())
def grouped_geometric_mean(x: pd.Series) -> float:
    """The same in one phase: for groups that fit in a task."""
    x = x[x > 0]
    return float(np.exp(np.log(x).mean())) if len(x) else None
