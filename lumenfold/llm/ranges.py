"""Rows cut into ranges of a long key, by borders from a sample: ranks and neighbours without one big window.

Borders at the quantiles of a sample make cells of about equal size; each cell is cut evenly into as many
ranges as keep a range near ROWS_A_RANGE rows. Ids that are dense, hashed to 64 bits or a mixture of both
so give ranges of alike size; rows of one id share a range. The sample only plans where rows go: any
borders give the same results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_A_RANGE = 256
#: Cells between borders, at most, and rows of the sample that finds the borders.
CELLS, SAMPLE_ROWS = 1024, 500_000
#: Ranges of one range of ranges: what a window over ranges holds at once.
UPPER_BITS = 12


class Ranges:
    """Numbers of ranges that rise with the key: 0 for null, then from 1 on."""

    def __init__(self, borders: list[int], subs: int, most: int):
        self.borders, self.subs, self.most = sorted(set(borders)), subs, most

    def part(self, key: Column) -> Column:
        steps = [1 << i for i in reversed(range(len(self.borders).bit_length()))]
        edges = self.borders + [self.most] * (sum(steps) - len(self.borders))
        listed = F.split(F.lit(",".join(map(str, edges))), ",").cast("array<bigint>") if edges else None
        # A binary search for the number of borders at or below the key, as a fold over the steps.
        cell = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: at + F.when(F.get(listed, at + step - 1) <= key, step).otherwise(0)) if steps else F.lit(0)
        cell = cell.cast("long")
        if self.subs == 1 or not edges:
            return F.when(key.isNull(), 0).otherwise(cell + 1)
        # As doubles: differences of longs may overflow; rounding never breaks the order.
        spots = F.array(F.get(listed, (cell - 1).cast("int")), F.get(listed, F.least(cell, F.lit(len(edges) - 1)).cast("int"))).cast("array<double>")
        share = F.element_at(F.transform(F.array(spots), lambda s: F.coalesce(F.try_divide(key.cast("double") - s[0], s[1] - s[0]), F.lit(0.0))), 1)
        sub = F.least(F.greatest(F.floor(share * self.subs), F.lit(0)), F.lit(self.subs - 1))
        return F.when(key.isNull(), 0).otherwise(cell * self.subs + sub + 1)


def plan(rows: DataFrame, key: Column, rows_a_range: int = ROWS_A_RANGE) -> Ranges:
    """Ranges for the rows; the driver gets a count, the largest key and at most CELLS borders."""
    keys = rows.select(key.cast("long").alias("key"))
    n, most = keys.agg(F.count(F.lit(1)), F.max("key")).first()
    if not n or most is None:
        return Ranges([], 1, 0)
    cells = min(CELLS, max(1, n // rows_a_range))
    if cells == 1:
        return Ranges([], 1, most)
    sample = keys.where("key IS NOT NULL")
    sample = sample.sample(SAMPLE_ROWS / n, seed=7) if n > SAMPLE_ROWS else sample
    borders = sample.agg(F.percentile_approx("key", [i / cells for i in range(1, cells)], 10 * cells)).first()[0] or []
    return Ranges(borders, max(1, -(-n // (cells * rows_a_range))), most)

