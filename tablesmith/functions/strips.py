"""Columns cut into strips of values, for work that needs the order of many values in bounded pieces.

A column's boundaries are quantiles of its rows. Every boundary value is a
strip of its own and so is every open interval between two, so a value that a
third of all rows hold never shares a strip with others, and an open interval
holds about ``STRIP_ROWS`` rows, up to ``FULL_ROWS`` beyond ``MANY_STRIPS``
intervals (more only beyond ``MAX_STRIPS``): the cells of two columns' strips
then stay far fewer than the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of an open interval, about; with more than so many intervals, the rows of one grow first; and the most intervals of a column.
STRIP_ROWS = 50_000
MANY_STRIPS = 512
FULL_ROWS = 1_000_000
MAX_STRIPS = 1 << 16


def number(name: str) -> Column:
    """The column as a double; NaN is missing."""
    c = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(c), c)


@dataclass
class Strips:
    """Boundaries of each column; strip 2k is the interval above boundary k (0: below all), strip 2k - 1 boundary k itself."""

    bounds: list[np.ndarray]

    @classmethod
    def plan(cls, table: DataFrame, columns: list[str], rows: int, strip_rows: int = STRIP_ROWS, max_strips: int = MAX_STRIPS) -> Strips:
        n = int(min(max(1, -(-rows // strip_rows)), max(MANY_STRIPS, -(-rows // FULL_ROWS)), max_strips))
        if n == 1:
            return cls([np.zeros(0) for _ in columns])
        found = table.approxQuantile(columns, [k / n for k in range(1, n)], 1 / (4 * n))
        return cls([np.unique(np.array(q, dtype=float)) + 0.0 for q in found])

    def of(self, k: int, values: np.ndarray) -> np.ndarray:
        """The strip of each value of column ``k``; -1 for NaN."""
        b = self.bounds[k]
        place = np.searchsorted(b, values, side="right")
        out = 2 * place
        if len(b):
            out -= (place > 0) & (values == b[np.maximum(place - 1, 0)])
        out[np.isnan(values)] = -1
        return out

    @property
    def width(self) -> int:
        """Above all strips' numbers."""
        return 2 * max((len(b) for b in self.bounds), default=0) + 1

    def added(self, table: DataFrame, columns: list[str]) -> DataFrame:
        """``table`` with a column ``s<k>`` for each column's strip; -1 where it is null."""
        shared = table.sparkSession.sparkContext.broadcast(self)
        at = [table.columns.index(c) for c in columns]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = [shared.value.of(k, batch.column(i).to_numpy(zero_copy_only=False).astype(float)) for k, i in enumerate(at)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(x.astype(np.int32)) for x in ids]],
                                                 [*batch.schema.names, *[f"s{k}" for k in range(len(at))]])

        kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields]
        return table.mapInArrow(run, ", ".join([*kinds, *[f"s{k} int" for k in range(len(at))]]))
