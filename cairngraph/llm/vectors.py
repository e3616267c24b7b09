"""Helpers for columns of vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usual_length(vectors: DataFrame) -> int:
    """The most frequent length of `embedding` (of ties the larger); 0 if no row has a vector."""
    sizes = vectors.filter(F.size("embedding") > 0).groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    row = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    return row["d"] if row else 0


def good_rows(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows with an id and a vector of `dim` finite components, and these vectors."""
    column = batch.column("embedding")
    right = pa.compute.and_(pa.compute.equal(pa.compute.list_value_length(column), dim).fill_null(False), batch.column("vec_id").is_valid())
    at = np.flatnonzero(right.to_numpy(zero_copy_only=False))
    values = column.filter(right).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    x = np.asarray(values, np.float64).reshape(-1, dim)
    good = np.isfinite(x).all(1)
    return at[good], x[good]


def units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def pieces(batch: pa.RecordBatch, dim: int, cells: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most `cells` components."""
    step = max(1, cells // max(dim, 1))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def by_groups(keys: list[str], step: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]], rows: int = 20_000) -> Callable:
    """A `mapInArrow` function for partitions sorted by `keys`: `step` gets many whole groups at a time and where they begin.

    About `rows` rows and the last group are held; the caller bounds the size of a group.
    """

    def starts(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[0] = True
        for k in keys:
            c = table.column(k).to_numpy()
            new[1:] |= c[1:] != c[:-1]
        return np.flatnonzero(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < rows:
                continue
            table = pa.Table.from_batches(held)
            at = starts(table)
            if len(at) > 1:
                yield from step(table.slice(0, at[-1]), at[:-1])
            table = table.slice(at[-1]).combine_chunks()
            held, n = table.to_batches(), table.num_rows
        if n:
            table = pa.Table.from_batches(held)
            yield from step(table, starts(table))

    return run
