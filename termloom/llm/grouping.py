"""Whole groups out of the sorted rows of a partition."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def _bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.zeros(table.num_rows - 1, bool)
    for k in keys:
        col = table.column(k).to_numpy()
        change |= col[1:] != col[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1, [table.num_rows]])


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, with the bounds of the groups in them; keys are numbers.

    Holds the rows of the groups of one batch, and those of the last group until it has ended.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if any(held[0].column(k)[0] != batch.column(k)[batch.num_rows - 1] for k in keys):
            table = pa.Table.from_batches(held)
            bounds = _bounds(table, keys)
            yield table.slice(0, bounds[-2]), bounds[:-1]
            held = table.slice(bounds[-2]).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, _bounds(table, keys)


def large_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 50_000
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """The same, for lean rows in small batches: some ten thousand rows at a time."""

    def joined() -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
        if n:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    yield from sorted_groups(joined(), keys)
