"""Arrow batches cut at group ends."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 100_000) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups with the groups' first rows (and the end), from batches sorted by integer ``keys``.

    At most ``rows`` rows and one group are held at a time.
    """
    held: list[pa.RecordBatch] = []
    count = 0

    def firsts(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, dtype=bool)
        new[0] = True
        for k in keys:
            v = table[k].to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count >= rows:
            table = pa.Table.from_batches(held).combine_chunks()
            at = firsts(table)
            if len(at) > 1:
                yield table.slice(0, at[-1]), at
                held = table.slice(at[-1]).to_batches()
                count = table.num_rows - int(at[-1])
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, np.r_[firsts(table), table.num_rows]
