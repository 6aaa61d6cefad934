"""Groups of a stream of Arrow batches that is sorted by an integer column."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def groups(batches: Iterator[pa.RecordBatch], key: int = 0) -> Iterator[pa.RecordBatch]:
    """Whole groups, many to a batch: a batch is cut at its last change of key, the rest waits for the next."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        change = np.flatnonzero(keys[1:] != keys[:-1])
        if waiting and waiting[-1].column(key)[-1].as_py() != keys[0]:
            yield pa.concat_batches(waiting)
            waiting = []
        if len(change):
            cut = int(change[-1]) + 1
            yield pa.concat_batches([*waiting, batch.slice(0, cut)])
            waiting = [batch.slice(cut)]
        else:
            waiting.append(batch)
    if waiting:
        yield pa.concat_batches(waiting)


def bounds(keys: np.ndarray) -> np.ndarray:
    """Where groups begin, and the end."""
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)])) if len(keys) else np.zeros(1, np.int64)
