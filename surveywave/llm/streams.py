"""Reading a partition that is sorted by key as a stream of groups."""

from __future__ import annotations

from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa

if TYPE_CHECKING:
    import pandas as pd


def groups(frames: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Consecutive rows with an equal key, across batch borders.  Holds one
    group at a time; the caller bounds how large a group is."""
    import pandas as pd  # only here: a worker of an Arrow stage does without
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        values = frame[key].to_numpy()
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1), len(values)]
        if held and held[-1][key].iloc[-1] != values[0]:
            yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
            held = []
        for a, b in zip(cuts[:-2], cuts[1:-1]):
            held.append(frame.iloc[a:b])
            yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0].reset_index(drop=True)
            held = []
        held.append(frame.iloc[cuts[-2]:cuts[-1]])
    if held:
        yield pd.concat(held, ignore_index=True)


def arrow_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The same for Arrow batches, which keep NULL integers as they are."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        if held and held[-1].column(key)[-1].as_py() != values[0]:
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(cuts[:-2], cuts[1:-1]):
            yield pa.Table.from_batches([*held, batch.slice(a, b - a)])
            held = []
        held.append(batch.slice(cuts[-2], cuts[-1] - cuts[-2]))
    if held:
        yield pa.Table.from_batches(held)
