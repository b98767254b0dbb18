"""Groups of rows that come sorted by their keys, taken apart without a pandas call for each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Rows of whole groups and the places where these begin and the last ends; only the group under way is held."""
    held: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        last = held[-1].iloc[[-1]] if held else b.iloc[:0]
        both = pd.concat([last, b])[keys]
        fresh = np.zeros(len(both), bool)
        for k in keys:
            was = both[k].shift()
            fresh |= ((both[k] != was) & ~(both[k].isna() & was.isna())).to_numpy(bool)
        if len(last):
            fresh = fresh[1:]
        else:
            fresh[0] = True
        at = np.flatnonzero(fresh)
        if held and len(at):
            before = pd.concat([*held, b.iloc[: at[0]]], ignore_index=True)
            yield before, np.array([0, len(before)])
            held = []
        if len(at) > 1:
            yield b.iloc[at[0] : at[-1]].reset_index(drop=True), at - at[0]
        held.append(b.iloc[at[-1] :] if len(at) else b)
    if held:
        rows = pd.concat(held, ignore_index=True)
        yield rows, np.array([0, len(rows)])
