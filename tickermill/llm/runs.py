"""Sorted rows in runs, and links as trees: small helpers of the tiled comparisons."""

from __future__ import annotations

import numpy as np
import pandas as pd


def by_run(order: list[str], compare, merge):
    """For mapInPandas over rows sorted by `order`: calls `compare` with the rows of one run at a time.

    `merge` turns the results of a batch into the frame that leaves the task.
    """

    def run(batches):
        waiting: list[pd.DataFrame] = []
        last = None
        for batch in batches:
            if not len(batch):
                continue
            keys = batch[order].to_numpy()
            cut = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(batch)]
            found = []
            if last is not None and (keys[0] != last).any():
                found.append(compare(pd.concat(waiting, ignore_index=True)))
                waiting = []
            for start, end in zip(cut[:-1], cut[1:]):
                waiting.append(batch.iloc[start:end])
                if end < len(batch):
                    found.append(compare(pd.concat(waiting, ignore_index=True)))
                    waiting = []
            last = keys[-1]
            if found:
                yield merge(found)
        if waiting:
            yield merge([compare(pd.concat(waiting, ignore_index=True))])

    return run


def trees(links: np.ndarray) -> np.ndarray:
    """Links (n x 2 ids) as (smallest id that the links reach, id), for ids that reach a smaller one."""
    ids, end = np.unique(links, return_inverse=True)
    x, y = end.reshape(-1, 2).T
    label = np.arange(len(ids))
    while len(x):
        before = label.copy()
        np.minimum.at(label, x, label[y])
        np.minimum.at(label, y, label[x])
        label = label[label]
        if (before == label).all():
            break
    moved = label != np.arange(len(ids))
    return np.stack([ids[label[moved]], ids[moved]], axis=1)
