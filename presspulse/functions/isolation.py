"""Failures of external models, kept to the rows that cause them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def score_rows(score: Callable[[slice], np.ndarray], n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Results of ``score`` for ``n`` rows, and which rows failed.

    ``score`` gets a slice of rows and returns one line of ``width`` numbers for each. Where it raises, or
    returns another shape, the slice is scored again in halves, down to single rows; those that fail
    alone are NaN. So the outcome does not depend on how rows were put into batches.
    """
    out, failed = np.full((n, width), np.nan), np.zeros(n, bool)
    todo = [slice(0, n)] if n else []
    while todo:
        part = todo.pop()
        size = part.stop - part.start
        try:
            out[part] = np.asarray(score(part), dtype="float64").reshape(size, width)
        except Exception:  # noqa: BLE001 - a failing model must not end the job
            if size == 1:
                failed[part] = True
            else:
                middle = part.start + size // 2
                todo += [slice(part.start, middle), slice(middle, part.stop)]
    return out, failed
