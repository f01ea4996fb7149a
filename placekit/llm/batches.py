"""Small pieces of the Arrow batches that tasks get."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS, SIZE = 256, 1 << 20


def slices(batches, column: str = "text", rows: int = ROWS, size: int = SIZE):
    """The rows of ``batches`` in order, at most ``rows`` at a time and ``size``
    bytes of ``column``, or one longer text.  Spark sends up to 10 000 rows at once:
    what a task makes of as many texts (their words, say) is many times their size."""
    for whole in batches:
        length = pc.binary_length(whole.column(column)).cast(pa.int64())
        ends = np.cumsum(length.fill_null(0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(whole):
            before = ends[at - 1] if at else 0
            n = int(np.searchsorted(ends, before + size, "right")) - at
            n = min(max(n, 1), rows)
            yield whole.slice(at, n)
            at += n
