"""Arrow batches in parts of bounded bytes of text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4_000_000


def text_slices(batches: Iterable[pa.RecordBatch], size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of batches with at most ``size`` bytes in the binary column ``text``, or with one text."""
    for batch in batches:
        column = batch.column("text")
        wide = pa.types.is_large_binary(column.type)
        kind, width = (np.int64, 8) if wide else (np.int32, 4)
        offsets = np.frombuffer(column.buffers()[1], kind, len(column) + 1, column.offset * width)
        begin = 0
        while begin < len(column):
            end = int(np.searchsorted(offsets, int(offsets[begin]) + size, side="right")) - 1
            end = min(max(end, begin + 1), len(column))
            yield batch.slice(begin, end - begin)
            begin = end
