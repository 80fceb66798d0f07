"""Small helpers that several operators of this package share."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc

#: Texts are taken from an Arrow batch in runs of at most so many bytes, so that memory stays bounded.
RUN_BYTES = 2_000_000


def runs(batches: Iterable[pa.RecordBatch], limit: int = RUN_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with their ``text`` column as strings (null: empty), each of about ``limit`` bytes."""
    for batch in batches:
        column = batch.column("text")
        begin = size = 0
        for i, length in enumerate(pc.binary_length(column).to_pylist()):
            if i > begin and size + (length or 0) > limit:
                yield batch.slice(begin, i - begin), [x or "" for x in column.slice(begin, i - begin).to_pylist()]
                begin, size = i, 0
            size += length or 0
        if batch.num_rows:
            yield batch.slice(begin), [x or "" for x in column.slice(begin).to_pylist()]
    give_back()


def give_back() -> None:
    """Return freed memory to the system; workers live on, and what one stage freed counts beside the next one's."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc alone has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)
