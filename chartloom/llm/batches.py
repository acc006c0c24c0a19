"""Arrow batches of texts cut to bounded sizes, and their words as arrays."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20  # text handled at once inside a task
SPACES = b" \t\n\x0b\x0c\r"


_FORGET: dict[str, Callable[[], None]] = {}  # by name of a memory: how this Python worker drops it


def remembered(name: str, forget: Callable[[], None]) -> None:
    """Let tasks that do not use the memory ``name`` drop it with ``forget``."""
    _FORGET[name] = forget


def settled(work: Callable[[Iterator], Iterator], memory: str = "") -> Callable[[Iterator], Iterator]:
    """``work`` on batches, for Python workers that serve one operator after another.

    A task first drops what the worker remembers for operators other than those with ``memory``,
    and at its end gives the memory it has freed back to the system, which pools would keep.
    """

    def run(batches: Iterator) -> Iterator:
        for name, forget in _FORGET.items():
            if name != memory:
                forget()
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
            if trim is not None:
                trim(0)

    return run


def filled(column: pa.Array) -> pa.Array:
    """Texts with null read as empty, in buffers of their own.

    The copy matters: some Arrow functions read a slice's text from the wrong place.
    """
    own = column.take(pa.array(np.arange(len(column))))
    return pc.fill_null(own.cast(pa.large_string()), "")


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` bytes of text each; a longer text is a run of its own."""
    if batch.num_rows == 0:
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        floor = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, floor + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Runs of characters other than ``[\\x20\\x09-\\x0D]``: row offsets and all words in order.

    Empty strings, which stand at the ends of a text with outer white space, are left out.
    """
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    full = pc.greater(pc.binary_length(flat), 0)
    if not pc.all(full).as_py():
        kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
        flat, offsets = flat.filter(full), kept[offsets]
    return offsets, flat


def coded(flat: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Codes of the words and the distinct words."""
    found = flat.dictionary_encode()
    return found.indices.to_numpy(), found.dictionary


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), values.dtype), np.cumsum(values, axis=0)])
    return total[offsets[1:]] - total[offsets[:-1]]


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] .. starts[i] + lengths[i]`` of all ranges, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
