"""Texts of an Arrow batch as numpy arrays: words, their hashes, and what is known of a word.

All per-byte work is done by numpy over a slice of texts at a time, so a text of any length costs a
few bytes of memory per byte and no Python step per word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on together; one longer text is worked on alone.
SLICE_BYTES = 1 << 20
_BLOCK = 1 << 16
_P = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_P_INVERSE = pow(_P, -1, 1 << 64)

#: The white space that ends a word: space and 0x09-0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS = _powers(_P, _BLOCK)
_INVERSE = _powers(_P_INVERSE, _BLOCK)
_BYTES = np.random.Generator(np.random.PCG64(20240115)).integers(
    0, 1 << 64, 256, dtype=np.uint64, endpoint=False)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A permutation of 64-bit values, another one for each salt."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each text starts; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, np.int64)[column.offset:column.offset + len(column) + 1]
    if len(column) == 0:
        offsets = np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows that hold about ``limit`` bytes."""
    data, offsets = string_buffers(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run without white space, and the text it is in."""
    inside = np.zeros(len(data) + 2, bool)
    np.logical_not(SPACE[data], out=inside[1:-1])
    edge = inside[1:] != inside[:-1]
    # a text's end ends its word: where a word runs on into the next text, both edges are set
    joints = offsets[1:-1]
    joints = np.unique(joints[(joints > 0) & (joints < len(data))])
    glued = joints[inside[joints] & inside[joints + 1]]
    at = np.flatnonzero(edge)
    if len(glued):
        at = np.sort(np.concatenate([at, glued, glued]), kind="stable")
    starts, ends = at[0::2], at[1::2]
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, from one pass over the bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    scale, total = 1, np.uint64(0)
    blocks = [1]
    step = pow(_P, _BLOCK, 1 << 64)
    for at in range(0, len(data), _BLOCK):
        part = data[at:at + _BLOCK]
        terms = _BYTES[part] * _POWERS[:len(part)]
        terms *= np.uint64(scale)
        np.cumsum(terms, out=terms)
        terms += total
        sums[at + 1:at + 1 + len(part)] = terms
        total = terms[-1]
        scale = scale * step & _MASK
        blocks.append(blocks[-1] * pow(step, -1, 1 << 64) & _MASK)
    back = np.array(blocks, np.uint64)
    h = (sums[ends] - sums[starts]) * _INVERSE[starts % _BLOCK] * back[starts // _BLOCK]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Known:
    """Values of spans by hash, each worked out once: a sorted table of at most ``limit`` entries.

    A full table starts again empty, so memory is bounded; results do not depend on it.
    """

    def __init__(self, limit: int, width: int | None = None, kind: type = np.float32):
        self.limit, self.width, self.kind = limit, width, kind
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        if self.width is None:  # ragged: each entry is a run of the pool
            self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
            self.pool = np.zeros(0, self.kind)
        else:
            self.rows = np.zeros((0, self.width), self.kind)

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray,
             work_out: Callable[[list[bytes]], object]) -> np.ndarray:
        """The entry of each span; unknown spans are given to ``work_out``, as bytes, once."""
        distinct, first, at = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, distinct)
        hit = np.zeros(len(distinct), bool)
        inside = place < len(self.keys)
        hit[inside] = self.keys[place[inside]] == distinct[inside]
        if not hit.all():
            if len(self.keys) + int((~hit).sum()) > self.limit and len(self.keys):
                self._clear()
                hit[:] = False
            new = ~hit
            which = first[new]
            raw = data.tobytes()
            spans = [raw[a:b] for a, b in zip(starts[which].tolist(), ends[which].tolist())]
            self._add(distinct[new], work_out(spans))
            place = np.searchsorted(self.keys, distinct)
        return place[at]

    def _add(self, keys: np.ndarray, values: object) -> None:
        where = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, where, keys)
        if self.width is None:
            pool, sizes = values
            starts = len(self.pool) + np.cumsum(sizes) - sizes
            self.pool = np.concatenate([self.pool, pool])
            self.starts = np.insert(self.starts, where, starts)
            self.sizes = np.insert(self.sizes, where, sizes)
        else:
            self.rows = np.insert(self.rows, where, values, axis=0)

    def runs(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs of ``entries`` one after the other, and the size of each."""
        sizes = self.sizes[entries]
        return self.pool[ragged(self.starts[entries], sizes)], sizes


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, .. for each run, one after the other."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.ones(total, np.int64)
    full = sizes > 0
    starts, sizes = starts[full], sizes[full]
    heads = np.cumsum(sizes) - sizes
    out[heads] = starts
    out[heads[1:]] -= starts[:-1] + sizes[:-1] - 1
    return np.cumsum(out)
