"""Words of whole texts as arrays of 64-bit hashes, computed for many texts at once.

A word is a run of bytes that are no ASCII white space, unchanged.  Its hash is a polynomial over
its bytes modulo 2**64, mixed with its length; unlike words meet with a chance of about 2**-64.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
#: Stands for a missing id: it is larger than every other.
LAST = np.iinfo(np.int64).max
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
_BYTES = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=U64) * U64(2) + U64(1)
#: Odd bases, so that their powers have inverses.
_BASE, _STEP = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
SLICE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as many as were asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 2 * len(self.up))
            for name, base in (("up", self.base), ("down", self.inverse)):
                values = np.full(size, base, U64)
                values[0] = 1
                setattr(self, name, np.multiply.accumulate(values))
        return self.up[:n], self.down[:n]


_letters, _windows = Powers(_BASE), Powers(_STEP)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts``, and the number of the first word of each text and the end."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    firsts, hashes = [], []
    lo, n = 0, len(data)
    while lo < n:
        hi = min(n, lo + SLICE)
        if hi < n:
            gaps = np.flatnonzero(_GAP[data[lo:hi]])
            if len(gaps):
                hi = lo + int(gaps[-1]) + 1
            else:
                while hi < n and not _GAP[data[hi - 1]]:
                    hi += 1
        part = data[lo:hi]
        gap = _GAP[part]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if not gap[0]:
            edge = np.concatenate(([0], edge))
        start, end = edge[0::2], edge[1::2]
        up, down = _letters(len(part) + 1)
        total = np.zeros(len(part) + 1, U64)
        np.cumsum(_BYTES[part] * up[:-1], out=total[1:])
        hashes.append(mix((total[end] - total[start]) * down[start] + (end - start).astype(U64) * U64(_STEP)))
        firsts.append(start + lo)
        lo = hi
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    where = np.concatenate(firsts) if firsts else np.zeros(0, np.int64)
    return (np.concatenate(hashes) if hashes else np.zeros(0, U64)), np.searchsorted(where, offsets)


def window_hashes(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rolling hashes of all windows of ``size`` words inside one text, and how many each text has."""
    counts = np.maximum(np.diff(bounds) - size + 1, 0)
    at = np.repeat(bounds[:-1] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
    up, down = _windows(len(words) + 1)
    total = np.zeros(len(words) + 1, U64)
    np.cumsum(words * up[:-1], out=total[1:])
    return mix((total[at + size] - total[at]) * down[at]), counts


def planes(values: np.ndarray) -> bytes:
    """Numbers as one plane for each of their bytes; planes of small numbers compress to nothing."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def from_planes(data: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    if not data:
        return np.zeros(0, kind)
    flat = np.frombuffer(data, np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(flat.T).view(kind).ravel()


def pack_places(ids: np.ndarray, ties: np.ndarray, rows: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """Window starts by document: ids, ties, starts of each, steps from one start to the next."""
    new = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    steps = np.diff(starts, prepend=0)
    steps[new] = starts[new]
    docs = rows[new]
    counts = np.diff(np.append(new, len(rows)))
    return [planes(ids[docs]), planes(ties[docs]), planes(counts.astype("<u4")), planes(steps.astype("<u4"))]


def unpack_places(ids: bytes, ties: bytes, counts: bytes, steps: bytes) -> tuple[np.ndarray, ...]:
    """Documents' ids and ties, the number of each start's document, and the starts."""
    n, step = from_planes(counts, "<u4").astype(np.int64), from_planes(steps, "<u4").astype(np.int64)
    first = np.concatenate(([0], np.cumsum(n)[:-1])).astype(np.int64)
    total = np.cumsum(step)
    before = np.repeat(total[first] - step[first], n) if len(n) else total
    return from_planes(ids, "<i8"), from_planes(ties, "<u4"), np.repeat(np.arange(len(n)), n), total - before


def prime_from(n: int) -> int:
    """The first prime that is not below ``n``."""
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def slots_of(ids: np.ndarray, ties: np.ndarray, slots: int) -> np.ndarray:
    """Slot of documents by id and checksum, so that rows that share an id, null too, do not share a task."""
    return (ids % slots + ties.astype(np.int64)) % slots
