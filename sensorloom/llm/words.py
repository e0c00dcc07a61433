"""Words, word hashes and hashes of word runs, over whole batches of texts at once."""

import numpy as np

#: What separates words: blank, and tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(0, 2**64, 256, np.uint64)
_ODD = [int(x) | 5 for x in _rng.integers(2**63, 2**64, 4, np.uint64)]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = (n | 0xFFFF) + 1
        step = np.full(size, base, np.uint64)
        back = np.full(size, pow(base, -1, 2**64), np.uint64)
        step[0] = back[0] = 1
        have = _powers[base] = (np.cumprod(step), np.cumprod(back))
    return have


def forget() -> None:
    """Drop the tables of powers; they are as long as the longest slice so far."""
    _powers.clear()


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word, and the n + 1 places where the texts' words begin."""
    blank = SPACE[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = ~blank
    begins[1:] &= blank[:-1] | edge[1:-1]
    ends = ~blank
    ends[:-1] &= blank[1:] | edge[1:-1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return begin, end, np.searchsorted(begin, offsets)


def runs(values: np.ndarray, begin: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
    """A 64-bit hash of each slice of ``values``; equal slices have equal hashes. ``which``: 0 to 3."""
    power, back = _power(_ODD[which], len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=total[1:])
    return mix((total[end] - total[begin]) * back[begin] + (end - begin).astype(np.uint64))


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    return runs(_BYTE[data], begin, end, 0)
