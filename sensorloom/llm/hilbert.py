"""Keys of points on a Hilbert curve, for many points at once."""

import numpy as np


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the curve of each row of ``points``: whole numbers below 2**bits, at most 63 bits in all.

    The coordinates are turned into the curve's own by rotations and reflections, the highest bit
    first, and then interleaved through a Gray code.
    """
    x = points.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        q = 1 << level
        low = q - 1
        for i in range(n):
            up = (x[i] & q) > 0
            swap = (x[0] ^ x[i]) & low
            x[0] = np.where(up, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = np.where(up, x[i], x[i] ^ swap)
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip = np.where((x[-1] >> level) & 1, flip ^ ((1 << level) - 1), flip)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> level) & 1
    return key
