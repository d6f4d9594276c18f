"""Columns of numbers as compressed bytes, for rows that carry many of them."""

from __future__ import annotations

import numpy as np
import zstandard


def small(x: np.ndarray) -> np.ndarray:
    """The same numbers in as few bytes each as the largest needs."""
    x = np.asarray(x)
    most = int(x.max()) if len(x) else 0
    return x.astype("<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4" if most < 1 << 32 else "<u8")


def pack(*columns: np.ndarray) -> bytes:
    """Columns of numbers as compressed bytes: most are small and alike."""
    head = np.array([len(columns), *[x for c in columns for x in (len(c), c.dtype.itemsize)]], dtype="<u8").tobytes()
    return zstandard.compress(head + b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(-1, c.dtype.itemsize).T.tobytes() for c in columns), 1)


def unpack(data: bytes) -> list[np.ndarray]:
    data = zstandard.decompress(data)
    n = int(np.frombuffer(data, "<u8", 1)[0])
    at, out = 8 + 16 * n, []
    for size, width in np.frombuffer(data, "<u8", 2 * n, 8).reshape(-1, 2).tolist():
        if size:
            out.append(np.ascontiguousarray(np.frombuffer(data, np.uint8, width * size, at).reshape(width, size).T).view(f"<u{width}").reshape(-1))
        else:
            out.append(np.zeros(0, f"<u{width}"))
        at += width * size
    return out


def steps(x: np.ndarray) -> np.ndarray:
    """Rising numbers as their differences."""
    return small(np.diff(x, prepend=x[:1] * 0))


def total(x: np.ndarray) -> np.ndarray:
    return np.cumsum(x, dtype=np.int64)
