"""WyHash (Wang Yi, public domain), the hash of shard values, as 16 hex digits of the UTF-8 text with seed 0.

Its products have 128 bits, which no SQL type holds, so it is Python: on the driver for literals, and over distinct shard
values (not rows) when a catalog is built.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_MASK = (1 << 64) - 1
#: Fixed values of the algorithm.
_W = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F)


def _mix(a: int, b: int) -> int:
    product = a * b
    return (product & _MASK) ^ (product >> 64)


def wyhash(data: bytes, seed: int = 0) -> int:
    n, state = len(data), seed ^ _W[0]

    def word(at: int, size: int = 8) -> int:
        return int.from_bytes(data[at : at + size], "little")

    at = 0
    if n > 64:
        other = state
        while n - at > 64:
            state = _mix(word(at) ^ _W[1], word(at + 8) ^ state) ^ _mix(word(at + 16) ^ _W[2], word(at + 24) ^ state)
            other = _mix(word(at + 32) ^ _W[3], word(at + 40) ^ other) ^ _mix(word(at + 48) ^ _W[4], word(at + 56) ^ other)
            at += 64
        state ^= other
    while n - at > 16:
        state = _mix(word(at) ^ _W[1], word(at + 8) ^ state)
        at += 16
    left = n - at
    if left > 8:
        a, b = word(at), word(n - 8)
    elif left >= 4:
        a, b = word(at, 4), word(n - 4, 4)
    elif left:
        a, b = data[at] << 16 | data[at + (left >> 1)] << 8 | data[n - 1], 0
    else:
        a = b = 0
    return _mix(_W[1] ^ n, _mix(a ^ _W[1], b ^ state))


def wyhash_hex(text: str) -> str:
    return f"{wyhash(text.encode()):016x}"


#: The shard hash of tables without a shard key: that of the empty text.
UNSHARDED = wyhash_hex("")


def wyhash_column(column: Column) -> Column:
    """For columns of few rows, such as a catalog's: null counts as the empty text."""

    def hashes(texts: pd.Series) -> pd.Series:
        return texts.fillna("").map(wyhash_hex)

    return F.pandas_udf(hashes, "string")(column)
