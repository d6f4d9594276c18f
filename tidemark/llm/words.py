"""Words of whole texts as numbers, and streams of grouped rows, for the operators that work on Arrow batches."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from tidemark.llm.workers import kept

#: Words whose hash a Python worker keeps.
KEPT_WORDS = 150_000
_MULT = np.uint64(0x9E3779B97F4A7C15)
_FMIX = np.uint64(0xC2B2AE3D27D4EB4F)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < KEPT_WORDS:
            self[word] = h
        return h


def words(text: str | None) -> list[bytes]:
    r"""A-Z in lower case, then runs of bytes outside [\x20\x09-\x0D]; bytes.lower and bytes.split mean just these."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_hashes(own: list[bytes]) -> np.ndarray:
    return np.fromiter(map(kept("hashes", _Hashes).__getitem__, own), dtype=np.uint64, count=len(own))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes whose powers are kept; a run of words is hashed at once if it is no longer.
_RUN = 1 << 18


@functools.cache
def _letters() -> np.ndarray:
    """A random number for each byte, the same for A-Z as for a-z."""
    return np.array([xxhash.xxh3_64_intdigest(bytes([b]).lower()) for b in range(256)], dtype=np.uint64)


@functools.cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64 from 0 on, and of its inverse."""
    odd = int(_MULT)
    out = []
    for base in (odd, pow(odd, -1, 1 << 64)):
        own = np.full(2 * _RUN, base, dtype=np.uint64)
        own[0] = 1
        out.append(np.cumprod(own, dtype=np.uint64))
    return out[0], out[1]


def _long_hash(data: np.ndarray) -> int:
    """The hash of a word that is longer than a run, before mixing."""
    powers, h = _powers()[0], 0
    for at in range(0, len(data), _RUN):
        own = data[at : at + _RUN]
        part = int(np.sum(_letters()[own] * powers[: len(own)], dtype=np.uint64))
        h = (h + part * pow(int(_MULT), at, 1 << 64)) % (1 << 64)
    return h


def text_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    r"""The hashes of all words of all texts in order, and the number of words of each text.

    Words as in `words`, found and hashed in the texts' bytes: a word's hash is a polynomial in its bytes' random numbers,
    taken from prefix sums. Hashes are not those of word_hashes.
    """
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    ends = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    first = int(ends[0])
    ends = ends - first
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[first : first + int(ends[-1])]
    word = ~_SPACE[data]
    before, after = np.r_[False, word[:-1]][: len(word)], np.r_[word[1:], False][: len(word)]
    before[ends[:-1][ends[:-1] < len(word)]] = False
    after[ends[1:][ends[1:] > 0] - 1] = False
    starts, stops = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    del word, before, after
    counts = np.diff(np.searchsorted(starts, ends))
    out = np.empty(len(starts), dtype=np.uint64)
    letters, (powers, inverse) = _letters(), _powers()
    sums = np.zeros(2 * _RUN + 1, dtype=np.uint64)
    i = 0
    while i < len(starts):
        a = int(starts[i])
        if stops[i] - a > _RUN:
            out[i] = _long_hash(data[a : stops[i]])
            i += 1
            continue
        # Words that begin and end within two runs' bytes of here.
        j = int(np.searchsorted(starts, a + _RUN))
        j -= int(stops[j - 1] - a > 2 * _RUN)
        z = int(stops[j - 1]) - a
        own = letters[data[a : a + z]]
        own *= powers[:z]
        np.cumsum(own, out=sums[1 : z + 1])
        s = starts[i:j] - a
        out[i:j] = (sums[stops[i:j] - a] - sums[s]) * inverse[s]
        i = j
    return mixed(out), counts


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _FMIX
    return h ^ (h >> np.uint64(32))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of `width` words; of the whole sequence if it is shorter; none for no words."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(width, n)
    out = np.full(n - width + 1, width, dtype=np.uint64)
    for j in range(width):
        out = (out ^ (out >> np.uint64(32))) * _MULT + hashes[j : n - width + 1 + j]
    return np.unique(mixed(out))


def slices(batches: Iterable[pa.RecordBatch], column: int, size: int = 4 << 20, most: int = 1 << 15) -> Iterator[pa.RecordBatch]:
    """Parts of Arrow batches with about `size` bytes of one column's text, a row at least and `most` rows at most."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = int(ends[at - 1]) if at else 0
            to = min(at + most, max(at + 1, int(np.searchsorted(ends, done + size, "right"))))
            yield batch.slice(at, to - at)
            at = to


def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples; binary values as bytes, of some rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, 64).columns), strict=True)


def groups(batches: Iterable[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal first `n_keys` values, from batches that are sorted by them."""
    key, own = None, []
    for row in rows(batches):
        k = row[:n_keys]
        if k != key:
            if own:
                yield key, own
            key, own = k, []
        own.append(row[n_keys:])
    if own:
        yield key, own


def tables(of: Iterable[dict], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Dictionaries as Arrow batches."""
    held: list[dict] = []
    for row in of:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)
