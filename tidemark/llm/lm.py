r"""Language model scoring with a hierarchical Pitman-Yor model.

Tokens are words of the whole text (A-Z in lower case, outside [\x20\x09-\x0D]) and one end; words are known by their
64-bit hashes. A restaurant for each two previous words has as its parent the restaurant of the last of them, whose parent
is the restaurant of single words; the parent of that is uniform over the V training words and one unknown word:

    p(w | u v) = (c_uvw - d2 t_uvw + (s + d2 t_uv) p(w | v)) / (s + c_uv)
    p(w | v)   = (c_vw - d1 t_vw + (s + d1 t_v) p(w)) / (s + c_v)        c_vw: tables t_uvw over all u
    p(w)       = (c_w - d0 t_w + (s + d0 t) / (V + 1)) / (s + c)         c_w: tables t_vw over all v

with customers c and tables t. Only c_uvw is counted in the texts; all tables are sampled.

1. Tokens are counted, and words that are frequent in a slice of the texts. The number of buckets follows from the number
   of tokens, never from the session's settings.
2. Texts are tokenized in slices. A slice sends the distinct (u, v, w) it holds to the bucket of v, so a restaurant v and
   all its children are in one bucket. A word v of more than half a bucket is dealt by u as well: then its children
   stay whole, and v's own restaurant is kept where single words are (3). Which document holds what stays with the slice.
3. The restaurant of single words is dealt by word to parts. A round: buckets send their tables t_vw (or t_uvw of divided
   words) to the parts, which sum them over all buckets, seat them and answer each word's customers, tables and posterior
   mass. Only sums, and a few numbers for each divided word (2 for each bucket at most), reach the driver.
4. Given the masses of single words, restaurants of different v are independent, so a round makes several Gibbs sweeps in
   each bucket: tables of each entry given all others, P(t) in proportion to S(c, t) (d x G(w))^t with S generalized Stirling
   numbers, x a gamma variate of shape s / d + (the restaurant's tables) and G the parent's masses, drawn from their
   posterior. BURN sweeps come before the first sample, BETWEEN before the next. Discounts are estimated from counts of
   counts over all buckets. Random numbers belong to words, pairs and triples, so nothing depends on how data are dealt.
5. Buckets answer each slice the probabilities of its entries (the mean of the samples; log10 in steps of 2**-14) and the
   words' counts, and the slice sums them up by document. What is sent grows with the tokens, not with documents by buckets.

Above EXACT customers the Stirling numbers follow their scaling law, S(c, t) ~ d^(1-t) / Gamma(t) h(t / c^d), with h from the
row of EXACT customers. Two previous words that follow each other very often are one task's: their entries, not their
occurrences, since a slice sends a triple once.

Cases: null text is an empty text: one end token. Null doc_id counts as the text "" for the split and is returned as
it is; repeated rows are trained on and scored each; without training rows N and V are 0 and the parent is uniform over
the unknown word, so scores are 0; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.columns import pack, small, steps, total, unpack
from tidemark.llm.words import groups, mixed, slices, tables, text_hashes
from tidemark.llm.workers import tidy, trim
from tidemark.session import Scratch, importable

#: Sweeps before the first sample, and between it and the second.
BURN, BETWEEN = 3, 2
#: Strength of a restaurant.
STRENGTH = 1.0
END = xxhash.xxh3_64_intdigest(b"\n end")
START = xxhash.xxh3_64_intdigest(b"\n start")
#: Tokens of a bucket, about; buckets whose words make a part; bytes of text of a slice. A task has one in memory at a time.
BUCKET_TOKENS, PART_BUCKETS, SLICE_BYTES = 1_400_000, 6, 12 << 20
#: A slice counts words that it holds this often, so a word's count is short by less for each slice.
FREQUENT = 8
#: Frequent words that have a number of their own everywhere, so that their hashes need not be sent. Others have one in each table.
NUMBERED = 1 << 18
#: Customers of an entry up to which its tables are drawn from Stirling numbers by recursion.
EXACT = 1000
#: Discounts before the first round has counted.
FIRST_DISCOUNT = 0.5
#: Steps of a log10: a token's is off by 3e-5 at most, and by nothing on average.
FINE = 1 << 14

_SENT = "key int, slice string, {ids}, held binary, data binary"
#: key: a bucket, or a part of the words for kind ask. source: where an ask or answer comes from.
_KEPT = "key int, kind string, source int, slice string, {ids}, held binary, data binary, totals array<double>, hot array<array<double>>"
_PART = "slice string, source int, {ids}, held binary, data binary"
_OUT = "doc_id {id_type}, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def uniform(keys: np.ndarray, *salt: int) -> np.ndarray:
    """A number over 0 and under 1 for each key, the same wherever it is drawn."""
    with np.errstate(over="ignore"):
        own = np.uint64(xxhash.xxh3_64_intdigest(repr(salt)))
        h = mixed(mixed(np.asarray(keys, dtype=np.uint64) + own) ^ own)
    return (h >> np.uint64(12)).astype(np.float64) * 2.0**-52 + 2.0**-53


def gamma(shape: np.ndarray, keys: np.ndarray, *salt: int) -> np.ndarray:
    """Gamma variates (Marsaglia and Tsang), each of its key; 0 for a shape of 0."""
    out = np.zeros(len(shape))
    a = np.where(shape < 1, shape + 1, shape) - 1 / 3
    todo, turn = np.flatnonzero(shape > 0), 0
    while len(todo):
        k, d = keys[todo], a[todo]
        x = np.sqrt(-2 * np.log(uniform(k, *salt, turn, 0))) * np.cos(2 * np.pi * uniform(k, *salt, turn, 1))
        v = np.maximum(1 + x / np.sqrt(9 * d), 0) ** 3
        ok = (v > 0) & (np.log(uniform(k, *salt, turn, 2)) < x * x / 2 + d - d * v + d * np.log(np.maximum(v, 1e-300)))
        out[todo[ok]] = (d * v)[ok]
        todo, turn = todo[~ok], turn + 1
    low = (shape > 0) & (shape < 1)
    out[low] *= uniform(keys[low], *salt, -1) ** (1 / shape[low])
    return out


@functools.lru_cache(maxsize=4)
def stirling(discount: float, most: int = EXACT) -> np.ndarray:
    """Logarithms of the generalized Stirling numbers of up to `most` customers (row) and tables (column)."""
    out = np.full((most + 1, most + 2), -np.inf)
    out[1, 1] = 0.0
    for c in range(1, most):
        t = np.arange(1, c + 2)
        out[c + 1, t] = np.logaddexp(out[c, t - 1], out[c, t] + np.log(np.maximum(c - discount * t, 1e-300)))
    return out


@functools.lru_cache(maxsize=4)
def _law(discount: float) -> np.ndarray:
    """h of the scaling law, as logarithms at t = 1, 2, ... of EXACT customers."""
    t = np.arange(1, EXACT + 1)
    return stirling(discount)[EXACT, 1 : EXACT + 1] + np.array([math.lgamma(x) for x in t]) + (t - 1) * math.log(discount)


def _log_weights(customers: int, log_z: float, discount: float) -> np.ndarray:
    """Logarithms of the weights of 1, 2, ... tables for more than EXACT customers, up to where they vanish."""
    scale = (EXACT / customers) ** discount
    mean = math.exp(min(log_z, 50)) / discount
    most = int(min(customers, EXACT / scale, mean + 12 * math.sqrt(mean) + 60))
    t = np.arange(1, most + 1)
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.maximum(t[:-1], 1)))])  # log Gamma(t)
    return (t - 1) * (log_z - math.log(discount)) - logs + np.interp(t * scale, np.arange(1, EXACT + 1), _law(discount))


def resample(customers: np.ndarray, z: np.ndarray, discount: float, keys: np.ndarray, *salt: int) -> np.ndarray:
    """Tables of each entry, t with a probability in proportion to S(customers, t) z^t."""
    out = np.minimum(customers, 1).astype(np.int64)
    log_s, log_z = stirling(discount), np.log(np.maximum(z, 1e-300))
    some = np.flatnonzero(customers > 1)
    some = some[np.argsort(customers[some], kind="stable")]
    u = uniform(keys[some], *salt)
    own = customers[some]
    cuts = np.flatnonzero(np.r_[True, np.diff(own) > 0, True]) if len(some) else []
    for first, end in zip(cuts, cuts[1:], strict=False):
        c = int(own[first])
        if c > EXACT:
            for i in range(first, end):
                w = _log_weights(c, float(log_z[some[i]]), discount)
                w = np.cumsum(np.exp(w - w.max()))
                out[some[i]] = 1 + int((w[:-1] <= u[i] * w[-1]).sum())
            continue
        t, size = np.arange(1, c + 1), max(1, (1 << 18) // c)
        for i in range(first, end, size):
            j = min(end, i + size)
            w = log_s[c, 1 : c + 1] + log_z[some[i:j], None] * t
            w = np.cumsum(np.exp(w - w.max(axis=1, keepdims=True)), axis=1)
            out[some[i:j]] = 1 + (w[:, :-1] <= u[i:j, None] * w[:, -1:]).sum(axis=1)
    return out


def rate(one: float, two: float) -> float:
    """A discount, from how many entries have one customer, and two."""
    return min(0.95, max(0.05, one / (one + 2 * two))) if one else 0.5


def lean(x: np.ndarray) -> np.ndarray:
    """The same numbers in 32 bits, if they fit."""
    return x.astype(np.int32) if not len(x) or x.max() < 1 << 31 else x.astype(np.int64)


def steps_within(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Numbers that rise within each run as their differences; a run's first number stays."""
    out = np.diff(x, prepend=x[:1] * 0)
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    out[first] = x[first]
    return small(out)


def within(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The inverse of steps_within."""
    out = total(x)
    start = np.cumsum(sizes) - sizes
    return out - np.repeat(np.r_[0, out][start], sizes)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all texts one after another, and the number of each text's."""
    own, counts = text_hashes(texts)
    out = np.empty(len(own) + len(counts), dtype=np.uint64)
    ends = np.cumsum(counts + 1) - 1
    out[ends] = END
    out[np.arange(len(own)) + np.repeat(np.arange(len(counts)), counts)] = own
    return out, counts + 1


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 0, size=SLICE_BYTES):
        own, _ = _tokens(batch.column(0))
        word, n = np.unique(own, return_counts=True)
        word, n = word[n >= FREQUENT], n[n >= FREQUENT]
        yield pa.RecordBatch.from_arrays([pa.array([None, *word.view(np.int64).tolist()], pa.int64()), pa.array([len(own), *n.tolist()], pa.int64())], ["word", "n"])


def _rough(masses: np.ndarray) -> np.ndarray:
    """Masses as the bytes of floats of 12 binary digits, which is finer than a random draw need be."""
    return (masses.astype("<f4").view("<u4") + np.uint32(0x400)) & np.uint32(0xFFFFF800)


def _share(hashes: np.ndarray, n: int) -> np.ndarray:
    """Numbers from 0 to n - 1 that rise with the hash."""
    return (((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


class Dealing:
    """Buckets, parts, words that are numbered (`top`, at most NUMBERED), and words that are divided (`hot`, sorted, with the number of pieces of each)."""

    def __init__(self, tokens: int, top: np.ndarray, often: dict[int, int], bucket_tokens: int):
        self.top = top
        self.buckets = max(1, -(-tokens // bucket_tokens))
        self.parts = -(-self.buckets // PART_BUCKETS)
        self.hot = np.array(sorted(often), dtype=np.uint64)
        self.pieces = np.array([0, *(-(-2 * often[w] // bucket_tokens) for w in sorted(often))], dtype=np.uint64)

    def numbers(self, word: np.ndarray) -> np.ndarray:
        """Of sorted hashes: the number of numbered words, and the numbers after those, in order, of others."""
        order = np.argsort(self.top)
        ordered = self.top[order]
        at = np.minimum(np.searchsorted(ordered, word), len(ordered) - 1) if len(ordered) else np.zeros(len(word), dtype=np.int64)
        known = ordered[at] == word if len(ordered) else np.zeros(len(word), dtype=bool)
        out = len(self.top) + np.cumsum(~known) - 1
        out[known] = order[at[known]]
        return out

    def place(self, word: np.ndarray) -> np.ndarray:
        """The place among the divided words, from 1; 0 for others."""
        if not len(self.hot):
            return np.zeros(len(word), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.hot, word), len(self.hot) - 1)
        return np.where(self.hot[at] == word, at + 1, 0)

    def bucket(self, words_: np.ndarray, v: np.ndarray, u: np.ndarray) -> np.ndarray:
        """Of tokens after v and u, which are places in words_."""
        with np.errstate(over="ignore"):
            own = mixed(words_)
            out = _share(own, self.buckets)[v]
            place = self.place(words_)
            at = np.flatnonzero(place[v] > 0) if place.any() else []
            if len(at):
                piece = (mixed(own[u[at]]) >> np.uint64(20)) % self.pieces[place[v[at]]]
                out[at] = _share(mixed(own[v[at]] + piece * np.uint64(0x9E3779B97F4A7C15)), self.buckets)
        return out


def _send(shared: Broadcast, schema: pa.Schema):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(slices(batches, 2, size=SLICE_BYTES)):
            yield from tables(_of_slice(f"{task}-{number}", batch), schema, 64)

    def _of_slice(name: str, batch: pa.RecordBatch) -> Iterator[dict]:
        deal = shared.value
        none = dict.fromkeys(x.name for x in schema)
        ids, held = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), dtype=bool)
        own, lengths = _tokens(batch.column(2))
        words_, w = np.unique(np.r_[own, np.uint64(START)], return_inverse=True)
        del own
        # Words by their numbers from here on.
        number = deal.numbers(words_)
        order = np.argsort(number)
        words_, number = words_[order], number[order]
        at = np.empty(len(order), dtype=np.int32)
        at[order] = np.arange(len(order), dtype=np.int32)
        w = at[w]
        start, w = w[-1], w[:-1]
        first = np.cumsum(lengths) - lengths
        v = np.r_[start, w[:-1]]
        v[first] = start
        u = np.r_[start, v[:-1]]
        u[first] = start
        bucket = deal.bucket(words_, v, u)
        bits = len(words_).bit_length()
        if 3 * bits + deal.buckets.bit_length() < 64:
            bucket <<= bits
            for x in (v, u):
                bucket += x
                bucket <<= bits
            bucket += w
            order = np.argsort(bucket)
            key = bucket[order]
            del bucket, v, u, w
            at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            key, size, mask = key[at], len(key), (1 << bits) - 1
            bucket, v, u, w = key >> 3 * bits, key >> 2 * bits & mask, key >> bits & mask, key & mask
        else:
            order = np.lexsort((w, u, v, bucket))
            bucket, v, u, w = (x[order] for x in (bucket, v, u, w))
            at = np.flatnonzero(np.r_[True, (w[1:] != w[:-1]) | (u[1:] != u[:-1]) | (v[1:] != v[:-1]) | (bucket[1:] != bucket[:-1])])
            size = len(w)
            bucket, v, u, w = (x[at] for x in (bucket, v, u, w))
        doc = np.repeat(np.arange(len(ids), dtype=np.uint16), lengths)[order]
        del order
        counts = np.diff(np.r_[at, size])
        n = np.add.reduceat((~held)[doc].astype(np.int64), at)
        buckets, cuts = np.unique(bucket, return_index=True)
        cuts = np.r_[cuts, len(bucket)]
        yield none | {"key": xxhash.xxh32_intdigest(name) % deal.buckets, "slice": name, "ids": ids, "held": np.packbits(held).tobytes(), "data": pack(small(lengths), doc, small(counts), small(buckets), small(np.diff(cuts)))}
        top = int(np.searchsorted(number, len(deal.top)))
        others, used = words_[top:], np.zeros(len(words_) - top, dtype=bool)
        for b, i, j in zip(buckets.tolist(), cuts, cuts[1:], strict=False):
            used[:] = False
            for x in (v[i:j], u[i:j], w[i:j]):
                used[x[x >= top] - top] = True
            local = np.concatenate([number[:top], len(deal.top) - 1 + np.cumsum(used)])
            yield none | {"key": b, "slice": name, "data": pack(steps(others[used]), steps(local[v[i:j]]), small(local[u[i:j]]), small(local[w[i:j]]), small(n[i:j]))}

    return run


class Bucket:
    """A bucket's entries (u, v, w), sorted by v, u and w, with what is derived from them.

    words: hashes, of numbered words and then of others. n, t: customers and tables of entries. context: an entry's (v, u). pair: an entry's (v, w), with
    pair_t its tables. asked: places of the words that follow anything. divided: pairs whose v is divided.
    """

    def __init__(self, words_: np.ndarray, v: np.ndarray, contexts: np.ndarray, u: np.ndarray, pairs: np.ndarray, w: np.ndarray, sizes: np.ndarray, pair: np.ndarray, n: np.ndarray, deal: Dealing):
        """v: places of the words that are followed. contexts, pairs: how many of each v. u, sizes: of contexts; w: of pairs; pair (its number within its v's), n: of entries."""
        self.words, self.deal, self.sizes, self.n = words_, deal, sizes, lean(n)
        self.by_v = v, contexts, u, pairs, w
        self.context_v, self.pair_v, self.pair_w = np.repeat(lean(v), contexts), np.repeat(lean(v), pairs), lean(w)
        self.context = np.repeat(np.arange(len(u), dtype=np.int32), sizes)
        self.pair = lean(pair + np.repeat(np.repeat(np.cumsum(pairs) - pairs, contexts), sizes))
        seen = np.zeros(len(words_), dtype=bool)
        seen[w] = True
        asked = np.flatnonzero(seen)
        self.asked = asked[np.argsort(words_[asked])]
        ask = np.empty(len(words_), dtype=np.int64)
        ask[self.asked] = np.arange(len(asked))
        self.ask = lean(ask[w])  # of each pair
        place = deal.place(words_)[self.pair_v]
        divided = np.flatnonzero(place)
        self.divided = divided[np.lexsort((place[divided], words_[w[divided]]))]
        self.place = place[self.divided]
        self.local = place == 0
        with np.errstate(over="ignore"):
            own = mixed(words_)
            self.v_keys = own
            self.pair_keys = mixed(own[self.pair_v] + np.uint64(1)) + words_[w]
            self.context_keys = mixed(own[self.context_v] + np.uint64(2)) + words_[u]
        self.t = np.minimum(self.n, 1)
        self.pair_t = np.where(self.local, np.minimum(self.sum_pairs(self.t), 1), 0)

    def entry_keys(self, at: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed(self.context_keys[self.context[at]]) + self.words[self.pair_w[self.pair[at]]]

    @classmethod
    def of_entries(cls, words_: np.ndarray, context_v: np.ndarray, u: np.ndarray, sizes: np.ndarray, w: np.ndarray, n: np.ndarray, deal: Dealing) -> Bucket:
        """context_v, u, sizes: of contexts in order; w, n: of entries."""
        k = len(words_)
        numbered, pair = np.unique(np.repeat(context_v, sizes) * k + w, return_inverse=True)
        v, contexts = np.unique(context_v, return_counts=True)
        pairs = np.bincount(np.searchsorted(v, numbered // k), minlength=len(v))
        pair -= np.repeat(np.repeat(np.cumsum(pairs) - pairs, contexts), sizes)
        return cls(words_, v, contexts, u, pairs, numbered % k, sizes, pair, n, deal)

    @classmethod
    def load(cls, data: bytes, deal: Dealing) -> Bucket:
        words_, v, contexts, u, pairs, w, sizes, pair, n = unpack(data)
        contexts, pairs = contexts.astype(np.int64), pairs.astype(np.int64)
        return cls(np.concatenate([deal.top, np.cumsum(words_, dtype=np.uint64)]), total(v), contexts, within(u, contexts), pairs, within(w, pairs), sizes.astype(np.int64), pair.astype(np.int64), n.astype(np.int64), deal)

    def saved(self) -> bytes:
        v, contexts, u, pairs, w = self.by_v
        number = self.pair - np.repeat(np.repeat(np.cumsum(pairs) - pairs, contexts), self.sizes)
        return pack(steps(self.words[len(self.deal.top) :]), steps(v), small(contexts), steps_within(u, contexts), small(pairs), steps_within(w, pairs), small(self.sizes), small(number), small(self.n))

    def sum_pairs(self, x: np.ndarray) -> np.ndarray:
        return lean(np.bincount(self.pair, weights=x, minlength=len(self.pair_v)))

    def sum_v(self, x: np.ndarray, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        return np.bincount(self.pair_v[at], weights=x, minlength=len(self.words)).astype(np.float64)

    def tables(self) -> bytes:
        return pack(small(self.t), small(self.pair_t))

    def set_tables(self, data: bytes) -> None:
        self.t, self.pair_t = (lean(x) for x in unpack(data))

    def hear(self, answers: list[tuple[int, bytes]], m: dict) -> None:
        """Customers, tables and masses of single words and of divided words' pairs, and the probabilities and masses they give."""
        found = [np.concatenate(x) for x in zip(*[unpack(data) for _, data in sorted(answers)], strict=True)]
        c, t, g, self.seen, hot_c, hot_t, hot_g = found
        each = 1 / (m["known"] + 1)
        self.mass = (g.view("<f4") + m["new"] * each) / m["mass"]
        self.p_word = (c - m["d0"] * t + (STRENGTH + m["d0"] * m["tables"]) * each) / (STRENGTH + m["customers"])
        self.pair_mass = self.mass[self.ask]
        k = self.place
        self.divided_mass = (hot_g.view("<f4") + m["hot_new"][k] * self.pair_mass[self.divided]) / m["hot_mass"][k]
        self.hot_c, self.hot_t = hot_c.astype(np.float64), hot_t.astype(np.float64)

    def sweep(self, m: dict, sweeps: int, turn: int) -> None:
        """m: what the last round counted."""
        d2, d1 = m["d2"], m["next_d1"]
        many = np.flatnonzero(self.n > 1)
        contexts = np.unique(self.context[many])
        needed = np.zeros(len(self.pair_v), dtype=bool)
        needed[self.pair[many]] = True
        rest, needed = np.flatnonzero(self.local & ~needed), np.flatnonzero(self.local & needed)
        parents = np.unique(self.pair_v[needed])
        keys = self.entry_keys(many)
        for k in range(sweeps):
            c = self._seat_pairs(d1, turn, k)
            shape = c - d1 * self.pair_t
            masses = gamma(shape[needed], self.pair_keys[needed], turn, k, 2)
            # Of pairs whose own mass nobody asks for, only the sum counts, and a sum of gamma variates is one.
            others = gamma(self.sum_v(shape[rest], rest)[parents], self.v_keys[parents], turn, k, 3)
            new = np.zeros(len(self.words))
            new[parents] = gamma(STRENGTH + d1 * self.sum_v(self.pair_t)[parents], self.v_keys[parents], turn, k, 4)
            sums = self.sum_v(masses, needed)
            sums[parents] += others + new[parents]
            mass = np.zeros(len(self.pair_v))
            mass[needed] = (masses + new[self.pair_v[needed]] * self.pair_mass[needed]) / sums[self.pair_v[needed]]
            mass[self.divided] = self.divided_mass
            x = np.zeros(len(self.sizes))
            x[contexts] = gamma(STRENGTH / d2 + np.bincount(self.context, weights=self.t, minlength=len(x))[contexts], self.context_keys[contexts], turn, k, 5)
            self.t[many] = resample(self.n[many], d2 * x[self.context[many]] * mass[self.pair[many]], d2, keys, turn, k, 6)
        self._seat_pairs(d1, turn, sweeps)

    def _seat_pairs(self, d1: float, turn: int, k: int) -> np.ndarray:
        """Tables of (v, w) given their customers, which are returned."""
        c = np.where(self.local, self.sum_pairs(self.t), 0)
        several = np.flatnonzero(c > 1)
        parents = np.unique(self.pair_v[several])
        now = np.minimum(c, 1)
        x = np.zeros(len(self.words))
        x[parents] = gamma(STRENGTH / d1 + self.sum_v(np.clip(self.pair_t, now, c))[parents], self.v_keys[parents], turn, k, 0)
        now[several] = resample(c[several], d1 * x[self.pair_v[several]] * self.pair_mass[several], d1, self.pair_keys[several], turn, k, 1)
        self.pair_t = now
        return c

    def probabilities(self, m: dict) -> np.ndarray:
        """Of entries, by the present tables."""
        d2, d1 = m["d2"], m["d1"]
        c, t = self.sum_pairs(self.t).astype(np.float64), self.pair_t.astype(np.float64)
        all_c, all_t = (self.sum_v(np.where(self.local, x, 0))[self.pair_v] for x in (c, t))
        c[self.divided], t[self.divided] = self.hot_c, self.hot_t
        all_c[self.divided], all_t[self.divided] = m["hot_customers"][self.place], m["hot_tables"][self.place]
        p = (c - d1 * t + (STRENGTH + d1 * all_t) * self.p_word[self.ask]) / (STRENGTH + all_c)
        in_context = lambda x: np.bincount(self.context, weights=x, minlength=len(self.sizes))[self.context]
        return (self.n - d2 * self.t + (STRENGTH + d2 * in_context(self.t)) * p[self.pair]) / (STRENGTH + in_context(self.n))

    def asks(self, none: dict, bucket: int, first: bool) -> Iterator[dict]:
        """To each part: words with the tables of local pairs and their counts, divided pairs with tables and the word's mass."""
        c = self.sum_pairs(self.t)
        up = np.bincount(self.ask, weights=self.pair_t, minlength=len(self.asked)).astype(np.int64)
        seen = np.bincount(self.ask[self.pair], weights=self.n, minlength=len(self.asked)).astype(np.int64)
        own, hot = self.words[self.asked], self.words[self.pair_w[self.divided]]
        mass = np.zeros(len(hot), "<f4") if first else self.pair_mass[self.divided].astype("<f4")
        ends = np.arange(self.deal.parts + 1)
        cuts, hot_cuts = (np.searchsorted(_share(x, self.deal.parts), ends) for x in (own, hot))
        c_local = c[self.local]
        sums = [float(x) for x in (self.n.sum(), (self.n == 1).sum(), (self.n == 2).sum(), (c_local == 1).sum(), (c_local == 2).sum())]
        for part, (i, j, a, z) in enumerate(zip(cuts, cuts[1:], hot_cuts, hot_cuts[1:], strict=False)):
            if j > i:
                yield none | {
                    "key": part, "kind": "ask", "source": bucket, "totals": sums,
                    "data": pack(steps(own[i:j]), small(up[i:j]), small(seen[i:j]), small(self.place[a:z]), hot[a:z], small(c[self.divided[a:z]]), mass[a:z].view("<u4")),
                }
                sums = None


def _train(shared: Broadcast, schema: pa.Schema):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket,), own in groups(batches, 1):
            yield from tables(_of_bucket(bucket, own), schema, 16)

    def _of_bucket(bucket: int, own: list[tuple]) -> Iterator[dict]:
        deal, none = shared.value, dict.fromkeys(x.name for x in schema)
        names, parts = [], []
        while own:
            name, ids, held, data = own.pop()
            if ids is not None:
                yield none | {"key": bucket, "kind": "slice", "slice": name, "ids": ids, "held": held, "data": data}
            else:
                names.append(name)
                words_, *rest = unpack(data)
                parts.append((np.cumsum(words_, dtype=np.uint64), *rest))
        if not parts:
            return
        others = np.unique(np.concatenate([p[0] for p in parts]))
        words_, top = np.concatenate([deal.top, others]), len(deal.top)
        k, sent = len(words_), [len(p[1]) for p in parts]
        context, w, n = [], [], []
        for own_words, v, u, w_, n_ in parts:
            at = np.concatenate([np.arange(top), top + np.searchsorted(others, own_words)])
            context.append(at[total(v)] * k + at[u])
            w.append(lean(at[w_]))
            n.append(lean(n_))
        del parts
        context, w, n = np.concatenate(context), np.concatenate(w), np.concatenate(n)
        contexts = None
        if 3 * k.bit_length() > 62:
            contexts, context = np.unique(context, return_inverse=True)
        context *= k
        context += w
        del w
        entries, entry = np.unique(context, return_inverse=True)
        del context
        entry = lean(entry)
        n = lean(np.bincount(entry, weights=n, minlength=len(entries)))
        at = 0
        for name, size in zip(names, sent, strict=True):
            yield none | {"key": bucket, "kind": "index", "slice": name, "data": pack(steps(entry[at : at + size]))}
            at += size
        del entry
        context, w = entries // k, entries % k
        first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
        sizes, context = np.diff(np.r_[first, len(context)]), context[first]
        if contexts is not None:
            context = contexts[context]
        state = Bucket.of_entries(words_, context // k, context % k, sizes, w, n, deal)
        yield none | {"key": bucket, "kind": "state", "data": state.saved()}

    return run


def _ask(shared: Broadcast, schema: pa.Schema):
    """What buckets (key, data) ask before anything is seated."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = dict.fromkeys(x.name for x in schema)
        for (bucket,), own in groups(batches, 1):
            yield from tables(Bucket.load(own[0][0], shared.value).asks(none, bucket, True), schema, 16)

    return run


def _answer(shared: Broadcast, m: dict | None, turn: int, schema: pa.Schema):
    """The restaurant of single words, and those of divided words. m: what the last round counted; none in the first."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = dict.fromkeys(x.name for x in schema)
        for (key,), own in groups(batches, 1):
            asks = [r[1:] for r in own if r[0] == "ask"]
            yield from tables((none | {"key": key, "kind": kind, "source": source, "data": data} for kind, source, data, _ in own if kind != "ask"), schema, 16)
            if asks:
                yield from tables(_of_part(key, asks), schema, 64)

    def _of_part(part: int, own: list[tuple]) -> Iterator[dict]:
        deal, none = shared.value, dict.fromkeys(x.name for x in schema)
        own.sort(key=lambda r: r[0])
        asked = [unpack(data) for _, data, _ in own]
        for a in asked:
            a[0] = np.cumsum(a[0], dtype=np.uint64)
        words_, at = np.unique(np.concatenate([a[0] for a in asked]), return_inverse=True)
        up, seen = (np.bincount(at, weights=np.concatenate([a[i] for a in asked]), minlength=len(words_)).astype(np.int64) for i in (1, 2))
        count = len(deal.hot) + 1
        word = np.searchsorted(words_, np.concatenate([a[4] for a in asked]))
        hot, hot_first, hot_at = np.unique(word * count + np.concatenate([a[3] for a in asked]).astype(np.int64), return_index=True, return_inverse=True)
        hot_word, place = hot // count, hot % count
        hot_c = np.bincount(hot_at, weights=np.concatenate([a[5] for a in asked]), minlength=len(hot)).astype(np.int64)
        with np.errstate(over="ignore"):
            hot_keys = mixed(mixed(deal.hot)[place - 1] + np.uint64(1)) + words_[hot_word] if len(hot) else np.zeros(0, np.uint64)
        hot_t = np.minimum(hot_c, 1)
        d1, d0 = (m["next_d1"], m["next_d0"]) if m else (FIRST_DISCOUNT, FIRST_DISCOUNT)
        if m:
            mass = np.concatenate([a[6] for a in asked]).view("<f4").astype(np.float64)[hot_first]
            hot_t = resample(hot_c, d1 * m["hot_x"][place] * mass, d1, hot_keys, turn, 11)
        c = up + np.bincount(hot_word, weights=hot_t, minlength=len(words_)).astype(np.int64)
        t = resample(c, np.full(len(c), d0 * m["x"] / (m["known"] + 1)), d0, words_, turn, 12) if m else np.minimum(c, 1)
        g, hot_g = _rough(gamma(c - d0 * t, words_, turn, 13)), _rough(gamma(hot_c - d1 * hot_t, hot_keys, turn, 14))
        cuts, hot_cuts = (np.cumsum([0, *(len(a[i]) for a in asked)]) for i in (0, 3))
        for (source, *_), i, j, y, z in zip(own, cuts, cuts[1:], hot_cuts, hot_cuts[1:], strict=False):
            mine, hers = at[i:j], hot_at[y:z]
            yield none | {
                "key": source, "kind": "answer", "source": part,
                "data": pack(*(x.astype("<u4") for x in (c[mine], t[mine])), g[mine], seen[mine].astype("<u8"), *(x[hers].astype("<u8") for x in (hot_c, hot_t)), hot_g[hers]),
            }
        sums = np.zeros(5)
        for _, _, more in own:
            if more is not None:
                sums += more
        g, hot_g = (x.view("<f4").astype(np.float64) for x in (g, hot_g))
        by_word = [np.bincount(place, weights=x, minlength=count) for x in (hot_c, hot_t, hot_g, hot_c == 1, hot_c == 2)]
        some = np.flatnonzero(by_word[0])
        yield none | {
            "key": part, "kind": "totals",
            "totals": [*sums.tolist(), *(float(x) for x in ((seen > 0).sum(), c.sum(), t.sum(), (c == 1).sum(), (c == 2).sum(), g.sum()))],
            "hot": [[float(k), *(float(x[k]) for x in by_word)] for k in some],
        }

    return run


def _model(answered: DataFrame, deal: Dealing, turn: int, before: dict | None) -> dict:
    """Sums over all parts: one row, and one for each divided word, of which there are 2 for each bucket at most."""
    totals = answered.where("kind = 'totals'")
    sums = totals.agg(*[F.coalesce(F.sum(F.element_at("totals", k + 1)), F.lit(0.0)) for k in range(11)]).first()
    n, one, two, pair_one, pair_two, known, customers, tables_, word_one, word_two, mass = sums
    hot = np.zeros((5, len(deal.hot) + 1))
    for k, *own in totals.select(F.explode("hot").alias("h")).groupBy(F.element_at("h", 1)).agg(*[F.sum(F.element_at("h", i + 2)) for i in range(5)]).collect():
        hot[:, int(k)] = own
    d1, d0 = (before["next_d1"], before["next_d0"]) if before else (FIRST_DISCOUNT, FIRST_DISCOUNT)
    next_d1, next_d0 = rate(pair_one + hot[3].sum(), pair_two + hot[4].sum()), rate(word_one, word_two)
    rng = np.random.default_rng([turn, 22])
    own = np.concatenate([[np.uint64(0)], deal.hot])
    new, hot_new = rng.gamma(STRENGTH + d0 * tables_), gamma(STRENGTH + d1 * hot[1], own, turn, 15)
    return {
        "n": int(n), "known": int(known), "customers": customers, "tables": tables_, "d2": rate(one, two), "d1": d1, "d0": d0, "next_d1": next_d1, "next_d0": next_d0,
        "new": new, "mass": mass + new, "x": rng.gamma(STRENGTH / next_d0 + tables_),
        "hot_customers": hot[0], "hot_tables": hot[1], "hot_new": hot_new, "hot_mass": hot[2] + hot_new, "hot_x": gamma(STRENGTH / next_d1 + hot[1], own, turn, 16),
    }


def _of_kind(rows_: pa.Table) -> dict[str, list[tuple]]:
    """Rows (source, slice, data) of each kind."""
    out: dict[str, list[tuple]] = {}
    for kind, *rest in zip(*(rows_.column(c).to_pylist() for c in ("kind", "source", "slice", "data")), strict=True):
        out.setdefault(kind, []).append(tuple(rest))
    return out


def _sweep(shared: Broadcast, m: dict, sweeps: int, turn: int, schema: pa.Schema):
    """Of a bucket: its state, and the tables and answers of the last round. Gives its tables and what it asks next."""

    def run(key: tuple, own: pa.Table, more: pa.Table) -> pa.Table:
        out = pa.Table.from_pylist(_of_bucket(key[0].as_py(), _of_kind(own) | _of_kind(more)), schema)
        trim()
        return out

    def _of_bucket(bucket: int, own: dict[str, list[tuple]]) -> list[dict]:
        none = dict.fromkeys(x.name for x in schema)
        state = Bucket.load(own["state"][0][2], shared.value)
        for _, _, data in own.get("tables", []):
            state.set_tables(data)
        state.hear([(source, data) for source, _, data in own["answer"]], m)
        state.sweep(m, sweeps, turn)
        return [none | {"key": bucket, "kind": "tables", "source": turn, "data": state.tables()}, *state.asks(none, bucket, False)]

    return run


def _score(shared: Broadcast, models: list[dict], schema: pa.Schema):
    """Of a bucket: its state, what it holds of each slice, and tables and answers of the samples, the second's in kinds of their own.

    To each slice: its entries' log10 and counts.
    """

    def run(own: pa.Table, more: pa.Table) -> pa.Table:
        out = pa.Table.from_pylist(_of_bucket(int(own.column("key")[0].as_py()), _of_kind(own) | _of_kind(more)), schema)
        trim()
        return out

    def _of_bucket(bucket: int, own: dict[str, list[tuple]]) -> list[dict]:
        none = dict.fromkeys(x.name for x in schema)
        state = Bucket.load(own["state"][0][2], shared.value)
        p = 0
        for k, m in enumerate(models):
            state.set_tables(own[f"tables{k}"][0][2])
            state.hear([(source, data) for source, _, data in own[f"answer{k}"]], m)
            p = p + state.probabilities(m) / len(models)
        fine = np.rint(-np.log10(np.minimum(p, 1.0)) * FINE).astype(np.int64)
        seen = state.seen[state.ask[state.pair]]
        out = []
        for _, name, data in own["index"]:
            at = total(unpack(data)[0])
            out.append(none | {"slice": name, "source": bucket, "data": pack(small(fine[at]), small(seen[at]))})
        return out

    return run


def _gather(m: dict, schema: pa.Schema):
    """A slice's documents, from its own row and the answers of its buckets."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own in groups(batches, 1):
            yield _of_slice(own)

    def _of_slice(own: list[tuple]) -> pa.RecordBatch:
        ids, held, data = next(r[1:] for r in own if r[1] is not None)
        answers = {r[0]: r[3] for r in own if r[1] is None}
        lengths, doc, counts, buckets, sizes = unpack(data)
        found = [unpack(answers[b]) for b in buckets.tolist()]
        assert [len(f[0]) for f in found] == sizes.tolist()
        fine, seen = (np.concatenate([f[i] for f in found]).astype(np.int64) for i in (0, 1))
        of_docs = lambda x: np.bincount(doc, weights=np.repeat(x, counts), minlength=len(ids))
        base = np.log10((seen + 0.5) / (m["n"] + 0.5 * (m["known"] + 1)))
        held = np.unpackbits(np.frombuffer(held, np.uint8))[: len(ids)].astype(bool)
        columns = [pa.array(ids, schema.field(0).type), pa.array(held), pa.array(lengths.astype(np.int64)), pa.array(of_docs(seen > 0).astype(np.int64)), pa.array(of_docs(base)), pa.array(0.0 - of_docs(fine) / FINE)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _arrow(schema: str, spark: SparkSession) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def score(docs: DataFrame, held_out, *, doc_id: str = "doc_id", text: str = "text", bucket_tokens: int | None = None) -> DataFrame:
    """held_out: a boolean column; rows where it is false are learned from.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; base_score is that of single words
    with half a count added to each. bucket_tokens: what one task holds at a time, BUCKET_TOKENS unless given.
    """
    spark = importable(docs.sparkSession)
    bucket_tokens = bucket_tokens or BUCKET_TOKENS
    id_type = dict(docs.dtypes)[doc_id]
    ids = f"ids array<{id_type}>"
    sent, kept, part, out = _SENT.format(ids=ids), _KEPT.format(ids=ids), _PART.format(ids=ids), _OUT.format(id_type=id_type)
    arrow = _arrow(kept, spark)
    scratch = Scratch(spark, "lm")
    free = spark.sparkContext._jvm.System.gc  # so that the shuffles of what is over go

    def save(df: DataFrame) -> DataFrame:
        free()
        saved = scratch.save(df, "none")
        free()
        return saved

    def by(df: DataFrame, key: str) -> DataFrame:
        return df.repartition(key).sortWithinPartitions(key)

    read = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held"), F.col(text).alias("text"))
    counted = save(read.select("text").mapInArrow(tidy(_counted), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    tokens = counted.where("word is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = {r.word % 2**64: r.n for r in counted.where(F.col("word").isNotNull() & (F.col("n") > bucket_tokens // 2)).collect()}
    top = counted.where("word is not null").orderBy(F.desc("n"), "word").limit(NUMBERED).select("word").toPandas()["word"]
    top = top.to_numpy(dtype=np.int64).view(np.uint64)
    scratch.drop(counted)
    deal = Dealing(tokens, top, often, bucket_tokens)
    shared = spark.sparkContext.broadcast(deal)
    # Each bucket's entries stay where they are from here on; rounds move only sums and answers.
    dealt = by(read.mapInArrow(_send(shared, _arrow(sent, spark)), sent), "key").mapInArrow(_train(shared, arrow), kept)
    first = scratch.save_dealt(dealt, "key", max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "none", "kind")
    free()
    columns = ["key", "kind", "source", "slice", "data"]

    def answered(of: DataFrame, m: dict | None, turn: int) -> tuple[DataFrame, dict]:
        saved = save(by(of.select("key", "kind", "source", "data", "totals"), "key").mapInArrow(_answer(shared, m, turn, arrow), kept))
        return saved, _model(saved, deal, turn, m)

    def of(df: DataFrame, kind: str, name: str | None = None) -> DataFrame:
        return df.where(F.col("kind") == kind).withColumn("kind", F.lit(name or kind)).select(columns)

    def with_entries(kinds: list[str], *more: DataFrame):
        held = first.where(F.col("kind").isin(kinds)).select(columns)
        return held.groupBy("key").cogroup(functools.reduce(DataFrame.unionByName, more).groupBy("key"))

    start, m0 = answered(first.where("kind = 'state'").select("key", "data").mapInArrow(_ask(shared, arrow), kept), None, 0)
    one, m1 = answered(with_entries(["state"], of(start, "answer")).applyInArrow(_sweep(shared, m0, BURN, 1, arrow), kept), m0, 1)
    scratch.drop(start)
    two, m2 = answered(with_entries(["state"], of(one, "tables"), of(one, "answer")).applyInArrow(_sweep(shared, m1, BETWEEN, 2, arrow), kept), m1, 2)
    samples = [of(one, "tables", "tables0"), of(one, "answer", "answer0"), of(two, "tables", "tables1"), of(two, "answer", "answer1")]
    told = save(with_entries(["state", "index"], *samples).applyInArrow(_score(shared, [m1, m2], _arrow(part, spark)), part))
    scratch.drop_kind(first, "state", "index")
    scratch.drop(one, two)
    own = first.where("kind = 'slice'").select("slice", F.lit(-1).alias("source"), "ids", "held", "data")
    gathered = by(own.unionByName(told), "slice").mapInArrow(_gather(m2, _arrow(out, spark)), out)
    return gathered.withColumn("train_tokens", F.lit(m0["n"]).cast("long")).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score(docs, F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 1)
