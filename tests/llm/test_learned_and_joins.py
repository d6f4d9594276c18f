"""Operators that SQL can't express: against brute force, exact round trips or held-out accuracy, and odd rows."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language, lm, ngram_join, packing, token_counts, toxicity, trie
from tidemark.llm.components import components
from tidemark.llm.tokens import WordEncoder, default_path
from tidemark.llm.words import shingles, slices, word_hashes, words

SMALL = "/root/testdata/sf0.001"
ODD = [
    (1, "a b c"), (1, "a b c"), (None, "a b c"), (None, None), (4, ""), (5, " \t\n"), (6, "long " * 30000), (7, "One two three four five six"), (8, "one TWO three four five six"),
    (9, "é ü 한 中文 x'll 12 <|endoftext|>"), (10, "a"), (11, "A"), (12, "\x1ca b"),
]


def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").withColumn("class", F.lit("clash")).withColumn("row", F.lit(1))


# --- tokens, counts and packing


def reference_ids(text: str | None) -> bytes:
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_path("word_bpe_49k.json"))
    return np.asarray([*t.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4").tobytes()


TRICKY = ["a.b, c.. d,. É. straße, İstanbul. ΑΣ. x́. don't, it's. 5. 五. 五五,", "\t a,\r\nb", "a b　c", ".", "x" * 500 + " " + "Ab" * 60, "\x00\x1f \x7f", "'S 'LL it'LL"]
TRICKY += ["a <|endoftext|> b", "x<|startoftext|>Y<|endoftext|><|endoftext|>", "<|ENDOFTEXT|> <|endoftext|", "é<|endoftext|>́ z <|end of|>", "<|<|endoftext|>|>"]


@pytest.mark.parametrize("text", [*TRICKY, *(t or "" for _, t in ODD)])
def test_word_encoder_is_the_tokenizer(text):
    assert WordEncoder.get(default_path("word_bpe_49k.json")).encode(text) == reference_ids(text)[:-4]


def check_packing(docs, packed, capacity):
    expected = Counter()
    for doc_id, text in docs:
        ids = reference_ids(text)
        for n, at in enumerate(range(0, len(ids), 4 * capacity)):
            piece = ids[at : at + 4 * capacity]
            expected[doc_id, n, at // 4, len(piece) // 4, zlib.crc32(piece)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == expected
    sequences: dict = {}
    for r in packed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0, *(n for _, n in own)])[:-1].tolist() and sum(n for _, n in own) <= capacity
    return len(sequences)


def test_pack_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    packed = packing.pack_documents(docs).collect()
    n = check_packing([tuple(r) for r in docs.collect()], packed, 2048)
    full = sum(r.length == 2048 for r in packed)
    assert n <= full + -(-sum(r.length for r in packed if r.length < 2048) // 2048) + 1


def test_pack_odd_rows(spark):
    packed = packing.pack_documents(odd(spark), capacity=64).collect()
    check_packing([(d, t) for d, t in ODD], packed, 64)
    assert packing.pack_documents(odd(spark).limit(0)).collect() == []


def test_pack_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_PIECES", 300)
    rng = random.Random(2)
    items = [(n, rng.choice([1, 5, 30, 49, 51, 99, 100])) for n in range(2000)]
    got = packing.pack(spark.createDataFrame(items, "uid long, length int"), capacity=100).collect()
    size = dict(items)
    bins: dict = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, size[r.uid]))
    assert sorted(r.uid for r in got) == list(range(2000))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0, *(n for _, n in own)])[:-1].tolist() and sum(n for _, n in own) <= 100
    assert len(bins) <= 1.02 * packing_bound(items) + 2


def packing_bound(items) -> int:
    return len(packing._fresh(sorted(range(len(items)), key=lambda i: -items[i][1]), [n for _, n in items], 100).bins)


def test_crossover_keeps_every_document():
    rng = random.Random(4)
    lengths = sorted((rng.randint(1, 60) for _ in range(300)), reverse=True)
    a = packing._fresh(range(300), lengths, 100)
    b = packing._fresh(sorted(range(300), key=lambda _: rng.random()), lengths, 100)
    for _ in range(20):
        child = packing.crossover(a, b, lengths, rng)
        assert sorted(i for own in child.bins for i in own) == list(range(300))
        assert all(sum(lengths[i] for i in own) + room == 100 for own, room in zip(child.bins, child.room, strict=True))
    best = packing.evolve([], lengths, 100, seed=1)[0]
    assert len(best.bins) <= len(a.bins) and len(best.bins) >= -(-sum(lengths) // 100)


def triples(rng: random.Random, n: int) -> list[tuple[int, int]]:
    """Three pieces to a sequence, without a gap: best fit in falling order needs more sequences than there are."""
    out = []
    for _ in range(n):
        a = rng.randint(380, 490)
        b = rng.randint(250, (1000 - a) // 2)
        out += [a, b, 1000 - a - b]
    rng.shuffle(out)
    return list(enumerate(out))


def test_evolution_betters_best_fit(spark):
    items = triples(random.Random(3), 60)
    lengths = sorted((n for _, n in items), reverse=True)
    fitted = len(packing._fresh(range(len(lengths)), lengths, 1000).bins)
    frame = spark.createDataFrame(items, "uid long, length int")
    evolved = packing.pack(frame, capacity=1000, offspring=60, patience=4).select("sequence_id").distinct().count()
    assert 60 <= evolved <= fitted - 5


def test_token_counts(spark):
    own = [len(reference_ids(t)) // 4 for _, t in ODD]
    sums = token_counts.suffix_sums(token_counts.lengths(odd(spark)))
    for r in sums.collect():
        assert r.documents == own.count(r.length)
        assert (r.longer_documents, r.longer_tokens) == (sum(n > r.length for n in own), sum(n for n in own if n > r.length))
        assert (r.total_tokens, r.kept_tokens) == (sum(own), sum(min(n, r.length) for n in own))
        assert r.fitting == pytest.approx(sum(n <= r.length for n in own) / len(own))
    got = {(r.kind, r["at"]): r["value"] for r in token_counts.answer(sums, [0, 3, 1000, 10**6], [0.5, 1.0]).collect()}
    for limit in (0, 3, 1000, 10**6):
        assert got["kept_tokens", float(limit)] == sum(min(n, limit) for n in own)
    assert got["quantile", 1.0] == max(own) and got["quantile", 0.5] == sorted(own)[(len(own) + 1) // 2 - 1]
    empty = token_counts.suffix_sums(token_counts.lengths(odd(spark).limit(0)))
    assert empty.collect() == [] and {r["value"] for r in token_counts.answer(empty, [5], [0.5]).collect()} == {0.0, None}


# --- n-gram join


def brute(rows, num=80, den=100):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and den * both >= num * len(a | sets[j]):
                root[find(i)] = find(j)
    least: dict = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted([(d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)], key=str)


def joined(df, **args):
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_join(df, **args).collect()], key=str)


def test_join_small_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    assert joined(docs) == brute([tuple(r) for r in docs.collect()])


def test_join_odd_rows(spark):
    assert joined(odd(spark)) == brute([(d, t) for d, t in ODD])
    assert joined(odd(spark).limit(0)) == []


def family(rng: random.Random, size: int, length: int, changes: int) -> list[str]:
    base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    out = []
    for _ in range(size):
        own = list(base)
        for _ in range(rng.randint(0, changes)):
            own[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("block", [4, 1024])
def test_join_large_groups_in_blocks(spark, block):
    rng = random.Random(9)
    passage = " ".join(f"p{n}" for n in range(40))
    texts = family(rng, 60, 80, 3) + family(rng, 25, 30, 2) + [f"{passage} " + t for t in family(rng, 30, 12, 6)] + family(rng, 10, 6, 1)
    texts += [texts[0]] * 20
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert joined(spark.createDataFrame(rows, "doc_id long, text string"), block=block) == brute(rows)


def chained(rng: random.Random, size: int, words_: int = 300, length: int = 60) -> list[str]:
    """Texts of few words, each of which two others may follow: all are tied to all, and hardly any two are alike."""
    follows = [(rng.randrange(words_), rng.randrange(words_)) for _ in range(words_)]
    out = []
    for _ in range(size):
        own = [rng.randrange(words_)]
        while len(own) < length:
            own.append(rng.choice(follows[own[-1]]))
        out.append(" ".join(f"c{w}" for w in own))
    return out


def test_join_of_texts_tied_through_others(spark):
    """Texts of few words in few orders, some of them copied with a change; and a run of words that every text holds."""
    rng = random.Random(12)
    texts = chained(rng, 500, words_=40)
    for t in texts[:40]:
        own = t.split()
        own[rng.randrange(len(own))] = "other"
        texts.append(" ".join(own))
    texts = [f"these five words come first {t}" for t in texts]
    rows = list(enumerate(texts))
    want = brute(rows)
    assert sum(c != d for d, _, c in want) >= 30
    assert joined(spark.createDataFrame(rows, "doc_id long, text string"), block=32, bucket_bytes=20_000) == want


def test_trie_finds_all_links():
    rng = np.random.default_rng(1)
    sets = [np.sort(rng.choice(40, size=rng.integers(3, 20), replace=False)) for _ in range(120)]
    sets += [np.sort(np.append(s[:-1], 40 + n)) for n, s in enumerate(sets[:40])]
    sizes = np.array([len(s) + int(rng.integers(0, 2)) for s in sets])
    t = trie.Trie(sets, sizes, 100)
    none = np.zeros(len(sets), dtype=bool)
    for i, s in enumerate(sets):
        for num, den in ((8, 10), (1, 2)):
            got = set(t.probe(s, int(sizes[i]), none, num, den).tolist())
            want = set()
            for j, o in enumerate(sets):
                both = len(np.intersect1d(s, o))
                if (den + num) * both >= num * (sizes[i] + sizes[j]):
                    want.add(j)
            assert got == want


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(n, n + 1) for n in range(400, 460)] + [(500, n) for n in range(501, 560)]
    root = {n: n for e in edges for n in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: find(n) for n in root if find(n) != n}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_text_hashes_know_words_apart(monkeypatch):
    from tidemark.llm import words as w

    rng = random.Random(4)
    letters = ["a", "B", "b", "É", "é", " ", " ", "\t", "\n", "\r", "\x0b", "\x0c", "\x1c", "\xa0", "z", "中"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts += [None, "", " ", "x" * 3000, "y" + "x" * 2999, "x" * 2999, "Q " * 1000, "x" * 700 + " b " + "x" * 700, "é" * 900]
    whole = pa.array(["not of the slice", *texts, "nor this"])
    for run in (1 << 18, 512):
        monkeypatch.setattr(w, "_RUN", run)
        w._powers.cache_clear()
        for column in (whole.slice(1, len(texts)), pa.array(texts, pa.large_string())):
            hashes, counts = w.text_hashes(column)
            own = [x for t in texts for x in words(t)]
            assert counts.tolist() == [len(words(t)) for t in texts] and len(hashes) == len(own)
            number = {}
            assert all(number.setdefault(x, h) == h for x, h in zip(own, hashes.tolist(), strict=True)) and len(set(number.values())) == len(number)
        if run == 512:
            assert {k: number[k] for k in list(before)} == before
        before = number
    w._powers.cache_clear()
    assert [len(x) for x in w.text_hashes(pa.array([], pa.string()))] == [0, 0] and w.text_hashes(pa.array([None], pa.string()))[1].tolist() == [0]


def test_shingles_and_slices():
    one = word_hashes(words("a b c d e f a b c d e"))
    assert len(shingles(one, 5)) == 6 and len(shingles(one[:3], 5)) == 1 and len(shingles(one[:0], 5)) == 0
    assert words("\x1ca B\x0bÉ") == ["\x1ca".encode(), b"b", "É".encode()]
    batch = pa.RecordBatch.from_pydict({"t": ["x" * 10, None, "y" * 100, "", "z"]})
    cut = list(slices([batch], 0, size=50))
    assert [b.num_rows for b in cut] == [2, 1, 2] and pa.Table.from_batches(cut).to_pydict() == batch.to_pydict()


# --- language model


def crc(doc_id) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


def scored(spark, df):
    return lm.score(df, F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 1)


def test_lm_base_and_held_out(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r for r in scored(spark, docs).collect()}
    rows = [tuple(r) for r in docs.collect()]
    tokens = {d: [*words(t), b"\n"] for d, t in rows}
    c = Counter(w for d, _ in rows if crc(d) != 1 for w in tokens[d])
    n, v = sum(c.values()), len(c)
    for d, _ in rows:
        r, own = got[d], tokens[d]
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (crc(d) == 1, len(own), sum(c[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(base)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_is_a_distribution(spark):
    """Over all texts of one word (known, frequent or unknown), the word's and the end's probabilities sum to less than 1, and nearly so where texts are one word."""
    rng = random.Random(6)
    train = [(n, rng.choice(["a", "b", "c", "d"] * 5 + [f"r{k}" for k in range(20)])) for n in range(0, 4000) if crc(n) != 1]
    held = [n for n in range(5000, 6000) if crc(n) == 1]
    texts = sorted({t for _, t in train} | {"unknown"})
    df = spark.createDataFrame(train + list(zip(held, texts, strict=False)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in scored(spark, df).where("held_out").collect()}
    total = sum(10**s for s in got.values())
    assert 0.9 < total <= 1.0 + 1e-9
    share = Counter(t for _, t in train)
    for d, t in zip(held, texts, strict=False):
        if share[t] > 300:
            assert 10 ** got[d] == pytest.approx(share[t] / len(train), rel=0.1)


def test_lm_odd_rows(spark):
    got = scored(spark, odd(spark)).collect()
    assert len(got) == len(ODD) and all(np.isfinite(r.score) and np.isfinite(r.base_score) and r.score <= 0 for r in got)
    assert all(r.n_tokens == 1 for r in got if r.doc_id in (4, 5))
    assert scored(spark, odd(spark).limit(0)).collect() == []
    alone = [n for n in range(50) if crc(n) == 1][:2]
    only = scored(spark, spark.createDataFrame([(n, "x y") for n in alone], "doc_id long, text string")).collect()
    assert [(r.train_tokens, r.n_known, r.score) for r in only] == [(0, 0, 0.0)] * 2


def by_the_book(docs, sweeps: int, burn: int):
    """The model with one customer removed and reseated at a time in all restaurants: scores of held-out documents."""
    rng = random.Random(5)
    tokens = {d: [*words(t), b"\n"] for d, t in docs}
    triples = lambda own: zip([b"\t", b"\t", *own], [b"\t", *own], own, strict=False)
    n = Counter(x for d, own in tokens.items() if crc(d) != 1 for x in triples(own))
    v = len({x[-1] for x in n}) + 1
    seats: dict = {}  # context: word: sizes of tables
    customers, tables = Counter(), Counter()
    discounts = [0.5, 0.5, lm.rate(sum(c == 1 for c in n.values()), sum(c == 2 for c in n.values()))]

    def p(context, w):
        sizes = seats.get(context, {}).get(w, ())
        d = discounts[len(context)]
        below = p(context[1:], w) if context else 1 / v
        return (sum(sizes) - d * len(sizes) + (1 + d * tables[context]) * below) / (1 + customers[context])

    def put(context, w):
        sizes, d = seats.setdefault(context, {}).setdefault(w, []), discounts[len(context)]
        below = p(context[1:], w) if context else 1 / v
        at = rng.choices(range(len(sizes) + 1), [*(k - d for k in sizes), (1 + d * tables[context]) * below])[0]
        customers[context] += 1
        if at < len(sizes):
            sizes[at] += 1
            return
        sizes.append(1)
        tables[context] += 1
        if context:
            put(context[1:], w)

    def take(context, w):
        sizes = seats[context][w]
        at = rng.choices(range(len(sizes)), sizes)[0]
        sizes[at] -= 1
        customers[context] -= 1
        if not sizes[at]:
            del sizes[at]
            tables[context] -= 1
            if context:
                take(context[1:], w)

    got = {d: [] for d in tokens if crc(d) == 1}
    for sweep in range(sweeps):
        for (*context, w), k in n.items():
            for _ in range(k):
                if sweep:
                    take(tuple(context), w)
                put(tuple(context), w)
        for depth in (0, 1):
            c = [sum(sizes) for context, own in seats.items() if len(context) == depth for sizes in own.values()]
            discounts[depth] = lm.rate(sum(x == 1 for x in c), sum(x == 2 for x in c))
        if sweep >= burn:
            for d, out in got.items():
                out.append([p((a, b), w) for a, b, w in triples(tokens[d])])
    return {d: float(np.log10(np.mean(out, axis=0)).sum()) for d, out in got.items()}


@pytest.fixture(scope="module")
def chains():
    """Texts from a chain of second order, with some noise."""
    rng = random.Random(3)
    vocabulary, follows, docs = [f"w{k}" for k in range(120)], {}, []
    for n in range(200):
        own = ["w0", "w1"]
        while len(own) < 30:
            after = follows.setdefault(tuple(own[-2:]), [rng.choice(vocabulary) for _ in range(3)])
            own.append(rng.choice(after) if rng.random() < 0.7 else vocabulary[min(119, int(rng.paretovariate(0.7)) - 1)])
        docs.append((n, " ".join(own)))
    return docs


def test_lm_is_the_model(spark, chains):
    """Against Gibbs sampling with one customer at a time."""
    df = spark.createDataFrame(chains, "doc_id long, text string")
    got = {r.doc_id: r.score for r in scored(spark, df).where("held_out").collect()}
    want = by_the_book(chains, 40, 20)
    per_token = sum(got.values()) / (31 * len(want)), sum(want.values()) / (31 * len(want))
    assert per_token[0] == pytest.approx(per_token[1], abs=0.015)
    assert np.corrcoef([got[d] for d in want], list(want.values()))[0, 1] > 0.98


def test_lm_scores_do_not_depend_on_the_session(spark, chains):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    for partitions, files in (("1", 2), ("4", 5), ("16", 1), ("64", 3)):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            df = spark.createDataFrame(chains, "doc_id long, text string").repartition(files, "doc_id")
            rows = lm.score(df, F.crc32(F.col("doc_id").cast("string")) % 5 == 1, bucket_tokens=700).collect()
            got.append({r.doc_id: r.score for r in rows})
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all(g == pytest.approx(got[0], abs=1e-9) for g in got)


def test_lm_divided_words_and_many_parts(spark, chains, monkeypatch):
    """A word that a third of all tokens are is dealt over several buckets; the model stays the same, other random numbers aside."""
    docs = [(d, " ".join(x for w in t.split() for x in ([w, "the"] if int(w[1:]) % 2 else [w]))) for d, t in chains]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    whole = {r.doc_id: r for r in scored(spark, df).collect()}
    monkeypatch.setattr(lm, "PART_BUCKETS", 1)
    parts = {r.doc_id: r for r in lm.score(df, F.crc32(F.col("doc_id").cast("string")) % 5 == 1, bucket_tokens=500).collect()}
    tokens = sum(r.n_tokens for r in whole.values())
    assert all(parts[d].base_score == pytest.approx(r.base_score) and parts[d].n_known == r.n_known for d, r in whole.items())
    assert sum(abs(parts[d].score - r.score) for d, r in whole.items()) / tokens < 0.03
    assert sum(parts[d].score - r.score for d, r in whole.items()) / tokens == pytest.approx(0, abs=0.01)


def test_lm_scores_repeated_texts_apart(spark, chains):
    held = next(d for d, _ in chains if crc(d) == 1)
    again = next(n for n in range(1000, 1100) if crc(n) != 1)
    once = {r.doc_id: r.score for r in scored(spark, spark.createDataFrame(chains, "doc_id long, text string")).collect()}
    twice = {r.doc_id: r.score for r in scored(spark, spark.createDataFrame([*chains, (again, dict(chains)[held])], "doc_id long, text string")).collect()}
    assert twice[held] > once[held] + 3


def test_lm_contexts_share_no_restaurant(spark):
    """Two previous words of equal hash modulo 2**16, each always followed by its own word."""
    own: dict = {}
    for n in range(2000):
        a = own.setdefault(int(lm._tokens(pa.array([f"u{n}"]))[0][0]) % 65536, n)
        if a != n:
            break
    one, two = f"u{a}", f"u{n}"
    docs = [(k, f"{one} left" if k % 2 else f"{two} right") for k in range(400) if crc(k) != 1]
    held = [k for k in range(400, 500) if crc(k) == 1][:2]
    df = spark.createDataFrame([*docs, (held[0], f"{one} left"), (held[1], f"{one} right")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in scored(spark, df).where("held_out").collect()}
    assert got[held[0]] > got[held[1]] + 1.5


def test_tables_are_drawn_given_all_others():
    """Against weights by brute force over seating plans: z for a new table, size - discount for an old one."""
    d, z, c = 0.6, 0.8, 7
    weights = Counter({(1,): z})
    for _ in range(c - 1):
        nxt: Counter = Counter()
        for sizes, w in weights.items():
            nxt[tuple(sorted([*sizes, 1]))] += w * z
            for k, size in enumerate(sizes):
                nxt[tuple(sorted([*sizes[:k], size + 1, *sizes[k + 1 :]]))] += w * (size - d)
        weights = nxt
    want = Counter()
    for sizes, w in weights.items():
        want[len(sizes)] += w / sum(weights.values())
    keys = word_hashes([b"k%d" % k for k in range(40000)])
    got = Counter(lm.resample(np.full(len(keys), c), np.full(len(keys), z), d, keys, 1).tolist())
    assert all(got[t] / len(keys) == pytest.approx(p, abs=0.01) for t, p in want.items())


@pytest.mark.parametrize(("d", "z"), [(0.6, 0.8), (0.9, 40.0), (0.5, 300.0), (0.4, 2.0)])
def test_tables_of_many_customers(d, z):
    """The scaling law against the recursion, at three times as many customers."""
    c = 3 * lm.EXACT
    want = lm.stirling.__wrapped__(d, c)[c, 1 : c + 1] + np.arange(1, c + 1) * math.log(z)
    want = np.exp(want - want.max())
    got = lm._log_weights(c, math.log(z), d)
    got = np.exp(got - got.max())
    mean = [float((w * np.arange(1, len(w) + 1)).sum() / w.sum()) for w in (want, got)]
    assert mean[1] == pytest.approx(mean[0], rel=0.03)
    keys = word_hashes([b"k%d" % k for k in range(400)])
    drawn = lm.resample(np.full(400, c), np.full(400, z), d, keys, 1)
    assert drawn.mean() == pytest.approx(mean[0], rel=0.1)


# --- toxicity


def test_segments_against_brute_force():
    rng = random.Random(8)
    for _ in range(200):
        s = np.array([rng.choice([-3.0, -1.0, -0.5, 1.0, 2.0, 4.0]) for _ in range(rng.randint(0, 14))])
        got = toxicity.segments(s)

        def maximal(lo: int, hi: int) -> list:
            """The greedy definition: the best segment (shortest, leftmost), then both sides of it."""
            best = None
            for a in range(lo, hi):
                for b in range(a + 1, hi + 1):
                    v = float(s[a:b].sum())
                    if v > 0 and (best is None or v > best[2] or v == best[2] and b - a < best[1] - best[0]):
                        best = (a, b, v)
            return [] if best is None else maximal(lo, best[0]) + [best] + maximal(best[1], hi)

        want = maximal(0, len(s))
        assert sum(v for *_, v in got) == pytest.approx(sum(v for *_, v in want)) and len(got) == len(want)
        assert all(v == pytest.approx(float(s[a:b].sum())) for a, b, v in got)


def test_poisson_tail():
    for mean in (1e-6, 0.1, 3.0):
        for r in (1, 2, 5):
            exact = 1 - sum(math.exp(-mean) * mean**k / math.factorial(k) for k in range(r))
            assert math.exp(toxicity.log_tail(r, mean)) == pytest.approx(exact, rel=1e-4, abs=1e-12)


def test_evidence_is_of_all_segments():
    """300 segments where 50 are expected; the first 200 of them alone are evidence of 57."""
    every = min(toxicity.log_tail(r, 50.0) for r in range(1, 301))
    assert toxicity.evidence([1.0] * 300, 50, 0.0, 1.0) == pytest.approx(-every / math.log(10)) and -every / math.log(10) > 120
    assert toxicity.evidence([1.0] * 5000, 50, 0.0, 1.0) == 300.0


def planted(n: int, seed: int):
    rng = random.Random(seed)
    plain, bad = [f"plain{k}x" for k in range(400)], ["vilea", "vileb", "vilec", "grossq"]
    rows, labels = [], []
    for d in range(n):
        own = [rng.choice(plain) for _ in range(rng.randint(5, 120))]
        toxic = d % 4 == 0
        for _ in range(3 if toxic else 0):
            own.insert(rng.randrange(len(own)), rng.choice(bad))
        rows.append((d, " ".join(own)))
        labels.append((d, int(toxic)))
    return rows, labels


def test_toxic_held_out(spark):
    rows, labels = planted(1200, 1)
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, marks, F.col("doc_id") % 3 != 1)
    truth = dict(labels)
    held = [r for r in toxicity.toxic(docs, model).collect() if r.row.doc_id % 3 == 1]
    assert np.mean([r.predicted == truth[r.row.doc_id] for r in held]) > 0.97
    text = dict(rows)
    caught = next(r for r in held if r.predicted)
    assert any(w[:4] in ("vile", "gros") for p in caught.passages for w in text[caught.row.doc_id].split()[p.start : p.end])


def test_rare_clean_words_are_evidence(spark):
    """A word of a few clean documents begins as toxic words do."""
    rows, labels = planted(1200, 1)
    few = [d for d, toxic in labels if not toxic][:9]
    rows = [(d, t + " vilest" if d in few else t) for d, t in rows]
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
    assert toxicity.Scorer(model).word(b"vilest") < 0 < toxicity.Scorer(model).word(b"vilea")


def test_toxic_odd_rows(spark):
    rows, labels = planted(600, 2)
    docs = spark.createDataFrame(rows + [(d, t) for d, t in ODD], "doc_id long, text string").withColumn("score", F.lit("clash"))
    marks = spark.createDataFrame([*labels, (None, 1), (3, None), (6, 1), (6, 0), (10**9, 1)], "doc_id long, toxic int")
    got = toxicity.toxic(docs, toxicity.fit(docs, marks, F.lit(True))).collect()
    assert len(got) == len(rows) + len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) and r.row.score == "clash" for r in got)
    empty = {round(r.score, 12) for r in got if not (r.row.text or "").split()}
    assert len(empty) == 1
    none = toxicity.fit(docs, marks.where("toxic = 0"), F.lit(True))
    assert none is None and {(r.score, r.predicted) for r in toxicity.toxic(docs, none).collect()} == {(0.0, 0)}
    assert toxicity.toxic(docs.limit(0), toxicity.fit(docs, marks, F.lit(True))).collect() == []
    assert toxicity.fit(docs.limit(0), marks, F.lit(True)) is None


# --- language


def test_language_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs.where("doc_id % 2 = 0"))
    got = language.identify(docs.where("doc_id % 2 = 1"), model).collect()
    assert np.mean([r.lang == r.row.lang for r in got]) > 0.98
    junk = spark.createDataFrame([(1, "1234 !!"), (2, None), (3, ""), (4, "xqzjkv wvxzq qqzx jjxkq vvwzx kxqjz " * 20)], "doc_id long, text string").withColumn("lang", F.lit("clash"))
    assert [r.lang for r in sorted(language.identify(junk, model).collect())] == ["und"] * 4


def test_language_of_pages(spark):
    model = language.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    got = language.identify_pages(pages, model).collect()
    assert np.mean([r.lang == r.declared for r in got]) > 0.95
    odd_pages = [
        (1, "http://a.example.de/x", "<html lang='de'><body></body></html>"), (2, None, None), (3, "::bad[", "<p>1 2 3"), (None, "http://h.example.org", '<html lang="zz"><p>the that and with</p>'),
        (5, "http://h.example.org", "<p>" + "the that and with from " * 5000), (5, "http://h.example.org", "<p>" + "the that and with from " * 5000),
    ]
    frame = spark.createDataFrame(odd_pages, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("host", F.lit("clash"))
    by = {r.page_id: r for r in language.identify_pages(frame, model).collect()}
    assert by[1].declared == "de" and by[1].lang == "de" and by[5].lang == "en" and by[None].declared == "zz"
    assert all(0 <= r.confidence <= 1 + 1e-9 for r in by.values())
    assert language.identify_pages(frame.limit(0), model).collect() == []
    nothing = language.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r.lang for r in language.identify_pages(frame, nothing).collect()} == {"und"}


def identified_by_hand(documents, pages):
    """The whole fusion in plain Python, over all labelled documents."""
    grams: dict = {}
    for lang, text in documents:
        for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
            padded = f" {word} "
            for i in range(1, len(padded)):
                g = padded[max(0, i - 2) : i + 1]
                grams.setdefault(lang, Counter())[g] += 1
    langs = [*sorted(grams), "und"]
    before = {k: Counter() for k in grams}
    every: set = set()
    for k, own in grams.items():
        for g, n in own.items():
            before[k][g[:-1]] += n
            every.add(g)
    known = {g[:-1] for g in every}

    def rate(k, g):
        if k == "und" or g not in every and g[:-1] not in known:
            return -math.log(64)
        return math.log(((grams[k][g] if g in every else 0) + 0.05) / (before[k][g[:-1]] + 0.05 * 64))

    def posterior(text):
        found = re.findall(r"[^\W\d_]+", text.lower())
        if not found:
            return [0.0] * (len(langs) - 1) + [1.0]
        log = [sum(n * rate(k, f" {w} "[max(0, i - 2) : i + 1]) for w, n in Counter(found).items() for i in range(1, len(w) + 2)) for k in langs]
        p = [math.exp(0.25 * (x - max(log))) for x in log]
        return [x / sum(p) for x in p]

    rows = []
    for page_id, url, page in pages:
        host, domain, suffix = language.address(url)
        rows.append((page_id, host, (suffix,), (suffix, domain), (host,), language.declared(page or ""), posterior(language.visible(page or ""))))
    world = [sum(r[-1][k] for r in rows) for k in range(len(langs))]
    sums: dict = {}
    for level in (2, 3, 4):
        for r in rows:
            own = sums.setdefault((level, r[level]), [0.0] * len(langs))
            for k, p in enumerate(r[-1]):
                own[k] += p
    said = {d: [sum(r[-1][k] for r in rows if r[5] == d) for k in range(len(langs))] for d in {r[5] for r in rows} if d in langs}
    out = {}
    for r in rows:
        prior = [(w + 1) / (sum(world) + len(langs)) for w in world]
        for level in (2, 3, 4):
            rest = [max(0.0, s - p) for s, p in zip(sums[level, r[level]], r[-1], strict=True)]
            prior = [(x + 5.0 * p) / (sum(rest) + 5.0) for x, p in zip(rest, prior, strict=True)]
        markup = [(said[r[5]][k] + (4.0 if langs[k] == r[5] else 0.5)) / (world[k] + 4.0 + 0.5 * len(said)) for k in range(len(langs))] if r[5] in said else [1.0] * len(langs)
        text = [1.0] * len(langs) if r[-1][-1] >= 1 else [max(1e-12, p) for p in r[-1]]
        evidence = [a * b * c for a, b, c in zip(prior, markup, text, strict=True)]
        best = max(range(len(langs)), key=lambda k: (evidence[k], -k))
        out[r[0]] = langs[best], evidence[best] / sum(evidence)
    return out


def test_language_of_pages_by_hand(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html")
    rows = [tuple(r) for r in pages.collect()] + [(9001, "http://x.example.de/a", "<p>1 2 3"), (9002, None, "<html lang='fr'><p>42"), (9003, "http://x.example.de/b", None), (9004, "", "<p>und der die das")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in language.identify_pages(frame, language.fit(documents)).collect()}
    want = identified_by_hand([(r.lang, r.text) for r in documents.where("lang is not null").collect()], rows)
    assert {p: r.lang for p, r in got.items()} == {p: lang for p, (lang, _) in want.items()}
    assert all(r.confidence == pytest.approx(want[p][1], rel=1e-6) for p, r in got.items())


def test_language_of_pages_by_their_common_words(spark):
    """Truth that is no input: which language's commonest short words a page holds most of."""
    common = {"en": "the of and to is that was for with are this from", "de": "der die und das nicht ist von mit auf ein den sich", "fr": "le les des et est dans une que pour qui sur pas", "es": "el los las del que una por con para como pero sus"}
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    model = language.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert set(model["langs"]) - {"und"} <= set(common)
    got = {r.page_id: r.lang for r in language.identify_pages(pages, model).collect()}
    right = total = 0
    for r in pages.collect():
        n = Counter(language.visible(r.html or "").lower().split())
        score = sorted(((sum(n[w] for w in own.split()), lang) for lang, own in common.items()), reverse=True)
        if score[0][0] >= 5 and score[0][0] >= 3 * score[1][0]:
            total += 1
            right += got[r.page_id] == score[0][1]
    assert total > 100 and right >= 0.98 * total


def test_language_by_source(spark):
    """Against the fusion by hand, from the text's own posteriors; short texts go with their source, none without letters."""
    documents = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source")
    model = language.fit(documents)
    odd_ = spark.createDataFrame([(9001, "la", None, "web"), (9002, "1 2 3", "x", "web"), (9003, None, None, None), (9004, "der", None, None)], documents.schema)
    docs = documents.unionByName(odd_).withColumn("group", F.lit("clash")).withColumn("prior", F.lit(1))
    got = {r.row.doc_id: r for r in language.identify_by_source(docs, model).collect()}
    scorer, langs = language.Likelihoods(model), model["langs"]
    rows = [(r.doc_id, r.source, language._posterior(scorer.text(r.text or ""), len(langs))) for r in docs.collect()]
    world = [sum(p[k] for *_, p in rows) for k in range(len(langs))]
    for d, source, p in rows:
        rest = [sum(q[k] for _, s, q in rows if s == source) - p[k] for k in range(len(langs))]
        prior = [(max(0.0, x) + 5.0 * (w + 1) / (sum(world) + len(langs))) / (sum(rest) + 5.0) for x, w in zip(rest, world, strict=True)]
        evidence = p if p[-1] >= 1 else [a * max(1e-12, b) for a, b in zip(prior, p, strict=True)]
        assert got[d].lang == langs[int(np.argmax(evidence))] and got[d].confidence == pytest.approx(max(evidence) / sum(evidence), rel=1e-6), d
    assert got[9002].lang == got[9003].lang == "und" and got[9001].row.group == "clash"
    assert language.identify_by_source(docs.limit(0), model).collect() == []


def test_host_prior_decides_pages_without_letters(spark):
    model = language.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    german = "<p>der die und das nicht ist von mit auf " * 30
    rows = [(n, "http://www.beispiel.example.org/x", german) for n in range(30)] + [(100, "http://www.beispiel.example.org/y", "<p>1 2 3")]
    got = {r.page_id: r for r in language.identify_pages(spark.createDataFrame(rows, "page_id long, url string, html string"), model).collect()}
    assert got[100].text_lang == "und" and got[100].lang == "de"
