"""Operators that SQL can express: against SQL on a whole small table, and the cases of their docstrings."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, mixing, near_vectors, queries, topk
from tidemark.llm.words import words

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_against_sql(spark, same, name, folder):
    same(queries.QUERIES[name](spark, folder), queries.ORACLE_SQL[name], folder)


def odd_documents(spark):
    rows = [
        (1, "a b c", "en", "x", 5), (1, "a b c", "en", "x", 5), (None, "d e", "en", "x", 3), (None, None, None, None, None), (4, "", "en", "y", 0), (5, " \t\n", "en", "y", 3),
        (6, "w " * 3000, "en", "hot", 6000), (7, "one", None, None, 3), (8, "é x y", "fr", "hot", 5),
    ]
    return spark.createDataFrame(rows, DOCS)


def test_mix_odd_rows(spark):
    docs = odd_documents(spark).withColumn("size", F.lit("clash")).withColumn("taken", F.lit(1))
    once, again = (sorted(mixing.mix(docs).collect(), key=str) for _ in range(2))
    assert once == again and len(once) == 9
    assert all(0 <= r.taken <= 2 * r["size"] and r.row.size == "clash" for r in once if r.row is not None)
    assert {r.row.doc_id: r["size"] for r in once}[8] == 2
    targets = {r.source_size: r.target for r in once}
    total = sum(r["size"] for r in once)
    assert sum(t for _, t in {(r.row.source, r.target) for r in once}) == pytest.approx(1.5 * total)
    assert targets


def test_mix_empty_and_wordless(spark):
    empty = spark.createDataFrame([], DOCS)
    assert mixing.mix(empty).collect() == [] and mixing.mixed_rows(mixing.mix(empty)).columns == empty.columns
    blank = spark.createDataFrame([(1, None, None, "a", 0), (2, " ", None, None, 1)], DOCS)
    assert [(r["size"], r.target, r.taken) for r in mixing.mix(blank).collect()] == [(0, 0.0, 0)] * 2


def test_targets_by_hand(spark):
    # Weights 5, 2, 1: 15 words are shared, a is full at 2, the other 13 go 2 to 1, where b is full at 8 and c takes 5.
    sources = spark.createDataFrame([("a", "sa", 1), ("b", "sb", 4), ("c", "sc", 5)], "source string, source_key string, source_size long")
    assert {r.source_key: r.target for r in mixing.targets(sources).collect()} == {"sa": 2.0, "sb": 8.0, "sc": 5.0}


def test_apportionment_by_quotients(spark):
    share = [3.4, 2.4, 2.4, 0.4, 0.4]
    house = round(sum(share))
    units = spark.createDataFrame([(0, f"u{n}", s, house) for n, s in enumerate(share)], "all int, unit string, share double, house long")
    got = {r.unit: r.seats for r in mixing._apportion(units, ["all"]).collect()}
    seats = dict.fromkeys(got, 0)
    for _ in range(house):
        best = min(seats, key=lambda u: (-share[int(u[1:])] / (2 * seats[u] + 1), u))
        seats[best] += 1
    assert got == seats


def test_apportionment_of_many_units_is_by_highest_quotients(spark):
    """Against awarding one seat at a time, with units far apart in size."""
    import heapq

    rng = random.Random(5)
    for n, house in ((7, 40), (200, 90), (60, 5000)):
        weight = [rng.paretovariate(0.6) for _ in range(n)]
        share = [w / sum(weight) * house for w in weight]
        seats, heap = [0] * n, [(-x / 0.5, k) for k, x in enumerate(share)]
        heapq.heapify(heap)
        for _ in range(house):
            _, k = heapq.heappop(heap)
            seats[k] += 1
            heapq.heappush(heap, (-share[k] / (seats[k] + 0.5), k))
        units = spark.createDataFrame([(k, x, house) for k, x in enumerate(share)], "unit long, share double, house long")
        for group in ([], ["g"]):
            got = mixing._apportion(units.withColumn("g", F.lit(1)) if group else units, group).collect()
            assert {r.unit: r.seats for r in got} == dict(enumerate(seats))


def test_mix_with_more_shards_and_many_sources(spark):
    rng = random.Random(6)
    rows = [(n, " ".join("w" * rng.randint(1, 5) for _ in range(rng.randint(0, 60))), rng.choice(["hot", f"host{rng.randrange(300)}", None])) for n in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs, shards=3000, keep=["doc_id", "source"]).collect()
    assert len(got) == 3000 and all(0 <= r.taken <= 2 * r["size"] for r in got)
    size = {d: len((t or "").split()) for d, t, _ in rows}
    assert all(r["size"] == size[r.row.doc_id] for r in got)
    taken, target = {}, {}
    for r in got:
        taken[r.row.source] = taken.get(r.row.source, 0) + r.taken
        target[r.row.source] = r.target
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()), rel=1e-6)
    assert abs(sum(taken.values()) - sum(target.values())) < 0.02 * sum(target.values())
    assert abs(taken["hot"] - target["hot"]) <= 0.02 * target["hot"] + 64


def test_mixed_rows_keep_what_is_taken(spark):
    docs = odd_documents(spark)
    mixture = mixing.mix(docs)
    rows = mixing.mixed_rows(mixture)
    assert rows.columns == docs.columns
    assert sum(len(words(r.text)) for r in rows.collect()) == mixture.agg(F.sum("taken")).first()[0]
    whole = [r.text for r in docs.collect()]
    assert all(any((t or "").startswith(r.text) for t in whole) and r.n_chars == len(r.text) for r in rows.collect())


VECTORS = [
    (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, [0.9, 0.43588989]), (5, [0.0, 1.0]), (6, None), (7, [0.0, 0.0]), (8, [None, 1.0]), (9, [float("nan"), 1.0]),
    (10, [float("inf"), 1.0]), (11, [1.0, 0.0, 0.0]), (12, []), (None, [1.0, 0.0]), (14, [0.0, 1.0]), (1, [1.0, 0.0]),
]


def test_near_vectors_odd_rows(spark):
    table = spark.createDataFrame(VECTORS, "vec_id long, embedding array<float>").withColumn("class", F.lit(1)).withColumn("links", F.lit(2))
    got = sorted(near_vectors.near_vectors(table, block=4).collect(), key=str)
    by = {r.vec_id: r for r in got if r.vec_id is not None}
    assert len(got) == len(VECTORS)
    # [1, 0] five times (1 twice, 2, 3, null): four others each, and 4 if its cosine reaches 0.9.
    assert by[2].component_id == 1 and by[2].n_links in (4, 5) and by[2].kept is False and by[1].kept is True
    assert (by[5].n_links, by[5].component_id, by[14].component_id) == (1, 5, 5)
    assert all((by[k].n_links, by[k].component_id, by[k].kept) == (0, k, True) for k in (6, 7, 8, 9, 10, 11, 12))
    lost = next(r for r in got if r.vec_id is None)
    assert lost.component_id == 1 and lost.kept is False
    assert near_vectors.near_vectors(table.limit(0)).collect() == []


def test_near_vectors_recall_over_blocks(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 24))
    x = np.concatenate([base + rng.normal(0, s, base.shape) for s in (0, 0.1, 0.2, 0.3, 0.45, 0.6)]).astype(np.float32)
    table = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(x)], "vec_id long, embedding array<float>")
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    links = (u @ u.T >= 0.9).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in near_vectors.near_vectors(table, block=64).collect()}
    assert links.sum() > 200 and sum(got.values()) >= 0.99 * links.sum() and all(got[n] <= links[n] for n in got)


def test_least_count_is_calibrated():
    p = 0.6827
    import math

    for recall in (0.9, 0.99, 0.999999):
        k = near_vectors.least_count(64, 1.0, recall)
        tail = sum(math.comb(64, n) * p**n * (1 - p) ** (64 - n) for n in range(k, 65))
        assert tail >= recall - 1e-6


def test_top_k_odd_rows(spark):
    rows = [(0, [1.0, 1.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 2.0]), (4, None), (5, [None, 1.0]), (6, [1.0]), (None, [2.0, 0.0]), (100, [-0.0001, 3.0]), (0, [1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).withColumn("row", F.lit(1))
    got = topk.top_k(table, F.col("vec_id") % 100 == 0, k=4, block=3).collect()
    by: dict = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    one = 1024 * 1024
    assert by[100][0][1] == 3072 * 2048 and by[100][0][0] == 3
    assert len(by[0]) == 8 and by[0][0] == (100, 1024 * -1 + 1024 * 3072)
    assert {v for v, s in by[0] if s == 2 * one} <= {0, 1, 2, 3}
    assert topk.top_k(table.limit(0), F.lit(True)).collect() == []


def test_top_k_beyond_double_precision(spark):
    big = [(0, [3.0e38, 1.0]), (1, [3.0e38, 1.0]), (2, [1.0, 1.0]), (3, [-3.0e38, 1.0])]
    got = topk.top_k(spark.createDataFrame(big, "vec_id long, embedding array<float>"), F.col("vec_id") == 0).collect()
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(1, (1 << 63) - 1), (2, (1 << 63) - 1), (3, -(1 << 63))]


def test_top_k_in_many_balls(spark):
    """Vectors in clusters and one of large components, in small blocks: against all products in Python's integers."""
    import numpy as np

    rng = np.random.default_rng(8)
    x = np.concatenate([c + rng.normal(0, 0.05, (90, 6)) for c in 3 * rng.standard_normal((9, 6))])
    x[100] *= 1e13
    rows = [(n, [float(v) for v in own]) for n, own in enumerate(x)] + [(5000 + n, [float(n)]) for n in range(70)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got: dict = {}
    for r in sorted(topk.top_k(table, F.col("vec_id") % 10 == 0, k=5, block=40, most_centres=12).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    whole = {n: [int(np.floor(1024.0 * v)) for v in own] for n, own in rows}
    for q in (n for n in whole if n % 10 == 0):
        score = {n: max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(whole[q], own)))) for n, own in whole.items() if n != q and len(own) == len(whole[q])}
        assert got[q] == sorted(score.items(), key=lambda e: (-e[1], e[0]))[:5], q


def test_top_k_prunes_and_is_exact(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    x = np.floor(1024 * np.concatenate([c + rng.normal(0, 0.02, (400, 8)) for c in rng.standard_normal((12, 8))]))
    q = x[::37]
    places, scores = topk.search(q, np.arange(0, len(x), 37), np.full(len(q), topk.LEAST), x, np.arange(len(x)), 10)
    for n, row in enumerate(q):
        s = x @ row
        s[n * 37] = -np.inf
        best = sorted(range(len(x)), key=lambda i: (-s[i], i))[:10]
        assert places[n] == best and scores[n] == [int(s[i]) for i in best]
    tree = topk.CoverTree(x)
    for node, (lo, hi, centre, radius) in enumerate(zip(tree.lo, tree.hi, tree.centre, tree.radius, strict=True)):
        assert np.linalg.norm(x[tree.order[lo:hi]] - x[centre], axis=1).max() <= radius + 1e-6
        if tree.children[node]:
            assert sum(tree.hi[c] - tree.lo[c] for c in tree.children[node]) == hi - lo


TURNS = [
    (1, 0, "user", "hi </s> \\ <|end|>"), (1, 1, "assistant", "a\\<b"), (1, 1, "assistant", "a\\<b"), (2, 0, None, None), (2, None, "assistant", ""), (None, 0, "user", "[INST]"),
    (None, 1, "assistant", "한é <|end|>\\"), (3, 5, "tool", "x" * 20000), (4, 0, "assistant", "\\\\<s>\\<s>"),
]


def test_chat_round_trip(spark):
    chats = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit(1)).withColumn("mask", F.lit(2))
    formatted = chat.format_chats(chats)
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    for conv in {t[0] for t in TURNS}:
        own = sorted(((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in TURNS if t[0] == conv))
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in own)
        loss = "".join(t for _, _, r, t in own if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == len("<|begin|>") + sum(len("<|turn|><|text|><|end|>") + len(chat.escape(x)) + len(chat.escape(t)) for _, _, x, t in own)
    codec = chat.Codec.get(chat.default_path("byte_bpe_50k.tiktoken"))
    for r in formatted.collect():
        marks = [codec.name[i] for i in r.ids if i >= codec.first]
        assert marks == ["<|begin|>"] * (r.number == 0) + ["<|turn|>", "<|text|>", "<|end|>"] and len(r.mask) == len(r.ids)
        text = codec.text([i for i in r.ids if i < codec.first])
        assert not any(c in text for c in chat.CONTROL)
    starts = sorted((r.conv_id is None, r.conv_id or 0, r.number, r.start, len(r.ids)) for r in formatted.collect())
    assert all(b[3] == (a[3] + a[4] if a[:2] == b[:2] else 0) for a, b in zip(starts, starts[1:], strict=False))
    assert chat.read_back(chat.format_chats(chats.limit(0))).collect() == []


@pytest.mark.parametrize("text", ["", "\\", "</s>", "<\\/s>", "<<SYS>><</SYS>>", "\\\\</s>\\", "<|<|end|>end|>", "[INST][/INST]", "<s<s>>"])
def test_escape_is_reversible(text):
    written = chat.escape(text)
    assert chat.unescape(written) == text and not any(c in written for c in chat.CONTROL)
