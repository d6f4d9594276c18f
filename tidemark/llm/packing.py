"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

A document is its token ids and then one end id. Documents over the capacity are cut into pieces of the capacity; the
last piece may be shorter. Pieces of exactly the capacity are sequences of their own. The others are dealt by hash to
blocks of a bounded size. Each block is evolved on several islands, each a task of its own: a chromosome is a list of
bins; crossover injects well-filled bins of one parent whole into the other, removes the bins that now hold a document
twice, and puts the displaced documents back by best fit. After an epoch each island's elite moves to the next island
of its block. A block is done when it has as few bins as its tokens need, or when no island has bettered its best for
PATIENCE epochs. Bins that a block could not fill well are opened and their documents pooled over all blocks for another
round, so the loss is that of the last round's blocks, not of every block.

Cases: null text counts as empty; an empty text has length 1 (its end id); the tokenizer's control strings in a text are
its ids for them, as the tokenizer itself has it; repeated rows and null or repeated doc_id
are packed as rows of their own; an empty table gives an empty result. Ties are broken by the row's number, so a run
is the same each time for the same files. Other columns of the input are not touched: the result has its own columns.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.tokens import WordEncoder, default_path
from tidemark.llm.workers import tidy
from tidemark.session import Scratch, importable

CAPACITY = 2048
END_ID = 0
#: A block holds at most about so many sequences' worth of tokens, and so many pieces.
BLOCK_BINS = 1024
BLOCK_PIECES = 16384
ISLANDS = 2
#: Epochs without a better chromosome after which a block is done.
PATIENCE = 1
POPULATION = 5
OFFSPRING = 12
#: A bin with at most this part of it free stays as it is when others are pooled for another round.
WELL_FILLED = 0.004
#: Parts of the bins that a crossover injects from, and opens from; how far its order of refilling may be from the falling one.
INJECTED, OPENED, NOISE = 0.5, 0.3, (0.0, 0.1, 1.0)
ROUNDS = 3

PIECES = "doc_id {id_type}, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, *, path: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """A row for each piece of each document: doc_id, piece, start, length, ids_crc32, and ids (binary) if asked for."""
    id_type = dict(docs.dtypes)[doc_id]

    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = WordEncoder.get(path), np.asarray([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            of, out = [], {name: [] for name in ("piece", "start", "length", "ids_crc32", "ids")}
            for row, words in enumerate(batch.column(1).to_pylist()):
                ids = encoder.encode(words) + end
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    of.append(row)
                    for name, value in zip(out, (n, at // 4, len(own) // 4, zlib.crc32(own), own), strict=True):
                        out[name].append(value)
            types = {"piece": pa.int32(), "ids": pa.binary()}
            columns = {name: pa.array(values, types.get(name, pa.int64())) for name, values in out.items() if with_ids or name != "ids"}
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).take(pa.array(of, pa.int64()))} | columns)

    schema = PIECES.format(id_type=id_type) + (", ids binary" if with_ids else "")
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, schema)


class Bins:
    """Bins under construction, found by how much room they have left."""

    def __init__(self, capacity: int):
        self.capacity, self.bins, self.room = capacity, [], []
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0  # bit r: some bin has room r

    def add(self, items: list[int], room: int) -> None:
        self.bins.append(items)
        self.room.append(room)
        if room:
            self.at[room].append(len(self.bins) - 1)
            self.mask |= 1 << room

    def best_fit(self, items, lengths: list[int]) -> None:
        """Each item goes to the fullest bin that has room for it, or to a new one."""
        at, bins, room, mask = self.at, self.bins, self.room, self.mask
        for i in items:
            size = lengths[i]
            fits = mask >> size
            if fits:
                r = size + (fits & -fits).bit_length() - 1
                stack = at[r]
                b = stack.pop()
                if not stack:
                    mask ^= 1 << r
            else:
                r, b = self.capacity, len(bins)
                bins.append([])
                room.append(r)
            bins[b].append(i)
            r -= size
            room[b] = r
            if r:
                at[r].append(b)
                mask |= 1 << r
        self.mask = mask


def _fresh(order, lengths: list[int], capacity: int) -> Bins:
    out = Bins(capacity)
    out.best_fit(order, lengths)
    return out


def _score(one: Bins) -> tuple[int, float]:
    """Fewer bins first; among equals, those whose fill is more uneven leave more to gain."""
    free = np.asarray(one.room, dtype=np.float64) / one.capacity
    return len(one.bins), -float(((1 - free) ** 2).sum())


def crossover(a: Bins, b: Bins, lengths: list[int], rng: random.Random) -> Bins:
    """Well-filled bins of b enter a whole; bins of a that share a document with them are opened and refilled.

    Well filled are the fuller INJECTED of b's bins, most of which enter. Some of the emptier OPENED of a's are opened as
    well. What is displaced goes back by best fit, in falling order or one that is more or less by chance.
    """
    full = sorted(b.room)[int(INJECTED * (len(b.room) - 1))]
    loose = max(1, sorted(a.room)[int((1 - OPENED) * (len(a.room) - 1))])
    taken = bytearray(len(lengths))
    out = Bins(a.capacity)
    for items, room in zip(b.bins, b.room, strict=True):
        if room <= full and rng.random() < 0.7:
            for i in items:
                taken[i] = 1
            out.add(list(items), room)
    displaced = []
    for items, room in zip(a.bins, a.room, strict=True):
        if any(taken[i] for i in items):
            displaced += [i for i in items if not taken[i]]
        elif room >= loose and rng.random() < 0.5:
            displaced += items
        else:
            out.add(list(items), room)
    noise = rng.choice(NOISE)
    displaced.sort(key=lambda i: -lengths[i] * (1 + noise * rng.random()))
    out.best_fit(displaced, lengths)
    return out


def evolve(population: list[Bins], lengths: list[int], capacity: int, seed: int, offspring: int = OFFSPRING, keep: int = POPULATION) -> list[Bins]:
    """lengths in falling order. The best `keep` after some crossovers, best first; no two are equally good, so that they differ."""
    rng = random.Random(seed)
    least = -(-sum(lengths) // capacity)
    population = list(population)
    while len(population) < keep:
        # Falling order with some noise, so that chromosomes differ.
        noisy = range(len(lengths)) if not population else sorted(range(len(lengths)), key=lambda i: -lengths[i] * (1 + 0.1 * rng.random()))
        population.append(_fresh(noisy, lengths, capacity))
        if len(population[-1].bins) == least:
            break
    population.sort(key=_score)
    for _ in range(offspring):
        if len(population[0].bins) <= least or len(population) < 2:
            break
        a, b = rng.sample(population, 2)
        child = crossover(a, b, lengths, rng)
        if all(_score(child) != _score(one) for one in population):
            population = sorted([*population, child], key=_score)[:keep]
    return population


_ELITE = "block long, island int, uid array<long>, length array<int>, bin array<int>, bins long, score double, least long"


def _elite(block: int, island: int, uid: np.ndarray, lengths: list[int], best: Bins) -> pd.DataFrame:
    of = np.empty(len(lengths), dtype=np.int32)
    for k, items in enumerate(best.bins):
        of[items] = k
    bins, score = _score(best)
    return pd.DataFrame({"block": [block], "island": [island], "uid": [uid], "length": [np.asarray(lengths, dtype=np.int32)], "bin": [of], "bins": [bins], "score": [score], "least": [-(-sum(lengths) // best.capacity)]})


def _restore(lengths: list[int], of: np.ndarray, bins: int, capacity: int) -> Bins:
    items: list[list[int]] = [[] for _ in range(bins)]
    for i, k in enumerate(of):
        items[k].append(i)
    out = Bins(capacity)
    for own in items:
        out.add(own, capacity - sum(lengths[i] for i in own))
    return out


def _evolved(items: DataFrame, capacity: int, islands: int, patience: int, offspring: int) -> DataFrame:
    """items: block, uid, length. The best chromosome of each block: block, uid, length and bin as arrays."""
    scratch = Scratch(items.sparkSession, "islands")

    def first(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        block, island = int(key[0]), int(key[1])
        rows = rows.sort_values(["length", "uid"], ascending=[False, True])
        lengths = rows["length"].tolist()
        best = evolve([], lengths, capacity, seed=block * 1009 + island, offspring=offspring)[0]
        return _elite(block, island, rows["uid"].to_numpy(), lengths, best)

    def later(epoch: int):
        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            block, island = int(key[0]), int(key[1])
            rows = rows.sort_values(["bins", "score", "came_from"])
            lengths = [int(x) for x in rows["length"].iloc[0]]
            own = [_restore(lengths, of, int(n), capacity) for of, n in zip(rows["bin"], rows["bins"], strict=True)]
            best = evolve(own, lengths, capacity, seed=(block * 1009 + island) * 31 + epoch, offspring=offspring)[0]
            return _elite(block, island, np.asarray(rows["uid"].iloc[0]), lengths, best)

        return run

    dealt = items.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))
    rank = F.struct("bins", "score", "island")
    best_of = lambda elites: elites.groupBy("block").agg(F.min_by(F.struct("uid", "length", "bin", "bins", "least"), rank).alias("best"), F.min(F.struct("bins", "score")).alias("now")).select("block", "best.*", "now")
    elites = scratch.save(dealt.groupBy("block", "island").applyInPandas(first, _ELITE))
    best = scratch.save(best_of(elites).withColumn("waited", F.lit(0)))
    done, epoch = best.where("bins <= least"), 0
    while True:
        # Blocks that may still lose a bin go on; the others keep what they have.
        open_ = best.where((F.col("bins") > F.col("least")) & (F.col("waited") < patience))
        if open_.isEmpty():
            break
        epoch += 1
        moved = elites.join(open_.select("block"), "block", "left_semi").withColumn("came_from", F.col("island"))
        moved = moved.withColumn("island", F.explode(F.array_distinct(F.array("island", ((F.col("island") + 1) % islands).cast("int")))))
        elites = scratch.save(moved.groupBy("block", "island").applyInPandas(later(epoch), _ELITE))
        before = open_.select("block", F.col("now").alias("was"), F.col("waited").alias("waited_before"))
        after = best_of(elites).join(before, "block")
        after = after.withColumn("waited", F.when(F.col("now") < F.col("was"), 0).otherwise(F.col("waited_before") + 1)).drop("was", "waited_before")
        best = scratch.save(after)
        done = done.unionByName(best.where((F.col("bins") <= F.col("least")) | (F.col("waited") >= patience)))
    return done.select("block", "uid", "length", "bin")


def pack(items: DataFrame, *, capacity: int = CAPACITY, islands: int = ISLANDS, patience: int = PATIENCE, offspring: int = OFFSPRING, rounds: int = ROUNDS) -> DataFrame:
    """items: uid long (unique), length (1 to capacity). Returns uid, sequence_id, offset."""
    spark = importable(items.sparkSession)
    scratch = Scratch(spark, "pack")
    done = items.where(F.col("length") == capacity).select("uid", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    open_ = items.where(F.col("length") < capacity).select("uid", F.col("length").cast("int").alias("length"))
    blocks_before = None
    for turn in range(rounds):
        tokens, n = open_.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
        if not n:
            break
        blocks = max(1, -(-tokens // (BLOCK_BINS * capacity)), -(-n // BLOCK_PIECES))
        last = turn == rounds - 1 or blocks == 1 or (blocks_before is not None and blocks > 0.8 * blocks_before)
        dealt = open_.withColumn("block", F.pmod(F.xxhash64("uid", F.lit(turn)), F.lit(blocks)))
        best = _evolved(dealt, capacity, islands, patience, offspring)

        def laid(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            """A block at a time, so each row's place in its bin follows from the rows before it."""
            for batch in batches:
                for block, uid, length, of in zip(batch["block"], batch["uid"], batch["length"], batch["bin"], strict=True):
                    uid, length, of = np.asarray(uid), np.asarray(length, dtype=np.int64), np.asarray(of)
                    order = np.argsort(of, kind="stable")
                    ends = np.cumsum(length[order])
                    starts = ends - length[order]
                    first = np.r_[True, of[order][1:] != of[order][:-1]] if len(of) else np.zeros(0, bool)
                    base = starts[first][np.cumsum(first) - 1]
                    total = np.bincount(of, weights=length, minlength=1)[of[order]]
                    yield pd.DataFrame({"uid": uid[order], "length": length[order].astype(np.int32), "sequence_id": (np.int64(block) << 24) + of[order], "offset": starts - base, "filled": total.astype(np.int64)})

        placed = scratch.save(best.mapInPandas(laid, "uid long, length int, sequence_id long, offset long, filled long"))
        good = F.lit(True) if last else F.col("filled") >= capacity - int(WELL_FILLED * capacity)
        number = F.col("sequence_id") * ROUNDS + turn
        done = done.unionByName(placed.where(good).select("uid", number.alias("sequence_id"), "offset"))
        if last:
            break
        open_ = placed.where(~good).select("uid", "length")
        blocks_before = blocks
    return done


def pack_documents(docs: DataFrame, *, path: str | None = None, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = importable(docs.sparkSession)
    cut = pieces(docs, path=path or default_path("word_bpe_49k.json"), capacity=capacity, doc_id=doc_id, text=text)
    cut = Scratch(spark, "pieces").save(cut.withColumn("uid", F.monotonically_increasing_id()))
    return cut.join(pack(cut.select("uid", "length"), capacity=capacity), "uid").drop("uid")


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
