"""Exact top-k by inner product with two cover trees.

Rows are dealt to balls around centres, rows of the table; queries and candidates alike. That is the top of one tree over
all of them. A ball over the block size is dealt by hash as well. First each ball's queries search their own ball; then
blocks of queries meet only the balls in which, by the bound below, one of them may still find a score that is no less than
its kth so far. A task has one block of queries and one of candidates and builds a cover tree of either: a node is a ball
around one of its vectors, split by farthest-first centres until balls of half the radius cover it. Where WIDE such balls
don't, each vector goes to its nearest centre and the child's radius is what it is. Pairs of nodes are visited best bound
first. No score in a pair exceeds

    q.p + |q| r_p + |p| r_q + r_q r_p

for centres q, p and radii r; a pair is left when that is below the worst kth score of the query node's queries, of which
each brings what it has found before. A tie may still win by a smaller id, so equal bounds are followed. Pairs of leaves are
scored by one product. Each task gives k rows a query, of which the best k stay.

Scores are integers: components are floor(scale * x). Products in double precision are exact below 2**53; pairs of vectors
whose product could reach that are scored again with Python's integers, and scores outside the range of long are clipped to
it, after which ids decide.

Cases: vectors that are null, empty or hold null or non-finite components take no part; vectors of different lengths
don't meet; null ids are not queries, and as candidates come last among ties; repeated rows are candidates each, and a
query's own row is left out by row, not by id; fewer than k candidates give fewer rows; an empty table gives none. Other
columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.vectors import vectors
from tidemark.llm.words import groups, tables
from tidemark.llm.workers import tidy
from tidemark.session import Scratch, importable

SCALE = 1024.0
K = 10
BLOCK = 8192
LEAF = 64
WIDE = 8
EXACT = float(1 << 53)
#: Centres at most: the table of them, so many vectors, goes to every task.
CENTRES = 2048
LEAST, MOST = -(1 << 63), (1 << 63) - 1


class CoverTree:
    """Rows of x by node: order[lo:hi] are a node's rows, centre and radius its ball, children below it."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.norm = np.sqrt(np.einsum("ij,ij->i", x, x))
        self.order = np.arange(len(x))
        self.lo, self.hi, self.centre, self.radius, self.children = [], [], [], [], []
        open_ = [(0, len(x), 0, None)]
        while open_:
            lo, hi, centre, parent = open_.pop()
            node = len(self.lo)
            if parent is not None:
                self.children[parent].append(node)
            own = self.order[lo:hi]
            away = self._away(own, centre)
            for column, value in zip((self.lo, self.hi, self.centre, self.radius, self.children), (lo, hi, centre, float(away.max()), []), strict=True):
                column.append(value)
            if hi - lo <= LEAF or away.max() == 0:
                continue
            nearest, least, centres = np.zeros(hi - lo, dtype=np.int64), away, [centre]
            while len(centres) < WIDE and least.max() > self.radius[node] / 2:
                far = int(own[least.argmax()])
                d = self._away(own, far)
                nearest, least = np.where(d < least, len(centres), nearest), np.minimum(d, least)
                centres.append(far)
            by = np.argsort(nearest, kind="stable")
            self.order[lo:hi] = own[by]
            ends = np.searchsorted(nearest[by], np.arange(len(centres) + 1))
            open_ += [(lo + int(a), lo + int(z), c, node) for a, z, c in zip(ends, ends[1:], centres, strict=False) if z > a]

    def _away(self, rows: np.ndarray, centre: int) -> np.ndarray:
        d = self.x[rows] - self.x[centre]
        return np.sqrt(np.einsum("ij,ij->i", d, d))


def _products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Inner products as long integers, clipped to their range."""
    score = q @ p.T
    wide = np.abs(q).sum(axis=1)[:, None] * np.abs(p).max(axis=1)[None, :] >= EXACT
    score[wide] = 0
    out = score.astype(np.int64)
    for i, j in zip(*np.nonzero(wide), strict=True):
        out[i, j] = max(LEAST, min(MOST, sum(int(x) * int(y) for x, y in zip(q[i].tolist(), p[j].tolist(), strict=True))))
    return out


def search(q: np.ndarray, q_row: np.ndarray, floor: np.ndarray, p: np.ndarray, p_row: np.ndarray, k: int) -> tuple[list[list[int]], list[list[int]]]:
    """For each query the places in p of its best k and their scores, none below its floor. p is in order of id, so ties are by place."""
    # No score is the least long but by clipping; a place after all others says that there is none.
    nowhere = len(p)
    best = np.full((len(q), k), LEAST)
    at = np.full((len(q), k), nowhere)
    a, b = CoverTree(q), CoverTree(p)

    def bound(i: int, j: int) -> float:
        u, v = a.centre[i], b.centre[j]
        r, t = a.radius[i], b.radius[j]
        most = float(q[u] @ p[v]) + a.norm[u] * t + b.norm[v] * r + r * t
        return most + 1e-9 * (1 + (a.norm[u] + r) * (b.norm[v] + t))  # radii and products are rounded; scores are not

    def worst(rows: np.ndarray) -> np.ndarray:
        return np.maximum(np.where(at[rows, -1] < nowhere, best[rows, -1], LEAST), floor[rows])

    heap = [(-bound(0, 0), 0, 0)]
    while heap:
        most, i, j = heapq.heappop(heap)
        rows = a.order[a.lo[i] : a.hi[i]]
        if -most < float(worst(rows).min()):
            continue
        if not a.children[i] and not b.children[j]:
            cols = b.order[b.lo[j] : b.hi[j]]
            score = _products(q[rows], p[cols])
            place = np.where((q_row[rows][:, None] == p_row[cols][None, :]) | (score < worst(rows)[:, None]), nowhere, cols[None, :])
            some = np.flatnonzero((place < nowhere).any(axis=1))
            if len(some):
                r = rows[some]
                both = np.concatenate([best[r], np.where(place[some] < nowhere, score[some], LEAST)], axis=1)
                place = np.concatenate([at[r], place[some]], axis=1)
                # Of equal scores the smaller place; so what is nowhere comes after all that has the least score.
                top = np.lexsort((place, ~both), axis=1)[:, :k]
                best[r], at[r] = np.take_along_axis(both, top, 1), np.take_along_axis(place, top, 1)
            continue
        wide = a.children[i] and (not b.children[j] or a.radius[i] >= b.radius[j])
        for pair in [(c, j) for c in a.children[i]] if wide else [(i, c) for c in b.children[j]]:
            heapq.heappush(heap, (-bound(*pair), *pair))
    found = at < nowhere
    return [at[n][found[n]].tolist() for n in range(len(q))], [best[n][found[n]].tolist() for n in range(len(q))]


def _scaled(scale: float, schema: pa.Schema):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_() -> Iterator[dict]:
            for batch in batches:
                for row, vec_id, asks, v in zip(*(batch.column(k).to_pylist() for k in range(3)), vectors(batch.column(3)), strict=True):
                    if v is not None:
                        yield {"row": row, "vec_id": vec_id, "asks": asks, "vector": np.floor(scale * v).tobytes()}

        yield from tables(rows_(), schema)

    return run


class Centres:
    """Centres of each length of vectors. Each length has the origin as well, as ball -length."""

    def __init__(self, vectors_: list[bytes]):
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        own: dict[int, list[tuple[int, np.ndarray]]] = {}
        for ball, v in enumerate(vectors_):
            own.setdefault(len(v) // 8, []).append((ball, np.frombuffer(v)))
        for length, found in own.items():
            self.by_length[length] = np.array([-length, *(b for b, _ in found)]), np.stack([np.zeros(length), *(x for _, x in found)])

    def of(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        return self.by_length.get(length) or (np.array([-length]), np.zeros((1, length)))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ball and distance of each row. Distances are of the difference itself, which rounding hardly touches."""
        balls, at = self.of(x.shape[1])
        near = ((at * at).sum(axis=1)[None, :] - 2 * (x @ at.T)).argmin(axis=1)
        return balls[near], np.sqrt(((x - at[near]) ** 2).sum(axis=1))


def _deal(centres: Centres, schema: pa.Schema):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("vector").to_pylist()
            ball, away = np.zeros(len(own), dtype=np.int64), np.zeros(len(own))
            lengths = np.array([len(v) // 8 for v in own])
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                ball[at], away[at] = centres.nearest(np.frombuffer(b"".join(own[n] for n in at)).reshape(len(at), length))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ball), pa.array(away)], schema=schema)

    return run


def _meet(centres: Centres, balls: list[tuple[int, int, float]], schema: pa.Schema):
    """Rows ball, part, length, radius, floor of blocks of queries: other balls (ball, length, radius) in which one may find more."""
    by_length: dict[int, dict[int, float]] = {}
    for ball, length, radius in balls:
        by_length.setdefault(length, {})[ball] = radius

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from tables((row for batch in batches for r in batch.to_pylist() for row in _of_block(r)), schema)

    def _of_block(r: dict) -> Iterator[dict]:
        names, at = centres.of(r["length"])
        norm = np.sqrt((at * at).sum(axis=1))
        radius = np.array([by_length[r["length"]].get(b, -1.0) for b in names.tolist()])
        k = int(np.flatnonzero(names == r["ball"])[0])
        most = at @ at[k] + norm[k] * radius + norm * r["radius"] + r["radius"] * radius
        most += 1e-9 * (1 + (norm[k] + r["radius"]) * (norm + radius))
        for b in names[(radius >= 0) & (most >= float(r["floor"])) & (names != r["ball"])].tolist():
            yield {"ball": r["ball"], "part": r["part"], "other": b}

    return run


def _cell(k: int, schema: pa.Schema):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from tables((row for _, own in groups(batches, 4) for row in _of_cell(own)), schema)

    def _of_cell(own: list[tuple]) -> Iterator[dict]:
        asking = sorted((r for r in own if r[0]), key=lambda r: r[1])
        held = sorted((r for r in own if not r[0]), key=lambda r: (r[2] is None, r[2], r[1]))
        if not asking or not held:
            return
        matrix = lambda rows: np.frombuffer(b"".join(r[3] for r in rows)).reshape(len(rows), -1)
        row = lambda rows: np.array([r[1] for r in rows], dtype=np.int64)
        floor = np.array([LEAST if r[4] is None else r[4] for r in asking], dtype=np.int64)
        places, scores = search(matrix(asking), row(asking), floor, matrix(held), row(held), k)
        for q, at, s in zip(asking, places, scores, strict=True):
            for place, x in zip(at, s, strict=True):
                yield {"query_row": q[1], "query_id": q[2], "row": held[place][1], "vec_id": held[place][2], "score": x}

    return run


def top_k(table: DataFrame, asks: Column, *, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K, scale: float = SCALE, block: int = BLOCK, most_centres: int = CENTRES) -> DataFrame:
    """asks: a boolean column, true for the rows that are queries. Returns query_id, rank, vec_id, score."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = importable(table.sparkSession)
    scratch = Scratch(spark, "topk")
    arrow = lambda s: to_arrow_schema(spark.createDataFrame([], s).schema)
    id_type = dict(table.dtypes)[vec_id]
    first = f"row long, vec_id {id_type}, asks boolean, vector binary"
    placed = first + ", ball long, away double"
    found = f"query_row long, query_id {id_type}, row long, vec_id {id_type}, score long"
    read = table.select(F.monotonically_increasing_id().alias("row"), F.col(vec_id).alias("vec_id"), F.coalesce(asks, F.lit(False)).alias("asks"), F.col(embedding).alias("embedding"))
    own = scratch.save(read.mapInArrow(_scaled(scale, arrow(first)), first))
    n = own.count()
    chosen = own.orderBy(F.xxhash64("row")).limit(min(most_centres, -(-n // block)) if n > block else 0)
    centres = Centres([r.vector for r in chosen.select("vector").collect()])
    own = scratch.save(own.mapInArrow(_deal(centres, arrow(placed)), placed))
    # A row for each centre and length: what a ball holds.
    length = (F.octet_length("vector") / 8).cast("int")
    of_ball = own.groupBy("ball").agg(F.first(length).alias("length"), F.count("*").alias("n"), F.count_if("asks").alias("queries"), F.max("away").alias("radius"))
    balls = scratch.save(of_ball)
    parts = balls.select("ball", F.ceil(F.col("n") / block).cast("int").alias("parts"), F.greatest(F.lit(1), F.ceil(F.col("queries") / block)).cast("int").alias("q_parts"))
    part = lambda of: F.pmod(F.xxhash64("row"), F.col(of)).cast("int")
    held = own.join(F.broadcast(parts), "ball").withColumn("j", part("parts")).select("ball", "j", "row", "vec_id", "vector")
    asking = own.where("asks").join(F.broadcast(parts), "ball").withColumn("i", part("q_parts")).select("ball", "i", "row", "vec_id", "vector", "away", "q_parts")
    columns = ["ball", "i", "other", "j", "asking", "row", "vec_id", "vector", "floor"]

    def searched(queries: DataFrame, meeting: DataFrame) -> DataFrame:
        """queries: with floor. meeting: ball, i, other: which blocks of queries meet which balls."""
        every = meeting.join(F.broadcast(parts.select(F.col("ball").alias("other"), "parts")), "other").withColumn("j", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        left = queries.join(every, ["ball", "i"]).withColumn("asking", F.lit(True)).select(columns)
        right = held.withColumnRenamed("ball", "other").join(every, ["other", "j"]).withColumn("asking", F.lit(False)).withColumn("floor", F.lit(None).cast("long")).select(columns)
        keys = ["ball", "i", "other", "j"]
        return scratch.save(left.unionByName(right).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_cell(k, arrow(found)), found))

    blocks = asking.groupBy("ball", "i").agg(F.max("away").alias("radius"))
    at_home = searched(asking.withColumn("floor", F.lit(None).cast("long")), blocks.select("ball", "i", F.col("ball").alias("other")))
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    kth = at_home.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).select(F.col("query_row").alias("row"), F.col("score").alias("floor"))
    floored = scratch.save(asking.join(kth, "row", "left"))
    worst = floored.groupBy("ball", "i").agg(F.max("away").alias("radius"), F.min(F.coalesce("floor", F.lit(LEAST))).alias("floor"), F.first(length).alias("length"))
    known = [(r.ball, r.length, r.radius) for r in balls.collect()]
    pairs = "ball long, part int, other long"
    meeting = worst.select("ball", F.col("i").alias("part"), "length", "radius", "floor").mapInArrow(_meet(centres, known, arrow(pairs)), pairs)
    meeting = scratch.save(meeting.withColumnRenamed("part", "i"))
    out = at_home.unionByName(searched(floored, meeting))
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(table, F.col("vec_id") % 100 == 0)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, p.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, p.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v p ON q.vec_id <> p.vec_id AND len(q.e) = len(p.e) WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
