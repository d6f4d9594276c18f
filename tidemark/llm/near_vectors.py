"""Embedding near-duplicates by collision-counting projections.

Vectors of length one are projected on PROJECTIONS seeded Gaussian directions. Along each, a block's vectors are sorted,
and the vectors that collide with a query are those in the window of half-width `window` around it: a run in sorted
order, kept as the difference of two prefix bit sets. Counters of collisions are added up for all pairs at once, 64 to a
machine word. Two vectors at an angle of the least cosine differ by a Gaussian of known width along every direction, so
the count of their collisions is binomial; the count that a pair must reach is the largest that such a pair reaches
with a probability of RECALL. Closer pairs reach it more surely. Pairs that pass are verified in double precision.

Equal vectors are one class from the start. Classes are dealt by hash to blocks of a bounded size; cells of two blocks
are the tasks, so each pair of classes meets once, and a task gives counts of links and links that span its
components, never its pairs. The work is that of a block for each pair of blocks: it grows with the square of the
number of different vectors (README has figures).

Cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of different
lengths don't link; null vec_id is returned as it is, and its component_id is the smallest vec_id of its component;
repeated rows are copies and link; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.vectors import grid, vectors
from tidemark.llm.words import groups, tables
from tidemark.llm.workers import tidy
from tidemark.session import Scratch, importable

LEAST_COSINE = 0.9
PROJECTIONS = 64
RECALL = 0.999999
#: Half-width of a window, in standard deviations of the difference of two vectors at the least cosine.
WINDOW = 1.0
#: Classes in a block of the grid, and in a part of it that has its own bit sets.
BLOCK = 8192
PART = 2048
#: Queries that are counted at once.
ASKED = 512


def least_count(projections: int, window: float, recall: float) -> int:
    """The largest count that a pair at the least cosine reaches with this probability."""
    p = math.erf(window / math.sqrt(2))
    tail = 0.0
    for k in range(projections + 1):
        tail += math.comb(projections, k) * p**k * (1 - p) ** (projections - k)
        if tail > 1 - recall:
            return k
    return projections


def directions(dim: int, projections: int) -> np.ndarray:
    return np.random.default_rng([dim, projections, 9]).standard_normal((dim, projections))


class Windows:
    """Sorted projections of one part, and the bit sets of all its prefixes."""

    def __init__(self, projected: np.ndarray):
        n, m = projected.shape
        self.n, self.width = n, -(-n // 64)
        order = np.argsort(projected, axis=0, kind="stable")
        self.sorted = np.asfortranarray(np.take_along_axis(projected, order, axis=0))
        one = np.zeros((m, n + 1, self.width), dtype=np.uint64)
        rows = np.arange(1, n + 1)
        for j in range(m):
            one[j, rows, order[:, j] >> 6] = np.uint64(1) << (order[:, j] & 63).astype(np.uint64)
        self.prefix = np.bitwise_or.accumulate(one, axis=1)

    def bounds(self, order: np.ndarray, queries: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray]:
        """Where each query's window begins and ends in each projection; queries are in the projection's order, which makes looking up quick."""
        low, high = (np.empty(queries.shape, dtype=np.int32) for _ in range(2))
        for j in range(len(queries)):
            low[j, order[j]] = np.searchsorted(self.sorted[:, j], queries[j] - half, "left")
            high[j, order[j]] = np.searchsorted(self.sorted[:, j], queries[j] + half, "right")
        return low, high

    def passing(self, low: np.ndarray, high: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, member) pairs with `least` collisions or more."""
        # All arrays are made once and kept small, so that they stay in a core's cache.
        m, n = low.shape
        shape = n, self.width
        planes = np.zeros((m.bit_length(), *shape), dtype=np.uint64)
        carry, spare = np.empty(shape, dtype=np.uint64), np.empty(shape, dtype=np.uint64)
        for j in range(m):
            np.take(self.prefix[j], high[j], axis=0, out=carry, mode="clip")
            np.take(self.prefix[j], low[j], axis=0, out=spare, mode="clip")
            np.bitwise_xor(carry, spare, out=carry)
            for k in range(min(len(planes), (j + 1).bit_length())):
                np.bitwise_and(planes[k], carry, out=spare)
                np.bitwise_xor(planes[k], carry, out=planes[k])
                carry, spare = spare, carry
        # count >= least: compared from the highest bit down.
        more, equal = np.zeros(shape, dtype=np.uint64), np.full(shape, np.uint64(0xFFFFFFFFFFFFFFFF))
        for k in reversed(range(len(planes))):
            if least >> k & 1:
                equal &= planes[k]
            else:
                more |= equal & planes[k]
                equal &= ~planes[k]
        hit = more | equal
        q, word = np.nonzero(hit)
        bits = np.unpackbits(hit[q, word].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        at, bit = np.nonzero(bits)
        member = word[at] * 64 + bit
        inside = member < self.n
        return q[at][inside], member[inside]


def near_pairs(a: np.ndarray, b: np.ndarray, pa_: np.ndarray, pb: np.ndarray, least_cosine: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a and b (of length one) at the least cosine or closer; of one block, each pair once."""
    half = WINDOW * math.sqrt(2 - 2 * least_cosine)
    least = least_count(pa_.shape[1], WINDOW, RECALL)
    order = np.ascontiguousarray(np.argsort(pa_, axis=0, kind="stable").T)
    asked = np.take_along_axis(pa_.T, order, axis=1)
    for at in range(0, len(b), PART):
        windows = Windows(pb[at : at + PART])
        low, high = windows.bounds(order, asked, half)
        for q in range(0, min(len(a), at + PART) if same else len(a), ASKED):
            i, j = windows.passing(low[:, q : q + ASKED], high[:, q : q + ASKED], least)
            i, j = i + q, j + at
            if same:
                i, j = i[i < j], j[i < j]
            for k in range(0, len(i), 1 << 16):
                x, y = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
                ok = np.einsum("ij,ij->i", a[x], b[y]) >= least_cosine
                yield x[ok], y[ok]


def _classes(schema: pa.Schema):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_() -> Iterator[dict]:
            for batch in batches:
                for vec_id, v in zip(batch.column(0).to_pylist(), vectors(batch.column(1)), strict=True):
                    unit = None
                    if v is not None and v.any():
                        v = v / np.abs(v).max()
                        unit = (v / math.sqrt(float(v @ v))).tobytes()
                    yield {"vec_id": vec_id, "class": xxhash.xxh3_128_digest(unit) if unit else None, "unit": unit}

        yield from tables(rows_(), schema)

    return run


def _cell(least_cosine: float, projections: int, schema: pa.Schema):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from tables((row for (i, j), own in groups(batches, 2) for row in _of_cell(i == j, own)), schema)

    def _of_cell(same: bool, own: list[tuple]) -> Iterator[dict]:
        own.sort(key=lambda r: (r[0], r[1]))
        for dim in sorted({len(r[3]) for r in own}):
            sides = [[r for r in own if r[0] == s and len(r[3]) == dim] for s in (0, 1)]
            if same:
                sides[1] = sides[0]
            if not sides[0] or not sides[1]:
                continue
            names = [[r[1] for r in s] for s in sides]
            weight = [np.array([r[2] for r in s], dtype=np.int64) for s in sides]
            unit = [np.frombuffer(b"".join(r[3] for r in s)).reshape(len(s), -1) for s in sides]
            project = directions(dim // 8, projections)
            links = [np.zeros(len(s), dtype=np.int64) for s in sides]
            if same:
                links[1] = links[0]
            shift = 0 if same else len(names[0])
            root = list(range(shift + len(names[1])))

            def find(x: int, root: list[int] = root) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            projected = [u @ project for u in unit]
            for x, y in near_pairs(unit[0], unit[1], projected[0], projected[1], least_cosine, same):
                np.add.at(links[0], x, weight[1][y])
                np.add.at(links[1], y, weight[0][x])
                for u, v in zip(x.tolist(), (y + shift).tolist(), strict=True):
                    u, v = find(u), find(v)
                    if u != v:
                        root[max(u, v)] = min(u, v)
            every = names[0] if same else names[0] + names[1]
            total = links[0] if same else np.concatenate(links)
            for k in np.flatnonzero(total).tolist():
                yield {"class": every[k], "links": int(total[k]), "root": every[find(k)]}

    return run


def near_vectors(table: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", least_cosine: float = LEAST_COSINE, projections: int = PROJECTIONS, block: int = BLOCK) -> DataFrame:
    """Returns vec_id, n_links, component_id, kept."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = importable(table.sparkSession)
    scratch = Scratch(spark, "vectors")
    arrow = lambda s: to_arrow_schema(spark.createDataFrame([], s).schema)
    id_type = dict(table.dtypes)[vec_id]
    first, out = f"vec_id {id_type}, class binary, unit binary", "class binary, links long, root binary"
    every = scratch.save(table.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding")).mapInArrow(_classes(arrow(first)), first))
    some = every.where("class is not null")
    # Copies count by the row; the vector itself comes from any of them.
    classes = some.groupBy("class").agg(F.count("*").alias("copies"), F.first("unit").alias("unit"), F.min("vec_id").alias("least"))
    n = some.select("class").distinct().count()
    blocks = max(1, -(-n // block))
    placed = classes.withColumn("cell", F.explode(grid(F.pmod(F.xxhash64("class"), F.lit(blocks)).cast("int"), blocks)))
    cells = placed.select("cell.i", "cell.j", "cell.side", "class", "copies", "unit").repartition(max(1, blocks * (blocks + 1) // 2), "i", "j").sortWithinPartitions("i", "j")
    found = scratch.save(cells.mapInArrow(_cell(least_cosine, projections, arrow(out)), out))
    roots = components(found.where("class <> root").select(F.col("class").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    # Smallest ids are taken of classes, then of components; rows are joined once, with their class.
    own = classes.select("class", "copies", "least").join(links, "class", "left").join(roots, F.col("class") == F.col("node"), "left")
    own = scratch.save(own.select("class", "copies", "links", "least", F.coalesce("root", "class").alias("component")))
    of_component = scratch.save(own.groupBy("component").agg(F.min("least").alias("component_id")))
    n_links = (F.coalesce(F.col("links"), F.lit(0)) + F.col("copies") - 1).cast("long")
    named = scratch.save(own.join(of_component, "component").select("class", n_links.alias("n_links"), "component_id"))
    linked = some.select("vec_id", "class").join(named, "class").select("vec_id", "n_links", "component_id")
    alone = every.where("class is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e,
         embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok
  FROM embeddings),
pair AS (
  SELECT a.vec_id AS u, b.vec_id AS w
  FROM (SELECT * FROM v WHERE ok) a JOIN (SELECT * FROM v WHERE ok) b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS u, vec_id AS w FROM v UNION SELECT reach.u, pair.w FROM reach JOIN pair ON reach.w = pair.u),
least AS (SELECT u, min(w) AS component_id FROM reach GROUP BY u)
SELECT vec_id, CAST((SELECT count(*) FROM pair WHERE pair.u = v.vec_id) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN least ON least.u = v.vec_id
"""
