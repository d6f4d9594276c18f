r"""N-gram Jaccard join by prefix trees.

A document's set is the distinct runs of `width` words of its whole text (A-Z in lower case, words outside
[\x20\x09-\x0D]); shorter texts are one run; a text without words has no set and links with nothing. Two documents link
when den * intersection >= num * union.

1. Sets are hashed where the texts are read. Documents with equal sets are one node from then on, named by a 128-bit
   digest. A slice of the texts sends each element once, with the number of its nodes that hold it, to buckets of the hash
   space, where an element's frequency is counted over all documents, and gets the frequencies of the elements that are
   shared back. So an element of every document is one entry for each slice. Which node holds what stays with the slice.
   The number of buckets follows from the bytes of the texts, never from the session's settings.
2. Elements are ordered by frequency, rarest first, then by hash: one global order. A node whose elements are mostly its
   own can't link and ends here. For the others the rarest n - ceil(t n) + 1 elements must hold one that any partner also
   holds among its own such elements, so candidates are the components of nodes that share one (each node is tied to
   the smallest node of the element, never all pairs).
3. The sets of a candidate component are stored in a trie in that order; probes share partial overlaps and leave
   subtrees by remaining-length bounds (trie.py). Components over BLOCK sets are cut into blocks: each block is joined
   with itself; then some sets of each block's classes are joined with each other. What is still outside a component's
   largest class is then dealt by each of the elements that must hold a shared one, and probes the sets of other classes
   that have the same: a trie for each element, and for each BLOCK of its sets if they are more. A link is between sets of
   one class by then, or one of them is outside the largest class and meets the other at an element that both have; so
   no pair of classes goes unseen, copies that are connected are not compared again, and texts that are only tied
   through others, such as those of few words in few orders, are not compared with all of their component.

An element is 64 bits within a document and 48 bits between documents. Two different elements of two sets of 550 words
get the same 48 bits with a probability of 1e-9.

Cases: null text is empty; repeated rows are equal sets; null doc_id is returned as it is, and its component_id is the
smallest doc_id of its class, null if there is none; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import trie
from tidemark.llm.columns import pack, small, steps, unpack
from tidemark.llm.components import components
from tidemark.llm.words import _MULT, groups, mixed, slices, tables, text_hashes
from tidemark.llm.workers import tidy
from tidemark.session import Scratch, importable

WIDTH = 5
NUM, DEN = 80, 100
#: Sets that one trie holds at most.
BLOCK = 1024
#: Sets of each class of a block that meet those of other blocks in the second step.
LEADERS = 4
#: Bytes of text whose elements make a bucket, about, and bytes of a slice. A task has one bucket or slice in memory at a time.
BUCKET_BYTES, SLICE_BYTES = 12 << 20, 8 << 20
_SHIFT = np.uint64(16)


def _bucket(tokens: np.ndarray, buckets: int) -> np.ndarray:
    """Of 48-bit elements; rising with them."""
    return (((tokens >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _frequency_class(df: np.ndarray) -> np.ndarray:
    """Rising with the frequency, in 256 steps."""
    return np.minimum(255, np.floor(8 * np.log2(df))).astype(np.uint64)


_SENT = "bucket int, batch string, {ids}, digests binary, data binary"
_FOUND = "batch string, bucket int, {ids}, digests binary, data binary"


def _sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Elements of all texts, sorted within each; and where each text's begin and end."""
    hashes, counts = text_hashes(texts)
    first = np.cumsum(counts) - counts
    runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), runs)
    start = first[text] + np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs)
    length = np.minimum(counts, width)[text]
    out = length.astype(np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):
            within = length > j
            whole = bool(within.all())
            at = slice(None) if whole else np.flatnonzero(within)
            out[at] = (out[at] ^ (out[at] >> np.uint64(32))) * _MULT + hashes[start[at] + j]
    out = mixed(out)
    order = np.lexsort((out, text))
    out, text = out[order], text[order]
    new = np.r_[True, (out[1:] != out[:-1]) | (text[1:] != text[:-1])][: len(out)]
    out, text = out[new], text[new]
    ends = np.searchsorted(text, np.arange(len(counts) + 1))
    return out, ends[:-1], ends[1:]


def _send(width: int, buckets: int, schema: pa.Schema):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(slices(batches, 1, size=SLICE_BYTES)):
            yield from tables(_of_slice(f"{task}-{number}", batch), schema, 64)

    def _of_slice(name: str, batch: pa.RecordBatch) -> Iterator[dict]:
        none = dict.fromkeys(x.name for x in schema)
        elements, starts, stops = _sets(batch.column(1), width)
        node_of: dict[bytes, int] = {}
        nodes, own = [], []
        for n, (a, z) in enumerate(zip(starts.tolist(), stops.tolist(), strict=True)):
            digest = xxhash.xxh3_128_digest(elements[a:z].tobytes()) if z > a else bytes(16)
            if digest not in node_of:
                node_of[digest] = len(node_of)
                own.append(n)
            nodes.append(node_of[digest])
        sizes = (stops - starts)[own]
        of = np.repeat(np.arange(len(own), dtype=np.uint16), sizes)
        tokens = elements[np.repeat(starts[own], sizes) + np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] >> _SHIFT
        order = np.argsort(tokens, kind="stable")
        tokens, of = tokens[order], of[order]
        at = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]][: len(tokens)])
        held, tokens = np.diff(np.r_[at, len(tokens)]), tokens[at]
        cuts = np.searchsorted(_bucket(tokens, buckets), np.arange(buckets + 1))
        some = np.flatnonzero(np.diff(cuts))
        packed = pack(small(sizes), small(np.array(nodes)), of, small(held), small(some), small(np.diff(cuts)[some]))
        yield none | {"bucket": xxhash.xxh32_intdigest(name) % buckets, "batch": name, "ids": batch.column(0).to_pylist(), "digests": b"".join(node_of), "data": packed}
        for b in some.tolist():
            yield none | {"bucket": b, "batch": name, "data": pack(steps(tokens[cuts[b] : cuts[b + 1]]), small(held[cuts[b] : cuts[b + 1]]))}

    return run


def _count(schema: pa.Schema):
    """Of each element that two nodes hold: its place in the global order, back to the slices that hold it."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket,), own in groups(batches, 1):
            yield from tables(_of_bucket(bucket, own), schema, 256)

    def _of_bucket(bucket: int, own: list[tuple]) -> Iterator[dict]:
        none = dict.fromkeys(x.name for x in schema)
        names, parts = [], []
        while own:
            name, ids, digests, data = own.pop()
            if ids is not None:
                yield none | {"batch": name, "ids": ids, "digests": digests, "data": data}
            else:
                tokens, held = unpack(data)
                names.append(name)
                parts.append((np.cumsum(tokens, dtype=np.uint64), held))
        if not names:
            return
        every, at = np.unique(np.concatenate([t for t, _ in parts]), return_inverse=True)
        df = np.bincount(at, weights=np.concatenate([h for _, h in parts]), minlength=len(every))
        rank = np.where(df > 1, _frequency_class(df), 0)
        i = 0
        for name, (tokens, _) in zip(names, parts, strict=True):
            own_rank = rank[at[i : i + len(tokens)]]
            i += len(tokens)
            hit = np.flatnonzero(own_rank)
            if len(hit):
                yield none | {"batch": name, "bucket": bucket, "data": pack(steps(hit), own_rank[hit].astype("<u1"), steps(tokens[hit]))}

    return run


def _nodes(num: int, den: int, schema: pa.Schema):
    """Each document's node, and of each node that may link its shared elements in order."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from tables((row for _, own in groups(batches, 1) for row in _of_batch(own)), schema, 1024)

    def _of_batch(own: list[tuple]) -> Iterator[dict]:
        ids, digests, data = next(r[1:] for r in own if r[1] is not None)
        sizes, nodes, of, held, some, counts = unpack(data)
        first = dict(zip(some.tolist(), (np.cumsum(counts, dtype=np.int64) - counts).tolist(), strict=True))
        ends = np.cumsum(held, dtype=np.int64)
        all_keys, all_of = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint16)]
        for bucket, row_ids, _, packed in own:
            if row_ids is None:
                hit, rank, tokens = unpack(packed)
                at = first[bucket] + np.cumsum(hit, dtype=np.int64)
                keys = (rank.astype(np.uint64) << np.uint64(48)) | np.cumsum(tokens, dtype=np.uint64)
                n = held[at].astype(np.int64)
                all_keys.append(np.repeat(keys, n))
                all_of.append(of[np.repeat(ends[at] - n, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)])
        keys, of = np.concatenate(all_keys), np.concatenate(all_of)
        order = np.lexsort((keys, of))
        keys, of = keys[order], of[order]
        cuts = np.searchsorted(of, np.arange(len(sizes) + 1))
        name = [digests[16 * k : 16 * k + 16] if sizes[k] else None for k in range(len(sizes))]
        for doc, k in zip(ids, nodes.tolist(), strict=True):
            yield {"doc_id": doc, "node": name[k], "size": int(sizes[k]), "keys": None, "prefix": None}
        for k, size in enumerate(sizes.tolist()):
            found, least = int(cuts[k + 1] - cuts[k]), -(-size * num // den)
            if size and found >= least:
                yield {"doc_id": None, "node": name[k], "size": size, "keys": keys[cuts[k] : cuts[k + 1]].tobytes(), "prefix": found - least + 1}

    return run


def _blocks(num: int, den: int, schema: pa.Schema):
    """Rows part..., node, size, keys: a self join of each part. Gives each node's class, by its first node, and whether it is among the class's first LEADERS."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from tables((row for part, own in groups(batches, 2) for row in _of_part(part, own)), schema)

    def _of_part(part: tuple, own: list[tuple]) -> Iterator[dict]:
        own = sorted(own)
        names = [r[0] for r in own]
        comp, _ = trie.self_links([np.frombuffer(r[2], "<u8") for r in own], [r[1] for r in own], num, den)
        classes: dict[int, list[bytes]] = {}
        for c, n in zip(comp.tolist(), names, strict=True):
            classes.setdefault(c, []).append(n)
        for own in classes.values():
            for k, n in enumerate(own):
                yield {"cluster": part[0], "block": part[1], "node": n, "root": own[0], "leads": k < LEADERS}

    return run


def _probes(num: int, den: int, schema: pa.Schema):
    """Rows key, block, chunk, probing, node, size, keys, root: links of probes with sets of other classes."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from tables((row for _, own in groups(batches, 3) for row in _of_part(own)), schema)

    def _of_part(own: list[tuple]) -> Iterator[dict]:
        held, asking = [r[1:] for r in own if not r[0]], [r[1:] for r in own if r[0]]
        if held and asking:
            as_set = lambda r: np.frombuffer(r[2], "<u8")
            for p, y in trie.cross_links([as_set(r) for r in held], [r[1] for r in held], [r[3] for r in held], [(as_set(r), r[1], r[3]) for r in asking], num, den):
                yield {"u": asking[p][0], "v": held[y][0]}

    return run


def _arrow(schema: str, spark: SparkSession) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def _by(df: DataFrame, *keys: str, then: tuple[str, ...] = ()) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys, *then)


def _prefix() -> Column:
    """The elements of which any partner has one among its own such."""
    return F.explode(F.expr("transform(sequence(0, cast(prefix as int) - 1), i -> substring(keys, 8 * i + 1, 8))"))


def links_of(nodes: DataFrame, num: int = NUM, den: int = DEN, block: int = BLOCK) -> DataFrame:
    """nodes: node, size, keys, prefix, a row each. Returns u, v: links whose components are the classes of all links."""
    spark = nodes.sparkSession
    scratch = Scratch(spark, "ngram")
    prefix = nodes.select("node", _prefix().alias("key"))
    hubs = prefix.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("other")).where("hub <> other").select("key", "hub")
    ties = prefix.join(hubs, "key").where("node <> hub").select(F.col("node").alias("u"), F.col("hub").alias("v"))
    clusters = components(ties)
    in_cluster = clusters.unionByName(clusters.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("root", "cluster")
    sizes = in_cluster.groupBy("cluster").agg(F.count("*").alias("sets")).withColumn("blocks", F.ceil(F.col("sets") / block).cast("int"))
    placed = in_cluster.join(sizes.drop("sets"), "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    sets = scratch.save(nodes.select("node", "size", "keys", "prefix").join(placed, "node"))
    part = "cluster binary, block int, node binary, root binary, leads boolean"
    own = _by(sets.select("cluster", "block", "node", "size", "keys"), "cluster", "block")
    first = scratch.save(own.mapInArrow(_blocks(num, den, _arrow(part, spark)), part))
    links = first.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v"))
    cut = sets.where("blocks > 1")
    if cut.isEmpty():
        return links
    # Components of several blocks: some of each class meet, by blocks of their own until no more meet in one.
    leading = first.where("leads").select("cluster", "node").join(sizes.where("blocks > 1").select("cluster"), "cluster")
    counted = leading.groupBy("cluster").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    leading = leading.join(counted, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).drop("parts")
    leaders = _by(cut.select("node", "size", "keys").join(leading, "node").select("cluster", "block", "node", "size", "keys"), "cluster", "block")
    second = scratch.save(leaders.mapInArrow(_blocks(num, den, _arrow(part, spark)), part))
    links = links.unionByName(second.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")))
    roots = components(links)
    rooted = cut.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = scratch.save(rooted.select("cluster", "node", "size", "keys", "prefix", "root"))
    largest = rooted.groupBy("cluster", "root").agg(F.count("*").alias("sets")).groupBy("cluster").agg(F.max_by("root", F.struct("sets", "root")).alias("largest"))
    # What is outside the largest class probes, element by element, the sets of other classes that have the element.
    outside = rooted.join(largest, "cluster").where("root <> largest").select("node", "size", "keys", "root", _prefix().alias("key"))
    asked = outside.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("chunks"))
    inside = rooted.select("node", "root", _prefix().alias("key")).join(asked, "key", "left_semi")
    met = inside.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"), F.min("root").alias("a"), F.max("root").alias("z")).where("a <> z")
    groups_ = scratch.save(asked.join(met.select("key", "blocks"), "key"))
    column = ["key", "block", "chunk", "probing", "node", "size", "keys", "root"]
    asking = outside.join(groups_, "key").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    held = rooted.select("node", "size", "keys", "root", _prefix().alias("key")).join(groups_, "key")
    held = held.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    both = asking.withColumn("probing", F.lit(True)).select(column).unionByName(held.withColumn("probing", F.lit(False)).select(column))
    pair = "u binary, v binary"
    third = _by(both, "key", "block", "chunk").mapInArrow(_probes(num, den, _arrow(pair, spark)), pair)
    return links.unionByName(scratch.save(third.distinct()))


def jaccard_join(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, num: int = NUM, den: int = DEN, block: int = BLOCK, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Returns doc_id, n_shingles, component_id, class (binary; equal within a component, null for empty sets).

    block: sets that one trie holds at most; bucket_bytes: bytes of text whose elements are one bucket, about.
    """
    spark = importable(docs.sparkSession)
    scratch = Scratch(spark, "ngram")
    id_type = dict(docs.dtypes)[doc_id]
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    size = read.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(1, -(-size // bucket_bytes))
    ids = f"ids array<{id_type}>"
    sent, found = _SENT.format(ids=ids), _FOUND.format(ids=ids)
    kept = f"doc_id {id_type}, node binary, size long, keys binary, prefix long"
    entries = read.mapInArrow(_send(width, buckets, _arrow(sent, spark)), sent)
    counted = _by(entries, "bucket").mapInArrow(_count(_arrow(found, spark)), found)
    every = scratch.save(_by(counted, "batch").mapInArrow(_nodes(num, den, _arrow(kept, spark)), kept))
    nodes = every.where("keys is not null").select("node", "size", "keys", "prefix").dropDuplicates(["node"])
    roots = components(links_of(nodes, num, den, block))
    docs_ = every.where("keys is null").select("doc_id", "node", F.col("size").alias("n_shingles"))
    # Smallest ids are taken of nodes, then of classes; documents are joined once, with their node.
    least = docs_.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    classed = scratch.save(least.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("class"), "least"))
    of_class = scratch.save(classed.groupBy("class").agg(F.min("least").alias("component_id")))
    named = scratch.save(classed.select("node", "class").join(of_class, "class"))
    linked = docs_.where("node is not null").join(named, "node").select("doc_id", "n_shingles", "component_id", "class")
    alone = docs_.where("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast("binary").alias("class"))
    return linked.unionByName(alone)


#: A-Z in lower case only, as the operator has it; pairs of documents that share a shingle, then what they reach.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS t
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(t) = 0 THEN [] WHEN len(t) < 5 THEN [array_to_string(t, ' ')]
    ELSE list_transform(range(1, len(t) - 3), lambda i: array_to_string(t[i:i + 4], ' ')) END) AS sh
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
pair AS (SELECT u, v FROM common JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT reach.u, pair.v FROM reach JOIN pair ON reach.v = pair.u),
least AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id FROM documents LEFT JOIN n USING (doc_id) JOIN least ON least.u = documents.doc_id
"""


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return jaccard_join(docs.select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")
