r"""Mixing sources to target weights by Sainte-Lague apportionment, with DataFrame operations only.

A document's size is its number of words, runs of characters outside [\x20\x09-\x0D]. Sources, ordered by code point
with null last, take the weights in turn and share `share` times all words; a target stops at `max_repeat` times its
source's size, and what is over goes to the others by weight until none is above (a water level, found in closed form).

Targets become integer quotas of equal blocks of `block_words` words, by highest quotients: first for the sources, then
within a source for its shards. A shard is a slice of the seeded document hash; a source has shards in proportion to
its size, so a hot source is spread over many, and there are more of them the larger the input is. Sources, of which there
may be as many as hosts, are ordered in ranges, a task each; only sums of ranges are lined up in one. Within a shard, documents stand in seeded order and are cut into blocks
along that line; the quota takes whole passes over the shard and then its first blocks. So at most one document of a
shard is taken in part, and no document more than `max_repeat` times.

Cases: null text has size 0; a null source is a source of its own, last in order; null and repeated doc_id are
ordinary rows (order is by a hash of id and text, so only identical rows can change places); an empty table gives an
empty result; sources without words have target 0. Other columns pass through inside the struct `row`, so their names
can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import Scratch

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_REPEAT = 2
#: Words in a block. Quotas are whole blocks, so a source misses its target by some blocks at most.
BLOCK_WORDS = 32
#: Shards of the whole corpus, or one for so many bytes of text if those are more; a source has its part of them, one at least.
SHARDS = 1024
SHARD_BYTES = 8 << 20
#: Blocks that a shard has at least: the last block of a shard may be short, so many small shards would miss the target.
SHARD_BLOCKS = 256
#: Slots of the document hash, from which shards are made: a power of two, this for SHARDS and more for more.
SLOTS = 4096
SEED = "tidemark-mix-1"


def _apportion(units: DataFrame, group: list[str]) -> DataFrame:
    """Sainte-Lague seats within each group, or of all units. units: group..., unit, share (seats as a fraction), house (the group's seats).

    The divisor that makes `share` sum to the house gives nearly all seats by rounding; the few that are then missing
    or too many go by quotients, share / (seats + 1/2): the highest not yet awarded, or the lowest awarded. The divisor at
    which none is missing differs by n / (2 house) at most, n being the units; so a unit gains or loses no more than
    share n / (2 house) + 1, and no more of its quotients need be looked at.
    """
    first = units.withColumn("seats", F.floor(F.col("share") + 0.5).cast("long"))
    if group:
        by_group = Window.partitionBy(*group)
        first = first.withColumn("short", F.col("house") - F.sum("seats").over(by_group)).withColumn("n", F.count("*").over(by_group))
    else:
        seated, n = first.agg(F.coalesce(F.sum("seats"), F.lit(0)), F.count("*")).first()
        first = first.withColumn("short", F.col("house") - F.lit(seated)).withColumn("n", F.lit(n))
    most = F.least(F.abs("short"), F.ceil(F.col("share") * (F.col("n") + 1) / (2 * F.greatest("house", F.lit(1)))) + 2).cast("long")
    steps = F.explode(F.sequence(F.lit(0).cast("long"), most - 1))
    open_ = first.where("short <> 0").select(*group, "unit", "share", "seats", "short", steps.alias("step"))
    quotient = F.when(F.col("short") > 0, F.col("share") / (F.col("seats") + F.col("step") + 0.5)).otherwise(
        -F.col("share") / (F.col("seats") - F.col("step") - 0.5)
    )
    ranked = open_.where("short > 0 or step < seats").withColumn("quotient", quotient)
    order = [F.desc("quotient"), F.asc("unit"), F.asc("step")]
    if group:
        ranked = ranked.withColumn("place", F.row_number().over(by_group.orderBy(*order))).where("place <= abs(short)")
    else:
        short = first.agg(F.coalesce(F.max(F.abs("short")), F.lit(0))).first()[0]
        ranked = ranked.orderBy(*order).limit(short)
    moved = ranked.groupBy(*group, "unit").agg(F.sum(F.signum("short")).cast("long").alias("moved"))
    return first.join(moved, [*group, "unit"], "left").select(
        *group, "unit", (F.col("seats") + F.coalesce("moved", F.lit(0))).alias("seats")
    )


def _before(rows: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Adds sums over all rows before each in the order, which no two rows share.

    Ranges of the order are a task each; their sums, a row each, are lined up in one.
    """
    dealt = Scratch(rows.sparkSession, "mix").save(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    ranges = dealt.groupBy("range").agg(*[F.sum(c).alias(name) for name, c in sums.items()])
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("range", *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"{name}_earlier") for name in sums])
    within = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    here = {name: F.coalesce(F.sum(c).over(within), F.lit(0)) for name, c in sums.items()}
    return dealt.join(ranges, "range").select(*rows.columns, *[(c + F.col(f"{name}_earlier")).alias(name) for name, c in here.items()])


def sized(docs: DataFrame, keep: list[str], doc_id: str, text: str, source: str, slots: int = SLOTS) -> DataFrame:
    """Each document with its size, its source as a key that is never null, its seeded place, and its slot of `slots` along that."""
    place = F.md5(
        F.concat(
            F.lit(f"{SEED}|"),
            F.coalesce(F.col(doc_id).cast("string"), F.lit("")),
            F.lit("|"),
            F.coalesce(F.col(text), F.lit("")),
        )
    )
    return docs.select(
        F.struct(*keep).alias("row"),
        F.col(source).alias("source"),
        F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("null")).alias("source_key"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        place.alias("place"),
    ).withColumn("slot", F.floor(F.conv(F.substring("place", 1, 8), 16, 10).cast("long") / (2**32 // slots)).cast("long"))


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """sources: source, source_key, source_size. Adds target, the words a source is to give."""
    scratch = Scratch(sources.sparkSession, "mix")
    ranked = _before(sources, [F.asc_nulls_last("source")], {"turn": F.lit(1)})
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("turn") % len(weights) + 1).cast("int"))).drop("turn")
    in_order = [(F.col("source_size") / F.col("weight")).asc(), F.asc_nulls_last("source")]
    ranked = scratch.save(_before(ranked, in_order, {"size_before": F.col("source_size"), "weight_before": F.col("weight")}))
    size, weight = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    level = (F.lit(share) * F.lit(size) - max_repeat * F.col("size_before")) / (F.lit(weight) - F.col("weight_before"))
    # For any set of capped sources the level is at least what the rest would need: the largest such need is the level.
    level = F.lit(ranked.agg(F.coalesce(F.max(level), F.lit(0.0))).first()[0])
    full = F.col("source_size") * F.lit(float(max_repeat))
    return ranked.withColumn("full", full <= level * F.col("weight")).select(
        "source_key", "source_size", "full", F.when(F.col("full"), full).otherwise(level * F.col("weight")).alias("target")
    )


def quotas(slots: DataFrame, *, block_words: int, shards: int, n_slots: int = SLOTS, weights, share: float, max_repeat: int) -> DataFrame:
    """slots: source, source_key, slot (of n_slots), size. Returns source_key, shard, shards, source_size, target, blocks, quota."""
    spark = slots.sparkSession
    sources = slots.groupBy("source", "source_key").agg(F.sum("size").alias("source_size"))
    goals = targets(sources, weights, share, max_repeat)
    every = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    in_proportion = F.ceil(F.col("source_size") * shards / F.lit(max(1, every)))
    n_shards = F.greatest(F.lit(1), F.least(F.lit(shards), in_proportion, F.ceil(F.col("source_size") / (SHARD_BLOCKS * block_words))))
    goals = Scratch(spark, "mix").save(goals.withColumn("shards", n_shards.cast("long")))
    part = goals.where("not full").select(F.col("source_key").alias("unit"), (F.col("target") / block_words).alias("share"))
    house = part.agg(F.floor(F.coalesce(F.sum("share"), F.lit(0.0)) + 0.5).cast("long")).first()[0]
    seats = _apportion(part.withColumn("house", F.lit(house)), []).select(F.col("unit").alias("source_key"), F.col("seats").alias("house"))
    cut = (
        slots.join(goals, "source_key")
        .withColumn("shard", F.floor(F.col("slot") * F.col("shards") / n_slots).cast("long"))
        .groupBy("source_key", "shard", "shards", "source_size", "target", "full")
        .agg(F.sum("size").alias("shard_size"))
        .withColumn("blocks", F.ceil(F.col("shard_size") / block_words).cast("long"))
    )
    cut = Scratch(spark, "mix").save(cut.join(seats, "source_key", "left"))
    inner = cut.where("not full and source_size > 0").select(
        "source_key", F.col("shard").alias("unit"), (F.col("house").cast("double") * F.col("shard_size") / F.col("source_size")).alias("share"), "house"
    )
    got = _apportion(inner, ["source_key"]).select("source_key", F.col("unit").alias("shard"), "seats")
    quota = F.when(F.col("full"), F.col("blocks") * max_repeat).otherwise(F.least(F.coalesce("seats", F.lit(0)), F.col("blocks") * max_repeat))
    return cut.join(got, ["source_key", "shard"], "left").select(
        "source_key", "shard", "shards", "source_size", "target", "blocks", quota.cast("long").alias("quota")
    )


def mix(
    docs: DataFrame,
    *,
    keep: list[str] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block_words: int = BLOCK_WORDS,
    shards: int | None = None,
    weights=WEIGHTS,
    share: float = SHARE,
    max_repeat: int = MAX_REPEAT,
) -> DataFrame:
    """Returns row (struct of the columns in keep, all by default), size, source_size, target, taken, passes, part.

    taken = passes * size + part: `passes` whole copies, then the first `part` words of one more. shards: SHARDS, or one for
    each SHARD_BYTES of text if those are more, unless given.
    """
    spark: SparkSession = docs.sparkSession
    if shards is None:
        shards = max(SHARDS, -(-docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0] // SHARD_BYTES))
    n_slots = SLOTS
    while n_slots * SHARDS < SLOTS * shards:
        n_slots *= 2
    own = sized(docs, keep or docs.columns, doc_id, text, source, n_slots)
    slots = Scratch(spark, "mix").save(own.groupBy("source", "source_key", "slot").agg(F.sum("size").alias("size")))
    plan = Scratch(spark, "mix").save(quotas(slots, block_words=block_words, shards=shards, n_slots=n_slots, weights=weights, share=share, max_repeat=max_repeat))
    # Few rows: one for each shard. Whether that is small enough to broadcast, the engine decides from the file's size.
    per_source = plan.select("source_key", "shards").distinct()
    placed = own.join(per_source, "source_key").withColumn("shard", F.floor(F.col("slot") * F.col("shards") / n_slots).cast("long"))
    placed = placed.drop("shards").join(plan, ["source_key", "shard"])
    line = Window.partitionBy("source_key", "shard").orderBy("place", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum("size").over(line)
    placed = placed.withColumn("end", end)
    passes = F.when(F.col("blocks") > 0, F.floor(F.col("quota") / F.greatest(F.lit(1), F.col("blocks")))).otherwise(0).cast("long")
    placed = placed.withColumn("passes", passes).withColumn("rest", (F.col("quota") - F.col("passes") * F.col("blocks")) * block_words)
    part = F.least("end", "rest") - F.least(F.col("end") - F.col("size"), F.col("rest"))
    placed = placed.withColumn("part", part)
    return placed.select(
        "row", "size", "source_size", "target", (F.col("passes") * F.col("size") + F.col("part")).cast("long").alias("taken"), "passes", F.col("part").cast("long").alias("part")
    )


def mixed_rows(mixture: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """The mixture as rows of documents: each whole pass a row, a part its first words; rows with nothing taken go.

    Documents without words have nothing to take and go. `mixture` must hold whole rows (keep=None).
    """
    fields = mixture.schema["row"].dataType.names
    copies = F.concat(
        F.array_repeat(F.lit(-1).cast("long"), F.col("passes").cast("int")),
        F.when(F.col("part") > 0, F.array(F.col("part"))).otherwise(F.array().cast("array<bigint>")),
    )
    words = F.slice(F.regexp_extract_all(F.col(f"row.`{text}`"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)), F.lit(1), F.col("first").cast("int"))
    cut = F.when((F.col("first") < 0) | (F.col("first") >= F.col("size")), F.col(f"row.`{text}`")).otherwise(F.array_join(words, ""))
    rows = mixture.where("size > 0").select("row", "size", F.explode(copies).alias("first"))
    rows = rows.select(*[F.col(f"row.`{c}`").alias(c) if c != text else cut.alias(c) for c in fields])
    if n_chars and n_chars in fields:
        rows = rows.withColumn(n_chars, F.length(text).cast("long"))
    return rows


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = mix(docs, keep=["doc_id"])
    return out.select("row.doc_id", "size", "source_size", "target", "taken")


#: For texts of SHARDS * SHARD_BYTES at most, where the number of shards is SHARDS.
SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS place
  FROM documents),
doc AS (SELECT *, CAST('0x' || substr(place, 1, 3) AS BIGINT) AS slot FROM sized),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM doc GROUP BY source),
weighed AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM src),
needs AS (
  SELECT *, (1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) - 2 * CAST(coalesce(sum(source_size) OVER before, 0) AS DOUBLE))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS need
  FROM weighed
  WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (SELECT *, max(need) OVER () AS level FROM needs),
goals AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size <= level * weight AS is_full, least(2.0::DOUBLE * source_size, level * weight) AS target,
         greatest(1, least({SHARDS}, CAST(ceil(source_size * {SHARDS}::DOUBLE / greatest(1, sum(source_size) OVER ())) AS BIGINT),
                           CAST(ceil(source_size / {SHARD_BLOCKS * BLOCK_WORDS}.0::DOUBLE) AS BIGINT))) AS shards
  FROM levels),
f1 AS (SELECT source, share, CAST(floor(share + 0.5) AS BIGINT) AS seats, CAST(floor(sum(share) OVER () + 0.5) AS BIGINT) AS house
       FROM (SELECT source, target / {BLOCK_WORDS} AS share FROM goals WHERE NOT is_full)),
g1 AS (SELECT *, CAST(house - sum(seats) OVER () AS BIGINT) AS short FROM f1),
q1 AS (SELECT *, CASE WHEN short > 0 THEN share / (seats + step + 0.5::DOUBLE) ELSE -share / (seats - step - 0.5::DOUBLE) END AS quotient
       FROM (SELECT *, unnest(range(abs(short))) AS step FROM g1) WHERE short > 0 OR step < seats),
m1 AS (SELECT source, sum(sign(short)) AS moved FROM
        (SELECT *, row_number() OVER (ORDER BY quotient DESC, coalesce('s' || source, 'null'), step) AS rank_ FROM q1) WHERE rank_ <= abs(short) GROUP BY source),
s1 AS (SELECT g1.source, CAST(seats + coalesce(moved, 0) AS BIGINT) AS house FROM g1 LEFT JOIN m1 ON g1.source IS NOT DISTINCT FROM m1.source),
placed AS (SELECT doc.*, goals.source_size, goals.target, goals.is_full, CAST(floor(slot * shards / {SLOTS}.0::DOUBLE) AS BIGINT) AS shard
           FROM doc JOIN goals ON doc.source IS NOT DISTINCT FROM goals.source),
cut AS (SELECT source, shard, source_size, is_full, CAST(sum(size) AS BIGINT) AS shard_size, CAST(ceil(sum(size) / {BLOCK_WORDS}.0::DOUBLE) AS BIGINT) AS blocks
        FROM placed GROUP BY ALL),
f2 AS (SELECT cut.source, shard, house, CAST(house AS DOUBLE) * shard_size / source_size AS share
       FROM cut JOIN s1 ON cut.source IS NOT DISTINCT FROM s1.source WHERE NOT is_full AND source_size > 0),
g2 AS (SELECT *, CAST(house - sum(seats) OVER (PARTITION BY source) AS BIGINT) AS short
       FROM (SELECT *, CAST(floor(share + 0.5) AS BIGINT) AS seats FROM f2)),
q2 AS (SELECT *, CASE WHEN short > 0 THEN share / (seats + step + 0.5::DOUBLE) ELSE -share / (seats - step - 0.5::DOUBLE) END AS quotient
       FROM (SELECT *, unnest(range(abs(short))) AS step FROM g2) WHERE short > 0 OR step < seats),
m2 AS (SELECT source, shard, sum(sign(short)) AS moved FROM
        (SELECT *, row_number() OVER (PARTITION BY source ORDER BY quotient DESC, shard, step) AS rank_ FROM q2) WHERE rank_ <= abs(short) GROUP BY ALL),
s2 AS (SELECT g2.source, g2.shard, CAST(seats + coalesce(moved, 0) AS BIGINT) AS seats
       FROM g2 LEFT JOIN m2 ON g2.source IS NOT DISTINCT FROM m2.source AND g2.shard = m2.shard),
plan AS (SELECT cut.source, cut.shard, blocks, CASE WHEN is_full THEN 2 * blocks ELSE least(coalesce(seats, 0), 2 * blocks) END AS quota
         FROM cut LEFT JOIN s2 ON cut.source IS NOT DISTINCT FROM s2.source AND cut.shard = s2.shard),
lines AS (
  SELECT p.*, blocks, quota, CASE WHEN blocks > 0 THEN quota // blocks ELSE 0 END AS passes,
         CAST(sum(size) OVER (PARTITION BY p.source, p.shard ORDER BY place, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS end_
  FROM placed p JOIN plan ON p.source IS NOT DISTINCT FROM plan.source AND p.shard = plan.shard)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(passes * size + least(end_, (quota - passes * blocks) * {BLOCK_WORDS}) - least(end_ - size, (quota - passes * blocks) * {BLOCK_WORDS}) AS BIGINT) AS taken
FROM lines
"""
