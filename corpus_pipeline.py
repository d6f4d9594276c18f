"""A training corpus from raw documents: five stages, each over all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. `run`
writes each stage's result to the shared folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language, mixing, ngram_join, packing, toxicity
from tidemark.session import Scratch, importable, scratch_scope

#: Rows of a side that may be broadcast: 53 characters each, so some 30 MB.
BROADCAST_ROWS = 250_000


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go. All labels are learned from, up to the operator's bound."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = toxicity.toxic(docs, toxicity.fit(docs, labels, F.lit(True)))
    return scored.where("predicted = 0").select("row.*")


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is of no known language go, by the text and the languages of other documents of the source."""
    identified = language.identify_by_source(docs, language.fit(docs))
    return identified.where(language.accepted(identified)).select("row.*")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one of the smallest doc_id stays; texts without words are no group.

    Rows are known by doc_id and a hash of the text. What goes is usually little, and then sent to every task; beyond
    BROADCAST_ROWS both sides are shuffled. Of rows that are the same in doc_id and text one stays. Columns pass through
    whatever their names: the rows' key takes a name that none of them has.
    """
    importable(spark)
    key = "key"
    while key in (c.lower() for c in docs.columns):
        key += "_"
    own = F.concat(F.coalesce(F.lpad(F.col("doc_id").cast("string"), 20, "0"), F.lit("~")), F.lit("|"), F.md5(F.coalesce("text", F.lit(""))))
    joined = ngram_join.jaccard_join(docs.select(own.alias("doc_id"), "text"))
    joined = Scratch(spark, "pipeline").save(joined.select(F.col("doc_id").alias(key), "component_id", "class"))
    linked = joined.where("class is not null")
    gone = linked.where(F.col(key) != F.col("component_id")).select(key).distinct()
    again = linked.where(F.col(key) == F.col("component_id")).groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key)

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df

    keyed = docs.withColumn(key, own)
    repeated = small(again)
    once = keyed.join(small(gone.unionByName(again)), key, "left_anti")
    return once.unionByName(keyed.join(repeated, key, "left_semi").dropDuplicates([key])).select(*[f"`{c}`" for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in proportion to their weights: documents go, are cut or come twice as the quotas say."""
    return mixing.mixed_rows(mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and their place in it."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("language", keep_known_languages),
    ("ngram_join", keep_one_of_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Learned models and a tokenizer have no SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(importable(spark), "stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        with scratch_scope():
            before, docs = docs, scratch.save(stage(spark, docs, sf_dir))
        if hasattr(before, "_scratch_path"):
            scratch.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
