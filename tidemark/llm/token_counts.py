"""Token counts from an exact histogram of encoded lengths.

Each document's length (ids of its whole text, and one end id) is counted where the text is read; only (length, count)
pairs are shuffled. Sums over the longer lengths then answer every question about a context limit L at once: how many
documents are longer, how many tokens there are in all and after cutting each document at L, and which part of the
documents fits. Suffix sums go in two steps, within runs of SPAN lengths and over the runs, so no task orders all lengths.

Cases: null text is an empty text; an empty text has length 1; a control string of the tokenizer in a text is one id, as
the tokenizer itself has it; repeated rows count each; an empty table gives an empty
histogram, and answers of 0 or null. Only the text column is read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.tokens import WordEncoder, default_path
from tidemark.session import Scratch, importable

#: Lengths whose suffix sums are one task's.
SPAN = 4096


def lengths(docs: DataFrame, *, path: str | None = None, text: str = "text") -> DataFrame:
    """Returns length, documents: the histogram, written once, since its answers read it several times."""
    path = path or default_path("word_bpe_49k.json")
    importable(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = WordEncoder.get(path), Counter()
        for batch in batches:
            seen.update(len(encoder.encode(t)) // 4 + 1 for t in batch.column(0).to_pylist())
        yield pa.RecordBatch.from_pydict({"length": pa.array(seen.keys(), pa.int64()), "documents": pa.array(seen.values(), pa.int64())})

    counted = docs.select(F.col(text).alias("text")).mapInArrow(count, "length long, documents long")
    return Scratch(docs.sparkSession, "lengths").save(counted.groupBy("length").agg(F.sum("documents").alias("documents")))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """A row for each length L that occurs, with answers for the context limit L.

    documents: of this length; longer_documents, longer_tokens: of documents over it; total_tokens; kept_tokens: after
    cutting each document at L; fitting: the part of all documents of length L or less.
    """
    own = histogram.withColumn("span", F.floor(F.col("length") / SPAN))
    spans = own.groupBy("span").agg(F.sum("documents").alias("d"), F.sum(F.col("documents") * F.col("length")).alias("t"))
    after = Window.orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    spans = spans.select(
        "span",
        F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d_after"),
        F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t_after"),
        F.sum("d").over(every).alias("all_documents"),
        F.sum("t").over(every).alias("total_tokens"),
    )
    within = Window.partitionBy("span").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    own = own.join(spans, "span").select(
        "length",
        "documents",
        (F.col("d_after") + F.coalesce(F.sum("documents").over(within), F.lit(0))).alias("longer_documents"),
        (F.col("t_after") + F.coalesce(F.sum(F.col("documents") * F.col("length")).over(within), F.lit(0))).alias("longer_tokens"),
        "all_documents",
        "total_tokens",
    )
    kept = F.col("total_tokens") - F.col("longer_tokens") + F.col("longer_documents") * F.col("length")
    fitting = (F.col("all_documents") - F.col("longer_documents")) / F.col("all_documents")
    return own.select("length", "documents", "longer_documents", "longer_tokens", "total_tokens", kept.alias("kept_tokens"), fitting.alias("fitting"))


def answer(sums: DataFrame, limits: list[int], quantiles: list[float]) -> DataFrame:
    """A row for each limit (any number, not only lengths that occur) and quantile, as kind, at and value.

    A quantile is the least length that this part of the documents doesn't exceed.
    """
    one = []
    for limit in limits:
        # Documents over the limit are those after the longest length that fits; all, if none fits.
        fits = F.when(F.col("length") <= limit, F.col("length"))
        n, total = F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.max("total_tokens"), F.lit(0))
        longer = F.coalesce(F.max_by("longer_documents", fits), n)
        kept = total - F.coalesce(F.max_by("longer_tokens", fits), total) + longer * limit
        one.append(sums.agg(kept.cast("double").alias("value")).select(F.lit("kept_tokens").alias("kind"), F.lit(float(limit)).alias("at"), "value"))
    one += [sums.where(F.col("fitting") >= q).agg(F.min("length").cast("double").alias("value")).select(F.lit("quantile").alias("kind"), F.lit(float(q)).alias("at"), "value") for q in quantiles]
    out = one[0]
    for df in one[1:]:
        out = out.unionByName(df)
    return out


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_sums(lengths(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")))
