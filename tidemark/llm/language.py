"""Language identification by Bayesian evidence fusion.

Text: letters are scored by a trigram model for each language, learned from labelled documents, and by a model of no
language (`und`), in which all letters are alike. A word's likelihoods depend on the word alone, so workers keep them.
The sum is raised to TEMPER, as neighbouring letters are not independent.

Pages bring more evidence: the language that the markup declares, by how often pages of each text language declare it;
and a prior by address, smoothed down a hierarchy: a host's share of each language is drawn towards its domain's, that
towards its address suffix's, that towards all pages'. Shares are sums of text posteriors by grouped aggregation; a
page's own share is taken out of them first, so that its text does not count twice. Documents have a source instead of an
address, whose shares are drawn towards all documents' (`identify_by_source`).

Labelled documents are a bounded sample (SAMPLE, those of the smallest id hash); all else covers every row, whole texts.

Cases: null and empty texts, and texts without letters, have no text evidence: `und`, unless markup declares a language
or, for pages, the address tells; null url or html is empty; repeated rows are rows of their own; without labelled
documents everything is `und`; empty tables give empty results. Rows pass through in the struct `row`, so that no name
can clash. Of languages with equal evidence the first by name wins, no language last.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.workers import kept, tidy
from tidemark.session import Scratch, importable

NONE = "und"
SAMPLE = 8_000
TEMPER = 0.25
#: Letters that are alike without a language.
ALIKE = 64
ADD = 0.05
#: Weight of the level above, in pages.
PRIOR = 5.0
LEAST_CONFIDENCE = 0.3
KEPT_WORDS = 250_000
_WORD = re.compile(r"[^\W\d_]+")
_HIDDEN = re.compile(r"(?is)<!--.*?-->|<(script|style|nav|footer|noscript)\b.*?</\1\s*>|<[^>]*>")
_DECLARED = re.compile(r"(?is)<html\b[^>]*?\b(?:xml:)?lang\s*=\s*[\"']?\s*([a-z]{2,3})\b|<meta\b[^>]*content-language[^>]*content\s*=\s*[\"']?\s*([a-z]{2,3})\b")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    for batch in batches:
        # A word's trigrams are counted once for a batch, however many documents hold it.
        words: dict[str, Counter] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            words.setdefault(lang, Counter()).update(_WORD.findall((text or "").lower()))
        for lang, own in words.items():
            for word, n in own.items():
                padded = f" {word} "
                for i in range(len(padded) - 1):
                    seen[lang, padded[max(0, i - 1) : i + 2]] += n
    keys = list(seen)
    yield pa.RecordBatch.from_pydict({"lang": pa.array([k[0] for k in keys], pa.string()), "gram": pa.array([k[1] for k in keys], pa.string()), "n": pa.array([seen[k] for k in keys], pa.int64())})


def fit(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> dict:
    """Counts of letter trigrams by language. Bounded by the sample."""
    importable(docs.sparkSession)
    ids = docs.where(F.col(lang).isNotNull() & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("key")).distinct()
    chosen = ids.orderBy(F.xxhash64("key"), "key").limit(sample)
    own = docs.where(F.col(lang).isNotNull()).select(F.col(doc_id).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    # At most `sample` ids, by the limit above.
    own = own.join(F.broadcast(chosen), "key").select("lang", "text")
    grams = own.mapInArrow(_count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(grams["lang"].unique())
    return {"langs": [*langs, NONE], "grams": [dict(zip(own["gram"], own["n"], strict=True)) for _, own in sorted(grams.groupby("lang"), key=lambda x: x[0])]}


class Likelihoods:
    """Logarithms of a text's likelihoods, in the order of the model's languages."""

    def __init__(self, model: dict):
        kept("nothing", dict)
        grams, width = model["grams"], len(model["langs"])
        every = sorted({g for own in grams for g in own})
        before = sorted({g[:-1] for g in every})
        # A row for each trigram, for each two letters before one that did not follow them, and for any other.
        self.row = {g: n for n, g in enumerate(every)}
        self.after = {b: n + len(every) for n, b in enumerate(before)}
        self.other = len(every) + len(before)
        self.table = np.full((self.other + 1, width), -math.log(ALIKE))
        for k, own in enumerate(grams):
            total: Counter = Counter()
            for g, n in own.items():
                total[g[:-1]] += n
            for g in every:
                self.table[self.row[g], k] = math.log((own.get(g, 0) + ADD) / (total[g[:-1]] + ADD * ALIKE))
            for b in before:
                self.table[self.after[b], k] = math.log(ADD / (total[b] + ADD * ALIKE))
        self.known: dict[str, int] = {}
        self.rows: list[np.ndarray] = []

    def _word(self, word: str) -> np.ndarray:
        padded, row = f" {word} ", self.row
        grams = [padded[max(0, i - 1) : i + 2] for i in range(len(padded) - 1)]
        at = [row[g] if g in row else self.after.get(g[:-1], self.other) for g in grams]
        return self.table[at].sum(axis=0)

    def text(self, text: str) -> np.ndarray | None:
        """None if there is no letter."""
        own = _WORD.findall(text.lower())
        if not own:
            return None
        if len(self.known) > KEPT_WORDS:
            self.known, self.rows = {}, []
        for w in set(own).difference(self.known):
            self.known[w] = len(self.rows)
            self.rows.append(self._word(w))
        at = np.fromiter(map(self.known.__getitem__, own), dtype=np.int64, count=len(own))
        which, n = np.unique(at, return_counts=True)
        return n @ np.array([self.rows[i] for i in which])


def _posterior(log: np.ndarray | None, width: int) -> list[float]:
    """From text alone; without letters, all of it on no language."""
    if log is None:
        return [0.0] * (width - 1) + [1.0]
    p = np.exp(TEMPER * (log - log.max()))
    return (p / p.sum()).tolist()


def identify(docs: DataFrame, model: dict, *, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """By text alone. Returns row (struct of the columns in keep, all by default), lang, confidence."""
    spark: SparkSession = importable(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    @tidy
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer, langs = Likelihoods(shared.value), shared.value["langs"]
        for batch in batches:
            found = [_posterior(scorer.text(t or ""), len(langs)) for t in batch]
            best = [int(np.argmax(p)) for p in found]
            yield pd.DataFrame({"lang": [langs[k] for k in best], "confidence": [p[k] for p, k in zip(found, best, strict=True)]})

    udf = F.pandas_udf(run, "struct<lang: string, confidence: double>")
    row = F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("row")
    out = docs.select(row, F.col(f"`{text}`").alias("text")).withColumn("found", udf("text"))
    return out.select("row", "found.lang", "found.confidence")


def _sums(column: str, langs: list[str]) -> Column:
    return F.array(*[F.coalesce(F.sum(F.element_at(column, k + 1)), F.lit(0.0)) for k in range(len(langs))])


def _numbers(xs) -> Column:
    return F.array(*[F.lit(float(x)) for x in xs])


def _smoothed(total: str, own: str, above: Column) -> Column:
    """A group's shares without a row's own, drawn towards those of the level above by PRIOR rows."""
    rest = F.zip_with(total, own, lambda s, t: F.greatest(F.lit(0.0), s - t))
    n = F.aggregate(rest, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(rest, above, lambda r, p: (r + F.lit(PRIOR) * p) / (n + PRIOR))


def identify_by_source(docs: DataFrame, model: dict, *, source: str = "source", text: str = "text") -> DataFrame:
    """By text and by what other documents of the same source are written in. Returns row (all columns), lang, confidence.

    A text without letters is of no language, whatever its source. A null source is one of its own.
    """
    spark = importable(docs.sparkSession)
    langs = model["langs"]
    shared = spark.sparkContext.broadcast(model)

    @tidy
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Likelihoods(shared.value)
        for batch in batches:
            yield pd.Series([_posterior(scorer.text(t or ""), len(langs)) for t in batch])

    udf = F.pandas_udf(read, "array<double>")
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("")).alias("group"), F.col(f"`{text}`").alias("text"))
    own = Scratch(spark, "language").save(own.select("row", "group", udf("text").alias("text")))
    world = own.agg(_sums("text", langs).alias("w")).first().w
    base = _numbers((w + 1) / (sum(world) + len(langs)) for w in world)
    of_source = Scratch(spark, "language").save(own.groupBy("group").agg(_sums("text", langs).alias("of_source")))
    own = own.join(of_source, "group").withColumn("prior", _smoothed("of_source", "text", base))
    none = F.element_at("text", len(langs)) >= 1.0
    evidence = F.zip_with("prior", F.transform("text", lambda t: F.greatest(F.lit(1e-12), t)), lambda p, t: p * t)
    own = own.withColumn("evidence", F.when(none, F.col("text")).otherwise(evidence)).withColumn("most", F.array_max("evidence"))
    lang = F.element_at(F.array(*map(F.lit, langs)), F.array_position("evidence", F.col("most")).cast("int"))
    return own.select("row", lang.alias("lang"), (F.col("most") / F.aggregate("evidence", F.lit(0.0), lambda a, x: a + x)).alias("confidence"))


def accepted(identified: DataFrame, least_confidence: float = LEAST_CONFIDENCE) -> Column:
    """Whether a row's language is known well enough."""
    return (identified["lang"] != NONE) & (identified["confidence"] >= least_confidence)


def address(url: str | None) -> tuple[str, str, str]:
    """Host, domain (its last two labels) and suffix (the last)."""
    try:
        host = (urlsplit(url or "").hostname or "").rstrip(".")
    except ValueError:
        host = ""
    labels = host.split(".")
    return host, ".".join(labels[-2:]), labels[-1]


def visible(page: str) -> str:
    return html.unescape(_HIDDEN.sub(" ", page))


def declared(page: str) -> str | None:
    m = _DECLARED.search(page)
    return (m[1] or m[2]).lower() if m else None


def identify_pages(pages: DataFrame, model: dict, *, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Returns page_id, host, declared, text_lang, lang, confidence."""
    spark = importable(pages.sparkSession)
    langs = model["langs"]
    shared = spark.sparkContext.broadcast(model)
    id_type = dict(pages.dtypes)[page_id]

    @tidy
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Likelihoods(shared.value)
        for batch in batches:
            at = [address(u) for u in batch.column(1).to_pylist()]
            pages_ = [p or "" for p in batch.column(2).to_pylist()]
            texts = [_posterior(scorer.text(visible(p)), len(langs)) for p in pages_]
            yield pa.RecordBatch.from_pydict({
                "page_id": batch.column(0), "host": pa.array([a[0] for a in at], pa.string()), "domain": pa.array([a[1] for a in at], pa.string()), "suffix": pa.array([a[2] for a in at], pa.string()),
                "declared": pa.array([declared(p) for p in pages_], pa.string()), "text": pa.array(texts, pa.list_(pa.float64())),
            })

    own = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"))
    own = own.mapInArrow(read, f"page_id {id_type}, host string, domain string, suffix string, declared string, text array<double>")
    own = Scratch(spark, "language").save(own)
    shares = lambda by, name: own.groupBy(*by).agg(_sums("text", langs).alias(name))
    said = F.when(F.col("declared").isin(langs), F.col("declared"))
    own = own.withColumn("said", F.coalesce(said, F.lit("")))
    world = own.agg(_sums("text", langs).alias("w")).first().w
    total = sum(world)
    # A row for each declared language: at most as many as the model has, and one. Nothing declared tells nothing.
    declaring = shares(["said"], "by_said")
    kinds = declaring.where("said <> ''").count()
    names = F.array(*map(F.lit, langs))
    agree = F.transform("by_said", lambda x, k: (x + F.when(F.get(names, k) == F.col("said"), 4.0).otherwise(0.5)) / (F.get(_numbers(world), k) + 4.0 + 0.5 * kinds))
    declaring = declaring.select("said", F.when(F.col("said") == "", _numbers([1.0] * len(langs))).otherwise(agree).alias("markup"))
    own = own.join(F.broadcast(declaring), "said")
    for by, name in ((["suffix"], "of_suffix"), (["suffix", "domain"], "of_domain"), (["host"], "of_host")):
        own = own.join(shares(by, name), by, "left")
    prior = _numbers((w + 1) / (total + len(langs)) for w in world)
    times = lambda a, b: F.zip_with(a, b, lambda x, y: x * y)
    sums = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    for name in ("of_suffix", "of_domain", "of_host"):
        own = own.withColumn("prior", _smoothed(name, "text", prior))
        prior = F.col("prior")
    # A page without letters says nothing by its text: what else is known decides.
    no_text = F.element_at("text", len(langs)) >= 1.0
    by_text = F.when(no_text, _numbers([1.0] * len(langs))).otherwise(F.transform("text", lambda t: F.greatest(F.lit(1e-12), t)))
    own = own.withColumn("evidence", times(times(prior, F.col("markup")), by_text)).withColumn("most", F.array_max("evidence"))
    name = lambda column, most: F.element_at(names, F.array_position(column, most).cast("int"))
    return own.select("page_id", "host", "declared", name(F.col("text"), F.array_max("text")).alias("text_lang"), name(F.col("evidence"), F.col("most")).alias("lang"), (F.col("most") / sums("evidence")).alias("confidence"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fit(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang"))
    return identify_pages(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), model)
