"""Toxic passages as maximum-scoring segments of token log-odds.

Token scores: of labelled documents, each word and its beginnings of three to eight letters are counted once per
document and label. A word's rate of label 1 is its counts under a Dirichlet prior, whose mean is the rate of its longest
beginning, whose prior mean is that of the next shorter one, and so on to the rate over all words. The score is the
log-odds of the word's rate against that of all words, less DRIFT, so that ordinary text falls.

Passages: a linear scan finds all maximal scoring segments of a text. Their scores follow an extreme-value law in clean
text: segments of a score of x or more are about K n exp(-lambda x) in n tokens. lambda and K are fitted to the upper half
of the segments of clean labelled documents whose words were not counted. A document's evidence is the least
probability, over its r best segments, of so many that good by chance; a logistic curve, fitted on the same documents and
toxic ones like them, turns it into a score between 0 and 1.

Labels come from a bounded sample: SAMPLE labelled documents at most, those of the smallest id hash. Everything else
covers every row and whole texts.

Cases: null text is empty, and an empty text has the score of no evidence; null labels and labels of no document are
left out; a doc_id labelled more than once counts as toxic if any label says so; null doc_id has no label but a score;
repeated rows are scored each. Without labels of both kinds every score is 0. Empty tables give an empty result. Other
columns are not read; in toxic() the rows pass through in the struct `row`, so no name can clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.words import tables, words
from tidemark.llm.workers import kept, tidy
from tidemark.session import importable

#: Labelled documents that are learned from, at most.
SAMPLE = 24_000
#: Of these, one in so many calibrates; the words of the others are counted.
CALIBRATION = 3
#: A feature counts if so many labelled documents hold it.
LEAST_DOCUMENTS = 3
#: Weight of the prior, in documents.
PRIOR = 2.0
DRIFT = 3.0
LOW, HIGH = -2.0, 9.0
THRESHOLD = 0.7
KEPT_WORDS = 600_000
_EDGES = b".,;:!?*&%$#|\"'()[]<>-_/"


def features(word: bytes) -> list[str]:
    """Beginnings from the shortest on, and the word itself, which = tells from a beginning."""
    letters = word.decode("utf-8", "replace")
    return [*(letters[:n] for n in range(3, 9) if len(letters) > n), "=" + letters]


def rates(counts: dict[str, tuple[int, int]], base: float) -> dict[str, float]:
    """Of each counted feature, given as (toxic, clean), the rate of label 1; the next broader counted one is its prior."""
    out: dict[str, float] = {}
    for key in sorted(counts, key=lambda k: (k[:1] == "=", len(k))):
        broader = features(key[1:].encode())[:-1] if key[:1] == "=" else [key[:n] for n in range(3, len(key))]
        prior = next((out[k] for k in reversed(broader) if k in out), base)
        toxic, clean = counts[key]
        out[key] = min(1 - 1e-9, max(1e-9, (toxic + PRIOR * prior) / (toxic + clean + PRIOR)))
    return out


class Scorer:
    """Token scores and segments, from counted features."""

    def __init__(self, model: dict):
        self.model = model
        self.known: dict[bytes, float] = {}

    def word(self, word: bytes) -> float:
        """By the narrowest feature that was counted."""
        letters = (word.strip(_EDGES) or word).decode("utf-8", "replace")
        score = self.model["score"]
        s = score.get("=" + letters)
        n = min(8, len(letters) - 1)
        while s is None and n >= 3:
            s = score.get(letters[:n])
            n -= 1
        return -DRIFT if s is None else s

    def tokens(self, own: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > KEPT_WORDS:
            known.clear()
        for w in set(own).difference(known):
            known[w] = self.word(w)
        return np.fromiter(map(known.__getitem__, own), dtype=np.float64, count=len(own))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score): linear, and only tokens over 0 are stepped through."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    out: list[list] = []  # start, end, total before, total after, the nearest segment before that starts lower
    for i in np.flatnonzero(scores > 0).tolist():
        start, low, high = i, float(total[i]), float(total[i + 1])
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= low:
                j = out[j][4]
            if j < 0 or out[j][3] >= high:
                break
            start, low = out[j][0], out[j][2]
            del out[j:]
        out.append([start, i + 1, low, high, j])
    return [(a, b, high - low) for a, b, low, high, _ in out]


def log_tail(r: int, mean: float) -> float:
    """Logarithm of the probability of r or more by a Poisson law."""
    if mean <= 0:
        return -math.inf
    if mean > r + 30:
        return 0.0
    term = total = 1.0
    k = r
    while term > 1e-12 * total and k < r + 500:
        k += 1
        term *= mean / k
        total += term
    return min(0.0, r * math.log(mean) - mean - math.lgamma(r + 1) + math.log(total))


def evidence(found: list[float], n: int, lam: float, k: float) -> float:
    """-log10 of the least probability of as many segments of these scores in n clean tokens."""
    least = 0.0
    for r, x in enumerate(sorted(found, reverse=True), 1):
        least = min(least, log_tail(r, k * n * math.exp(-lam * x)))
        if -least >= 300 * math.log(10):  # the cap
            break
    return min(300.0, -least / math.log(10))


def _sample(docs: DataFrame, labels: DataFrame, training, doc_id: str, text: str, label: str, sample: int) -> DataFrame:
    own = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & training).groupBy(doc_id).agg(F.max(label).alias("toxic"))
    place = F.xxhash64(doc_id)
    chosen = own.orderBy(place, doc_id).limit(sample).select(F.col(doc_id).alias("key"), (F.col("toxic") > 0).alias("toxic"), (F.pmod(place, F.lit(CALIBRATION)) == 0).alias("calibrates"))
    # At most `sample` rows of three small columns, by the limit above.
    texts = docs.select(F.col(doc_id).alias("key"), F.col(text).alias("text"))
    return texts.join(F.broadcast(chosen), "key").select("toxic", "calibrates", "text")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = (Counter(), Counter())
    total = [0, 0]
    for batch in batches:
        for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist(), strict=True):
            own = {w.strip(_EDGES) or w for w in set(words(text))}
            total[toxic] += len(own)
            seen[toxic].update({k for w in own for k in features(w)})
    keys = list(seen[0].keys() | seen[1].keys())
    columns = {"feature": ["", *keys], "clean": [total[0], *(seen[0][k] for k in keys)], "toxic": [total[1], *(seen[1][k] for k in keys)]}
    yield pa.RecordBatch.from_pydict(columns, schema=pa.schema([("feature", pa.string()), ("clean", pa.int64()), ("toxic", pa.int64())]))


def _measure(model: dict):
    schema = pa.schema([("toxic", pa.bool_()), ("n", pa.int64()), ("scores", pa.list_(pa.float64()))])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)

        def measured() -> Iterator[dict]:
            for batch in batches:
                for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    s = scorer.tokens(words(text))
                    yield {"toxic": toxic, "n": len(s), "scores": [x for _, _, x in segments(s)]}

        yield from tables(measured(), schema)

    return run


def extreme_law(scores: np.ndarray, n: int) -> tuple[float, float]:
    """(lambda, K) from the segments' scores in n clean tokens; scores over the median exceed it exponentially."""
    if not len(scores) or not n:
        return 1.0, 1e-4
    cut = float(np.median(scores))
    over = scores[scores >= cut] - cut
    lam = 1 / max(float(over.mean()), 0.1)
    return lam, len(over) / n * math.exp(lam * cut)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope, by Newton steps with a small ridge."""
    X = np.c_[np.ones(len(x)), x]
    beta = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(X @ beta, -30, 30)))
        w = p * (1 - p) + 1e-9
        beta = beta + np.linalg.solve(X.T * w @ X + 1e-3 * np.eye(2), X.T @ (y - p) - 1e-3 * beta)
    return float(beta[0]), float(max(beta[1], 0.0))


def fit(docs: DataFrame, labels: DataFrame, training, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> dict | None:
    """training: a boolean column of labels. None if the sample lacks a label."""
    importable(docs.sparkSession)
    own = _sample(docs, labels, training, doc_id, text, label, sample)
    parts = own.where("not calibrates").mapInArrow(_count, "feature string, clean long, toxic long")
    counted = parts.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # Bounded by the sample: its documents' features, without those that few of them hold. The empty one has the totals.
    table: pd.DataFrame = counted.where((F.col("feature") == "") | (F.col("clean") + F.col("toxic") >= LEAST_DOCUMENTS)).toPandas()
    counts = {f: (t, c) for f, c, t in zip(table["feature"], table["clean"].tolist(), table["toxic"].tolist(), strict=True)}
    toxic, clean = counts.pop("", (0, 0))
    if not toxic or not clean:
        return None
    odds = math.log(toxic / clean)
    score = {f: min(HIGH, max(LOW, math.log(r / (1 - r)) - odds)) - DRIFT for f, r in rates(counts, toxic / (toxic + clean)).items()}
    model = {"score": score}
    seen = own.where("calibrates").mapInArrow(_measure(model), "toxic boolean, n long, scores array<double>").toPandas()
    clean = seen[~seen["toxic"]]
    if not len(clean) or len(clean) == len(seen):
        return None
    lam, k = extreme_law(np.concatenate([np.asarray(s, dtype=np.float64) for s in clean["scores"]]), int(clean["n"].sum()))
    x = np.array([evidence(list(s), m, lam, k) for s, m in zip(seen["scores"], seen["n"], strict=True)])
    model |= {"lambda": lam, "k": k}
    model["intercept"], model["slope"] = _logistic(np.log1p(x), seen["toxic"].to_numpy().astype(float))
    return model


def toxic(docs: DataFrame, model: dict | None, *, keep: list[str] | None = None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Returns row (struct of the columns in keep, all by default), score, predicted, passages.

    passages: start and end word, score and expected number by chance, of each segment that less than one is expected of.
    """
    spark: SparkSession = importable(docs.sparkSession)
    row = F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("row")
    read = docs.select(row, F.col(f"`{text}`").alias("text"))
    out_type = "struct<score: double, passages: array<struct<start: int, end: int, score: double, expected: double>>>"
    if model is None:
        return read.select("row", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.from_json(F.lit("{}"), out_type)["passages"].alias("passages"))
    shared = spark.sparkContext.broadcast(model)

    @tidy
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        kept("nothing", dict)
        scorer = Scorer(shared.value)
        m = shared.value
        for batch in batches:
            scores, passages = [], []
            for t in batch:
                s = scorer.tokens(words(t))
                found = segments(s)
                x = evidence([v for _, _, v in found], len(s), m["lambda"], m["k"])
                scores.append(1 / (1 + math.exp(-max(-700.0, min(700.0, m["intercept"] + m["slope"] * math.log1p(x))))))
                expected = [m["k"] * len(s) * math.exp(-m["lambda"] * v) for _, _, v in found]
                passages.append([{"start": a, "end": b, "score": v, "expected": e} for (a, b, v), e in zip(found, expected, strict=True) if e < 1])
            yield pd.DataFrame({"score": scores, "passages": passages})

    udf = F.pandas_udf(run, out_type)
    out = read.withColumn("found", udf("text"))
    return out.select("row", "found.score", (F.col("found.score") >= threshold).cast("int").alias("predicted"), "found.passages")


def _held_out(doc_id: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 3 == 1


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = fit(docs, labels, ~_held_out())
    out = toxic(docs, model, keep=["doc_id"])
    return out.select(F.col("row.doc_id").alias("doc_id"), _held_out("row.doc_id").alias("held_out"), "score", "predicted")
