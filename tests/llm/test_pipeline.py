"""The corpus pipeline, stage by stage against brute force, and on odd rows."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_learned_and_joins import brute, check_packing
from tidemark.llm import language, mixing, toxicity
from tidemark.llm.words import words

SF = "/root/testdata/sf0.01"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage was given and what it returned, written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out[name] = docs, after
        docs = after
    return out


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "ngram_join", "mixing", "packing"]


def test_toxic_documents_go(spark, stages):
    before, after = stages["toxicity"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = toxicity.toxic(before, toxicity.fit(before, labels, F.lit(True)))
    assert rows(after) == rows(scored.where("predicted = 0").select("row.*")) and after.columns == before.columns
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()}
    assert len(gone) > 20 and all(truth.get(d, 1) for d in gone)


def test_languages(spark, stages):
    before, after = stages["language"]
    identified = language.identify_by_source(before, language.fit(before))
    assert rows(after) == rows(identified.where(language.accepted(identified)).select("row.*"))
    assert after.count() >= 0.99 * before.count()


def test_one_of_each_group_stays(stages):
    before, after = stages["ngram_join"]
    own = [(r.doc_id, r.text) for r in before.collect()]
    keep = Counter(d for d, n, least in brute(own) if d == least or not n)
    assert Counter(r.doc_id for r in after.collect()) == keep and after.columns == before.columns
    assert rows(after) - rows(before) == Counter()


def test_mixture_holds_what_quotas_say(stages):
    before, after = stages["mixing"]
    taken = mixing.mix(before).select(F.col("row.doc_id").alias("doc_id"), "taken", "target", F.col("row.source").alias("source")).collect()
    words_of = Counter()
    for r in after.collect():
        words_of[r.doc_id] += len(words(r.text))
    assert words_of == Counter({r.doc_id: r.taken for r in taken if r.taken})
    by_source, target = Counter(), {}
    for r in taken:
        by_source[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(by_source[s] - target[s]) <= 0.02 * target[s] + 64 for s in target)


def test_packed(stages):
    before, after = stages["packing"]
    check_packing([(r.doc_id, r.text) for r in before.collect()], after.collect(), 2048)


def test_run_is_the_stages(spark, stages):
    _, last = stages["packing"]
    out = corpus_pipeline.run(spark, SF)
    pick = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows(out.select(pick)) == rows(last.select(pick))


def test_odd_rows_pass_through(spark):
    docs = spark.createDataFrame(
        [
            (1, "a b c d e f", "en", "x", 11), (1, "a b c d e f", "en", "x", 11), (2, "a b c d e f", None, None, None), (None, "a b c d e f", "en", "x", 11), (None, None, None, None, None), (5, "", "en", "y", 0),
            (6, "the and that with from " * 4000, "en", "hot", 1), (7, "the and that with this " * 4000, "en", "hot", 1), (8, "1 2 3", "en", "y", 5),
        ],
        COLUMNS,
    ).withColumn("key", F.lit("clash")).withColumn("size", F.lit(2))
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns, name
        out.collect()
        none = stage(spark, empty, "/root/testdata/sf0.001")
        assert none.columns == docs.columns and none.collect() == [], name
    kept = corpus_pipeline.keep_one_of_near_copies(spark, docs, "").collect()
    assert sorted((str(r.doc_id), (r.text or "")[:5]) for r in kept) == [("1", "a b c"), ("5", ""), ("6", "the a"), ("7", "the a"), ("8", "1 2 3"), ("None", "")]
    assert {(r.key, r.size) for r in kept} == {("clash", 2)}
    assert corpus_pipeline.pack_sequences(spark, empty, "").collect() == []
    assert len(corpus_pipeline.pack_sequences(spark, docs, "").collect()) >= docs.count()
