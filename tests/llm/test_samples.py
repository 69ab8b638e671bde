"""What models learn from: distinct texts, within the stated bounds."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loamlens.llm import langid, toxicity


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return (spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@pytest.fixture
def learned(monkeypatch):
    """What is handed to the two fits."""
    seen = []

    def watch(module):
        fit = module.fit

        def kept(texts, kinds):
            seen.append((list(texts), list(kinds)))
            return fit(texts, kinds)

        monkeypatch.setattr(module, "fit", kept)

    watch(langid)
    watch(toxicity)
    return seen


def _copied(spark, docs, row, times):
    copies = spark.range(times).select(*[F.lit(row[c]).alias(c) for c in docs.columns])
    return docs.unionByName(copies.select(*[F.col(c).cast(docs.schema[c].dataType) for c in docs.columns]))


def test_copies_of_a_text_change_no_language(spark, tables, learned):
    docs, _ = tables
    row = docs.where("lang = 'fr' AND crc32(CAST(doc_id AS STRING)) % 5 <> 0 AND length(text) < 2000").orderBy("doc_id").first()
    langid.train(docs)
    langid.train(_copied(spark, docs, row, 200_000))
    assert learned[0] == learned[1]
    assert {"en", "de", "fr", "es"} <= set(learned[0][1]) and len(learned[0][0]) <= langid.SAMPLE_DOCS
    assert len(set(zip(*learned[0]))) == len(learned[0][0])


def test_copies_of_a_text_change_no_toxicity(spark, tables, learned):
    docs, labels = tables
    row = docs.join(labels.where("toxic = 1"), "doc_id", "left_semi").where(
        "crc32(CAST(doc_id AS STRING)) % 5 <> 0").orderBy("doc_id").first()
    toxicity.train(docs, labels)
    toxicity.train(_copied(spark, docs, row, 200_000), labels)
    assert learned[0] == learned[1] and len(set(learned[0][0])) == len(learned[0][0])


def test_samples_keep_to_their_bounds(spark, learned):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"),
        F.concat(F.lit("l"), (F.col("id") % 50).cast("string")).alias("lang"))
    # one labelled id with many different texts
    docs = docs.unionByName(spark.range(3000).select(F.lit(1).alias("doc_id").cast("bigint"), F.concat(
        F.lit("other "), F.col("id").cast("string")).alias("text"), F.lit("l1").alias("lang")))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")).distinct()
    langid.train(docs, sample=120)
    toxicity.train(docs, labels, toxic=30, clean=40)
    (_, langs), (_, toxic) = learned
    assert len(langs) == 120 and {langs.count(x) for x in set(langs)} == {2, 3} and len(set(langs)) == 50
    assert sorted(map(int, toxic)) == [0] * 40 + [1] * 30


def test_the_languages_with_the_most_texts_are_learned(spark, learned, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 3)
    rows = [(i, f"text {i} {k}", f"x{i % 6}") for i in range(60) for k in range(1 + i % 6)] + [(99, "copy", "x0")] * 500
    langid.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), sample=30)
    assert {x: learned[0][1].count(x) for x in set(learned[0][1])} == {"x3": 10, "x4": 10, "x5": 10}
