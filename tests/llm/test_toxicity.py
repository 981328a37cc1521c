"""Toxicity: held-out accuracy on planted words, the noisy-or, and the place of what offends."""

import random

import pytest

from autostrata.llm import toxicity
from autostrata.llm.toxicity import Model


def _texts(count, seed=1):
    random.seed(seed)
    plain = [f"word{i}" for i in range(200)]
    rows = []
    for i in range(count):
        sentences = [" ".join(random.choices(plain, k=8)) for _ in range(random.randint(1, 12))]
        toxic = i % 5 == 0
        if toxic:
            at = random.randrange(len(sentences))
            sentences[at] += " " + random.choice(["scumly", "scumish", "grolf"])
        rows.append((i, ". ".join(sentences), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    rows = _texts(500)
    docs = spark.createDataFrame([(i, t, 0.5, "x") for i, t, _ in rows], "doc_id long, text string, score double, label string")
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows], "doc_id long, toxic int, quality int")
    return docs, labels


@pytest.fixture(scope="module")
def model(tables):
    docs, labels = tables
    return toxicity.fit(docs, labels.where(toxicity.crc_remainder("doc_id") != 2))


def test_held_out_rows(tables, model):
    docs, labels = tables
    held = toxicity.score(docs, model).where(toxicity.crc_remainder("doc_id") == 2)
    rows = held.join(labels, "doc_id").collect()
    assert len(rows) > 80
    right = sum((r.score >= toxicity.THRESHOLD) == (r.toxic == 1) for r in rows)
    assert right / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_offending_sentences_have_the_planted_word(tables, model):
    docs, _ = tables
    found = toxicity.offending_sentences(docs, model).collect()
    assert len(found) > 80
    assert all("scum" in r.sentence or "grolf" in r.sentence for r in found)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(texts[r.doc_id][r.start : r.end] == r.sentence for r in found)


def test_score_is_the_noisy_or_of_sentences():
    model = Model({"bad": 2.0, "awfu*": 1.0}, -1.0, 0.01)
    p, q = (1 / (1 + 2.718281828459045 ** -z) for z in (1.0, 0.0))
    assert model.score("A bad one. Fine. awfully so") == pytest.approx(1 - 0.99 * (1 - p) * (1 - q))
    assert model.score("nothing here") == pytest.approx(0.01)
    assert model.score("") == pytest.approx(0.01)
    assert model.score("clean. " * 100_000) == pytest.approx(0.01)  # length alone is no evidence


def test_null_empty_and_unlabelled(spark):
    docs = spark.createDataFrame([(1, None), (None, ""), (2, "bad"), (2, "bad")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (7, None)], "doc_id long, toxic int")
    for used in (labels, labels.limit(0)):
        model = toxicity.fit(docs, used)
        scores = [r.score for r in toxicity.score(docs, model).collect()]
        assert scores == [0.0] * 4
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert toxicity.offending_sentences(docs, Model({"bad": 9.0}, 0.0, 0.0)).count() == 2


def test_training_sample_is_bounded_and_has_texts(tables):
    docs, labels = tables
    assert toxicity.training_sample(labels, docs, "doc_id", "toxic", 50).count() == 50
    foreign = labels.selectExpr("doc_id + 100000 AS doc_id", "toxic").union(labels.select("doc_id", "toxic"))
    assert toxicity.training_sample(foreign, docs, "doc_id", "toxic", 10_000).count() == 500


def test_few_labels_tell_toxic_texts_and_clear_the_others(spark):
    rows = [(i, "what a moron you are" if i < 7 else f"a quiet text number{i}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 7)) for i in range(20)], "doc_id long, toxic int")
    scores = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert min(scores[i] for i in range(7)) >= toxicity.THRESHOLD > max(scores[i] for i in range(7, 20))


def test_labels_without_telling_words_call_nothing_toxic(spark):
    docs = spark.createDataFrame([(i, "the same text") for i in range(10)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, toxic int")
    scores = {r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert len(scores) == 1 and scores.pop() < toxicity.THRESHOLD


def test_spans_of_offending_sentences(tables, model):
    docs, _ = tables
    kept = docs.withColumn("spans", docs["label"])
    rows = toxicity.score(kept, model, spans="spans").collect()
    listed = {(r.doc_id, s.start, s.end) for r in rows for s in r.spans}
    found = toxicity.offending_sentences(docs, model).collect()
    assert listed == {(r.doc_id, r.start, r.end) for r in found} and listed
    assert [c for c, _ in toxicity.score(kept, model, spans="spans").dtypes] == kept.columns
