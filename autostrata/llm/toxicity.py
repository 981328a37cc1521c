"""Toxicity by multiple-instance learning: sentences are scored, documents carry the labels.

A document is toxic unless none of its sentences is: its score is the noisy-or of its sentences'
scores and a small constant. The sentence model is fitted through that formula from document
labels, so it also tells which sentences offend.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from autostrata.llm.common import whole
from autostrata.staging import materialize

# Bound of the training sample.
TRAINING_DOCUMENTS = 20_000
# Least smoothed odds ratio of a feature's presence in toxic against clean documents. It asks for
# three to four toxic documents more than chance gives, whatever the number of labels.
EVIDENCE = 45.0

# Documents that score at least this are called toxic.
THRESHOLD = 0.3

STEMS = (4, 5, 6)
STEPS = 400
STEP_SIZE = 0.1
SHRINKAGE = 1e-3

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W_]+")


def features(word: str) -> list[str]:
    """A word and its beginnings, which stand for its inflected forms."""
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) >= n)]


@dataclass(frozen=True)
class Model:
    """Weights of features in a sentence, its bias, and the score of a document without evidence.

    A sentence without any known feature has score 0, so length alone is no evidence.
    """

    weights: dict[str, float]
    bias: float
    leak: float

    def sentences(self, text: str) -> Iterator[tuple[int, int, float]]:
        """``start``, ``end`` and score of each sentence that has a known feature."""
        telling = self._telling(text)
        if not telling:
            return
        for sentence in _SENTENCE.finditer(text):
            known = _found(sentence.group(), telling)
            if known:
                z = self.bias + sum(self.weights[f] for f in known)
                yield sentence.start(), sentence.end(), 1 / (1 + exp(-z))

    def _telling(self, text: str) -> dict[str, list[str]]:
        """The text's words that have known features, with those. Most texts have none."""
        known, words = self.weights.keys(), set(_WORD.findall(text.lower()))
        hits = words & known
        for n in STEMS:
            starts = {w[:n] for w in words if len(w) >= n} & self.stems.keys()
            if starts:
                hits.update(w for w in words if w[:n] in starts)
        return {w: [f for f in features(w) if f in known] for w in hits}

    @cached_property
    def stems(self) -> dict[str, str]:
        return {f[:-1]: f for f in self.weights if f.endswith("*")}

    def score(self, text: str) -> float:
        """Noisy-or over the sentences and the constant."""
        clean = 1 - self.leak
        for _, _, p in self.sentences(text):
            clean *= 1 - p
        return 1 - clean


def _found(sentence: str, telling: dict[str, list[str]]) -> set[str]:
    words = set(_WORD.findall(sentence.lower())) & telling.keys()
    return {f for w in words for f in telling[w]}


def training_sample(
    labels: DataFrame, docs: DataFrame, id: str, label: str, bound: int
) -> DataFrame:
    """``id`` and ``label`` (0 or 1) of at most ``bound`` labels of documents that are there,
    chosen by a hash of the id."""
    return (
        labels.where(F.col(label).isin(0, 1))
        .select(F.col(id).alias("id"), F.col(label).cast("int").alias("label"))
        .join(docs.select(F.col(id).alias("id")), "id", "left_semi")
        .orderBy(F.xxhash64("id"), "id", "label")
        .limit(bound)
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    bound: int = TRAINING_DOCUMENTS,
) -> Model:
    """Fit the sentence model from document labels (1 toxic, 0 not).

    At most ``bound`` labelled documents are used; they are found by a join with those ids, which
    are few enough to broadcast. Spark counts in how many toxic and clean documents each feature
    occurs, and keeps those whose smoothed odds ratio is at least ``EVIDENCE``, a bound that does
    not depend on the number of labels. Only these features' places in sentences reach the driver,
    where the likelihood of the document labels is maximised.

    A text without evidence has the model's constant score, which stays below half the threshold,
    so no document is called toxic for lack of knowledge. Without labelled documents, without toxic
    ones or without telling features every text is such a text (0 where there are no labels).
    """
    sample = training_sample(labels, docs, id, label, bound)
    texts = docs.select(F.col(id).alias("id"), whole(text).alias("text"))
    # At most ``bound`` short rows.
    labelled = materialize(texts.join(F.broadcast(sample), "id").select("label", "text"), "sample")
    counts = labelled.mapInArrow(
        _document_features, "feature string, in_toxic bigint, in_clean bigint"
    )
    totals = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    prior = min(toxic / (toxic + clean), THRESHOLD / 2) if toxic + clean else 0.0
    if not toxic or not clean:
        return Model({}, 0.0, prior)
    telling = (
        counts.groupBy("feature")
        .agg(F.sum("in_toxic").alias("in_toxic"), F.sum("in_clean").alias("in_clean"))
        .where(_odds_ratio("in_toxic", "in_clean", toxic, clean) >= EVIDENCE)
    )
    names = sorted(r["feature"] for r in telling.select("feature").collect())
    if not names:
        return Model({}, 0.0, prior)
    bags = labelled.mapInArrow(
        lambda batches: _sentence_bags(batches, names), "label int, sentences array<array<int>>"
    ).collect()
    return _maximise(names, [(b["label"], b["sentences"]) for b in bags])


def _odds_ratio(a: str, b: str, toxic: int, clean: int) -> Column:
    """Odds of a feature's presence in toxic documents over those in clean ones, half a document
    added to each number."""
    x, y = F.col(a) + F.lit(0.5), F.col(b) + F.lit(0.5)
    return x * (clean + 1 - y) / (y * (toxic + 1 - x))


def _document_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and clean documents of a batch each feature occurs."""
    for batch in batches:
        counts = Counter(), Counter()
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = set(_WORD.findall(text.as_py().lower()))
            counts[label].update({f for w in words for f in features(w)})
        clean, toxic = counts
        found = list(clean.keys() | toxic.keys())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(found, pa.string()),
                pa.array([toxic[f] for f in found], pa.int64()),
                pa.array([clean[f] for f in found], pa.int64()),
            ],
            ["feature", "in_toxic", "in_clean"],
        )


def _sentence_bags(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    place = {name: i for i, name in enumerate(names)}
    probe = Model(dict.fromkeys(names, 0.0), 0.0, 0.0)
    for batch in batches:
        bags = []
        for text in batch.column(1):
            telling = probe._telling(text.as_py())
            found = (_found(s.group(), telling) for s in _SENTENCE.finditer(text.as_py()))
            bags.append([sorted(place[f] for f in known) for known in found if known])
        kind = pa.list_(pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(bags, kind)], ["label", "sentences"]
        )


def _maximise(names: list[str], bags: list[tuple[int, list[list[int]]]]) -> Model:
    """Adam on the noisy-or likelihood, weights shrunk towards 0."""
    bags = sorted(bags)
    y = np.array([label for label, _ in bags], np.float64)
    owner = np.array([i for i, (_, ss) in enumerate(bags) for _ in ss], np.int64)
    sentences = [s for _, ss in bags for s in ss]
    row = np.repeat(np.arange(len(sentences)), [len(s) for s in sentences])
    column = np.array([f for s in sentences for f in s], np.int64)
    size = len(names)
    theta = np.zeros(size + 2)  # weights, bias, leak as a log-odds
    theta[size], theta[size + 1] = -1.0, -4.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        z = np.bincount(row, theta[column], len(sentences)) + theta[size]
        p = 1 / (1 + np.exp(-z))
        leak = 1 / (1 + np.exp(-theta[size + 1]))
        # Minus the log of the chance that nothing in the document is toxic.
        total = np.bincount(owner, np.logaddexp(0, z), len(y)) + np.logaddexp(0, theta[size + 1])
        slope = np.where(y > 0, -1 / np.expm1(np.clip(total, 1e-9, 50)), 1.0)
        dz = slope[owner] * p
        gradient = np.append(
            np.bincount(column, dz[row], size), [dz.sum(), slope.sum() * leak]
        ) / len(y)
        gradient[:size] += SHRINKAGE * theta[:size] / max(size, 1)
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient**2
        rate = STEP_SIZE * m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        theta = theta - rate
    leak = min(float(1 / (1 + np.exp(-theta[size + 1]))), THRESHOLD / 2)
    return Model(dict(zip(names, map(float, theta[:size]))), float(theta[size]), leak)


def score(
    docs: DataFrame,
    model: Model,
    text: str = "text",
    name: str = "score",
    spans: str | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` with a column ``name``: the chance that the whole text is toxic, 0 to 1.

    NULL and empty texts, and texts without a known feature, get the model's constant. ``spans``
    names a column for the ``start`` and ``end`` (code points, end exclusive) of the sentences
    whose own score is at least ``threshold``. Both take the place of columns of their names.
    """
    kind = "score double, spans array<struct<start: bigint, end: bigint>>"

    def scored(texts: pa.Array) -> pa.Array:
        scores, found = [], []
        for value in texts:
            clean, places = 1 - model.leak, []
            for start, end, p in model.sentences(value.as_py()):
                clean *= 1 - p
                if p >= threshold:
                    places.append({"start": start, "end": end})
            scores.append(1 - clean)
            found.append(places)
        spots = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.StructArray.from_arrays(
            [pa.array(scores, pa.float64()), pa.array(found, spots)], ["score", "spans"]
        )

    judged = F.arrow_udf(scored, kind)(whole(text))
    added = {name: F.col("_judged.score")} | ({spans: F.col("_judged.spans")} if spans else {})
    others = [F.col(f"`{c}`") for c in docs.columns if c not in added and c != "_judged"]
    order = [
        added[c].alias(c) if c in added else F.col(f"`{c}`") for c in docs.columns if c != "_judged"
    ]
    new = [value.alias(c) for c, value in added.items() if c not in docs.columns]
    return docs.select(*others, judged.alias("_judged")).select(*order, *new)


def offending_sentences(
    docs: DataFrame,
    model: Model,
    id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``id``, ``start``, ``end`` (code points, end exclusive), ``score`` and ``sentence`` of each
    sentence whose own score is at least ``threshold``."""
    texts = docs.select(F.col(id).alias("id"), whole(text).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, ends, scores, parts = [], [], [], [], []
            for i, value in enumerate(batch.column(1)):
                whole_text = value.as_py()
                for start, end, p in model.sentences(whole_text):
                    if p >= threshold:
                        rows.append(i), starts.append(start), ends.append(end)
                        scores.append(p), parts.append(whole_text[start:end])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(starts, pa.int64()),
                    pa.array(ends, pa.int64()),
                    pa.array(scores, pa.float64()),
                    pa.array(parts, pa.string()),
                ],
                ["id", "start", "end", "score", "sentence"],
            )

    out = texts.mapInArrow(
        located, f"id {kind}, start bigint, end bigint, score double, sentence string"
    )
    return out.withColumnRenamed("id", id)


def crc_remainder(id: str, parts: int = 4) -> Column:
    """crc32 of the id as text, modulo ``parts``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit(""))) % parts
