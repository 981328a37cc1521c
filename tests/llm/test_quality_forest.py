"""Quality rules: counts against SQL and a plain scan, the forest on planted outliers and held-out rows."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from autostrata.llm import quality_forest as Q
from autostrata.llm.queries import QUERIES
from autostrata.llm.toxicity import crc_remainder

SF_DIR = "/root/testdata/sf0.01"

COUNTS = """
    WITH word AS (
        SELECT doc_id, text, coalesce(list_filter(
            string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''), []) AS words
        FROM documents
    ), placed AS (
        SELECT doc_id, i, words[i + 1 : i + 8] AS run
        FROM (SELECT *, unnest(range(len(words) - 7)) AS i FROM word)
    ), repeated AS (
        SELECT doc_id, count(*) AS n FROM (
            SELECT DISTINCT doc_id, unnest(range(i, i + 8)) AS i FROM (
                SELECT *, count(*) OVER (PARTITION BY doc_id, run) AS times FROM placed
            ) WHERE times > 1
        ) GROUP BY doc_id
    )
    SELECT doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS word_chars,
           length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
           len(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')))
           - len(list_distinct(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')))) AS n_dup_lines,
           coalesce(n, 0) AS n_repeat_words,
           len(words) < 20 OR 100 * coalesce(n, 0) > 30 * len(words) AS base_failed
    FROM word LEFT JOIN repeated USING (doc_id)
"""


@pytest.fixture(scope="module")
def judged(spark):
    return QUERIES["op13_quality_rules"](spark, SF_DIR).cache()


def test_counts_equal_sql(judged):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    want = duck.sql(COUNTS)
    got = judged.select(*want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
    assert not judged.where("base_failed AND kept").count()


def test_held_out_rows(spark, judged):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where(crc_remainder("doc_id") == 2)
    rows = judged.where("NOT base_failed").join(labels, "doc_id").select("kept", "quality").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) / len(good) > 0.95
    assert sum(bad) / len(bad) < 0.5


def test_repeated_words_equal_a_scan():
    rng = random.Random(2)
    for _ in range(300):
        ids = [rng.randrange(2) for _ in range(rng.randint(0, 60))]
        windows = [tuple(ids[i : i + 8]) for i in range(len(ids) - 7)]
        inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
        assert Q._repeated(np.array(ids, np.int64), 8) == len(inside)


def test_forest_isolates_outliers():
    random_ = np.random.default_rng(1)
    usual, odd = random_.normal(0, 1, (2000, 3)), random_.normal(6, 1, (40, 3))
    features = np.concatenate([usual, odd])
    good = np.arange(2040) < 2000
    forest = Q.calibrated(Q.grow(features), features, good)
    rejected = forest.scores(features) > forest.threshold
    assert rejected[~good].mean() > 0.95 and rejected[good].mean() <= Q.MOST_LOST
    same = Q.grow(np.ones((50, 3)))
    assert np.ptp(same.scores(np.ones((5, 3)))) == 0


def test_path_lengths_of_a_small_tree():
    forest = Q.Forest(
        np.array([[0, -1, -1]]), np.array([[5.0, 0, 0]]), np.array([[0, 1.0, 3.0]]), 0.5
    )
    scale = Q._mean_path(Q.TREE_ROWS)
    got = forest.scores(np.array([[4.9], [5.0]]))
    assert got.tolist() == pytest.approx([2 ** (-1 / scale), 2 ** (-3 / scale)])


def test_null_empty_unlabelled_and_clashing(spark):
    plain = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame(
        [(1, None), (None, ""), (2, plain), (2, plain), (3, "a " * 30)], "doc_id long, text string"
    ).withColumn("n_words", F.lit("x")).withColumn("_good", F.lit(1)).withColumn("kept", F.lit(None))
    labels = spark.createDataFrame([(2, 1), (3, 0), (None, 1), (7, None)], "doc_id long, quality int")
    for used in (labels, labels.limit(0)):
        rows = Q.judge_documents(docs, used).collect()
        got = sorted((r.doc_id or 0, r.n_words, r.n_repeat_words, r.base_failed, r.kept) for r in rows)
        assert got == [
            (0, 0, 0, True, False), (1, 0, 0, True, False), (2, 40, 0, False, True),
            (2, 40, 0, False, True), (3, 30, 30, True, False),
        ]
    assert Q.judge_documents(docs.limit(0), labels).count() == 0


def test_sample_is_bounded(spark, judged):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    counts = Q.statistics(docs.select("doc_id", "text"))
    assert Q.fit(counts, labels, rows=0).threshold == float("inf")
    assert Q.fit(counts, labels, rows=300).threshold < 1


def test_all_labelled_rows_teach(spark):
    ids = spark.range(24_000).select(F.col("id").alias("doc_id"), F.xxhash64("id").alias("h")).toPandas()
    ids = ids.sort_values("h", ignore_index=True)
    random_ = np.random.default_rng(2)
    n_words = random_.integers(50, 400, len(ids))
    bad = ids.index >= 23_800  # the last by hash, beyond any bounded sample of less
    counts = ids[["doc_id"]].assign(
        n_words=n_words, word_chars=5 * n_words + random_.integers(0, 40, len(ids)),
        n_symbols=np.where(bad, random_.integers(200, 2000, len(ids)), random_.integers(0, 3, len(ids))),
        n_dup_lines=0, n_repeat_words=0, n_upper=random_.integers(0, 20, len(ids)),
        n_marks=np.where(bad, random_.integers(100, 1000, len(ids)), 0), n_distinct=n_words // 2,
    )
    labels = ids[["doc_id"]].assign(quality=np.where(bad, 0, 1))
    table = spark.createDataFrame(counts).repartition(5)
    forest = Q.fit(table, spark.createDataFrame(labels))
    features = Q._features(counts)
    assert forest.threshold == Q.calibrated(forest, features, ~bad).threshold
    assert (forest.scores(features[bad]) > forest.threshold).mean() > 0.7
    root = next(forest.leaves(features))
    shares = np.bincount(root, minlength=forest.feature.shape[1]) / len(ids)
    depth = [(node + 1).bit_length() - 1 for node in range(len(shares))]
    want = [d + Q._mean_path(256 * s) if s else 0 for d, s in zip(depth, shares)]
    assert forest.path[0].tolist() == pytest.approx(want)


def test_cutoff_equals_the_plain_one(spark):
    random_ = np.random.default_rng(7)
    for n, kinds in ((400, 2), (60, 2), (30, 1)):
        values, good = random_.integers(0, n // 2, n) / 8, random_.integers(0, kinds, n) == 0
        forest = Q.Forest(np.empty((0, 1)), np.empty((0, 1)), np.empty((0, 1)), float("inf"))
        plain = type("Scored", (Q.Forest,), {"scores": lambda self, features: features})(*forest)
        rows = spark.createDataFrame(list(zip(values.tolist(), good.tolist())), "anomaly double, good boolean")
        assert Q.cutoff(rows) == Q.calibrated(plain, values, good).threshold
    assert Q.cutoff(rows.limit(0)) == float("inf")
