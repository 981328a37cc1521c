"""The whole pipeline on planted cases, and the registered queries against SQL or the pipeline."""

import base64
import hashlib
import random
import sys
import zlib
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).parents[2]))

import corpus_pipeline
from autostrata.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Documents with one toxic, one copied, one nearly copied and one contaminated text each."""
    random.seed(12)
    root = str(tmp_path_factory.mktemp("planted"))
    words = [f"word{i}" for i in range(3000)]
    text = lambda n: " ".join(random.choices(words, k=n)) + "."
    docs = [(i, text(60), "en", "s", 0) for i in range(400)]
    docs = [(i, t + (" you grolf" if i % 4 == 0 else ""), *rest) for i, t, *rest in docs]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(400)]
    item = text(15)
    clean = docs[1][1]
    docs += [
        (1000, clean, "en", "s", 0),
        (1001, clean + " tail", "en", "s", 0),
        (1002, text(10) + item + text(10), "en", "s", 0),
        (1003, text(30) + " what a grolf", "en", "s", 0),
        (1004, None, "en", "s", 0),
        (1005, "", "en", "s", 0),
        (1006, text(30), None, None, None),
        (1006, "twice", "en", "s", 0),
        (1006, "twice", "en", "s", 0),
        (None, text(30), "en", "s", 0),
    ]
    spark.createDataFrame(
        docs, "doc_id long, text string, lang string, source string, n_chars long"
    ).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_planted_cases(spark, planted):
    rows = corpus_pipeline.run(spark, planted).collect()
    ids = [r.doc_id for r in rows]
    left = {i for i in range(400) if i % 4} - {1}
    # The copy 1000 outlives 1 as the larger id; of 1000 and 1001 the smaller id stays.
    assert sorted(i for i in ids if i is not None and i < 400) == sorted(left)
    assert 1000 in ids and not {1001, 1002, 1003} & set(ids)
    assert ids.count(1006) == 2 and ids.count(None) == 1
    assert ids.count(1004) + ids.count(1005) == 1


def test_stages_keep_the_columns(spark, planted):
    docs = spark.read.parquet(f"{planted}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, planted).columns == docs.columns, name


def test_stages_of_an_empty_table(spark, planted):
    docs = spark.read.parquet(f"{planted}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, planted).count() == 0, name


def test_columns_with_clashing_names(spark, planted):
    docs = spark.read.parquet(f"{planted}/documents.parquet")
    for name in ("id", "_row_key", "score", "node", "row", "term", "pool", "key", "_id", "_bitmap_row"):
        docs = docs.withColumn(name, docs["n_chars"])
    for name, stage in corpus_pipeline.STAGES:
        left = stage(spark, docs, planted)
        assert left.count() > 0
        assert name == "packing" or left.columns == docs.columns


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    expected = duck.sql(ORACLE[name])
    got = QUERIES[name](spark, SF_DIR)
    assert sorted(got.columns) == sorted(expected.columns)
    assert sorted(map(tuple, got.select(*expected.columns).collect())) == sorted(expected.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_every_document_or_page_has_its_row(spark, name):
    table = "pages" if name in ("op2_html_extraction", "op7_warc") else "documents"
    key = {"pages": "page_id", "documents": "doc_id"}[table]
    want = sorted(r[0] for r in spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key).collect())
    got = sorted(r[0] for r in QUERIES[name](spark, SF_DIR).select(key).distinct().collect())
    assert got == want


def _crc(value):
    return zlib.crc32(str(value).encode())


def test_contract_columns_that_sql_leaves_open(spark):
    """What the queries say of rows beside their decisions, recomputed from the tables."""
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    pages = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}

    for r in QUERIES["op1_toxicity"](spark, SF_DIR).collect():
        assert r.held_out == (_crc(r.doc_id) % 4 == 2) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.3)

    placed = QUERIES["op3_sharding"](spark, SF_DIR).collect()
    slots = {}
    for r in placed:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < 24
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(i, [])) for i in range(24)]
    assert max(counts) - min(counts) <= 1

    last = {}
    for page in sorted(pages):
        last[pages[page]] = page
    for r in QUERIES["op7_warc"](spark, SF_DIR).collect():
        raw = pages[r.page_id]
        assert r.payload_bytes == len(raw)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        keeper = last[raw]
        want = ("response", None) if keeper == r.page_id else ("revisit", keeper)
        assert (r.record_type, r.refers_to) == want

    for r in QUERIES["op2_html_extraction"](spark, SF_DIR).collect():
        assert r.n_chars == len(r.text)
