"""Exact duplicates against grouping in Python, and the pipeline's row filter."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from autostrata.llm.exact_dedup import exact_groups, keep_one

SCHEMA = "doc_id long, text string, _id string, _key string, digest int"


def _expected(rows):
    groups = defaultdict(list)
    for id, text in rows:
        groups[text or ""].append(id)
    lowest = float("-inf")
    return sorted(
        (id, max(g, key=lambda x: lowest if x is None else x), len(g))
        for id, text in rows
        for g in [groups[text or ""]]
    )


def _frame(spark, rows):
    """With columns named like those the operator uses inside."""
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], SCHEMA)


@pytest.mark.parametrize("prefix_letters,filter_bits", [(256, 26), (2, 15)])
def test_equals_grouping(spark, prefix_letters, filter_bits):
    random.seed(4)
    rows = [(i, "".join(random.choice("ab") for _ in range(random.randint(0, 6)))) for i in range(300)]
    rows += [(300, None), (301, ""), (302, "é" * 5000), (303, "é" * 5000), (304, "é" * 4999 + "e")]
    got = exact_groups(
        _frame(spark, rows), prefix_letters=prefix_letters, filter_bits=filter_bits
    ).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got) == _expected(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_carried_columns_empty_table_and_null_ids(spark):
    docs = _frame(spark, [(None, "a"), (1, "a"), (2, "b"), (None, "c")])
    sha = F.sha2(F.coalesce("text", F.lit("")), 256)
    got = {(r.doc_id, r.keep_id, r.kept, r.sha) for r in exact_groups(docs, carry={"sha": sha}).collect()}
    digest = {t: hashlib.sha256(t.encode()).hexdigest() for t in "abc"}
    assert got == {
        (None, 1, False, digest["a"]),
        (1, 1, True, digest["a"]),
        (2, 2, True, digest["b"]),
        (None, None, True, digest["c"]),
    }
    assert exact_groups(docs.limit(0)).count() == 0


def test_one_row_stays_of_repeated_rows(spark):
    docs = _frame(spark, [(1, "a"), (1, "a"), (0, "a"), (2, None), (2, ""), (3, "b")])
    left = keep_one(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in left.collect()) == [(1, "a"), (2, ""), (3, "b")]


def test_no_python_and_no_text_in_a_shuffle(spark):
    plan = exact_groups(_frame(spark, [(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
