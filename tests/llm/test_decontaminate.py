"""Benchmark passages against a scan of all windows."""

import random
import re

from autostrata.llm.decontaminate import PositionalIndex, drop_contaminated


def _words(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def _expected(docs, items):
    windows = {}
    for id, text in items:
        words = _words(text)
        n = min(10, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(id)
    out = {}
    for id, text in docs:
        words, hit, found = _words(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                names = windows.get(tuple(words[i : i + n]))
                if names:
                    found |= names
                    hit |= set(range(i, i + n))
        out[id] = (len(words), len(hit), sorted(str(x) for x in found if x is not None))
    return out


def _tables(seed):
    random.seed(seed)
    letters = ["the", "of", "é", "a1", "zeta", "omega", "Kappa", "nu"]

    def text(n):
        return "".join(random.choice(letters) + random.choice([" ", ", ", "-\n"]) for _ in range(n))

    items = [(i, text(random.randint(8, 25))) for i in range(12)]
    items += [(50, "the of"), (51, "Zeta"), (52, None), (53, "..."), (3, items[3][1]), (54, "unseen word")]
    docs = [(i, text(random.randint(0, 60))) for i in range(60)]
    docs += [(100 + i, text(5) + items[i][1].upper() + text(5)) for i in range(12)]
    docs += [(200, None), (201, ""), (202, text(3000))]
    return docs, items


def test_equals_a_scan_of_all_windows(spark):
    docs, items = _tables(8)
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, term int, row string")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, words int")
    got = PositionalIndex(frame, bench).contamination().collect()
    assert {r.id: (r.n_words, r.n_hit, r.item_ids) for r in got} == _expected(docs, items)
    left = drop_contaminated(frame, bench)
    clean = {i for i, (_, hit, _) in _expected(docs, items).items() if not hit}
    assert left.columns == frame.columns and {r.doc_id for r in left.collect()} == clean


def test_proximity(spark):
    docs = spark.createDataFrame(
        [(1, "one two x three four"), (2, "one two three four"), (3, "four three two one")],
        "doc_id long, text string",
    )
    bench = spark.createDataFrame([(9, "one two three four")], "item_id long, text string")
    index = PositionalIndex(docs, bench)
    ids = {r.row: r.id for r in index.heads.collect()}
    assert {ids[r.row] for r in index.matches().collect()} == {2}
    assert {ids[r.row] for r in index.matches(slop=1).collect()} == {1, 2}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([(9, "a b")], "item_id long, text string")
    assert PositionalIndex(docs.limit(0), bench).contamination().count() == 0
    rows = PositionalIndex(docs, bench.limit(0)).contamination().collect()
    assert [(r.id, r.n_words, r.n_hit, r.item_ids) for r in rows] == [(1, 2, 0, [])]


def test_rows_that_repeat_an_id_are_told_apart(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "c d"), (None, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([(9, "a b")], "item_id long, text string")
    rows = PositionalIndex(docs, bench).contamination().collect()
    assert sorted((r.id or 0, r.n_hit) for r in rows) == [(0, 2), (1, 0), (1, 2)]
    assert [r.text for r in drop_contaminated(docs, bench).collect()] == ["c d"]


def test_an_item_of_many_words_and_a_text_that_repeats_a_passage(spark):
    """Memory and time grow with the number of words, not with its square."""
    words = [f"w{i % 9000}" for i in range(60_000)]
    passage = " ".join(words[:12])
    docs = [(1, " ".join(words)), (2, "x " * 20_000 + passage), (3, f"{passage} sep " * 3000), (4, "clean")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(words)), (2, passage)], "item_id long, text string")
    got = {r.id: (r.n_words, r.n_hit, r.item_ids) for r in PositionalIndex(frame, bench).contamination().collect()}
    assert got == {
        1: (60_000, 60_000, ["1", "2"]), 2: (20_012, 12, ["1", "2"]),
        3: (13 * 3000, 12 * 3000, ["1", "2"]), 4: (1, 0, []),
    }
