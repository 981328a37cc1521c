"""Secret scans: base findings against the patterns as stated, and linked parts."""

import hashlib
import random
import re
import time

from autostrata.llm.credentials import SCOPE, SecretScan, base_spans, weak_spans

ASSIGN = re.compile(
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"
    r"[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def _expected(text):
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def _scan(spark, rows):
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, row int, weak string")
    return {r.id: r for r in SecretScan(docs).findings().collect()}


def test_base_spans_as_stated():
    random.seed(6)
    parts = ["password", "ToKen", "api_key", "apikey", '"', "'", " ", ":", "=", "AKIA", "A1B2C3D4E5F6G7H8",
             "deadbeef" * 3, "abc.def", "é", "ſecret", "secre", "x", "toKen", "\n"]
    for _ in range(3000):
        text = "".join(random.choice(parts) for _ in range(random.randint(0, 14)))
        assert base_spans(text) == _expected(text), text


def test_weak_parts_need_their_complements(spark):
    random_ = "Zx9" + "aB3" * 10
    rows = [
        (1, f"user: bob99 pw {random_} at https://db.example.com/x"),
        (2, f"pw {random_} alone"),
        (3, "user: bob99 and https://db.example.com/x"),
        (4, f"user: bob99 {'far ' * 200} {random_}"),
        (5, "user: bob99 password = hunter2hunter2"),
        (6, None), (7, ""), (7, ""),
    ]
    found = {i: r.spans for i, r in _scan(spark, rows).items()}
    assert found[1] == "user:0:11,random:15:48,url:52:76"
    assert found[5] == "user:0:11,assign:12:37"
    assert {i for i in found if found[i] == ""} == {2, 3, 4, 6, 7}


def test_digest_counts_and_far_stretches(spark):
    text = "é" * 1000 + " AKIA" + "A" * 16 + " " + "x " * 100 + "host=db1 secret: abcdef0123"
    row = _scan(spark, [(1, text)])[1]
    base = ",".join(f"{k}:{s}:{e}" for k, s, e in _expected(text))
    assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert (row.n_assign, row.n_access, row.n_hex) == (1, 1, 0)
    assert row.spans.split(",")[0].startswith("access:1001") and "host:" in row.spans


def test_empty_table_and_long_text(spark):
    assert _scan(spark, []) == {}
    row = _scan(spark, [(1, "a" * 300_000 + "@" * 10 + " =" * 1000)])[1]
    assert (row.n_assign, row.n_access, row.n_hex) == (0, 0, 1)


def test_parts_do_not_complete_themselves(spark):
    key = "AKIA" + "A1B2C3D4" * 3
    rows = [
        (1, "login: Zx9" + "aB3" * 10), (2, f"{key} https://x.example/a"), (3, f"{key} user: bob99"),
        (4, "https://user.example/?x=Zx9" + "aB3" * 10), (5, f"{key} pw Zx9{'aB3' * 10} https://x.example/a"),
    ]
    found = {i: r.spans for i, r in _scan(spark, rows).items()}
    assert found[1] == "" and found[4] == ""
    assert found[2] == found[3] == f"access:0:{len(key)}"
    assert [s.split(":")[0] for s in found[5].split(",")] == ["access", "random", "url"]


def _linked(text):
    """All spans of a text by comparing all parts with all."""
    base = base_spans(text)
    roles = {"assign": "secret", "access": "identifier", "hex": "secret"}
    parts = [(k, roles[k], s, e, False) for k, s, e in base]
    parts += [
        (k, r, s, e, True) for k, r, s, e in weak_spans(text)
        if not any(bs <= s and be >= e for _, bs, be in base)
    ]
    needs = {"secret": {"identifier"}, "identifier": {"secret"}, "endpoint": {"identifier", "secret"}}
    kept = list(base)
    for kind, role, start, end, weak in parts:
        near = {r for _, r, s, e, _ in parts if (e <= start or s >= end) and abs(s - start) <= SCOPE}
        if weak and needs[role] <= near - {role}:
            kept.append((kind, start, end))
    rank = {k: i for i, k in enumerate(("assign", "access", "hex"))}
    kept.sort(key=lambda s: (s[1], str(rank.get(s[0], 9)) + s[0], s[2]))
    return ",".join(f"{k}:{s}:{e}" for k, s, e in kept)


def test_links_equal_a_comparison_of_all_parts(spark):
    rng = random.Random(9)
    pieces = [
        "user: bob99", "login=Zx9aB3aB3aB3aB3aB3aB3", "a.b@c.example", "Zx9aB3aB3aB3aB3aB3aB3aB3", "password: hunter2x",
        "AKIA" + "Q" * 16, "deadbeef" * 3, "https://h.example/p?u=Zx9aB3aB3aB3aB3aB3aB3", "host=db1.local", "far " * 50,
        "user=a.b@c.example", "region: Zx9aB3aB3aB3aB3aB3aB3aB3", "x", "far " * 101,
    ]
    texts = [" ".join(rng.choices(pieces, k=rng.randint(0, 25))) for _ in range(300)]
    found = _scan(spark, list(enumerate(texts)))
    assert {i: found[i].spans for i in range(300)} == {i: _linked(t) for i, t in enumerate(texts)}
    assert sum(len(r.spans.split(",")) for r in found.values()) > 1000


def test_a_text_full_of_secrets_takes_linear_time(spark):
    text = "user: bob99 password = hunter2x Zx9aB3aB3aB3aB3aB3aB3aB3 " * 20_000
    start = time.perf_counter()
    row = _scan(spark, [(1, text)])[1]
    assert row.n_assign == 20_000 and row.spans.count(",") == 3 * 20_000 - 1
    assert time.perf_counter() - start < 60
