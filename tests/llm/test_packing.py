"""Packing: nothing lost, nothing overlaps, and bins as a plain search would choose them."""

import itertools
import random
from collections import defaultdict

from pyspark.sql import functions as F

from autostrata.llm.packing import Packer, pack


def _plain_best_fit(pieces, lengths, bounds, plan):
    """What each bin holds, looking at every bin for every piece; of equal rooms the last one used."""
    bins = []
    for step, piece in enumerate(pieces):
        fitting = [(b["size"] - b["used"], -b["step"], i) for i, b in enumerate(bins) if b["size"] - b["used"] >= piece]
        if fitting:
            chosen = bins[min(fitting)[2]]
        else:
            chosen = {"size": plan[sum(b < piece for b in bounds)], "used": 0}
            bins.append(chosen)
        chosen["used"] += piece
        chosen["step"] = step
    return [b["used"] for b in bins]


def _cost(used, lengths, overhead):
    return sum(next(n for n in lengths if n >= u) + overhead for u in used)


def test_bins_are_filled_as_by_a_plain_search():
    random.seed(1)
    for _ in range(50):
        lengths = random.choice([(10, 20, 40), (15, 40), (7, 16, 40)])
        pieces = sorted((random.randint(1, 40) for _ in range(60)), reverse=True)
        packer = Packer(lengths, 3)
        places = packer.pack(pieces)
        assert packer.used == _plain_best_fit(pieces, lengths, packer.bounds(), packer.plan)
        assert packer.size == [next(n for n in lengths if n >= u) for u in packer.used]
        used = defaultdict(int)
        for piece, (bin, offset) in zip(pieces, places):
            assert offset == used[bin]
            used[bin] += piece
        assert all(used[b] <= packer.size[b] for b in used)


DISTRIBUTIONS = {
    "lognormal": lambda r: max(1, int(r.lognormvariate(5.6, 1))),
    "middle": lambda r: r.randint(520, 1000),
    "halves": lambda r: r.randint(1400, 2040),
    "small": lambda r: r.randint(200, 900),
    "wide": lambda r: r.randint(1, 4096),
}


def test_plans_are_never_worse_than_the_best_single_length():
    random.seed(4)
    better = set()
    for lengths in ((512, 1024, 2048, 4096), (600, 1000, 1536), (512, 1280, 3000)):
        for name, draw in DISTRIBUTIONS.items():
            pieces = sorted((min(draw(random), lengths[-1]) for _ in range(2000)), reverse=True)
            packer = Packer(lengths, 64)
            packer.pack(pieces)
            single = min(
                _cost(_plain_best_fit(pieces[:400], lengths, [lengths[-1]], [n]), lengths, 64)
                for n in lengths if n >= pieces[0]
            )
            few = Packer(lengths, 64)
            few.pack(pieces[:400])
            assert _cost(few.used, lengths, 64) <= single
            plans = [tuple(max(n, packer.smallest(b)) for b in packer.bounds()) for n in lengths]
            least = min(packer.cost(pieces, plan) for plan in plans)
            assert _cost(packer.used, lengths, 64) <= least
            better |= {name} if _cost(packer.used, lengths, 64) < least else set()
    assert len(better) >= 2


def test_a_plan_for_two_kinds_of_pieces_is_the_best_of_all():
    """Pieces of 9 fit a bin of 10, those of 4 one of 16: no single length serves both."""
    pieces, packer = [9] * 20 + [4] * 60, Packer((10, 16), 3)
    packer.pack(pieces)
    bounds = packer.bounds()
    every = itertools.product(*([n for n in (10, 16) if n >= b] for b in bounds))
    costs = [_cost(_plain_best_fit(pieces, (10, 16), bounds, plan), (10, 16), 3) for plan in every]
    assert _cost(packer.used, (10, 16), 3) == min(costs)
    assert sorted(set(packer.size)) == [10, 16]


def test_whole_documents_in_bins(spark):
    random.seed(2)
    rows = [(i, " ".join(["w"] * random.choice((0, 1, 5, 30, 64, 200)))) for i in range(300)]
    rows += [(300, None), (301, ""), (302, "a b \n c"), (303, "x" * 1_000_000), (304, "w " * 5000), (1, "again")]
    docs = spark.createDataFrame([(i, t, 1, "b") for i, t in rows], "doc_id long, text string, pool int, bin string")
    out = pack(docs, lengths=(16, 32, 64), pool=40).collect()
    words = defaultdict(int)
    for i, t in rows:
        words[i] += len([w for w in (t or "").replace(" ", "_").split(" ") if w.strip()])
    total = defaultdict(int)
    bins = defaultdict(list)
    for r in out:
        total[r.doc_id] += r.n_tokens
        if r.n_tokens:
            bins[r.pool, r.bin].append((r.bin_offset, r.n_tokens, r.bin_length))
        else:
            assert r.bin is None and r.bin_length is None
    assert total == words
    for parts in bins.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(parts, parts[1:]))
        used = parts[-1][0] + parts[-1][1]
        assert {p[2] for p in parts} == {min(n for n in (16, 32, 64) if n >= used)}
    assert len({r.pool for r in out if r.bin is not None}) > 3


def test_token_counts_of_the_caller_and_empty_table(spark):
    docs = spark.createDataFrame([(1, 100), (2, None)], "doc_id long, n int")
    rows = pack(docs, tokens=F.col("n"), lengths=(64, 32)).orderBy("doc_id", "piece").collect()
    assert [(r.doc_id, r.piece, r.first_token, r.n_tokens) for r in rows] == [(1, 0, 0, 64), (1, 1, 64, 36), (2, 0, 0, 0)]
    assert pack(docs.limit(0), tokens=F.col("n")).count() == 0


def test_one_id_spreads_over_the_pools(spark):
    docs = spark.createDataFrame([(None if i % 2 else 7, 3) for i in range(2000)], "doc_id long, n int")
    out = pack(docs, tokens=F.col("n"), lengths=(16, 32), pool=100).groupBy("pool").count().collect()
    assert len(out) == 20 and sum(r["count"] for r in out) == 2000
    assert max(r["count"] for r in out) < 200
