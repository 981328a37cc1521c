"""Closest names against brute force."""

import random

import pytest

from autostrata.operators import closest_names


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, previous + (x != y))
    return row[-1]


@pytest.mark.parametrize("limit", [0, 1, 2])
def test_closest_names_equals_brute_force(spark, limit):
    rng = random.Random(limit)
    word = lambda: "".join(rng.choice("ABC") for _ in range(rng.randrange(0, 7)))
    names = {(rng.choice("XY"), word()) for _ in range(80)}
    candidates = [(rng.choice("XY"), word(), rng.choice([None, "1", "2"])) for _ in range(120)]
    expected = set()
    for block, name in names:
        found = sorted(
            (_distance(name, c), c, v is not None, v or "") for b, c, v in candidates if b == block
        )
        if found and found[0][0] <= limit:
            distance, best, coded, value = found[0]
            expected.add((block, name, best, value if coded else None, distance))
    got = closest_names(
        spark.createDataFrame(sorted(names), "uf string, nm string"),
        spark.createDataFrame(candidates, "uf string, nm string, cd string"),
        block="uf", name="nm", value="cd", max_distance=limit,
    )
    assert {tuple(r) for r in got.collect()} == expected
    assert got.columns == ["uf", "nm", "nm_candidato", "cd", "nr_distancia"]


def test_many_names_with_a_common_prefix_do_not_all_meet(spark):
    """Far-apart names of one block share no join key, however alike their beginnings are."""
    rng = random.Random(0)
    numbers = rng.sample(range(10**9), 2000)
    names = [("X", f"MUNICIPIO{n:09d}") for n in numbers]
    candidates = [("X", name + "S", name[-9:]) for _, name in names]
    got = closest_names(
        spark.createDataFrame(names, "uf string, nm string"),
        spark.createDataFrame(candidates, "uf string, nm string, cd string"),
        block="uf", name="nm", value="cd", max_distance=1,
    )
    rows = got.collect()
    assert len(rows) == len(names)
    assert all(r.nm_candidato == r.nm + "S" and r.nr_distancia == 1 for r in rows)


def test_large_distances_are_refused(spark):
    names = spark.createDataFrame([("X", "ABC", "1")], "uf string, nm string, cd string")
    with pytest.raises(ValueError, match="max_distance"):
        closest_names(names, names, "uf", "nm", "cd", max_distance=4)
