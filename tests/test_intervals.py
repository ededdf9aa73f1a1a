import random

import pytest
from helpers import rows

from galley.operators.intervals import coverage
from galley.operators.ranking import running_sums


def brute(intervals, frames):
    """Each place of each group looked at by itself."""
    out = []
    for g in sorted({g for g, *_ in intervals + frames}, key=repr):
        places = range(-2, 80)
        depth = {p: sum(a <= p < b for h, a, b in intervals if h == g) for p in places}
        inside = {p: any(a <= p < b for h, a, b in frames if h == g) for p in places}
        kinds = [
            "repeated" if depth[p] > 1 else "beyond" if depth[p] and not inside[p] else "missing" if not depth[p] and inside[p] else None
            for p in places
        ]
        start = 0
        for i in range(1, len(kinds) + 1):
            if i == len(kinds) or kinds[i] != kinds[start]:
                if kinds[start]:
                    out.append((g, kinds[start], places[start], places[start] + i - start))
                start = i
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_coverage_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    groups = ["a", "b", None]
    intervals = [(rng.choice(groups), a := rng.randrange(60), a + rng.randrange(12)) for _ in range(25)]
    frames = [(g, 0, rng.randrange(40, 70)) for g in groups[:2]]
    schema = "g string, start long, end long"
    found = coverage(spark.createDataFrame(intervals, schema).repartition(3), spark.createDataFrame(frames, schema), ["g"])
    assert rows(found, "g", "kind", "first", "until") == brute(intervals, frames)


def test_nothing_to_cover(spark):
    none = spark.createDataFrame([], "g string, start long, end long")
    assert coverage(none, none, ["g"]).count() == 0
    frame = spark.createDataFrame([("a", 0, 9)], "g string, start long, end long")
    assert rows(coverage(none, frame, ["g"])) == [("a", "missing", 0, 9)]


def test_running_sums_by_group(spark):
    data = [(g, i, (i * 7) % 5 - 2) for g in ("a", None) for i in range(200)]
    df = spark.createDataFrame(data, "g string, i long, v long").repartition(7)
    got = {(r["g"], r["i"]): r["v_sum"] for r in running_sums(df, ["i"], ["v"], ["g"]).collect()}
    for g in ("a", None):
        total = 0
        for i in range(200):
            total += (i * 7) % 5 - 2
            assert got[g, i] == total
