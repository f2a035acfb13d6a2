import math
import random

import pytest

from voltseries.llm import hard_negatives as hn


def brute(rows):
    """The contract, row by row."""
    used = set()
    for vec_id, label, vector in rows:
        if None in (vec_id, label, vector) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        used.add((vec_id, label, tuple(math.floor(256 * x) for x in vector)))
    out = []
    for a in used:
        if a[0] % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(a[2], r[2], strict=True)), r[0], r[1]) for r in used if r != a and len(r[2]) == len(a[2])]
        same = sorted(s for s in scored if s[2] == a[1])[:5]
        for score, positive, _ in same:
            p = -score
            fits = sorted(s for s in scored if s[2] != a[1] and 80 * p <= -100 * s[0] <= 100 * p)[:5]
            out += [(a[0], positive, i + 1, s[1], p, -s[0]) for i, s in enumerate(fits)]
    return sorted(out)


def frame(spark, rows):
    wide = [(v, i, label, 3, "x", 1.0) for i, label, v in rows]
    return spark.createDataFrame(
        wide, "embedding array<double>, vec_id long, label int, rank int, mark string, score double"
    ).repartition(3)


def result(spark, rows):
    return sorted(tuple(r) for r in hn.hard_negatives(frame(spark, rows)).collect())


def random_rows(n, dim=6, seed=1):
    rng = random.Random(seed)
    # Few distinct values, so that scores tie.
    return [(i, rng.randrange(10), [rng.choice((-0.5, 0.1, 0.25, 0.5)) for _ in range(dim)]) for i in range(n)]


@pytest.mark.parametrize("block", [16_384, 37])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(hn, "BLOCK_ROWS", block)
    monkeypatch.setattr(hn, "ANCHOR_ROWS", 3 if block < 100 else 4096)
    rows = random_rows(620)
    want = brute(rows)
    assert len(want) > 50
    assert result(spark, rows) == want


def test_edges(spark):
    rows = random_rows(330, seed=4)
    rows += rows[:5]  # repeated rows
    rows += [(None, 1, [0.5] * 6), (400, None, [0.5] * 6), (500, 1, None), (501, 1, [0.5, None, 0.0, 0.0, 0.0, 0.0])]
    rows += [(600, 1, [float("nan")] + [0.0] * 5), (601, 2, [float("inf")] + [0.0] * 5), (700, 3, []), (701, 3, [])]
    rows += [(800, 4, [0.5, 0.5]), (801, 4, [0.5, 0.25]), (802, 5, [0.5, 0.25])]
    assert result(spark, rows) == brute(rows)
    assert result(spark, []) == []
    assert result(spark, [(100, 1, [1.0])]) == []


def test_large_components_are_exact(spark):
    rows = [(i, 1 + i % 2, [float(2**20 + i), 0.5, float(-(2**21) + 3 * i)]) for i in range(0, 220, 2)]
    rows += [(301, 1, [1e300, 0.0, 0.0])]
    got = result(spark, rows)
    # No score of the last row fits in 64 bits.
    assert got == brute(rows[:-1])
    assert len(got) > 20


def test_one_hot_label_and_ties(spark):
    rows = [(i, 3 if i % 3 else 4, [0.5, 0.5, 0.5]) for i in range(1, 240)] + [(0, 2, [0.5, 0.5, 0.5])]
    assert result(spark, rows) == brute(rows)
