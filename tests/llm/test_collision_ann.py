import numpy as np
import pytest

from voltseries.llm import collision_ann
from voltseries.llm.collision_ann import cosines, nearest

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, v int, dim string"


def brute(rows, k=5, every=50):
    """The k nearest of each query, by comparing it with all vectors."""
    rows = sorted((i, np.asarray(v, np.float64)) for i, v in rows)
    ids, vectors = np.array([i for i, _ in rows]), np.stack([v for _, v in rows])
    out = {}
    for i, v in rows:
        if i % every == 0:
            score = cosines(vectors, v)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def answers(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def recall(found, want):
    return np.mean([len({i for i, _ in found[q]} & {i for i, _ in w}) / len(w) for q, w in want.items()])


def test_recall_on_the_whole_table(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    want = brute([(r["vec_id"], r["embedding"]) for r in table.collect()])
    found = answers(nearest(table))
    assert {q: len(v) for q, v in found.items()} == {q: 5 for q in want}
    assert recall(found, want) >= 0.9


@pytest.mark.parametrize("block", [64, 500])
def test_recall_over_blocks(spark, monkeypatch, block):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((8, 32))
    rows = [(i, (centres[i % 8] + 0.7 * rng.standard_normal(32)).tolist()) for i in range(1500)]
    monkeypatch.setattr(collision_ann, "BLOCK_ROWS", block)
    monkeypatch.setattr(collision_ann, "QUERY_ROWS", 7)
    table = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA).repartition(4)
    stored_rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    want, found = brute(stored_rows), answers(nearest(table))
    assert recall(found, want) >= 0.9
    exact = dict(stored_rows)
    for q, near in found.items():
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
        for i, score in near:
            a, b = (np.asarray(exact[j], np.float64) for j in (q, i))
            assert score == pytest.approx(float(a @ b / np.sqrt((a @ a) * (b @ b))), abs=1e-12)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [3.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, []), (6, [0.0, 0.0]),
        (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (None, [1.0, 0.0]), (10, [1.0, 0.0, 0.0]), (50, [1.0, 0.0]),
        (50, [1.0, 0.0]), (100, [1.0, 0.0, 0.0]), (150, [0.0, 0.0]), (-50, [-1.0, 0.0]),
    ]
    found = answers(nearest(spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA)))
    assert [i for i, _ in found[0]] == [1, 2, 50, 3, -50]
    assert [s for _, s in found[0]] == [1.0, 1.0, 1.0, 0.0, -1.0]
    assert [i for i, _ in found[50]] == [0, 1, 2, 3, -50]
    assert [i for i, _ in found[100]] == [10]
    assert set(found) == {0, 50, 100, -50}


def test_many_equal_vectors(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(600)]
    found = answers(nearest(spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA)))
    assert all([i for i, _ in near] == [j for j in range(6) if j != q][:5] for q, near in found.items())


def test_no_rows(spark):
    assert nearest(spark.createDataFrame([], SCHEMA)).count() == 0
