import random

import pytest

from voltseries.llm.components import component_labels
from voltseries.llm.ngram_join import ngram_classes, one_per_component


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        low = low.replace(blank, " ")
    return [w for w in low.split(" ") if w]


def shingles(text, k=5):
    w = words_of(text)
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}


def brute(rows, percent=80):
    """Smallest id reachable by links, comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


def near_copies(seed, families, size, length, edits):
    """Families of texts that differ in some words, with passages shared among families."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    rows, number = [], 0
    for _ in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(*length))] + passage
        for _ in range(rng.randint(1, size)):
            text = list(base)
            for _ in range(rng.randint(0, edits)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((number, " ".join(text)))
            number += 1
    rng.shuffle(rows)
    return [(i, t) for i, (_, t) in enumerate(rows)]


@pytest.mark.parametrize(
    ("seed", "families", "size", "length", "edits"),
    [(1, 12, 8, (20, 120), 6), (2, 3, 40, (60, 80), 8), (3, 60, 2, (1, 30), 2), (4, 2, 40, (5, 200), 3)],
)
def test_components_equal_all_pairs(spark, seed, families, size, length, edits):
    rows = near_copies(seed, families, size, length, edits)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: r for r in ngram_classes(docs).collect()}
    want = brute(rows)
    assert {i: r["component_id"] for i, r in found.items()} == want
    assert {i: r["n_shingles"] for i, r in found.items()} == {i: len(shingles(t)) for i, t in rows}


def test_other_thresholds(spark):
    rows = near_copies(9, 6, 10, (10, 60), 10)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in ngram_classes(docs, percent=55).collect()}
    assert found == brute(rows, 55)


def test_edges(documents, edge_rows):
    found = sorted(ngram_classes(documents(edge_rows)).collect(), key=str)
    assert len(found) == len(edge_rows)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[5]["component_id"] == 1
    assert by_id[1]["n_shingles"] == 2
    assert by_id[2]["n_shingles"] == by_id[3]["n_shingles"] == by_id[6]["n_shingles"] == 0
    assert by_id[2]["component_id"] == 2
    assert by_id[4]["n_shingles"] == 1
    assert by_id[None]["component_id"] is None
    assert by_id[7]["n_shingles"] == len(shingles(edge_rows[8][1]))


def test_case_and_blanks_do_not_matter(spark):
    rows = [(1, "A b\tc  D e f"), (2, "a B c d\ne f"), (3, "É b c d e f"), (4, "é b c d e f")]
    found = {r["doc_id"]: r["component_id"] for r in ngram_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: 1, 2: 1, 3: 3, 4: 4}


def test_one_stays_of_each_component(documents, edge_rows):
    kept = one_per_component(documents(edge_rows))
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"]) == [1, 2, 3, 4, 6, 7, 8]
    assert kept.columns == documents(edge_rows).columns


def test_empty_table(documents):
    assert ngram_classes(documents([])).count() == 0
    assert one_per_component(documents([])).count() == 0


def test_components_of_a_path_a_star_and_a_ring(spark):
    path = [(i, i + 1) for i in range(0, 40)]
    star = [(100, i) for i in range(101, 140)]
    ring = [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    links = spark.createDataFrame([*path, *star, *ring, (5, 5), (None, 3)], "a long, b long")
    found = {r["vertex"]: r["component"] for r in component_labels(links).collect()}
    assert found == {v: 0 for v in range(41)} | {v: 100 for v in range(100, 140)} | {v: 200 for v in range(200, 209)}
