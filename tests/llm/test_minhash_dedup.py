import random

import numpy as np
import pytest
from conftest import words_of

from voltseries.llm import minhash_dedup
from voltseries.llm.minhash_dedup import BANDS, HASHES, ROWS, near_duplicates, signatures


def shingles(text, k=4):
    w = words_of(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k=4, percent=80):
    sets = [shingles(t, k) for _, t, *_ in rows]
    reach = {r[0]: {r[0]} for r in rows if r[0] is not None}
    edges = []
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if None not in (rows[i][0], rows[j][0]) and a and b and 100 * len(a & b) >= percent * len(a | b):
                edges.append((rows[i][0], rows[j][0]))
    low = {d: d for d in reach}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return sorted(
        (str(r[0]), len(s), str(low.get(r[0])), r[0] is None or low[r[0]] == r[0]) for r, s in zip(rows, sets, strict=True)
    )


def result(documents, rows, **kw):
    found = near_duplicates(documents(rows), **kw).collect()
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in found)


def families(seed, n_families=8, size=12, length=70):
    """Chains of edits: neighbours link, the ends often do not."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, i = [], 0
    for _ in range(n_families):
        text = [rng.choice(vocabulary) for _ in range(length)]
        for _ in range(size):
            rows.append((i, " ".join(text), "en", "a", 0))
            i += 1
            text = list(text)
            for _ in range(rng.choice((0, 1, 1, 2, 3))):
                text[rng.randrange(length)] = rng.choice(vocabulary)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "block"), [(1, 1_000_000), (2, 400)])
def test_equals_all_pairs(documents, seed, block, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK_ITEMS", block)
    rows = families(seed)
    want = brute(rows)
    assert len({w[2] for w in want}) < len(rows) // 2
    assert result(documents, rows) == want


@pytest.mark.parametrize("block", [1_000_000, 2_000])
def test_a_family_around_no_centre(documents, block, monkeypatch):
    """Members differ from a common text in their own places: many pairs lie near the threshold."""
    monkeypatch.setattr(minhash_dedup, "BLOCK_ITEMS", block)
    rng = random.Random(7)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(60):
        text = list(base)
        for place in rng.sample(range(200), rng.choice((2, 4, 5, 6))):
            text[place] = f"x{i}-{place}"
        rows.append((100 - i, " ".join(text), "en", "a", 0))
    assert result(documents, rows) == brute(rows)


def test_edges(documents, edge_rows):
    rows = [*edge_rows, *((i + 50, *r) for i, *r in families(5, 2, 4)[:6]), (9, None, None, None, None)]
    assert result(documents, rows) == brute(rows)
    assert result(documents, []) == []


def test_rows_of_one_id_tie_their_texts(documents):
    base = [f"w{i}" for i in range(60)]
    a, b = " ".join(base), " ".join(f"v{i}" for i in range(60))
    near = " ".join([*base[:-1], "other"])
    rows = [(3, b, "en", "a", 0), (5, b, "en", "a", 0), (5, a, "en", "a", 0), (9, near, "en", "a", 0)]
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(documents(rows)).collect()} == {3: 3, 5: 3, 9: 3}


def test_many_equal_rows(documents):
    rows = [(i, "one two three four five six seven", "en", "a", 0) for i in range(300)]
    assert {r["component_id"] for r in near_duplicates(documents(rows)).collect()} == {0}


def test_minima_estimate_the_similarity():
    rng = np.random.default_rng(1)
    items = rng.integers(-(2**63), 2**63 - 1, 3000)
    left, right = signatures([np.sort(items[:2000]), np.sort(items[500:2500])])
    assert abs((left == right).mean() - 0.6) < 0.12
    assert (1 - 0.8**ROWS) ** BANDS < 2e-7 and BANDS * ROWS == HASHES
    assert (signatures([items[:5], items, items[7:8]])[1] == signatures([items])[0]).all()
