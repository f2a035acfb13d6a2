from collections import defaultdict
from itertools import combinations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from voltseries.llm.packing import bucket_bounds, length_histogram, pack


def padding(lengths, counts, bounds):
    return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts, strict=True))


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 40), st.integers(1, 9), min_size=1, max_size=9), st.integers(1, 4))
def test_bounds_pad_the_fewest_tokens(histogram, buckets):
    lengths, counts = sorted(histogram), [histogram[n] for n in sorted(histogram)]
    bounds = bucket_bounds(np.array(lengths), np.array(counts), buckets)
    best = min(
        padding(lengths, counts, [*cut, lengths[-1]])
        for k in range(min(buckets, len(lengths)))
        for cut in combinations(lengths[:-1], k)
    )
    assert len(bounds) <= buckets
    assert padding(lengths, counts, bounds) == best


def test_all_words_are_packed_within_the_budget(documents):
    rows = [(i, " ".join(f"w{j}" for j in range(i * 13 % 150)), "en", "s", 0) for i in range(200)]
    found = pack(documents(rows), context=50, buckets=4, budget=400).collect()
    texts, batches = defaultdict(dict), defaultdict(list)
    for r in found:
        texts[r["doc_id"]][r["piece"]] = r["text"]
        batches[r["bucket"], r["batch_group"], r["batch"]].append(r)
        assert r["n_tokens"] == len(r["text"].split()) <= r["bucket"] <= 50
        assert r["padding"] == r["bucket"] - r["n_tokens"]
    assert {i: " ".join(p[k] for k in sorted(p)) for i, p in texts.items()} == {r[0]: r[1] for r in rows}
    for (bucket, _, _), members in batches.items():
        assert len(members) * bucket <= 400 or len(members) == 1
        assert sorted(r["slot"] for r in members) == list(range(len(members)))
    assert len({r["bucket"] for r in found}) == 4
    partial = defaultdict(int)
    for (bucket, group, _), members in batches.items():
        partial[bucket, group] += len(members) < 400 // bucket
    assert all(n <= 1 for n in partial.values())


def test_histogram_counts_every_piece(documents):
    rows = [(1, "a " * 25, "en", "s", 0), (2, "a " * 20, "en", "s", 0), (3, None, "en", "s", 0), (4, "a", "en", "s", 0)]
    lengths, counts = length_histogram(documents(rows), 10)
    assert dict(zip(lengths.tolist(), counts.tolist(), strict=True)) == {0: 1, 1: 1, 5: 1, 10: 4}


def test_edges(documents, edge_rows):
    found = pack(documents(edge_rows), context=512).collect()
    pieces = defaultdict(int)
    for r in found:
        pieces[r["doc_id"]] += 1
    assert pieces[7] == -(-15_001 // 512)
    assert pieces[5] == 2
    assert pieces[2] == pieces[3] == pieces[6] == pieces[None] == 1
    assert sum(r["n_tokens"] for r in found if r["doc_id"] == 7) == 15_001


def test_no_rows(documents):
    assert pack(documents([])).count() == 0
