import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from voltseries.llm.mixing import hypergeometric, mix, mixed_documents, shard_quotas


def corpus(n, sources=5, hot=0.5):
    rows = []
    for i in range(n):
        source = "hot" if i < n * hot else f"s{i % sources}"
        rows.append((i, " ".join(["w"] * (5 + i * 7 % 90)), "en", source, 0))
    return rows


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """Share by weight, cap, and share the excess again until no source is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        left = total - sum(fixed.values())
        free = [s for s in order if s not in fixed]
        share = sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / share > cap * sizes[s]]
        if not above:
            return fixed | {s: left * weight[s] / share for s in free}
        fixed |= {s: cap * sizes[s] for s in above}


def by_source(rows, found):
    taken = defaultdict(int)
    source = {r[0]: r[3] for r in rows}
    for r in found:
        taken[source[r["doc_id"]]] += r["taken"]
    return taken


@pytest.mark.parametrize(("n", "sources", "hot"), [(400, 5, 0.5), (300, 7, 0.02), (60, 3, 0.9)])
def test_targets_and_taken_words(documents, n, sources, hot):
    rows = corpus(n, sources, hot)
    found = mix(documents(rows)).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(r[1].split())
    want = brute_targets(sizes)
    source = {r[0]: r[3] for r in rows}
    assert len(found) == n
    for r in found:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(want[s])
        assert r["taken"] == r["size"] * len(r["shards"]) <= 3 * r["size"]
    for s, words in by_source(rows, found).items():
        assert abs(words - want[s]) <= 48, s


@pytest.mark.parametrize("seed", range(3))
def test_a_long_document_does_not_end_a_source(documents, seed):
    """Half of the source's words are asked for, and one document is longer than that."""
    rows = [(i, " ".join(["w"] * 10), "en", "a", 0) for i in range(200)]
    rows += [(1000, " ".join(["w"] * 2200), "en", "a", 0), (1001, " ".join(["w"] * 700), "en", "a", 0)]
    rows += [(2000 + i, " ".join(["w"] * 5), "en", "b", 0) for i in range(1200)]
    found = mix(documents(rows), weights=(1, 5), seed=seed).collect()
    target = next(r["target"] for r in found if r["doc_id"] == 0)
    assert 1500 < target < 2200
    assert abs(by_source(rows, found)["a"] - target) <= 10


def test_reruns_and_other_partitions_agree(documents):
    rows = corpus(200)
    one = {r["doc_id"]: (r["taken"], r["shards"]) for r in mix(documents(rows)).collect()}
    two = {r["doc_id"]: (r["taken"], r["shards"]) for r in mix(documents(rows[::-1]).repartition(5)).collect()}
    assert one == two


def test_shards_get_exact_quotas(spark):
    quotas = {0: 1000, 1: 37, 2: 0, 3: 411}
    frame = spark.createDataFrame(list(quotas.items()), "source_no int, quota long")
    ends = {r["source_no"]: r["ends"] for r in shard_quotas(frame, shards=13).collect()}
    parts = {s: [b - a for a, b in zip([0, *e], e, strict=False)] for s, e in ends.items()}
    assert {s: sum(p) for s, p in parts.items()} == quotas
    assert all(x >= 0 for p in parts.values() for x in p)
    sums = [sum(p[i] for p in parts.values()) for i in range(13)]
    assert max(sums) - min(sums) <= math.ceil(math.log2(13))
    assert len(set(parts[0])) > 1


@pytest.mark.parametrize(("total", "marked", "drawn"), [(50, 20, 10), (9, 9, 4), (12, 0, 5), (7, 3, 7), (4000, 900, 1500)])
def test_draws_follow_the_hypergeometric_distribution(spark, total, marked, drawn):
    n = 3000
    lit = [F.lit(x).cast("bigint") for x in (total, marked, drawn)]
    got = [r["x"] for r in spark.range(n).select(hypergeometric(*lit, F.col("id")).alias("x")).collect()]
    mean = drawn * marked / total
    variance = mean * (1 - marked / total) * (total - drawn) / max(total - 1, 1)
    assert all(max(0, drawn - total + marked) <= x <= min(marked, drawn) for x in got)
    assert abs(sum(got) / n - mean) <= 5 * math.sqrt(variance / n) + 1e-9
    spread = sum((x - mean) ** 2 for x in got) / n
    assert spread == pytest.approx(variance, rel=0.15, abs=1e-9)


def test_mixed_documents_are_the_draws(documents):
    rows = corpus(120)
    docs = documents(rows)
    drawn = {r["doc_id"]: len(r["shards"]) for r in mix(docs).collect()}
    found = mixed_documents(docs)
    assert found.columns == docs.columns
    counts = Counter(r["doc_id"] for r in found.collect())
    assert counts == {i: k for i, k in drawn.items() if k}


def test_edges(documents, edge_rows):
    found = mix(documents(edge_rows)).collect()
    assert len(found) == len(edge_rows)
    assert all(r["taken"] <= 3 * r["size"] for r in found)
    assert {r["doc_id"]: r["size"] for r in found}[6] == 0
    assert mixed_documents(documents(edge_rows)).count() >= 0


def test_no_words_and_no_rows(documents):
    found = mix(documents([(1, "", "en", "a", 0), (2, None, "en", None, 0)])).collect()
    assert [(r["taken"], r["target"]) for r in found] == [(0, 0.0)] * 2
    assert mix(documents([])).count() == 0
    assert mixed_documents(documents([])).count() == 0


def test_uneven_sizes_come_near_in_few_rounds(documents):
    """Short and long documents by turns: a gap is filled by halves, not document by document."""
    rows = [(i, " ".join(["w"] * (1 if i % 2 else 400 - i)), "en", "a", 0) for i in range(240)]
    rows += [(2000 + i, " ".join(["w"] * 5), "en", "b", 0) for i in range(9000)]
    found = mix(documents(rows), weights=(1, 3)).collect()
    want = next(r["target"] for r in found if r["doc_id"] == 0)
    # No document between 1 and 162 words: the last one comes within half of that.
    assert abs(by_source(rows, found)["a"] - want) <= 81


def test_null_and_repeated_ids_are_drawn_apart(documents):
    rows = [(None if i % 2 else 7, f"{'w ' * (5 + i % 9)}{i}", "en", "a", 0) for i in range(300)]
    rows += [(1000 + i, "w " * 20, "en", "b", 0) for i in range(300)]
    found = mix(documents(rows), weights=(1, 4)).collect()
    own = [r for r in found if r["doc_id"] is None or r["doc_id"] == 7]
    assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 13
    assert len({r["taken"] > r["size"] for r in own}) == 2 or own[0]["target"] < own[0]["source_size"]


def test_shards_are_ordered_ranges(documents, monkeypatch):
    """Many partitions to a shard: same rows, and no partition holds two shards."""
    from voltseries.llm import mixing

    docs = documents(corpus(200))
    whole = Counter(r["doc_id"] for r in mixed_documents(docs, shards=3).collect())
    monkeypatch.setattr(mixing, "PART_WORDS", 1000)
    cut = mixed_documents(docs, shards=3)
    assert cut.rdd.getNumPartitions() > 6
    assert Counter(r["doc_id"] for r in cut.collect()) == whole
