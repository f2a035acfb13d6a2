import random
import re
from collections import Counter, defaultdict

import pytest

from voltseries.llm import collocations as col


def brute(rows, longest=3, least=10, held=50, top=2000):
    counts = defaultdict(Counter)
    for _, text, lang, *_ in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    counts["und" if lang is None else lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        found = []
        for p, a in candidates.items():
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            inside = any(
                100 * c >= held * a and any(q[s : s + len(p)] == p for s in range(len(q) - len(p) + 1))
                for q, c in candidates.items()
                if len(q) > len(p)
            )
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (score, a, phrase, left, right) in enumerate(sorted(found)[:top]):
            out.append((lang, i + 1, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def result(frame, **kw):
    return sorted(tuple(r) for r in col.collocations(frame, **kw).collect())


def random_rows(n=160, seed=1):
    rng = random.Random(seed)
    words = "Alpha beta gamma delta é ß 漢 zz-top eta THE of and".split()
    rows = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "!?"]) for _ in range(80))
        rows.append((i, text, rng.choice(["en", "de", None, "und"]), "s", 0))
    return rows


@pytest.mark.parametrize("kw", [{}, {"top": 7}, {"longest": 4, "least": 4, "held": 30}, {"longest": 2}])
def test_equals_brute_force(documents, kw):
    rows = random_rows()
    want = brute(rows, **kw)
    assert len({w[0] for w in want}) == 3 and len(want) > 10
    kw = {"held_percent" if k == "held" else k: v for k, v in kw.items()}
    assert result(documents(rows), **kw) == want


def test_overlaps_repeats_and_long_pieces(documents):
    rows = [(1, "a a a a a a", "en", "s", 0)] * 5 + [(2, "x y " * 20_000, "en", "s", 0), (3, "p q r" + ". p q r" * 30, "en", "s", 0)]
    found = result(documents(rows), least=3)
    assert found == brute(rows, least=3)
    assert any(r[2] == "x y x" for r in found)


def test_edges(documents, edge_rows):
    assert result(documents(edge_rows), least=2) == brute(edge_rows, least=2)
    assert result(documents([])) == []
    assert result(documents([(1, None, None, "s", 0), (2, " .,!\t", "en", "s", 0)])) == []


def test_words_that_share_a_hash_get_another_seed(documents, monkeypatch):
    real, seeds = col._hash, []

    def poor(seed):
        seeds.append(seed)
        return col.F.lit(7).cast("long") if seed == 0 else real(seed)

    monkeypatch.setattr(col, "_hash", poor)
    rows = random_rows(60)
    assert result(documents(rows)) == brute(rows)
    assert set(seeds) == {0, 1}


def test_large_counts_do_not_overflow(spark):
    rows = [("en", [1], 9 * 10**15), ("en", [2], 9 * 10**15), ("en", [1, 2], 8 * 10**15)]
    groups = spark.createDataFrame(rows, "lang string, words array<long>, f long")
    found = col._scored(groups).collect()
    assert [r["score"] for r in found] == [10**6 * (8 * 10**15) ** 2 // (9 * 10**15) ** 2]


def test_occurrences_are_joined_without_a_shuffle(documents, spark, monkeypatch):
    plans = []
    store = col._counted

    def seen(rows, k, least):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return store(rows, k, least)

    monkeypatch.setattr(col, "_counted", seen)
    before = spark.conf.get(col._BY_PIECE)
    result(documents(random_rows(40)))
    assert "SortMergeJoin" in plans[-1]
    assert not [x for x in ("(run", "(piece", "(_r") if f"Exchange hashpartitioning{x}" in plans[-1]]
    assert spark.conf.get(col._BY_PIECE) == before
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("occurrences_")]


def test_occurrences_hold_one_place_and_end_with_their_piece(documents, monkeypatch):
    kept = []
    store = col._Relations.store
    monkeypatch.setattr(col._Relations, "store", lambda self, rows: kept.append(rows.columns) or store(self, rows))
    rows = [(i, "\tÉ Aa\tbB  . cC DD ,,é x Éa. \t z", "en", "s", 0) for i in range(12)]
    assert result(documents(rows)) == brute(rows)
    assert kept == [["run", "place", "w1"], ["run", "place", "w1", "w2"]]
