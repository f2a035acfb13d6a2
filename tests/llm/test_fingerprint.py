import hashlib
import random

from voltseries.llm.fingerprint import FARTHEST, difference, digest, edited, fingerprint_pairs, likeness


def brute(rows):
    """One row per document, walking the ids downwards."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for n, (i, text) in enumerate(order):
        text, following = text or "", order[(n + 1) % len(order)][1] or ""
        changed = edited(text, following)
        out[i] = (
            len(text),
            hashlib.sha256(changed.encode()).hexdigest(),
            digest(text),
            digest(changed),
            likeness(digest(text), digest(changed)),
            likeness(digest(text), digest(following)),
        )
    return out


FIELDS = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def rows_of(frame):
    return {r["doc_id"]: tuple(r[f] for f in FIELDS) for r in frame.collect()}


def test_neighbours_over_many_ranges(spark):
    rng = random.Random(3)
    rows = [(i * 3, "".join(rng.choice("abc é😀 \n") for _ in range(rng.randint(0, 60)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert rows_of(fingerprint_pairs(docs)) == brute(rows)


def test_edges(documents, edge_rows):
    rows = [r for r in edge_rows if r[0] != 5]
    assert rows_of(fingerprint_pairs(documents(rows))) == brute([r[:2] for r in rows])


def test_repeated_rows_stay(documents, edge_rows):
    found = fingerprint_pairs(documents(edge_rows)).collect()
    assert len(found) == len(edge_rows)
    assert len({r["fingerprint"] for r in found if r["doc_id"] in (1, 5)}) == 1


def test_single_document_is_its_own_next(documents):
    row = fingerprint_pairs(documents([(1, "abcdefghi", "en", "s", 9)])).first()
    assert row["near_next"] == 1.0
    assert row["edited_sha256"] == hashlib.sha256(b"abcdefabc").hexdigest()


def test_no_rows(documents):
    assert fingerprint_pairs(documents([])).count() == 0


def test_score_is_bounded_and_symmetric():
    rng = random.Random(1)
    texts = ["", "a", "ab", "abc", "abcd"] + ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (10, 500, 5000)]
    for a in texts:
        assert difference(digest(a), digest(a)) == 0
        for b in texts:
            assert difference(digest(a), digest(b)) == difference(digest(b), digest(a)) <= FARTHEST


def test_edited_texts_are_nearer_than_others():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
    texts = [" ".join(rng.choice(words) for _ in range(600)) for _ in range(20)]
    for a, b in zip(texts, texts[1:], strict=False):
        assert likeness(digest(a), digest(edited(a, b))) > likeness(digest(a), digest(b))


def test_long_text_is_counted_in_steps():
    text = "".join(chr(97 + i * i % 23) for i in range(1_100_000))
    assert len(digest(text)) == 4 + 128
    assert digest(text) != digest(text[:-60_000] + "z" * 60_000)
