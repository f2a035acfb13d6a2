import math
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voltseries.llm import language_id as lid
from voltseries.llm.language_id import accepted_documents, identify, identify_documents, identify_pages

FOLDER = "/root/testdata/sf0.01"
WORDS = {
    "en": "the and of to that with from this which there their would about other people water".split(),
    "de": "der die und das nicht mit sich auch werden einen wurde zwischen jahr durch über".split(),
    "fr": "les des est que dans pour une qui sur pas avec plus être cette mais nous".split(),
}


def corpus(n=240, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = ("en", "de", "fr")[i % 3]
        rows.append((i, " ".join(rng.choice(WORDS[lang]) for _ in range(40)), lang, f"host-{lang}", 0))
    return rows


def test_held_out_accuracy_without_declarations(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    hidden = docs.withColumn("truth", F.col("lang")).withColumn(
        "lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang"))
    )
    found = identify_documents(hidden).join(docs.select("doc_id", F.col("lang").alias("truth")), "doc_id")
    held = found.filter("doc_id % 2 = 1")
    assert held.filter("language = truth").count() >= 0.99 * held.count()
    assert found.count() == docs.count()


def test_clean_documents_are_kept(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert accepted_documents(docs).count() == docs.count()


def test_declaration_and_host_decide_where_the_text_is_short(documents):
    rows = [*corpus(), (1000, "zq", "de", "host-de", 0), (1001, "zq", None, "host-fr", 0), (1002, "the and", "xx", "host-en", 0)]
    found = {r["doc_id"]: r for r in identify_documents(documents(rows)).collect()}
    assert [found[i]["language"] for i in (1000, 1001, 1002)] == ["de", "fr", "en"]


def test_text_overrules_a_wrong_declaration(documents):
    rows = [*corpus(), (1000, corpus()[1][1], "en", "host-en", 0)]
    found = {r["doc_id"]: r for r in identify_documents(documents(rows)).collect()}
    assert found[1000]["language"] == "de"


def test_noise_and_empty_texts_are_rejected(documents):
    rng = random.Random(5)
    noise = " ".join("".join(rng.choice("qxzjkvw") for _ in range(7)) for _ in range(60))
    rows = [*corpus(), (1000, noise, None, "host-en", 0), (1001, None, "en", "host-en", 0), (1002, "12 34 !?", "en", "host-en", 0)]
    docs = documents(rows)
    found = {r["doc_id"]: r for r in identify_documents(docs).collect()}
    assert [found[i]["reason"] for i in (1000, 1001, 1002)] == ["no known language", "no letters", "no letters"]
    assert found[1001]["language"] == "und"
    kept = accepted_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(240))


def test_address_suffix_is_evidence(spark):
    rows = [(i, t, lang, f"h{i % 30}.example.com", "com") for i, t, lang, _, _ in corpus()]
    rows += [(1000, "zzz", None, "h.example.de", "de"), (1001, "zzz", None, "h.example.fr", "fr")]
    frame = spark.createDataFrame(rows, "id long, text string, declared string, host string, suffix string")
    found = {r["id"]: r["language"] for r in identify(frame).collect()}
    assert (found[1000], found[1001]) == ("de", "fr")


def test_pages(spark):
    rows = [
        (i, f"http://{lang}.example.com/{i}", f"<html lang='{lang}'><style>x y z</style><p>{t}</p></html>", "host")
        for i, t, lang, _, _ in corpus()
    ]
    rows += [(900, None, None, "host"), (901, "nothing", "<html><p>der die und das nicht</p>", "host")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    found = {r["page_id"]: r for r in identify_pages(frame).collect()}
    assert all(found[i]["language"] == lang for i, _, lang, _, _ in corpus())
    assert found[0]["suffix"] == "com" and found[900]["host"] is None
    assert (found[901]["language"], found[900]["accepted"]) == ("de", False)


def test_edges(documents, edge_rows):
    found = identify_documents(documents([*edge_rows, *((i + 100, *r) for i, *r in corpus())])).collect()
    assert len(found) == len(edge_rows) + 240
    assert {r["doc_id"]: r["accepted"] for r in found}[5] is True
    kept = accepted_documents(documents([*edge_rows, *((i + 100, *r) for i, *r in corpus())]))
    assert sum(r["doc_id"] == 5 for r in kept.collect()) == 2


def test_no_declared_language_and_no_rows(documents):
    rows = [(1, "some text", None, "a", 0)]
    assert [r["accepted"] for r in identify_documents(documents(rows)).collect()] == [False]
    assert identify_documents(documents([])).count() == 0
    assert accepted_documents(documents([])).count() == 0


def many_languages(count, each=24, seed=3):
    """Made-up languages of thirty words each, over a few common letters."""
    rng = random.Random(seed)
    rows, i = [], 0
    for lang in range(count):
        words = ["".join(rng.choice("abdeghiklmnoprstuvw") for _ in range(rng.randint(3, 8))) for _ in range(30)]
        for _ in range(each):
            rows.append((i, " ".join(rng.choice(words) for _ in range(60)), f"l{lang:03d}", f"host{i % 7}", 0))
            i += 1
    return rows


def test_all_of_eighty_languages_are_known(documents):
    """More languages than a group holds: two passes, and no clean document is lost."""
    rows = many_languages(80)
    assert lid.GROUP < 80
    found = identify_documents(documents(rows)).collect()
    said = {r[0]: r[2] for r in rows}
    assert all(r["accepted"] and r["language"] == said[r["doc_id"]] for r in found)
    assert accepted_documents(documents(rows)).count() == len(rows)


def test_rare_languages_are_kept_as_declared(documents):
    rows = [*corpus(), *((1000 + i, t, "rare", "host-en", 0) for i, t, *_ in many_languages(1, each=5))]
    found = {r["doc_id"]: r for r in identify_documents(documents(rows)).collect()}
    assert all(found[1000 + i]["accepted"] for i in range(5))
    assert accepted_documents(documents(rows)).count() == len(rows)


def test_rows_of_one_id_are_judged_one_by_one(documents):
    rows = [*corpus(), (3, "12 34", "en", "host-en", 0), (None, "12 34", "en", "host-en", 0), (None, "the and of", "en", "a", 0)]
    kept = accepted_documents(documents(rows)).collect()
    assert len(kept) == 241
    assert [r["text"] for r in kept if r["doc_id"] is None] == ["the and of"]


@pytest.mark.parametrize("group", [64, 2])
def test_posterior_equals_a_plain_walk(documents, monkeypatch, group):
    """Every row's fused posterior, recomputed row by row in plain Python."""
    monkeypatch.setattr(lid, "GROUP", group)
    rows = [*corpus(120), *many_languages(3, each=25, seed=9)]
    rows = [(10 * i, t, None if i % 5 == 0 else lang, host, 0) for i, (_, t, lang, host, _) in enumerate(rows)]
    rows += [(1, "der the les", "fr", "host1", 0), (2, "zq", None, "host2", 0), (3, "aa", "de", None, 0)]
    frame = lid.document_rows(documents(rows))
    names = list(lid.declared_languages(frame))
    assert len(names) == 6
    padded = frame.withColumn("text", F.concat(F.lit(" "), F.coalesce("text", F.lit("")), F.lit(" ")))
    logs, _ = lid.fit(padded, lid.declared_languages(frame))
    grams = {}
    for i, text, *_ in rows:
        hashed, spans = next(lid._trigrams(pa.array([f" {text} "])))
        grams[i] = [int(g) for g in hashed[spans[0][0] : spans[0][1]] if g != 1 << lid.BITS]
    mean = {i: [sum(line[g] for g in gs) / max(len(gs), 1) for line in logs] for i, gs in grams.items()}
    votes, overall = defaultdict(Counter), Counter(range(6))
    for i, _, _, host, _ in rows:
        best = max(range(6), key=lambda x: (mean[i][x], -x))
        votes[host][best] += 1
        overall[best] += 1
    # Documents have no suffix: its counts are those of all rows.
    want = {}
    everywhere = [overall[x] / sum(overall.values()) for x in range(6)]
    all_votes = sum(votes.values(), Counter())
    for i, _, lang, host, _ in rows:
        total = sum(all_votes.values())
        wide = [(all_votes[x] + 10 * everywhere[x]) / (total + 10) for x in range(6)]
        own = sum(votes[host].values())
        log = []
        for x in range(6):
            prior = (votes[host][x] + 10 * wide[x]) / (own + 10)
            said = 0.0 if lang is None else math.log(0.9 if names[x] == lang else 0.1 / 5)
            log.append(math.log(prior) + min(len(grams[i]), 200) * mean[i][x] + said)
        top = max(range(6), key=lambda x: (log[x], -x))
        want[i] = (names[top], 1 / sum(math.exp(v - log[top]) for v in log))
    for r in identify_documents(documents(rows)).collect():
        assert r["language"] == want[r["doc_id"]][0]
        assert r["posterior"] == pytest.approx(want[r["doc_id"]][1], rel=1e-6)
