import pytest

from voltseries.llm.license_scan import BASE_PHRASES, Template, scan_licenses

NOTICE = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def scan(documents, texts, templates=None):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    return by_id(scan_licenses(documents(rows), templates))


def test_places_of_base_phrases(documents):
    found = scan(
        documents,
        [
            "CC BY, cc-by and CC_BY",
            "General Public License general public license",
            "all rights are reserved",
            "x All Rights\nReserved. y cc by",
            "cc cc by by cc by",
        ],
    )
    assert (found[0]["n_base"], found[0]["first_word"], found[0]["last_word"]) == (3, 0, 5)
    assert (found[1]["n_base"], found[1]["last_word"], found[1]["base_labels"]) == (2, 3, "gpl")
    assert (found[2]["n_base"], found[2]["first_word"], found[2]["base_labels"]) == (0, None, "")
    assert found[3]["base_labels"] == "cc-by,reserved"
    assert (found[3]["first_word"], found[3]["last_word"]) == (1, 5)
    assert (found[4]["n_base"], found[4]["first_word"], found[4]["last_word"]) == (2, 1, 4)


def test_notices_with_changed_words(documents):
    found = scan(
        documents,
        [
            NOTICE,
            NOTICE.replace("any person", "any other natural person"),
            NOTICE.replace("free of charge", "gratis"),
            "permission to copy this software is granted",
            "Licensed under CC BY-NC 4.0.",
        ],
    )
    assert [found[i]["labels"] for i in range(4)] == ["mit", "mit", "mit", ""]
    assert found[0]["score"] == 1.0
    assert 0.75 <= found[1]["score"] < 1.0
    assert found[3]["score"] == 0.0
    assert found[4]["labels"] == "cc-by,cc-by-nc-4.0"


def test_edges(documents, edge_rows):
    found = scan_licenses(documents(edge_rows)).collect()
    assert len(found) == len(edge_rows)
    rows = {r["doc_id"]: r for r in found}
    assert rows[2]["n_words"] == rows[3]["n_words"] == rows[6]["n_words"] == 0
    assert rows[7]["n_words"] == 1 + 15_000
    assert all((r["n_base"], r["labels"], r["score"]) == (0, "", 0.0) for r in found)


def test_repeated_rows_keep_their_counts(documents):
    rows = [(1, "cc by", "en", "s", 0)] * 3 + [(1, "other", "en", "s", 0), (None, "cc by", "en", "s", 0)]
    found = scan_licenses(documents(rows)).collect()
    assert sorted((r["doc_id"] or 0, r["n_base"]) for r in found) == [(0, 1), (1, 0), (1, 1), (1, 1), (1, 1)]


def test_many_places_in_a_long_text(documents):
    text = "all rights reserved " * 5000
    row = scan(documents, [text])[0]
    assert (row["n_base"], row["first_word"], row["last_word"]) == (5000, 0, 14_997)


def test_own_templates_and_limits(documents):
    found = scan(documents, ["a b c d"], [Template(("b", "c"), "mine", True)])
    assert (found[0]["n_base"], found[0]["first_word"]) == (1, 1)
    with pytest.raises(ValueError):
        scan(documents, ["a"], [Template(("one",), "x", False)])
    assert all(len(p.split()) >= 2 for p, _ in BASE_PHRASES)


def test_empty_table(documents):
    assert scan_licenses(documents([])).count() == 0
