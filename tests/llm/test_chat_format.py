import hashlib

from voltseries.llm.chat_format import read_back, read_turns, training_examples

SCHEMA = "conv_id long, turn long, role string, text string, at string, full string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "at", "full") for r in rows], SCHEMA).repartition(3)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(
            ((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        )
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        out[conv] = (
            len(turns),
            sha("".join(f"{t[2]}\n{t[3]}\n" for t in turns)),
            len(loss),
            sha(loss),
        )
    return out


ROWS = [
    (1, 0, "user", "hello"),
    (1, 1, "assistant", "hi there"),
    (1, 2, "user", "more"),
    (1, 3, "assistant", "\\h \\\\l \\b <turn> ### user: x </turn>\n### assistant: y"),
    (2, 0, "user", "only a question"),
    (3, 0, "system", None),
    (3, 1, None, "no role"),
    (3, 2, "assistant", ""),
    (3, None, "a:b #<\\", "null turn comes first"),
    (4, 1, "assistant", "same"),
    (4, 1, "assistant", "same"),
    (4, 1, "user", "tie"),
    (None, 0, "assistant", "no id 😀 é"),
    (5, 0, "assistant", "long " * 20_000),
    (-7, 0, "user", r"\### Assistant: </turn> ok"),
    (-7, 1, "assistant", r"\### Assistant: </turn> ok"),
]


def test_digests_equal_the_input(spark):
    found = read_back(training_examples(frame(spark, ROWS))).collect()
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in found}
    assert got == brute(ROWS)


def test_each_reply_is_one_example(spark):
    found = training_examples(frame(spark, ROWS)).filter("conv_id = 1").orderBy("example_no").collect()
    assert len(found) == 2
    assert found[1]["text"].startswith(found[0]["text"])
    first = found[0]
    assert first["text"][first["target_start"] : first["target_start"] + first["target_chars"]] == "hi there"
    assert [r["is_last"] for r in found] == [False, True]


def test_context_only_example_has_no_target(spark):
    found = training_examples(frame(spark, ROWS)).filter("conv_id = 2").collect()
    assert [(r["target_start"], r["is_last"]) for r in found] == [(None, True)]


def test_turns_are_read_back(spark):
    examples = training_examples(frame(spark, ROWS)).filter("conv_id = 1 AND is_last")
    (row,) = examples.select(read_turns(examples["text"]).alias("t")).collect()
    assert [(t["role"], t["text"]) for t in row["t"]] == [(r[2], r[3]) for r in ROWS[:4]]


def test_no_rows(spark):
    assert training_examples(frame(spark, [])).count() == 0
    assert read_back(training_examples(frame(spark, []))).count() == 0
