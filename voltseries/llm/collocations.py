"""Phrase collocations by set-oriented relational mining.

1. Texts are cut into pieces at punctuation. The occurrence relation of length 1 has a row
   (run, place, word) for every word. Places are numbered through, with a gap behind each piece.
   It is stored in buckets of runs of consecutive pieces, sorted by place, as the scan gives
   them: nothing is shuffled.
2. The relation of length k is filtered to frequent groups and merge-joined with that of
   length 1 by run and adjacent place. As both are bucketed alike, no occurrence is
   shuffled. The result is stored in the same way and its groups are counted, which shuffles
   pre-aggregated groups only. That is repeated up to the longest phrase.
3. Every cut of a frequent phrase meets the counts of its two parts; the lowest score counts.
   Phrases that a frequent longer one holds most times are dropped, the rest are ranked.

Words are 64-bit hashes of language and word inside the relations. The table of all words shows
whether two share a hash; if so, another seed is taken. The filter to frequent groups is a
bit map of bounded size: what it lets through in error is not frequent after the join either.

Defined cases: a null text is empty and has no pieces; a null language is ``und``; pieces without
words count for nothing; a text without punctuation is one piece, whatever its length; repeated
rows count each; ties are ranked by phrase, so ranks are unique; no rows give no rows; other
columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltseries.llm.common import stored
from voltseries.llm.ngram_join import _maybe_in as maybe_in
from voltseries.session import scratch_path

LONGEST = 3
LEAST = 10
HELD_PERCENT = 50
TOP = 2000
SCALE = 1_000_000
BUCKET_ROWS = 1_000_000  # about what a task sorts in memory
RUN_BITS = 16  # 2^16 consecutive pieces go to one bucket
MOST_BUCKETS = 50_000  # more rows make larger buckets, which are sorted on disk
_BY_PIECE = "spark.sql.requireAllClusterKeysForCoPartition"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@contextmanager
def _joined_by_piece(spark: SparkSession) -> Iterator[None]:
    """Joins on run and place may use the partitioning by run alone."""
    before = spark.conf.get(_BY_PIECE, None)
    spark.conf.set(_BY_PIECE, "false")
    try:
        yield
    finally:
        spark.conf.unset(_BY_PIECE) if before is None else spark.conf.set(_BY_PIECE, before)


class _Relations:
    """Stored occurrence relations, bucketed and sorted; the table names last as long as the block."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets, self.names = spark, buckets, []

    def __enter__(self) -> _Relations:
        return self

    def __exit__(self, *_: object) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def store(self, rows: DataFrame) -> DataFrame:
        name = f"occurrences_{uuid.uuid4().hex}"
        self.names.append(name)
        writer = rows.write.format("parquet").option("path", scratch_path(self.spark, "occurrences"))
        # Pages of the second version hold differences: places that follow each other take hardly any bytes.
        writer = writer.option("parquet.writer.version", "v2")
        writer.bucketBy(self.buckets, "run").sortBy("run", "place").saveAsTable(name)
        return self.spark.table(name)


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text.alias("text"))


def _lowered(word: str) -> Column:
    """A-Z lowered, in a word: most are ASCII, where ``lower`` does that many times faster than ``translate``."""
    ascii_only = F.octet_length(word) == F.length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(F.translate(word, _UPPER, _LOWER))


def _spoken(docs: DataFrame) -> DataFrame:
    """lang and word of every word of every text; pieces do not matter here."""
    words = F.split("text", r"[.,;:!?\x09-\x0D\x20]+")
    spoken = _texts(docs).select("lang", F.explode(words).alias("word")).filter("word <> ''")
    return spoken.select("lang", _lowered("word").alias("word"))


def _pieces(docs: DataFrame) -> DataFrame:
    """lang and words, not lowered yet, of every piece."""
    cut = _texts(docs).select("lang", F.explode(F.split("text", r"[.,;:!?\x0A-\x0D]")).alias("piece"))
    # A split at a single character needs no regular expression.
    words = F.array_remove(F.split(F.replace("piece", F.lit("\t"), F.lit(" ")), " "), "")
    return cut.select("lang", words.alias("words"))


def _hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "lang", "word")


def _numbered(words: DataFrame) -> tuple[DataFrame, int]:
    """The words with their hash ``h``, under the first seed that gives each of them its own."""
    seed = 0
    while True:
        hashed = words.withColumn("h", _hash(seed))
        if hashed.groupBy("h").count().filter("count > 1").isEmpty():
            return hashed, seed
        seed += 1


def _names(first: int, last: int) -> list[str]:
    return [f"w{i}" for i in range(first, last + 1)]


def _only_frequent(rows: DataFrame, frequent: DataFrame, names: list[str]) -> DataFrame:
    """Rows whose words in ``names`` may be a frequent group; callers count exactly afterwards."""
    wanted = frequent.select(F.xxhash64(*_names(1, len(names))).alias("_group"))
    return maybe_in(rows.withColumn("_group", F.xxhash64(*names)), wanted, "_group").drop("_group")


def _extended(rows: DataFrame, first: DataFrame, k: int) -> DataFrame:
    """The relation of length k + 1: each occurrence with the word behind it."""
    right = first.select(F.col("run").alias("_r"), F.col("place").alias("_p"), F.col("w1").alias(f"w{k + 1}"))
    adjacent = (F.col("run") == F.col("_r")) & (F.col("place") + k == F.col("_p"))
    return rows.join(right.hint("merge"), adjacent).drop("_r", "_p")


def _counted(rows: DataFrame, k: int, least: int) -> DataFrame:
    return rows.groupBy(*_names(1, k)).agg(F.count(F.lit(1)).alias("f")).filter(F.col("f") >= least)


def frequent_groups(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, words, f) of the frequent phrases up to ``longest`` words, and (lang, word, f, h) of all words."""
    spark = docs.sparkSession
    pieces = _pieces(docs)
    words, seed = _numbered(stored(_spoken(docs).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("f")), "words"))
    total = words.agg(F.sum("f").alias("n")).first()["n"] or 0
    found = [stored(words.filter(F.col("f") >= least).select(F.col("h").alias("w1"), "f"), "groups")]
    with _Relations(spark, min(total // BUCKET_ROWS + 1, MOST_BUCKETS)) as relations, _joined_by_piece(spark):
        # A piece of one word has no phrases. Numbers hold the task above their 33 lowest bits.
        number = F.monotonically_increasing_id()
        phrases = pieces.filter(F.size("words") > 1).withColumn("run", F.shiftright(number, RUN_BITS))
        places = phrases.select("run", "lang", F.explode(F.array_append("words", F.lit(""))).alias("word"))
        # The empty word behind a piece takes a place and is dropped: no phrase reaches over it.
        places = places.withColumn("place", number).filter("word <> ''").withColumn("word", _lowered("word"))
        rows = places.select("run", "place", _hash(seed).alias("w1"))
        first = rows = relations.store(_only_frequent(rows, found[0], ["w1"]))
        for k in range(1, longest):
            if k > 1:
                rows = _only_frequent(rows, found[-1], _names(1, k))
            rows = _extended(rows, first, k)
            if k > 1:
                rows = _only_frequent(rows, found[-1], _names(2, k + 1))
            if k + 1 < longest:
                rows = relations.store(rows)
            found.append(stored(_counted(rows, k + 1, least), "groups"))
    every = None
    for k, groups in enumerate(found, 1):
        listed = groups.select(F.array(*_names(1, k)).alias("words"), "f")
        every = listed if every is None else every.unionByName(listed)
    of = words.select("h", "lang")
    return stored(every.join(of, F.col("words")[0] == F.col("h")).select("lang", "words", "f"), "groups"), words


def _scored(groups: DataFrame) -> DataFrame:
    """lang, words, a, l, r, score: the lowest-scoring cut of each phrase of two words or more."""
    phrases = groups.filter(F.size("words") > 1).withColumnRenamed("f", "a")
    cuts = phrases.select("*", F.explode(F.expr("sequence(1, size(words) - 1)")).alias("k")).select(
        "*", F.expr("slice(words, 1, k)").alias("left"), F.expr("slice(words, k + 1, size(words) - k)").alias("right")
    )
    parts = groups.select("lang", "words", "f")
    both = cuts.join(parts.withColumnsRenamed({"words": "left", "f": "l"}), ["lang", "left"]).join(
        parts.withColumnsRenamed({"words": "right", "f": "r"}), ["lang", "right"]
    )
    # Decimals of 38 digits: exact while 1,000,000 a² stays below 10^38.
    score = F.expr(
        f"(cast(a AS decimal(18,0)) * cast(a AS decimal(18,0)) * {SCALE}) div (cast(l AS decimal(18,0)) * cast(r AS decimal(18,0)))"
    )
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c")
    return both.groupBy("lang", "words", "a").agg(lowest).select("lang", "words", "a", "c.l", "c.r", "c.score")


def _mostly_held(groups: DataFrame) -> DataFrame:
    """(lang, words, f): the most frequent longer phrase that holds each shorter one."""
    inner = F.expr("""
        flatten(transform(sequence(2, size(words) - 1), n ->
            transform(sequence(1, size(words) - n + 1), s -> slice(words, s, n))))""")
    longer = groups.filter(F.size("words") > 2).select("lang", "f", F.explode(inner).alias("words"))
    return longer.groupBy("lang", "words").agg(F.max("f").alias("f"))


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, held_percent: int = HELD_PERCENT, top: int = TOP
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language."""
    groups, words = frequent_groups(docs, longest, least)
    held = _mostly_held(groups).withColumnRenamed("f", "longer")
    open_ = _scored(groups).join(held, ["lang", "words"], "left")
    kept = open_.filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * held_percent)).drop("longer")
    # Ties at the last place stay until the words are known.
    place = F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))
    leading = stored(kept.withColumn("_place", place).filter(F.col("_place") <= top).drop("_place"), "leading")
    named = (
        leading.select("lang", "words", F.posexplode("words").alias("i", "h"))
        .join(words.select("h", "word"), "h")
        .groupBy("lang", "words")
        .agg(F.sort_array(F.collect_list(F.struct("i", "word"))).alias("w"))
        .select("lang", "words", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("phrase"))
    )
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        leading.join(named, ["lang", "words"])
        .withColumn("rank", F.row_number().over(order).cast("bigint"))
        .filter(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("bigint").alias("score"))
    )
