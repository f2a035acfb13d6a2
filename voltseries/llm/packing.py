"""Packing into batches of optimal length buckets.

Texts are cut into sequences of at most ``context`` tokens (words). Dynamic programming
over the histogram of all lengths finds the ``buckets`` upper bounds that pad the fewest
tokens. Inside a bucket, sequences are dealt by hash to groups of about GROUP_TOKENS, and
each group fills batches of as many sequences as the token budget holds at the bucket's
width; so a bucket of any size is packed in parallel, with one partial batch per group.

Defined cases: a null or empty text is one sequence of length 0; repeated rows are packed
each for itself; null ids are kept; no rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltseries.llm.common import WORD, word_count

CONTEXT = 2048
BUCKETS = 8
BUDGET = 16_384
GROUP_TOKENS = 4_000_000  # padded tokens of a group: about 250 batches, some 25 MB of text
SEED = 23


def bucket_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding in total.

    ``best[j]`` is the least padding of the first j lengths; another bucket may end at
    each of them. Lengths are ascending; there are at most ``context`` + 1.
    """
    m = len(lengths)
    if not m:
        return []
    n = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)]).astype(np.float64)
    best = np.full(m + 1, np.inf)
    best[0] = 0
    cuts = []
    for _ in range(min(buckets, m)):
        new, cut = np.full(m + 1, np.inf), np.zeros(m + 1, np.int64)
        new[0] = 0
        for j in range(1, m + 1):
            cost = best[:j] + lengths[j - 1] * (n[j] - n[:j]) - (tokens[j] - tokens[:j])
            cut[j] = int(np.argmin(cost))
            new[j] = cost[cut[j]]
        best = new
        cuts.append(cut)
    bounds, j = [], m
    for cut in reversed(cuts):
        if j == 0:
            break
        bounds.append(int(lengths[j - 1]))
        j = int(cut[j])
    return sorted(bounds)


def sequences(docs: DataFrame, context: int = CONTEXT) -> DataFrame:
    """doc_id, piece, n_tokens, text: the words of each piece, joined by blanks."""
    words = F.regexp_extract_all(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD), 0)
    last = F.greatest(F.floor((F.size("_w") - 1) / context).cast("int"), F.lit(0))
    return (
        docs.select("doc_id", words.alias("_w"))
        .withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("_w", F.slice("_w", F.col("piece") * context + 1, F.lit(context)))
        .select("doc_id", "piece", F.size("_w").alias("n_tokens"), F.array_join("_w", " ").alias("text"))
    )


def length_histogram(docs: DataFrame, context: int = CONTEXT) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of all sequences and how often they occur; at most ``context`` + 1 numbers."""
    n = docs.select(word_count(F.col("text").cast("string")).alias("n"))
    full = F.floor(F.col("n") / context)
    rest = F.col("n") % context
    parts = F.array(
        F.struct(F.lit(context).cast("bigint").alias("length"), full.cast("bigint").alias("k")),
        F.struct(rest.alias("length"), F.when((rest > 0) | (F.col("n") == 0), 1).otherwise(0).cast("bigint").alias("k")),
    )
    rows = (
        n.select(F.explode(parts).alias("p"))
        .groupBy("p.length")
        .agg(F.sum("p.k").alias("k"))
        .filter("k > 0")
        .orderBy("length")
        .toPandas()
    )
    return rows["length"].to_numpy(np.int64), rows["k"].to_numpy(np.int64)


def pack(
    docs: DataFrame, context: int = CONTEXT, buckets: int = BUCKETS, budget: int = BUDGET, seed: int = SEED
) -> DataFrame:
    """doc_id, piece, n_tokens, bucket, padding, batch_group, batch, slot, text.

    (bucket, batch_group, batch) names a batch; all its sequences are padded to ``bucket``
    tokens, and together they hold at most ``budget`` (or a single sequence).
    """
    lengths, counts = length_histogram(docs, context)
    bounds = bucket_bounds(lengths, counts, buckets) or [0]
    rows = [int(counts[(lengths <= b) & (lengths > a)].sum()) for a, b in zip([-1, *bounds], bounds, strict=False)]

    def per_bucket(values: list[int]):
        column = F.lit(values[-1])
        for bound, value in zip(reversed(bounds[:-1]), reversed(values[:-1]), strict=True):
            column = F.when(F.col("n_tokens") <= bound, value).otherwise(column)
        return column

    key = F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), "piece", "text")
    groups = per_bucket([max(1, -(-n * b // GROUP_TOKENS)) for n, b in zip(rows, bounds, strict=True)])
    holds = per_bucket([max(1, budget // max(b, 1)) for b in bounds])
    keyed = sequences(docs, context).select(
        "*", per_bucket(bounds).cast("int").alias("bucket"), holds.alias("_holds"), key.alias("_key")
    )
    dealt = keyed.withColumn("batch_group", F.pmod(F.shiftrightunsigned("_key", 20), groups).cast("int"))
    place = F.row_number().over(Window.partitionBy("bucket", "batch_group").orderBy("_key", "doc_id", "piece")) - 1
    return dealt.withColumn("_at", place).select(
        "doc_id",
        "piece",
        "n_tokens",
        "bucket",
        (F.col("bucket") - F.col("n_tokens")).alias("padding"),
        "batch_group",
        F.floor(F.col("_at") / F.col("_holds")).cast("int").alias("batch"),
        (F.col("_at") % F.col("_holds")).cast("int").alias("slot"),
        "text",
    )
