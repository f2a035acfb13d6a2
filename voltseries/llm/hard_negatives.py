"""Hard-negative mining by a secondary sort.

1. Rows and anchors are cut into blocks, so a task scores one block of each. The rows of an
   anchor's label give its positives: the best of every block, then the best of all.
2. A second pass scores all rows for the anchors, whose windows are now known: a block hands
   on, for each window, its first rows of other labels. So what is shuffled is a few pairs
   per anchor and block, and never a pair that cannot be in the result for want of a better
   one in its own block.
3. The pairs are keyed (anchor, descending score, positives first, id), dealt out by anchor
   and sorted inside their partitions. One streaming iterator runs over the sorted pairs: a
   positive opens its window, a negative goes to every open window, a window closes when it
   is full or its lower bound is passed. No anchor is ever held as a whole.

Scores are exact: components are whole numbers, and products of rows whose sums could pass
2^53 are taken in unbounded integers.

Defined cases: rows with a null id, label or vector, or with null or non-finite components,
take no part; rows equal in id, label and vector count once; different rows of one id are
rows, and anchors, of their own, and each other's candidates; rows meet only rows of their
own dimension, an empty vector scores 0; pairs whose score does not fit in 64 bits take no
part; equal scores go to the smaller id; an anchor without positives, or a positive without
negatives, has no rows; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltseries.llm.common import ready_python, stored

POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100  # percent of the positive's score
EVERY = 100
SHIFT_EVERY, LABELS = 7, 10
SCALE = 256
BLOCK_ROWS = 16_384
ANCHOR_ROWS = 4_096
_MOST = 2**63


def mining_rows(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, v, dim and mark of the rows that take part, each once."""
    wide = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("v"),
    ).filter("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    moved = F.when(F.col("vec_id") % SHIFT_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    once = wide.filter(finite).withColumn("label", moved).distinct()
    return once.withColumns({"dim": F.size("v"), "mark": F.xxhash64("label", "v")})


def _whole(vectors: pd.Series) -> np.ndarray:
    """Components as whole numbers: rows of doubles, in which every one of them is exact."""
    rows = np.stack(vectors.to_numpy()) if len(vectors) else np.zeros((0, 0))
    with np.errstate(over="ignore"):
        whole = np.floor(rows * SCALE)
    return whole if np.isfinite(whole).all() else _unbounded(rows)


def _unbounded(rows: np.ndarray) -> np.ndarray:
    # A double of this size is a whole number already.
    exact = np.empty(rows.shape, object)
    for at, x in np.ndenumerate(rows):
        exact[at] = int(x) * SCALE if abs(x) > 2.0**60 else int(np.floor(x * SCALE))
    return exact


def _ints(rows: np.ndarray) -> np.ndarray:
    exact = np.empty(rows.shape, object)
    for at, x in np.ndenumerate(rows):
        exact[at] = int(x)
    return exact


def exact_products(anchors: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inner products as 64-bit integers, anchors by rows, and which of them fit in 64 bits."""
    dim = max(anchors.shape[1], 1)
    limit = int(((2**53 - 1) / dim) ** 0.5)
    big_a = np.array([max(map(abs, r), default=0) > limit for r in anchors], bool)
    big_r = np.array([max(map(abs, r), default=0) > limit for r in rows], bool) if rows.dtype == object else (
        np.abs(rows).max(axis=1, initial=0) > limit
    )
    plain_a = np.where(big_a[:, None], 0, anchors).astype(np.float64)
    plain_r = np.where(big_r[:, None], 0, rows).astype(np.float64)
    score = (plain_a @ plain_r.T).astype(np.int64)
    fits = np.ones(score.shape, bool)

    def slow(some_a: np.ndarray, some_r: np.ndarray) -> None:
        if len(some_a) and len(some_r):
            exact = _ints(anchors[some_a]).dot(_ints(rows[some_r]).T)
            inside = np.frompyfunc(lambda x: -_MOST <= x < _MOST, 1, 1)(exact).astype(bool)
            score[np.ix_(some_a, some_r)] = np.where(inside, exact, 0).astype(np.int64)
            fits[np.ix_(some_a, some_r)] = inside

    slow(np.flatnonzero(big_a), np.arange(len(rows)))
    slow(np.flatnonzero(~big_a), np.flatnonzero(big_r))
    return score, fits


def _first(score: np.ndarray, ids: np.ndarray, marks: np.ndarray, n: int) -> np.ndarray:
    """Places of the first n by descending score, id and mark."""
    if len(score) > 4 * n:
        # All that tie with the n-th stay in the running.
        least = np.partition(score, len(score) - n)[len(score) - n]
        near = np.flatnonzero(score >= least)
    else:
        near = np.arange(len(score))
    order = np.lexsort((marks[near], ids[near], ~score[near]))
    return near[order[:n]]


_PAIR = "anchor_id long, anchor_mark long, score long, vec_id long, mark long"


def _frame(parts: list[tuple]) -> pd.DataFrame:
    names = [c.split()[0] for c in _PAIR.split(", ")]
    if not parts:
        return pd.DataFrame({n: np.zeros(0, np.int64) for n in names})
    columns = zip(*parts, strict=True)
    return pd.DataFrame({n: np.concatenate(c) for n, c in zip(names, columns, strict=True)})


def _scan(pick: Callable) -> Callable:
    """Runs ``pick`` for every anchor of a group over the scores of the group's rows."""

    def run(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(rows) and len(anchors):
            whole, asked = _whole(rows["v"]), _whole(anchors["av"])
            ids, marks, labels = (rows[c].to_numpy() for c in ("vec_id", "mark", "label"))
            step = max(1, 4_000_000 // max(len(rows), 1))
            for at in range(0, len(anchors), step):
                some = anchors.iloc[at : at + step]
                score, fits = exact_products(asked[at : at + step], whole)
                for i, anchor in enumerate(some.itertuples(index=False)):
                    ok = np.flatnonzero(fits[i])
                    found = ok[pick(anchor, score[i][ok], ids[ok], marks[ok], labels[ok])]
                    n = len(found)
                    parts.append(
                        (np.full(n, anchor.anchor_id), np.full(n, anchor.anchor_mark), score[i][found], ids[found], marks[found])
                    )
        return _frame(parts)

    return run


def _positives(n: int) -> Callable:
    def pick(anchor, score, ids, marks, labels) -> np.ndarray:
        others = np.flatnonzero((labels == anchor.a_label) & ((ids != anchor.anchor_id) | (marks != anchor.anchor_mark)))
        return others[_first(score[others], ids[others], marks[others], n)]

    return pick


def _negatives(n: int) -> Callable:
    def pick(anchor, score, ids, marks, labels) -> np.ndarray:
        other = np.flatnonzero(labels != anchor.a_label)
        kept = []
        for p in {int(p) for p in anchor.positives}:
            # 80 p <= 100 s <= 100 p, as bounds on s that cannot overflow.
            low, high = -((-LOW * p) // 100), (HIGH * p) // 100
            if low <= high:
                inside = other[(score[other] >= low) & (score[other] <= high)]
                kept.append(inside[_first(score[inside], ids[inside], marks[inside], n)])
        return np.unique(np.concatenate(kept)) if kept else np.zeros(0, np.int64)

    return pick


def _scored(rows: DataFrame, anchors: DataFrame, keys: list[str], pick: Callable) -> DataFrame:
    """Pairs that ``pick`` chooses, from all rows and anchors with equal ``keys``, in blocks."""
    n_rows = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    n_anchors = anchors.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / ANCHOR_ROWS).cast("int").alias("parts"))
    sizes = stored(n_rows.join(n_anchors, keys), "sizes")
    hashed = F.xxhash64("vec_id", "mark")
    held = rows.join(sizes, keys).select(
        *keys,
        F.pmod(hashed, F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        *[c for c in ("vec_id", "mark", "label", "v") if c not in keys],
    )
    asked = anchors.join(sizes, keys).select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("_block"),
        F.pmod(F.xxhash64("anchor_id", "anchor_mark"), F.col("parts")).cast("int").alias("_part"),
        *[c for c in anchors.columns if c not in keys],
    )
    groups = [*keys, "block", "part"]
    both = held.groupBy(*groups).cogroup(asked.groupBy(*[f"_{g}" for g in groups]))
    return both.applyInPandas(_scan(pick), _PAIR)


def _windows(positives: int, negatives: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, open_ = None, []
        for batch in batches:
            out = []
            columns = (batch.column(i).to_pylist() for i in range(batch.num_columns))
            for anchor_id, mark, score, kind, vec_id in zip(*columns, strict=True):
                if (anchor_id, mark) != anchor:
                    anchor, open_, seen = (anchor_id, mark), [], 0
                if kind == 0:
                    seen += 1
                    if seen <= positives:
                        open_.append([vec_id, score, 0])
                    continue
                open_ = [w for w in open_ if w[2] < negatives and LOW * w[1] <= 100 * score]
                for w in open_:
                    if 100 * score <= HIGH * w[1]:
                        w[2] += 1
                        out.append((anchor_id, w[0], w[2], vec_id, w[1], score))
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def hard_negatives(
    embeddings: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    ready_python(embeddings.sparkSession)
    rows = stored(mining_rows(embeddings), "mining-rows")
    anchors = rows.filter(F.col("vec_id") % every == 0).select(
        "dim", F.col("label").alias("a_label"), F.col("vec_id").alias("anchor_id"), F.col("mark").alias("anchor_mark"), F.col("v").alias("av")
    )
    of_label = anchors.withColumn("label", F.col("a_label"))
    near = _scored(rows, of_label, ["dim", "label"], _positives(positives))
    order = Window.partitionBy("anchor_id", "anchor_mark").orderBy(F.desc("score"), "vec_id", "mark")
    near = stored(near.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= positives).drop("_n"), "positives")
    # At most ``positives`` scores per anchor.
    known = near.groupBy("anchor_id", "anchor_mark").agg(F.collect_list("score").alias("positives"))
    far = _scored(rows, anchors.join(known, ["anchor_id", "anchor_mark"]), ["dim"], _negatives(negatives))
    pairs = stored(
        near.withColumn("kind", F.lit(0)).unionByName(far.withColumn("kind", F.lit(1))), "mining-pairs"
    )
    keyed = (
        pairs.repartition("anchor_id", "anchor_mark")
        .sortWithinPartitions("anchor_id", "anchor_mark", F.desc("score"), "kind", "vec_id", "mark")
        .select("anchor_id", "anchor_mark", "score", "kind", "vec_id")
    )
    return keyed.mapInArrow(
        _windows(positives, negatives),
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long",
    )
