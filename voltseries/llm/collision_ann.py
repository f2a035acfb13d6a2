"""Approximate nearest neighbours by collision counting over single projections.

Vectors are scaled to length 1 and projected on ``PROJECTIONS`` random lines. A block of
about BLOCK_ROWS vectors keeps, for each line, its projections as a sorted array. A query
opens a window around its own projection on every line; virtual rehashing widens all
windows together by steps of ``STEP``, without hashing anything anew. A vector collides on
a line if it lies in the window. The windows stop growing when enough vectors, NEED +
SHARE of the block, collide on at least ``COLLISIONS`` of the lines; all vectors that do
are verified with the exact cosine. There is no cap on them.

Queries and vectors are both cut into blocks, so a task holds one block of each. Each
returns the best of its block, and the best of all blocks follow by a ranked window.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components,
and null ids, take no part; vectors are compared with those of their own dimension;
rows equal in id and vector count once; several vectors of one id are one query, and no
candidate of its own; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltseries.llm.common import ready_python, stored

PROJECTIONS = 128
COLLISIONS = 0.7
STEP = 1.08
NEED, SHARE = 150, 0.15
BLOCK_ROWS = 8192
QUERY_ROWS = 2048
SEED = 7


class SortedProjections:
    """The sorted arrays of one block, and the search of one query in them."""

    def __init__(self, units: np.ndarray, seed: int = SEED):
        lines = np.random.Generator(np.random.PCG64([seed, units.shape[1]])).standard_normal(
            (units.shape[1], PROJECTIONS)
        )
        self.lines = lines
        projected = units @ lines
        self.order = np.argsort(projected, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(projected.T, self.order, axis=1)
        self.n = len(units)
        self.need = min(self.n, int(NEED + SHARE * self.n))
        self.level = 0
        # A starting width from the block itself; every query then finds its own.
        tried = [self._level(projected[i]) for i in range(0, self.n, max(1, self.n // 5))]
        self.level = int(np.median(tried))

    def _colliding(self, at: np.ndarray, level: int) -> np.ndarray:
        radius = STEP**level
        parts = []
        for line in range(PROJECTIONS):
            low, high = np.searchsorted(self.values[line], (at[line] - radius, at[line] + radius))
            parts.append(self.order[line, low:high])
        hits = np.bincount(np.concatenate(parts), minlength=self.n)
        return np.flatnonzero(hits >= COLLISIONS * PROJECTIONS)

    def _level(self, at: np.ndarray) -> int:
        """The narrowest level of windows with enough colliding vectors."""
        level = self.level
        if len(self._colliding(at, level)) >= self.need:
            while len(self._colliding(at, level - 1)) >= self.need and level > -200:
                level -= 1
            return level
        while len(self._colliding(at, level)) < self.need and level < 200:
            level += 1
        return level

    def candidates(self, unit: np.ndarray) -> np.ndarray:
        at = unit @ self.lines
        level = self.level
        found = self._colliding(at, level)
        if len(found) < self.need:
            while len(found) < self.need and level < 200:
                level += 1
                found = self._colliding(at, level)
            return found
        while level > -200:
            fewer = self._colliding(at, level - 1)
            if len(fewer) < self.need:
                return found
            found, level = fewer, level - 1
        return found


def cosines(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosine of each row with the query, in double precision; equal rows give equal values."""
    dots = (vectors * query).sum(axis=1)
    return dots / (np.sqrt((vectors * vectors).sum(axis=1)) * np.sqrt((query * query).sum()))


def _search(k: int):
    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(vectors) and len(queries):
            ids = vectors["vec_id"].to_numpy()
            rows = np.stack(vectors["v"].to_numpy()).astype(np.float64)
            order = np.argsort(ids, kind="stable")
            ids, rows = ids[order], rows[order]
            index = SortedProjections(rows / np.linalg.norm(rows, axis=1, keepdims=True))
            for query_id, vector in zip(queries["query_id"].tolist(), queries["query"], strict=True):
                query = np.asarray(vector, np.float64)
                near = index.candidates(query / np.linalg.norm(query))
                near = near[ids[near] != query_id]
                score = cosines(rows[near], query)
                top = np.lexsort((ids[near], -score))[:k]
                out["query_id"] += [query_id] * len(top)
                out["vec_id"] += ids[near][top].tolist()
                out["score"] += score[top].tolist()
        return pd.DataFrame(out)

    return run


def valid_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id and v (array<double>) of the vectors that take part, each row once."""
    wide = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("v", lambda x: x != 0)
    return wide.filter(F.col("vec_id").isNotNull() & (F.size("v") > 0) & finite & some).distinct()


def nearest(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query.

    Queries are the rows whose id is divisible by ``every``; all rows are candidates.
    """
    ready_python(embeddings.sparkSession)
    vectors = stored(valid_vectors(embeddings), "vectors").withColumn("dim", F.size("v"))
    # One row per dimension and kind: counts that fix the number of blocks.
    sizes = vectors.groupBy("dim").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.lit(1)).cast("int").alias("blocks"),
        F.greatest(F.ceil(F.sum(F.when(F.col("vec_id") % every == 0, 1).otherwise(0)) / QUERY_ROWS), F.lit(1))
        .cast("int")
        .alias("parts"),
    )
    sized = vectors.join(F.broadcast(sizes), "dim")
    block = F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.col("blocks"))
    part = F.pmod(F.xxhash64("vec_id", F.lit(SEED + 1)), F.col("parts"))
    every_part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    every_block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    held = sized.select("dim", block.cast("int").alias("block"), every_part.alias("part"), "vec_id", "v")
    asked = sized.filter(F.col("vec_id") % every == 0).select(
        F.col("dim").alias("q_dim"),
        every_block.alias("q_block"),
        part.cast("int").alias("q_part"),
        F.col("vec_id").alias("query_id"),
        F.col("v").alias("query"),
    )
    best = (
        held.groupBy("dim", "block", "part")
        .cogroup(asked.groupBy("q_dim", "q_block", "q_part"))
        .applyInPandas(_search(k), "query_id long, vec_id long, score double")
    )
    # Several vectors of one id: the best of them counts.
    once = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
