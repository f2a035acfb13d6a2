"""MinHash near-dedup: many universal hash minima, banding, verification, components.

A document is the set of its distinct word shingles. Two documents link when the Jaccard
similarity of their sets is at least ``percent`` / 100.

1. A signature holds the minima of ``BANDS`` x ``ROWS`` universal hashes over the set. A band is
   a run of ``ROWS`` minima; documents that agree on a whole band share a bucket. At a
   similarity of 0.8, two sets share no bucket with a chance of 1.3e-7.
2. Documents with equal sets form one class. In every bucket each class is paired with the
   bucket's first one, its centre. Pairs pass the signatures (an estimate more than six
   deviations below the threshold is dropped) and are then compared on their full sets.
3. Alternating large-star and small-star rounds turn the links into components.
4. What is left are classes that share a bucket and are still in different components. The
   bucket's sets, as 32-bit shingles, are compared in blocks, and only pairs that are similar
   enough come out; they are confirmed on the full sets, and the components follow anew.

No bucket emits all its pairs, and none is cut off.

Defined cases: null and empty texts have empty sets and link with nothing; a null id takes no
part in links, has a null component and is kept; rows of one id are one vertex, linked if any
of its texts is, and have a result row each, but a row without words stays alone; a very long text is one set; no rows give no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltseries.llm.common import ready_python, stored
from voltseries.llm.components import component_labels
from voltseries.llm.ngram_join import _maybe_in as maybe_in
from voltseries.llm.shingles import list_array, shingle_sets

BANDS, ROWS = 40, 5
HASHES = BANDS * ROWS
BLOCK_ITEMS = 1_000_000  # shingles of a bucket that one task compares with as many
_WORK = 1 << 16  # shingles hashed in one step, at least one document
_DRAWN = np.random.Generator(np.random.PCG64(12)).integers(0, 2**64 - 1, (2, HASHES), dtype=np.uint64)
_FACTORS, _TERMS = _DRAWN[0] | np.uint64(1), _DRAWN[1]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The minima of all hashes, a row per set; sets must not be empty."""
    out = np.empty((len(sets), HASHES), np.uint32)
    i = 0
    while i < len(sets):
        j, size = i, 0
        while j < len(sets) and (j == i or size + len(sets[j]) <= _WORK):
            size += len(sets[j])
            j += 1
        items = np.concatenate(sets[i:j]).view(np.uint64)
        starts = np.cumsum([0, *map(len, sets[i : j - 1])])
        for h in range(HASHES):
            # Multiply and shift: the high half is a universal hash.
            hashed = ((items * _FACTORS[h] + _TERMS[h]) >> np.uint64(32)).astype(np.uint32)
            out[i:j, h] = np.minimum.reduceat(hashed, starts)
        i = j
    return out


def _sign(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column(1), words))
            real = [s for s in sets if len(s)]
            lines = iter(signatures(real)) if real else iter(())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()),
                    pa.array([next(lines).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                ["doc_id", "n", "set_key", "signature"],
            )

    return run


def _set_rows(words: int, short: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column(1), words))
            keys = pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary())
            if short:
                items = pa.array([(s.view(np.uint64) >> np.uint64(32)).astype(np.uint32).tobytes() for s in sets], pa.binary())
            else:
                items = list_array(sets)
            yield pa.RecordBatch.from_arrays([keys, items], ["set_key", "items"])

    return run


def _agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Share of equal minima of each pair of signatures."""
    for batch in batches:
        left, right = (
            np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(-1, HASHES) for i in (2, 3)
        )
        alike = pa.array((left == right).mean(axis=1) if len(left) else np.zeros(0), pa.float64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), alike], ["x", "y", "alike"])


def _deviations(similarity: float) -> float:
    return 6 * (similarity * (1 - similarity) / HASHES) ** 0.5


class _Verifier:
    """Compares pairs (x, y) of set keys, first by signature and then on the full sets."""

    def __init__(self, docs: DataFrame, classes: DataFrame, words: int):
        self.docs, self.classes, self.words = docs, classes, words

    def sets(self, keys: DataFrame, short: bool = False) -> DataFrame:
        """set_key and items of some classes: a list, or the bytes of 32-bit shingles."""
        wanted = self.classes.select("set_key", "class_id").join(keys, "set_key")
        texts = maybe_in(self.docs, wanted.withColumnRenamed("class_id", "doc_id"), "doc_id").select("doc_id", "text")
        kind = "binary" if short else "array<long>"
        rows = texts.mapInArrow(_set_rows(self.words, short), f"set_key binary, items {kind}")
        once = rows.join(keys, "set_key", "left_semi").groupBy("set_key").agg(F.first("items").alias("items"))
        return stored(once, "sets")

    def links(self, pairs: DataFrame, percent: int) -> DataFrame:
        """The class ids a and b of the pairs that link."""
        least = percent / 100
        lines = self.classes.select("set_key", "signature")
        both = (
            pairs.select("x", "y")
            .distinct()
            .join(lines.withColumnsRenamed({"set_key": "x", "signature": "sx"}), "x")
            .join(lines.withColumnsRenamed({"set_key": "y", "signature": "sy"}), "y")
            .select("x", "y", "sx", "sy")
        )
        alike = both.mapInArrow(_agreement, "x binary, y binary, alike double")
        near = stored(alike.filter(F.col("alike") >= least - _deviations(least)).select("x", "y"), "near")
        sets = self.sets(near.select(F.col("x").alias("set_key")).union(near.select("y")).distinct())
        common = (
            near.join(sets.withColumnsRenamed({"set_key": "x", "items": "ix"}), "x")
            .join(sets.withColumnsRenamed({"set_key": "y", "items": "iy"}), "y")
            .select("x", "y", F.size("ix").alias("nx"), F.size("iy").alias("ny"), F.size(F.array_intersect("ix", "iy")).alias("k"))
        )
        union = F.col("nx") + F.col("ny") - F.col("k")
        found = common.filter(F.col("k") * 100 >= union * percent)
        ids = self.classes.select("set_key", "class_id")
        return (
            found.join(ids.withColumnsRenamed({"set_key": "x", "class_id": "a"}), "x")
            .join(ids.withColumnsRenamed({"set_key": "y", "class_id": "b"}), "y")
            .select("a", "b")
        )


def _postings(classes: DataFrame) -> DataFrame:
    """(bucket, set_key, class_id, n) of the buckets that hold two classes or more."""
    width = ROWS * 4
    band = F.xxhash64("i", F.expr(f"substring(signature, i * {width} + 1, {width})"))
    numbered = classes.select("set_key", "class_id", "n", "signature", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("i"))
    rows = numbered.select(band.alias("bucket"), "set_key", "class_id", "n")
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("bucket")
    return stored(maybe_in(rows, stored(shared, "buckets"), "bucket").join(shared, "bucket", "left_semi"), "postings")


def _first_pairs(postings: DataFrame, percent: int) -> DataFrame:
    centres = postings.groupBy("bucket").agg(F.min(F.struct("class_id", "set_key", "n")).alias("c"))
    fit = F.least("n", "c.n") * 100 >= F.greatest("n", "c.n") * percent
    spokes = postings.join(centres, "bucket").filter((F.col("set_key") != F.col("c.set_key")) & fit)
    return spokes.select(F.col("c.set_key").alias("x"), F.col("set_key").alias("y")).distinct()


def _scan(percent: int):
    """Links between different components among the sets of one or two blocks of a bucket."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        keys, comp, n = (rows[c].to_numpy() for c in ("set_key", "comp", "n"))
        items = [np.frombuffer(x, np.uint32) for x in rows["items"]]
        two = bool((rows["b1"] != rows["b2"]).any())
        second = rows["second"].to_numpy() if two else np.ones(len(rows), bool)
        values, codes = np.unique(np.concatenate(items), return_inverse=True)
        starts = np.cumsum([0, *map(len, items)])
        held = np.zeros(len(values), np.int32)
        # Every pair has an end outside the most frequent component.
        names, counts = np.unique(comp, return_counts=True)
        main = comp == names[counts.argmax()]
        place = np.arange(len(rows))
        out = []
        for i in np.flatnonzero(~main):
            fit = (np.minimum(n, n[i]) * 100 >= np.maximum(n, n[i]) * percent) & (comp != comp[i])
            fit &= (second != second[i]) if two else True
            fit &= main | (place > i)
            if fit.any():
                mine = codes[starts[i] : starts[i + 1]]
                held[mine] = 1
                common = np.add.reduceat(held[codes], starts[:-1])
                held[mine] = 0
                out += [(keys[i], keys[j]) for j in np.flatnonzero(fit & (common * 100 >= (n + n[i] - common) * percent))]
        return pd.DataFrame(out, columns=["x", "y"])

    return run


def _later_pairs(
    classes: DataFrame, postings: DataFrame, labels: DataFrame, check: _Verifier, percent: int
) -> DataFrame:
    """Pairs of classes in different components that share a bucket and are similar enough.

    A bucket is cut into blocks of about ``BLOCK_ITEMS`` shingles: large components have
    blocks of their own, the others share some. Blocks of one and the same component are not
    paired, so a large family costs no more than its meetings with what is outside.
    """
    marked = classes.select("set_key", "class_id", "n").join(labels, F.col("class_id") == F.col("vertex"), "left")
    marked = marked.select("set_key", "n", F.coalesce("component", "class_id").alias("comp"))
    held = stored(postings.select("bucket", "set_key").join(marked, "set_key"), "held")
    by_comp = held.groupBy("bucket", "comp").agg(F.sum("n").alias("size"))
    small = F.col("size") * 2 <= BLOCK_ITEMS
    mixed = by_comp.groupBy("bucket").agg(F.count(F.lit(1)).alias("c"), F.sum(F.when(small, F.col("size"))).alias("rest"))
    parts = F.ceil(F.coalesce(F.when(small, F.col("rest")), "size") / BLOCK_ITEMS)
    sized = by_comp.join(mixed.filter("c > 1"), "bucket").select(
        "bucket", "comp", F.when(small, F.lit(None)).otherwise(F.col("comp")).alias("own"), parts.alias("parts")
    )
    spread = F.xxhash64(F.when(F.col("own").isNull(), F.col("comp").cast("string")).otherwise(F.hex("set_key")))
    block = F.xxhash64("own", F.pmod(spread, F.col("parts")))
    open_ = stored(
        held.join(sized, ["bucket", "comp"]).select("bucket", "set_key", "comp", "n", "own", block.alias("block")), "open"
    )
    blocks = open_.select("bucket", "block", "own").distinct()
    one, two = (blocks.select("bucket", F.col("block").alias(f"b{i}"), F.col("own").alias(f"o{i}")) for i in (1, 2))
    apart = F.coalesce(F.col("o1") != F.col("o2"), F.lit(True))
    met = one.join(two, (one["bucket"] == two["bucket"]) & (F.col("b1") <= F.col("b2")) & apart).select(
        one["bucket"], "b1", "b2"
    )
    met = stored(met, "met")
    sides = met.select("bucket", "b1", "b2", F.col("b1").alias("block"), F.lit(False).alias("second")).unionByName(
        met.filter("b1 <> b2").select("bucket", "b1", "b2", F.col("b2").alias("block"), F.lit(True).alias("second"))
    )
    sets = check.sets(open_.select("set_key").distinct(), short=True)
    rows = open_.drop("own").join(sides, ["bucket", "block"]).join(sets, "set_key")
    found = rows.select("bucket", "b1", "b2", "second", "set_key", "comp", "n", "items").groupBy("bucket", "b1", "b2")
    return found.applyInPandas(_scan(percent), "x binary, y binary").distinct()


def near_duplicates(docs: DataFrame, words: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable by links), kept."""
    ready_python(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stored(
        docs.mapInArrow(_sign(words), "doc_id long, n long, set_key binary, signature binary"), "signed"
    )
    real = signed.filter("n > 0 AND doc_id IS NOT NULL")
    classes = stored(
        real.groupBy("set_key").agg(
            F.min("doc_id").alias("class_id"), F.first("n").alias("n"), F.first("signature").alias("signature")
        ),
        "classes",
    )
    check = _Verifier(docs.filter("doc_id IS NOT NULL"), classes, words)
    postings = _postings(classes)
    links = stored(check.links(stored(_first_pairs(postings, percent), "pairs"), percent), "links")
    # Rows of one id with different sets tie the classes of these sets.
    rows = real.select("doc_id", "set_key")
    several = rows.groupBy("doc_id").agg(F.min("set_key").alias("s1"), F.max("set_key").alias("s2")).filter("s1 < s2")
    ties = stored(
        rows.join(several.select("doc_id"), "doc_id", "left_semi")
        .distinct()
        .join(classes.select("set_key", "class_id"), "set_key")
        .select(F.col("doc_id").alias("a"), F.col("class_id").alias("b")),
        "ties",
    )
    labels = stored(component_labels(links.unionByName(ties)), "labels")
    later = stored(_later_pairs(classes, postings, labels, check, percent), "pairs")
    more = check.links(later, percent)
    joined = labels.select(F.col("vertex").alias("a"), F.col("component").alias("b")).unionByName(more)
    final = component_labels(joined)

    named = classes.select("set_key", "class_id").join(final, F.col("class_id") == F.col("vertex"), "left")
    named = named.select("set_key", F.coalesce("component", "class_id").alias("component_id"))
    linked = real.select("doc_id", "n", "set_key").join(named, "set_key").select("doc_id", "n", "component_id")
    alone = signed.filter("n = 0 OR doc_id IS NULL").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )
