"""N-gram Jaccard join by grouped prefixes.

A document is the set of its distinct word shingles. Two documents link when the
Jaccard similarity of their sets is at least ``percent`` / 100.

1. Every set is put in one total order, and its prefix is kept: linked sets share a
   shingle of their prefixes. The order puts shingles that repeat within a chunk of
   input last; any order gives the same links, this one keeps common passages out of
   the prefixes. Documents with equal sets form one class, classes with equal prefix
   and size one group.
2. Only shingles in the prefixes of two groups enter the index.
3. Star round: each index entry, and each group, links its members to its smallest
   one. The pairs are verified on the whole sets, and components are formed.
4. Full round: what is left are pairs of stars in different components that share an
   index entry. They are filtered by size and by the number of shared prefix shingles,
   expanded to those members that can still be similar enough, and verified. No candidate
   is cut off:
   a pair is skipped only if its two ends are in one component already, or if the
   filters prove that it cannot link.

Defined cases: null and empty texts have empty sets and link with nothing; a null
id takes no part in links and has a null component; rows that repeat an id are one
vertex (it links if any of its texts does) and keep a result row each; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltseries.llm.common import ready_python, stored
from voltseries.llm.components import component_labels
from voltseries.llm.shingles import list_array, shingle_sets

CHUNK = 1_000_000  # shingles counted together when looking for common ones
COMMON = 3  # a shingle in so many different texts of a chunk is ordered last
MAX_COMMON = 500_000  # at most so many are sent to the executors: 4 MB; affects speed only
FILTER_BITS = 1 << 24


def _common_in_chunks(words: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: list[np.ndarray] = []
        seen: set[int] = set()
        total = 0

        def found() -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(sets), return_counts=True)
            keep = n >= COMMON
            return pa.RecordBatch.from_arrays([pa.array(values[keep]), pa.array(n[keep])], ["h", "n"])

        for batch in batches:
            for shingles in shingle_sets(batch.column(0), words):
                key = xxhash.xxh3_64_intdigest(shingles)
                if key not in seen:
                    seen.add(key)
                    sets.append(shingles)
                    total += len(shingles)
                if total >= CHUNK:
                    yield found()
                    sets, seen, total = [], set(), 0
        if sets:
            yield found()

    return count


def _common_shingles(docs: DataFrame, words: int) -> np.ndarray:
    counted = docs.select("text").mapInArrow(_common_in_chunks(words), "h long, n long")
    top = (
        counted.groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h").limit(MAX_COMMON).select("h")
    )
    return np.sort(top.toPandas()["h"].to_numpy(np.int64))


def _prepare(words: int, percent: int, common) -> object:
    def longs(values: list[int]) -> pa.Array:
        return pa.array(np.array(values, np.uint64).view(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = common.value
        for batch in batches:
            sizes, keys, prefixes = [], [], []
            for shingles in shingle_sets(batch.column(1), words):
                n = len(shingles)
                if n and len(last):
                    late = last[np.minimum(np.searchsorted(last, shingles), len(last) - 1)] == shingles
                    ordered = np.concatenate([shingles[~late], shingles[late]]) if late.any() else shingles
                else:
                    ordered = shingles
                prefix = ordered[: n - (-(-n * percent // 100)) + 1] if n else ordered
                sizes.append(n)
                keys.append((xxhash.xxh3_128_intdigest(shingles), xxhash.xxh3_128_intdigest(prefix)))
                prefixes.append(prefix)
            half = (1 << 64) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    longs([s >> 64 for s, _ in keys]),
                    longs([s & half for s, _ in keys]),
                    longs([p >> 64 for _, p in keys]),
                    longs([p & half for _, p in keys]),
                    list_array(prefixes),
                ],
                ["doc_id", "n_shingles", "set_hi", "set_lo", "pre_hi", "pre_lo", "prefix"],
            )

    return run


def _set_rows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column(1), words))
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, list_array(sets)], ["vertex", "n", "items"])

    return run


def _maybe_in(rows: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """Rows whose number in ``column`` may be in ``wanted``, chosen without a shuffle.

    The wanted numbers set bits of a map of FILTER_BITS. It has FILTER_BITS / 64 rows at
    most (4 MB), so it is broadcast whatever the number of rows; a full map only lets
    more rows through. Callers join exactly afterwards.
    """
    place = f"pmod(xxhash64({column}), {FILTER_BITS})"
    cell, bit = f"{place} div 64", f"shiftleft(1L, cast({place} % 64 as int))"
    bits = wanted.selectExpr(f"{cell} AS _cell", f"{bit} AS _bit").groupBy("_cell").agg(F.bit_or("_bit").alias("_bits"))
    return (
        rows.withColumns({"_cell": F.expr(cell), "_bit": F.expr(bit)})
        .join(F.broadcast(bits), "_cell")
        .filter(F.col("_bits").bitwiseAND(F.col("_bit")) != 0)
        .drop("_cell", "_bit", "_bits")
    )


def _in_pairs(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows whose doc_id stands in some pair, and few others."""
    ends = [pairs.select(F.col(c).alias("doc_id")).distinct() for c in ("a", "b")]
    wanted = ends[0].unionByName(ends[1])
    return _maybe_in(rows.filter(F.col("doc_id").isNotNull()), wanted, "doc_id")


def _needed(percent: int) -> Column:
    """Shared shingles that sets of n1 and n2 need at least."""
    return F.ceil(F.lit(percent) * (F.col("n1") + F.col("n2")) / F.lit(100 + percent))


def _beyond(n: str, percent: int) -> Column:
    """Shingles of a set behind its prefix."""
    return F.ceil(F.col(n) * percent / 100) - 1


def _may_link(percent: int, shared: Column) -> Column:
    rest = F.greatest(_beyond("n1", percent), _beyond("n2", percent))
    return shared + rest >= _needed(percent)


def _sizes_fit(percent: int) -> Column:
    return F.least("n1", "n2") * 100 >= F.greatest("n1", "n2") * percent


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, n1, n2 and the number of ``items`` that both have; ``sets`` has vertex, n, items."""
    left = sets.select(F.col("vertex").alias("a"), F.col("n").alias("n1"), F.col("items").alias("ia"))
    right = sets.select(F.col("vertex").alias("b"), F.col("n").alias("n2"), F.col("items").alias("ib"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a")
    return both.select("a", "b", "n1", "n2", F.size(F.array_intersect("ia", "ib")).cast("bigint").alias("k"))


def _whole_sets(docs: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """vertex, n and items (all shingles) of the documents in some pairs."""
    texts = _in_pairs(docs, pairs).select("doc_id", "text")
    return stored(texts.mapInArrow(_set_rows(words), "vertex long, n long, items array<long>"), "sets")


def verified(pairs: DataFrame, prepared: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs that link: a, b, n1, n2 and k, the number of shingles both have.

    The prefixes, a fifth of the sets, rule out most others; the rest are compared on
    the whole sets.
    """
    prefixes = _in_pairs(prepared, pairs).selectExpr("doc_id AS vertex", "n_shingles AS n", "prefix AS items")
    near = _overlaps(pairs, prefixes).filter(_sizes_fit(percent) & _may_link(percent, F.col("k")))
    near = stored(near.select("a", "b").distinct(), "near")
    union = F.col("n1") + F.col("n2") - F.col("k")
    return _overlaps(near, _whole_sets(docs, near, words)).filter(F.col("k") * 100 >= union * percent)


def ngram_classes(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id, component_id.

    ``class_id`` is the smallest id with the same set, ``component_id`` the smallest
    id reachable by links; both are the own id for a document without links.
    """
    spark = docs.sparkSession
    ready_python(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    common = spark.sparkContext.broadcast(_common_shingles(docs, words))
    prepared = stored(
        docs.mapInArrow(
            _prepare(words, percent, common),
            "doc_id long, n_shingles long, set_hi long, set_lo long, pre_hi long, pre_lo long, prefix array<long>",
        ),
        "shingled",
    )
    real = prepared.filter("n_shingles > 0 AND doc_id IS NOT NULL").withColumnRenamed("n_shingles", "n")

    # Classes of equal sets, groups of equal prefix and size.
    group_key = ["n", "pre_hi", "pre_lo"]
    by_set = real.groupBy("set_hi", "set_lo").agg(
        F.min("doc_id").alias("class_id"), *[F.first(c).alias(c) for c in group_key]
    )
    groups = real.groupBy(*group_key).agg(F.min("doc_id").alias("g"))
    classes = stored(
        by_set.join(groups, group_key).select("set_hi", "set_lo", "class_id", "n", "g"), "classes"
    )

    # Index of the prefixes of groups: shingles that two groups share.
    led = real.groupBy(*group_key).agg(F.min("doc_id").alias("g"), F.first("prefix").alias("prefix"))
    entries = led.select(F.explode("prefix").alias("h"), "g", "n")
    shared = entries.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("h")
    index = stored(_maybe_in(entries, shared, "h").join(shared, "h", "left_semi"), "index")

    first = stored(_star_pairs(classes, index, percent), "pairs")
    links = stored(verified(first, prepared, docs, words, percent), "links")
    labels = component_labels(links)
    rest = stored(_open_pairs(classes, index, links, labels, docs, words, percent), "pairs")
    more = verified(rest, prepared, docs, words, percent)
    joined = labels.select(F.col("vertex").alias("a"), F.col("component").alias("b")).unionByName(
        more.select("a", "b")
    )
    final = component_labels(joined)

    named = classes.join(final, classes["class_id"] == final["vertex"], "left").select(
        "set_hi", "set_lo", "class_id", F.coalesce("component", "class_id").alias("component_id")
    )
    rows = prepared.filter("n_shingles > 0 AND doc_id IS NOT NULL").join(named, ["set_hi", "set_lo"])
    alone = prepared.filter("n_shingles = 0 OR doc_id IS NULL").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id")
    )
    return rows.select("doc_id", "n_shingles", "class_id", "component_id").unionByName(alone)


def _star_pairs(classes: DataFrame, index: DataFrame, percent: int) -> DataFrame:
    """Members of a group to its smallest one, groups of an entry to its smallest one."""
    inner = classes.filter("class_id <> g").select(F.col("g").alias("a"), F.col("class_id").alias("b"))
    centres = index.groupBy("h").agg(F.min(F.struct("g", "n")).alias("c"))
    spokes = (
        index.join(centres, "h")
        .filter("g <> c.g")
        .select(F.col("c.g").alias("a"), F.col("c.n").alias("n1"), F.col("g").alias("b"), F.col("n").alias("n2"))
        .filter(_sizes_fit(percent))
        .groupBy("a", "b", "n1", "n2")
        .agg(F.count(F.lit(1)).alias("k"))
        # Only entries centred here are counted; a pair passed over is left for the full round.
        .filter(_may_link(percent, F.col("k") * 4))
        .select("a", "b")
    )
    return inner.unionByName(spokes).distinct()


def _open_pairs(
    classes: DataFrame,
    index: DataFrame,
    links: DataFrame,
    labels: DataFrame,
    docs: DataFrame,
    words: int,
    percent: int,
) -> DataFrame:
    """Candidate pairs of classes whose components still differ.

    A class that links to a centre of the star round belongs to the centre's star, any
    other is a star of its own. Stars, not their members, meet in the index. For two
    stars of several members the centres are compared: members m1 and m2 share at most
    what their centres share, plus what m1 and m2 have beyond their own centres. Only
    pairs of members that can still reach the similarity are handed on.
    """
    nearest = links.groupBy("b").agg(F.min(F.struct((F.col("n2") - F.col("k")).alias("beyond"), "a")).alias("s"))
    marked = stored(
        classes.join(labels, classes["class_id"] == labels["vertex"], "left")
        .join(nearest, F.col("class_id") == F.col("b"), "left")
        .select(
            "class_id",
            "g",
            "n",
            F.coalesce("component", "class_id").alias("comp"),
            F.coalesce("s.a", "class_id").alias("star"),
            F.coalesce("s.beyond", F.lit(0)).alias("beyond"),
        ),
        "marked",
    )
    held = marked.select("g", "star", "comp").distinct()
    posted = stored(
        index.join(held, "g")
        .groupBy("h", "star", "comp")
        .agg(F.min("n").alias("low"), F.max("n").alias("high")),
        "posted",
    )
    mixed = posted.groupBy("h").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).filter("c1 < c2").select("h")
    posted = posted.join(mixed, "h", "left_semi")
    x, y = (
        posted.select("h", *[F.col(c).alias(f"{c}{i}") for c in ("star", "comp", "low", "high")]) for i in (1, 2)
    )
    # Some sizes of the two ranges must fit.
    fit = (F.col("high1") * 100 >= F.col("low2") * percent) & (F.col("high2") * 100 >= F.col("low1") * percent)
    met = (
        x.join(y, (x["h"] == y["h"]) & (F.col("star1") < F.col("star2")) & (F.col("comp1") != F.col("comp2")) & fit)
        .groupBy("star1", "star2")
        .agg(
            F.count(F.lit(1)).alias("k"),
            F.least(F.min("low1"), F.min("low2")).alias("n1"),
            F.greatest(F.max("high1"), F.max("high2")).alias("n2"),
        )
        # The fewest shared shingles are needed by the smallest set and the largest that fits it.
        .withColumn("n2", F.least(F.col("n2"), F.floor(F.col("n1") * 100 / percent)))
        .filter(_may_link(percent, F.col("k") + 2))
        .select("star1", "star2")
    )
    stars = marked.groupBy("star").agg(
        F.min("n").alias("low"),
        F.max("beyond").alias("most"),
        ((F.count(F.lit(1)) == 1) & (F.min("class_id") == F.col("star"))).alias("single"),
    )
    one, two = (stars.select(*[F.col(c).alias(f"{c}{i}") for c in stars.columns]) for i in (1, 2))
    met = stored(met.join(one, "star1").join(two, "star2"), "met")
    single = F.col("single1") & F.col("single2")
    direct = met.filter(single).select(F.col("star1").alias("a"), F.col("star2").alias("b"))

    centres = met.filter(~single).select(F.col("star1").alias("a"), F.col("star2").alias("b"), "low2", "most2")
    shared = _overlaps(centres, _whole_sets(docs, centres, words)).groupBy("a", "b").agg(F.max("k").alias("k"))
    left = marked.select(F.col("star").alias("a"), F.col("class_id").alias("m1"), F.col("n").alias("n1"), F.col("beyond").alias("b1"))
    right = marked.select(F.col("star").alias("b"), F.col("class_id").alias("m2"), F.col("n").alias("n2"), F.col("beyond").alias("b2"))
    least = F.greatest(F.col("low2"), F.ceil(F.col("n1") * percent / 100))
    reach1 = F.col("k") + F.col("b1") + F.col("most2") >= F.ceil(F.lit(percent) * (F.col("n1") + least) / F.lit(100 + percent))
    known = centres.join(shared, ["a", "b"])
    half = known.join(left, (known["a"] == left["a"]) & reach1).drop(left["a"])
    reach2 = F.col("k") + F.col("b1") + F.col("b2") >= _needed(percent)
    across = half.join(right, (half["b"] == right["b"]) & _sizes_fit(percent) & reach2).select(
        F.col("m1").alias("a"), F.col("m2").alias("b")
    )
    # Inside one group: equal prefixes, different sets, still in different components.
    split = marked.groupBy("g").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).filter("c1 < c2").select("g")
    own = marked.join(split, "g", "left_semi")
    left = own.select("g", F.col("comp").alias("c1"), F.col("class_id").alias("a"))
    right = own.select("g", F.col("comp").alias("c2"), F.col("class_id").alias("b"))
    inside = left.join(right, "g").filter("c1 < c2").select("a", "b")
    return direct.unionByName(across).unionByName(inside).distinct()


def one_per_component(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without those linked to a document of smaller id.

    Rows that repeat an id and a null id all stay, as do documents without words.
    """
    found = ngram_classes(docs, words, percent)
    gone = found.filter("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
