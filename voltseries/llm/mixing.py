"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Sources, in code point order with null last, weigh ``weights`` in turn and share the
   words of all documents. A target stops at ``cap`` times its source's words; the rest
   is shared again by weight.
2. The documents of a source fall by hash into about sqrt(n) blocks. A source takes
   every block as often as its target holds all its words, and then blocks in a keyed
   order up to the target; the block at the target is cut between two documents. If the
   room left there is more than ``NEAR`` of the target, later documents and blocks fill it
   in a bounded number of rounds (``_filled``).
3. The draws of blocks are split among the output shards: a tree halves the shards, and
   at each node the left half draws its share of every source's quota from the
   multivariate hypergeometric distribution. Shards get exact quotas of nearly equal sums.
4. The draws of a source, in a keyed order, fill the quotas of the shards one after the
   other, so shards are disjoint; within a shard documents are put in a keyed order.

Everything is keyed by ``seed`` and the content, so reruns agree. Plans have one row per
source or block; documents meet them in one join that hot sources cannot skew, as its
key has the block.

Defined cases: a null or empty text has size 0 and is drawn like others, adding nothing;
rows equal in id and text share a key and are drawn together; sources without words
have target 0; a very long text is one document, passed over where it does not fit. Other columns are kept by ``mixed_documents``. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltseries.llm.common import stored, unit_hash, word_count

WEIGHTS = (5, 2, 1)
CAP = 3
SHARDS = 16
SEED = 17
NEAR = 0.001  # of a target: a smaller gap is left
ROUNDS = 12  # of filling a gap; each at least halves it
PART_WORDS = 4_000_000  # of a shard in one task
_ALL, _NONE = 2**63 - 1, -(2**63)


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Add weight, total and target to one row per source (source, source_size, n_docs).

    A source is capped if its cap is at most its share of what the sources with a
    smaller cap per weight leave; in that order the capped ones come first.
    """
    everything = Window.partitionBy()
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    weighed = sizes.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    fits = F.when(F.col("limit") > F.col("level") * F.col("weight"), F.struct("place", "level"))
    return (
        weighed.withColumn("level", level)
        .withColumn("place", F.row_number().over(by_limit))
        .withColumn("level", F.min(fits).over(everything)["level"])
        .withColumn("target", F.coalesce(F.least("limit", F.col("level") * F.col("weight")), F.lit(0.0)))
        .drop("level", "limit", "place")
    )


def hypergeometric(total: Column, marked: Column, drawn: Column, *key: Column) -> Column:
    """A draw of how many of ``drawn`` out of ``total`` items are among the ``marked``.

    The largest log-probability plus Gumbel noise is an exact draw; values beyond twelve
    standard deviations (chance below 1e-30) are not looked at.
    """
    n, big, k = drawn.cast("double"), total.cast("double"), marked.cast("double")
    mean = n * k / big
    spread = F.sqrt(mean * (1 - k / big) * (big - n) / F.greatest(big - 1, F.lit(1.0))) * 12 + 12
    low = F.greatest(F.lit(0.0), n - (big - k), F.floor(mean - spread).cast("double")).cast("bigint")
    high = F.least(k, n, F.ceil(mean + spread).cast("double")).cast("bigint")

    def step(state: Column, x: Column) -> Column:
        noisy = state["log"] - F.log(-F.log(unit_hash(*key, x)))
        better = noisy > state["best"]
        ratio = F.log((k - x) * (n - x)) - F.log((x + 1.0) * (big - k - n + x + 1.0))
        return F.struct(
            (state["log"] + F.coalesce(ratio, F.lit(0.0))).alias("log"),
            F.when(better, noisy).otherwise(state["best"]).alias("best"),
            F.when(better, x).otherwise(state["x"]).alias("x"),
        )

    start = F.struct(F.lit(0.0).alias("log"), F.lit(float("-inf")).alias("best"), low.alias("x"))
    return F.aggregate(F.sequence(low, high), start, step, lambda s: s["x"])


def shard_quotas(quotas: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(source_no, ends): running ends of the quotas of shards 0, 1, … per source.

    ``quotas`` has one row per source: source_no and quota, its number of draws. All
    sources stand in one row per node of the tree.
    """
    by_no = F.transform(F.sort_array(F.collect_list(F.struct("source_no", "quota"))), lambda s: s["quota"])
    nodes = quotas.agg(by_no.alias("q"), F.sum("quota").alias("n")).select(
        F.lit(0).alias("first"), F.lit(shards).alias("size"), "q", "n"
    )
    empty = F.expr("cast(array() as array<bigint>)")
    for _ in range(max(shards - 1, 0).bit_length()):
        left = F.floor(F.col("size") / 2).cast("int")
        want = F.floor(F.col("n") * left / F.col("size")).cast("bigint")

        def draw(state: Column, q: Column) -> Column:
            number = F.size(state["got"])
            x = F.when(q == state["rest"], state["want"]).otherwise(
                hypergeometric(
                    state["rest"], q, state["want"], F.lit(seed), F.col("first"), F.col("size"), number
                )
            )
            return F.struct(
                (state["want"] - x).alias("want"),
                (state["rest"] - q).alias("rest"),
                F.concat(state["got"], F.array(x)).alias("got"),
            )

        start = F.struct(want.alias("want"), F.col("n").alias("rest"), empty.alias("got"))
        got = F.aggregate("q", start, draw, lambda s: s["got"])
        split = nodes.withColumn("got", got).withColumn("left", left).withColumn("want", want)
        sides = F.when(
            F.col("size") == 1,
            F.array(F.struct(F.col("first"), F.col("size"), F.col("q").alias("q"), F.col("n").alias("n"))),
        ).otherwise(
            F.array(
                F.struct(F.col("first"), F.col("left").alias("size"), F.col("got").alias("q"), F.col("want").alias("n")),
                F.struct(
                    (F.col("first") + F.col("left")).alias("first"),
                    (F.col("size") - F.col("left")).alias("size"),
                    F.zip_with("q", "got", lambda q, x: q - x).alias("q"),
                    (F.col("n") - F.col("want")).alias("n"),
                ),
            )
        )
        nodes = split.select(F.explode(sides).alias("s")).select("s.*")
    leaves = nodes.select(F.col("first").alias("shard"), F.posexplode("q").alias("source_no", "quota"))
    upto = Window.partitionBy("source_no").orderBy("shard")
    return (
        leaves.withColumn("end", F.sum("quota").over(upto))
        .groupBy("source_no")
        .agg(F.sort_array(F.collect_list("end")).alias("ends"))
    )


def _keyed(docs: DataFrame, seed: int) -> DataFrame:
    """Add the key of a document: a hash of its id and its text."""
    key = F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.col("text").cast("string"))
    return docs.withColumn("_key", key)


def _block(n_docs: Column) -> Column:
    return F.pmod(F.col("_key"), F.ceil(F.sqrt(n_docs.cast("double"))))


def _wide(state: DataFrame) -> DataFrame:
    """The sources whose gap is more than ``NEAR`` of their target."""
    return state.filter(F.col("gap") > F.col("target") * NEAR).withColumnRenamed("spot", "_spot")


def _filled(tagged: DataFrame, blocks: DataFrame, state: DataFrame) -> DataFrame | None:
    """(source_no, block, _key): documents beyond the cut that fill the room left, or None.

    ``state`` has a row per source with a cut: the spot and key reached, the gap and the
    target. Only sources with a wide gap are looked at, and their later documents are
    gathered once. A round goes on from there over the documents of at most half the gap,
    up to the first that does not fit. Either that takes more than half the gap, or no such
    document is left: so the rounds are at most log2(1 / NEAR) for a gap as large as the
    target. At last the one document follows that comes nearest to what is left, if it is
    nearer than none.
    """
    wide = stored(_wide(state), "gaps")
    if wide.isEmpty():
        return None
    at, since = F.struct("spot", "_key"), F.struct("_spot", "after")
    places = blocks.select("source_no", "block", "spot").join(wide, "source_no").filter(F.col("spot") >= F.col("_spot"))
    later = stored(
        tagged.filter("size > 0")
        .join(places, ["source_no", "block"])
        .filter((at > since) & (F.col("size") < 2 * F.col("gap")))
        .groupBy("source_no", "block", "spot", "_key", F.col("gap").alias("_gap"))
        .agg(F.sum("size").alias("words"))
        .filter(F.col("words") < 2 * F.col("_gap"))
        .drop("_gap"),
        "later",
    )
    by_block = Window.partitionBy("source_no").orderBy("spot")
    in_block = Window.partitionBy("source_no", "spot").orderBy("_key")
    columns = ["source_no", "block", "_key"]
    taken = []
    for _ in range(ROUNDS):
        open_ = later.join(wide, "source_no").filter((at > since) & (2 * F.col("words") <= F.col("gap")))
        sums = (
            open_.groupBy("source_no", "spot", "gap")
            .agg(F.sum("words").alias("block_words"))
            .withColumn("before", F.sum("block_words").over(by_block) - F.col("block_words"))
            .filter("before < gap")
            .select("source_no", "spot", "before")
        )
        found = stored(
            open_.join(sums, ["source_no", "spot"])
            .withColumn("upto", F.col("before") + F.sum("words").over(in_block))
            .filter("upto <= gap")
            .select(*columns, "spot", "upto"),
            "fill",
        )
        if found.isEmpty():
            break
        taken.append(found.select(*columns))
        last = found.groupBy("source_no").agg(
            F.max("upto").alias("got"), F.max(F.struct(F.col("spot").alias("_spot"), F.col("_key").alias("after"))).alias("last")
        )
        moved = wide.join(last, "source_no", "left").select(
            "source_no",
            F.coalesce("last._spot", "_spot").alias("_spot"),
            F.coalesce("last.after", "after").alias("after"),
            (F.col("gap") - F.coalesce("got", F.lit(0))).alias("gap"),
            "target",
        )
        wide = stored(moved.filter(F.col("gap") > F.col("target") * NEAR), "gaps")
    left = later.join(wide, "source_no")
    for found in taken:
        left = left.join(found, columns, "left_anti")
    nearest = left.filter(F.col("words") < 2 * F.col("gap")).groupBy("source_no").agg(
        F.min(F.struct(F.abs(F.col("words") - F.col("gap")).alias("miss"), "spot", "_key", "block")).alias("s")
    )
    every = nearest.select("source_no", "s.block", "s._key")
    for found in taken:
        every = every.unionByName(found)
    return stored(every, "extras")


def mixing_plan(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, shards: int = SHARDS, seed: int = SEED
) -> tuple[DataFrame, DataFrame | None]:
    """One row per source and block: source, block, n_docs, source_size, target, draws.

    ``sized`` has source, size and _key. A draw is (pass, shard, limit, partial); it holds
    the documents of the block whose key is at most the limit. The second table, if any,
    has (source, _key) of documents beyond the limit that the partial draw takes, too.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    sources = targets(sources, weights, cap).withColumn(
        "source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    )
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = stored(
        sources.withColumn("passes", passes.cast("int")).withColumn(
            "rest", F.col("target") - F.col("passes") * F.col("source_size")
        ),
        "sources",
    )

    # Blocks of each source in their keyed order, and the one that holds the target.
    tagged = sized.join(sources.select("source", "n_docs", "source_no"), sized["source"].eqNullSafe(sources["source"]))
    tagged = tagged.select("source_no", _block(F.col("n_docs")).alias("block"), "_key", "size")
    blocks = tagged.groupBy("source_no", "block").agg(F.sum("size").alias("words"))
    place = Window.partitionBy("source_no").orderBy(F.xxhash64(F.lit(seed), "source_no", "block"), "block")
    blocks = stored(
        blocks.join(sources, "source_no")
        .withColumn("upto", F.sum("words").over(place))
        .withColumn("spot", F.row_number().over(place))
        .withColumn(
            "part",
            F.when(F.col("upto") <= F.col("rest"), "whole").when(
                F.col("upto") - F.col("words") < F.col("rest"), "cut"
            ),
        ),
        "blocks",
    )

    # Inside the cut block, one per source: documents up to the target.
    cut = blocks.filter("part = 'cut'").select(
        "source_no", "block", "spot", "target", (F.col("rest") - F.col("upto") + F.col("words")).alias("room")
    )
    own = ["source_no", "block", "spot", "target", "room"]
    fits = F.col("upto") <= F.col("room")
    inside = stored(
        tagged.join(cut, ["source_no", "block"])
        .groupBy(*own, "_key")
        .agg(F.sum("size").alias("words"))
        .withColumn("upto", F.sum("words").over(Window.partitionBy("source_no", "block").orderBy("_key")))
        .groupBy(*own)
        .agg(
            F.coalesce(F.max(F.when(fits, F.col("_key"))), F.lit(_NONE)).alias("after"),
            (F.col("room") - F.coalesce(F.max(F.when(fits, F.col("upto"))), F.lit(0))).alias("gap"),
        ),
        "cut-blocks",
    )
    extras = _filled(tagged, blocks, inside.select("source_no", "spot", "after", "gap", "target"))
    reached = inside.select("source_no", "block", F.col("after").alias("limit"))
    if extras is not None:
        more = extras.select("source_no", "block", F.lit(_NONE).alias("limit")).distinct()
        reached = reached.unionByName(more).groupBy("source_no", "block").agg(F.max("limit").alias("limit"))
    limited = blocks.join(reached, ["source_no", "block"], "left").withColumn(
        "limit", F.when(F.col("part") == "whole", F.lit(_ALL)).otherwise(F.col("limit"))
    )

    # One row per draw of a block: the whole passes, then the partial one.
    whole = F.transform(
        F.sequence(F.lit(0), F.col("passes")),
        lambda p: F.struct(
            p.alias("pass"),
            F.when(p < F.col("passes"), F.lit(_ALL)).otherwise(F.col("limit")).alias("limit"),
            (p == F.col("passes")).alias("partial"),
        ),
    )
    by_hash = Window.partitionBy("source_no").orderBy(
        F.xxhash64(F.lit(seed + 1), "source_no", "block", "pass"), "block", "pass"
    )
    draws = stored(
        limited.select("source_no", "block", F.explode(whole).alias("d"))
        .filter("d.limit IS NOT NULL")
        .select("source_no", "block", "d.*")
        .withColumn("place", F.row_number().over(by_hash) - 1),
        "draws",
    )
    quotas = sources.select("source_no").join(
        draws.groupBy("source_no").agg(F.count(F.lit(1)).alias("quota")), "source_no", "left"
    )
    ends = shard_quotas(quotas.select("source_no", F.coalesce("quota", F.lit(0)).alias("quota")), shards, seed)
    dealt = (
        draws.join(stored(ends, "quotas"), "source_no")
        .withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("place"))))
        .groupBy("source_no", "block")
        .agg(F.sort_array(F.collect_list(F.struct("pass", "shard", "limit", "partial"))).alias("draws"))
    )
    plan = stored(
        blocks.join(dealt, ["source_no", "block"], "left").select(
            "source", "block", "n_docs", "source_size", "target", "draws"
        ),
        "mix-plan",
    )
    if extras is not None:
        extras = extras.join(sources.select("source_no", "source"), "source_no").select("source", "_key")
        extras = stored(extras.distinct(), "extras")
    return plan, extras


def with_draws(docs: DataFrame, plan: DataFrame, extras: DataFrame | None = None) -> DataFrame:
    """Documents (source, _key, …) with source_size, target and their own draws."""
    sources = plan.select("source", "n_docs").distinct().withColumnsRenamed({"source": "_s", "n_docs": "_n"})
    blocked = docs.join(sources, docs["source"].eqNullSafe(sources["_s"])).withColumn("_block", _block(F.col("_n")))
    side = plan.withColumnsRenamed({"source": "_source", "block": "_b", "draws": "_draws"})
    both = blocked.join(side, (blocked["_block"] == side["_b"]) & blocked["source"].eqNullSafe(side["_source"]))
    if extras is None:
        both = both.withColumn("_extra", F.lit(False))
    else:
        more = extras.select(F.col("source").alias("_es"), F.col("_key").alias("_ek"), F.lit(True).alias("_extra"))
        both = both.join(more, (both["_key"] == more["_ek"]) & both["source"].eqNullSafe(more["_es"]), "left")
        both = both.withColumn("_extra", F.coalesce("_extra", F.lit(False))).drop("_ek", "_es")
    empty = F.expr("cast(array() as array<struct<pass:int,shard:int,limit:bigint,partial:boolean>>)")
    own = F.filter(
        F.coalesce("_draws", empty), lambda d: (F.col("_key") <= d["limit"]) | (d["partial"] & F.col("_extra"))
    )
    return both.withColumn("draws", own).drop("_s", "_n", "_block", "_source", "_b", "_draws", "_extra")


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    rows = _keyed(docs.select("doc_id", "text", F.col("source").cast("string").alias("source")), seed)
    return stored(rows.select("doc_id", "source", "_key", word_count(F.col("text")).alias("size")), "sized")


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, shards: int = SHARDS, seed: int = SEED
) -> DataFrame:
    """doc_id, size, source_size, target, taken, shards: one row per document."""
    sized = _sized(docs, seed)
    drawn = with_draws(sized, *mixing_plan(sized, weights, cap, shards, seed))
    return drawn.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.size("draws")).cast("bigint").alias("taken"),
        F.transform("draws", lambda d: d["shard"]).alias("shards"),
    )


def mixed_documents(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, shards: int = SHARDS, seed: int = SEED
) -> DataFrame:
    """The rows of ``docs`` as often as they are drawn, by shard and in keyed order.

    A shard is a run of consecutive partitions, each a range of the keyed order of about
    ``PART_WORDS`` words: the order is a hash, so equal ranges hold nearly equal shares.
    """
    sized = _sized(docs, seed)
    plan, extras = mixing_plan(sized, weights, cap, shards, seed)
    wanted = plan.select("source", "target").distinct().agg(F.sum("target").alias("t")).first()["t"] or 0.0
    parts = int(wanted / shards // PART_WORDS) + 1
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("_row"), "doc_id", "text", F.col("source").cast("string").alias("source")
    )
    rows = _keyed(rows, seed).select("_row", "source", "_key")
    drawn = with_draws(rows, plan, extras).select("_row", "_key", F.explode("draws").alias("_d"))
    order = F.shiftrightunsigned(F.xxhash64(F.lit(seed + 2), "_key", "_d.pass"), 1)
    part = F.least(F.floor(F.col("_order") / F.lit(2.0**63) * parts), F.lit(parts - 1))
    return (
        drawn.select("_row", F.col("_d.shard").alias("_shard"), order.alias("_order"))
        .repartitionById(shards * parts, (F.col("_shard") * parts + part).cast("int"))
        .sortWithinPartitions("_shard", "_order")
        .select("_row.*")
    )
