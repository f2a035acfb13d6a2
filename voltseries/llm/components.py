"""Connected components by alternating large-star and small-star rounds.

Both rounds only group by a vertex and join back, so a vertex of any degree is
aggregated in parts on the map side. Every round is stored in the shared scratch
folder. The edges shrink to stars whose centre is the smallest vertex.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltseries.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # Edges point from the larger vertex u to the smaller v.
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("h"),
    ).first()
    return row["n"], row["h"]


def component_labels(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(vertex, component): the smallest vertex each linked vertex can reach.

    Vertices without links are absent. Self-links and repeated links do no harm;
    links with a null end are ignored.
    """
    high, low = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    edges = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = stored(edges.select(high, low).distinct(), "edges")
    before = _state(edges)
    while before[0]:
        edges = stored(_small_star(_large_star(edges)), "edges")
        now = _state(edges)
        if now == before:
            break
        before = now
    stars = edges.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
    centres = edges.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    return stars.unionByName(centres)
