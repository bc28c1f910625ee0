"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    return joined.select("b", "m").union(joined.select("a", "m")).toDF("a", "b")


def _clean(edges: DataFrame) -> DataFrame:
    return edges.filter("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in ``edges`` (a, b); component is the smallest id reachable.

    Each round is written to the shared scratch folder, so lineage stays short and a
    lost executor repeats one round at most. Ends when a round changes nothing,
    which takes a logarithmic number of rounds even for long chains. Rows of an
    edge with itself or with a null end are left out.
    """
    now = materialise(_clean(edges.select("a", "b").filter("a is not null and b is not null")), "edges")

    def mark(e):
        return e.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()

    before = mark(now)
    while before[0]:
        now = materialise(_clean(_small_star(_clean(_large_star(now)))), "stars")
        after = mark(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("b").alias("id")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")) \
        .union(roots.select("id", F.col("id").alias("component")))
