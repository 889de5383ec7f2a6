"""Components of links between documents or vectors, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.session import staged

# Rows up to which a side of ids is broadcast (8 bytes each); beyond, both sides are shuffled.
BROADCAST_IDS = 1_000_000
# Rows of a few numbers each that one task writes at least.
ROWS_A_FILE = 200_000


def few(ids: DataFrame, rows: int | None = None) -> DataFrame:
    """`ids` (a staged frame of one or two id columns) with a broadcast hint if it is counted to be small."""
    n = ids.count() if rows is None else rows
    return F.broadcast(ids) if n <= BROADCAST_IDS else ids


def light(df: DataFrame, rows: int) -> DataFrame:
    """`df` in as few tasks as about `rows` rows of numbers need, so that small results make few files."""
    return df.coalesce(1 + rows // ROWS_A_FILE)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b): the smallest node reachable.

    Alternates two star steps: neighbours larger than a node are linked to its smallest neighbour, then
    smaller ones are. Each round is a grouped minimum and a join, written to the shared folder; the number
    of rounds grows with the logarithm of the longest chain. Nodes without edges are not returned.
    """
    both = lambda e: e.unionByName(e.selectExpr("v AS u", "u AS v"))
    n, told = edges.count(), None
    now = staged(light(edges.where("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v").distinct(), n), "edges")
    while True:
        around = both(now)
        smallest = around.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
        large = around.join(smallest, "u").where("v > u").selectExpr("v AS u", "m AS v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").selectExpr("v AS u", "m AS v").unionByName(least.selectExpr("u", "m AS v"))
        now = staged(light(small.distinct(), n), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == told:
            return now.selectExpr("u AS node", "v AS component").unionByName(now.selectExpr("v AS node", "v AS component").distinct())
        n, told = seen[0], seen
