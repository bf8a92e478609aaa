"""Connected components by alternating stars, for graphs of any size.

Each round replaces links by links to smaller nodes until every node points to the
smallest of its component. A round is two aggregates and two joins; its links are
written to the shared folder, so a lost executor costs no earlier round. A hub's
links meet its minimum in a join, which AQE splits, and never in one group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.sources.staging import stage


def _large_star(links: DataFrame, folder: str, name: str) -> DataFrame:
    """Large star: the neighbours of a node above it point to the node's smallest one.

    The minima are written first: AQE only splits a hub's links in a join whose sides
    both come straight from a shuffle.
    """
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stage(
        both.groupBy("a").agg(F.min("b").alias("least")).select(
            "a", F.least("a", "least").alias("least")
        ),
        folder,
        name,
    )
    return (
        both.join(least, "a")
        .filter(F.col("b") > F.col("a"))
        .select(F.col("least").alias("a"), "b")
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Small star: a node and its smaller neighbours point to the smallest of them."""
    least = links.groupBy("b").agg(F.min("a").alias("least"))
    moved = links.join(least, "b")
    return moved.select(
        F.explode(
            F.array(
                F.struct(F.col("least").alias("a"), F.col("b").alias("b")),
                F.struct(F.col("least").alias("a"), F.col("a").alias("b")),
            )
        ).alias("link")
    ).select("link.a", "link.b").filter(F.col("a") != F.col("b"))


def components(links: DataFrame, folder: str, name: str = "links") -> DataFrame:
    """(node, root) for every node of ``links`` (a, b with a < b); root is the smallest.

    Stops when every node has one link and no root has a link to a smaller node. The
    number of rounds grows with the logarithm of the longest path.
    """
    now = stage(links.select("a", "b").distinct(), folder, f"{name}_0")
    round_ = 0
    while True:
        round_ += 1
        grown = _large_star(now, folder, f"{name}_least_{round_}")
        now = stage(_small_star(grown).distinct(), folder, f"{name}_{round_}")
        roots = now.select(F.col("a").alias("b")).distinct()
        open_ = (
            now.groupBy("b").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).limit(1).count()
            or now.join(roots, "b", "left_semi").limit(1).count()
        )
        if not open_:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root"))
