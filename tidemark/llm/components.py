"""Connected components of a graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import discard, durable


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Each linked node with the smallest node it can reach: columns ``id`` and ``root``.

    Larger neighbours are hung below the smallest one, then smaller ones, in turn, until nothing changes;
    a chain of n nodes takes some log n squared turns. A node of any degree is summed up by a partial
    minimum, and its links meet that minimum in a join that can be split. Each turn is written to the
    shared folder, so a lost executor costs no earlier turn. Null ends and loops are left out.
    """
    links = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
    edges = durable(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = durable(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = (joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        done, edges = edges, durable(small)
        discard(edges.sparkSession, [done, large])
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    hung = edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return hung.unionByName(hung.select(F.col("root").alias("id"), "root").distinct())


def _mark(edges: DataFrame) -> tuple:
    """What tells one set of links from the next: their number and a sum over them."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
