"""Connected components of links, in distributed steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropsieve.llm.common import drop, stored


def components(links: DataFrame) -> DataFrame:
    """id and component, the smallest id that can be reached, for all ids in ``links`` (a, b).

    Large and small stars by turns: every node hands its larger neighbours its smallest one, then
    its smaller ones. Sums and joins only; a node with very many neighbours is one whose edges all
    lead to the smallest, and its minimum combines before the shuffle. Each round is stored. Rounds
    end when a round leaves the edges as they are.
    """
    edges = stored(_ordered(links.selectExpr("greatest(a, b) AS a", "least(a, b) AS b")), "links")
    before = None
    while True:
        last, edges = edges, stored(_small(_large(edges)), "links")
        drop(last)
        now = edges.selectExpr("count(*) AS n", "sum(cast(xxhash64(a, b) AS decimal(38))) AS h").first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").distinct()


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.selectExpr("b AS a", "a AS b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    far = both.where("b > a").join(least, "a")
    return _ordered(far.selectExpr("b AS a", "m AS b"))


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    near = edges.join(least, "a").selectExpr("b AS a", "m AS b")
    return _ordered(near.unionByName(least.selectExpr("a", "m AS b")))
