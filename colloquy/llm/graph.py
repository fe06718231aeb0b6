"""Connected components of links between ids, by alternating large and small stars.

Each round is an aggregate (combined before its shuffle) and a join, so a node with very many links is
no single task's work; links stay distributed and are written to the shared folder after each round, in
place of the round's before. Rounds go on until every component is a star; their number grows with the
logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.scratch import cut, drop


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links every neighbour of a node to the least of them: the greater ones (large), or the lesser and the node itself."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    met = both.join(least, "u")
    new = met.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b")) if large else met.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return new.filter("a != b").distinct()


def _settled(links: DataFrame) -> bool:
    """Whether each node has one link to a lesser one at most, and that leads to a node without such a link."""
    ends = links.select(F.col("a").alias("id"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(links.select(F.col("b").alias("id"), F.lit(0).alias("below"), F.lit(1).alias("above")))
    roles = ends.groupBy("id").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return roles.filter("below > 1 OR (below = 1 AND above = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """Of links (a, b): every id that is linked, with the least id reachable: (id, least). The result is a table of `cut`."""
    links = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "links")
    while not _settled(links):
        after = cut(_star(_star(links, True), False), "links")
        drop(links)
        links = after
    ids = cut(links.select(F.col("a").alias("id"), F.col("b").alias("least")).unionByName(links.select(F.col("b").alias("id"), F.col("b").alias("least"))).distinct(), "components")
    drop(links)
    return ids
