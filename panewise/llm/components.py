"""Connected components of a graph of links, round by round on Spark.

Every round contracts the graph: each node is linked to the least neighbour it has (large
stars, then small stars), so paths halve and no node gathers more links than it has
neighbours. Nothing but two counts per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panewise.llm.tables import stored


def _least(edges: DataFrame) -> DataFrame:
    """(node, least): the least of each node and its neighbours. ``edges`` has both directions."""
    return edges.groupBy("node").agg(F.least("node", F.min("other")).alias("least"))


def _both(links: DataFrame) -> DataFrame:
    return links.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(
        links.select(F.col("low").alias("node"), F.col("high").alias("other"))
    )


def _links(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) as distinct links (high, low), loops left out."""
    return (
        pairs.where("a <> b")
        .select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
        .distinct()
    )


def components(pairs: DataFrame) -> DataFrame:
    """(node, component) for every node of ``pairs`` (a, b), whole numbers: the least node it can reach."""
    links = stored(_links(pairs), "links")
    state = None
    while True:
        # Large stars: neighbours above a node move to the least one around it.
        edges = _both(links)
        large = (
            edges.where("other > node").join(_least(edges), "node").select(F.col("other").alias("a"), F.col("least").alias("b"))
        )
        large = stored(_links(large), "large-stars")
        # Small stars: neighbours below a node, and the node itself, move to the least one.
        down = large.select(F.col("high").alias("node"), F.col("low").alias("other"))
        least = _least(down)
        small = down.join(least, "node").select(F.col("other").alias("a"), F.col("least").alias("b"))
        small = small.unionByName(least.select(F.col("node").alias("a"), F.col("least").alias("b")))
        links = stored(_links(small), "small-stars")
        now = links.agg(F.count("high"), F.bit_xor(F.xxhash64("high", "low"))).first()
        if now == state:
            break
        state = now
    roots = links.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return links.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(roots)
