"""Connected components of a link table, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import Scratch
from pairloom.session import written


def _large_star(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to its smallest neighbour or itself."""
    turned = links.select(F.col("v").alias("u"), F.col("u").alias("v"))
    both = links.select("u", "v").unionByName(turned)
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return (
        both.filter("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = (
        links.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _stored(links: DataFrame, scratch: Scratch) -> tuple[str, DataFrame]:
    path = scratch.path("links")
    return path, written(links, path)


def connected_components(links: DataFrame, scratch: Scratch, most_rounds: int = 60) -> DataFrame:
    """`(node, component)` for every node of `links(u, v)`: the smallest node it reaches.

    The number of links never grows, and each round only exchanges each node's smallest
    neighbour, which is combined before the shuffle; a hub that a third of all nodes are
    linked to is one row of `least`, and its links are a skewed join that Spark may split.
    Rounds are written to the scratch folder; the table before the last is deleted.
    """
    u, v = F.greatest("u", "v"), F.least("u", "v")
    start = links.filter("u <> v").select(u.alias("u"), v.alias("v")).distinct()
    path, current = _stored(start, scratch)
    state = None
    for _ in range(most_rounds):
        last = path
        path, current = _stored(_small_star(_large_star(current)), scratch)
        scratch.drop(last)
        checksum = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        seen = current.agg(F.count(F.lit(1)), checksum).first()
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)
