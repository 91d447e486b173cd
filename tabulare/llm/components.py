"""Connected components of links that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulare.session import work_table


HUB_LINKS = 256


def _with_nearest(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The links with ``_m``, the smallest neighbour ``v`` of their ``u``, and these minima, one per ``u``.

    Each task reduces a node's links before the shuffle. The links of a node
    with more than ``HUB_LINKS`` of them get its minimum where they are: there
    are at most so many such nodes as links over ``HUB_LINKS``, and Spark sends
    their short list by broadcast or, when it is long, splits it. So no task
    gathers the links of a hub.
    """
    nearest = links.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m"), F.count("*").alias("_links"))
    nearest = work_table(nearest, "nearest")
    hubs = nearest.where(F.col("_links") > HUB_LINKS).select(F.col("_u").alias("_hub"), F.col("_m").alias("_hub_m"))
    marked = links.join(hubs, F.col("u") == F.col("_hub"), "left")
    of_hubs = marked.where(F.col("_hub").isNotNull()).select("u", "v", F.col("_hub_m").alias("_m"))
    others = marked.where(F.col("_hub").isNull()).select("u", "v")
    small = nearest.where(F.col("_links") <= HUB_LINKS)
    return of_hubs.unionByName(others.join(small, F.col("u") == F.col("_u")).select("u", "v", "_m")), nearest


def _large_star(links: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest one among the node and its neighbours."""
    both, _ = _with_nearest(links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    return both.where("v > u").select(F.col("v").alias("u"), F.least("u", "_m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of these."""
    known, nearest = _with_nearest(links)
    moved = known.where("v != _m").select(F.col("v").alias("u"), F.col("_m").alias("v"))
    return moved.unionByName(nearest.select(F.col("_u").alias("u"), F.col("_m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """Per linked node ``node`` its ``root``, the smallest node it can reach; a root itself has no row.

    ``links`` has the columns ``u`` and ``v``, in either order. Rounds of large
    and small stars, each written to the shared folder, until nothing changes;
    their number grows with the logarithm of the longest path. A node with a
    third of all links is reduced in the tasks that read them, and never gathered.
    """
    oriented = links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current, before = work_table(oriented, "links"), None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        current = work_table(_small_star(work_table(_large_star(current), "stars")), "links")
