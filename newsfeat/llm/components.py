"""Connected components of a link table, by alternating stars.

Each round replaces the links of a node by links to its smallest neighbour:
first those to larger nodes, then those to smaller ones; the number of rounds
grows with the logarithm of the longest path.  Per round the minimum is a
partial aggregate, and the joins are plain equi-joins that adaptive execution
splits when a node has very many links.  The links after each star are written
to the shared folder, so that no plan holds more than one star: the driver's
memory goes with the plan that it keeps and with the tasks of its stages.  Only
the number of links and whether they are stars reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsfeat.llm.tables import dropped, written

#: A node with more than this part of all links has them dealt to several tasks.
HOT = 200


def _star(links: DataFrame, larger: bool, total: int) -> DataFrame:
    """One star step on rows ``(u, v)`` of a table of ``total`` rows.  The links
    of a node with more than a share ``1 / HOT`` of them are dealt to several
    tasks by their other end; there are at most ``2 * HOT`` such nodes, so
    they are broadcast."""
    if larger:
        both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"), F.count("*").alias("n")) \
        .select("w", F.least("w", "m").alias("m"), F.ceil(F.col("n") * HOT / max(1, total)).cast("int").alias("parts"))
    hot = low.where("parts > 1").select(F.col("w").alias("hot"), F.col("parts").alias("hot_parts"))
    part = F.coalesce(F.pmod(F.xxhash64("v"), F.col("hot_parts")), F.lit(0)).cast("int")
    dealt = both.join(F.broadcast(hot), both["u"] == hot["hot"], "left").select("u", "v", part.alias("part"))
    copies = low.select("w", "m", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("at"))
    joined = dealt.join(copies, (dealt["u"] == copies["w"]) & (dealt["part"] == copies["at"]))
    if larger:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select(F.col("w").alias("u"), F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def _settled(links: DataFrame) -> tuple[int, bool]:
    """The number of links, and whether each node above another one has that
    link alone: then all are stars around the smallest node."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionByName(
        links.select(F.col("v").alias("node"), F.lit(0).alias("up")))
    node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.count("*").alias("n"))
    total, open_ = node.agg(F.sum("up"), F.max((F.col("up") > 0) & (F.col("n") > 1))).first()
    return total or 0, not open_


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node with a link in ``links (u, v)``;
    the component is its smallest node.  Links of a node to itself, repeated
    and reversed links change nothing; no links give no rows.  Raises when
    ``max_rounds`` rounds (paths of more than 2**30 nodes) do not suffice."""
    state = written(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), "links")
    total, settled = _settled(state)
    rounds = 0
    while not settled:
        if rounds == max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        half = written(_star(state, True, total), "links")
        dropped(state)
        state = written(_star(half, False, total), "links")
        dropped(half)
        total, settled = _settled(state)
        rounds += 1
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        state.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
