"""Connected components of a graph given as links, by alternating stars.

A round joins every node's links to the smallest neighbour of that node; both star
steps are a grouped minimum and a join, so a hub's links are never gathered.  Links
between rounds are tables in the shared folder.  The number of rounds grows with the
logarithm of the longest path.
"""

from pyspark.sql import functions as F

from almanack.llm.base import staged


def _star(links, small):
    """One step: of each node's chosen neighbours, link them to the smallest known."""
    # both ways out of one row: a union would hold the plan of ``links`` twice
    ways = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    both = links.select(ways.alias("way")).select("way.*")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    least = least.select(F.col("a").alias("node"), "least")
    chosen = both.where("b < a") if small else both.where("b > a")
    linked = F.col("b")
    if small:
        # the smallest itself needs no link; its row links the node
        linked = F.when(F.col("b") == F.col("least"), F.col("a")).otherwise(linked)
    out = chosen.join(least, chosen["a"] == least["node"]).select(linked.alias("a"), F.col("least").alias("b"))
    return out.where("a != b").distinct()


def components(links):
    """``a, b`` (long, not null) -> ``node, component``: the smallest node reachable,
    for every node with a link to another."""
    now = staged(links.select("a", "b").where("a != b").distinct(), "links")
    seen = None
    while True:
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).head()
        if tuple(state) == seen:
            break
        seen = tuple(state)
        now = staged(_star(_star(now, small=False), small=True), "links")
    # at rest every link goes from a node to its component's smallest
    pairs = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return pairs.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
