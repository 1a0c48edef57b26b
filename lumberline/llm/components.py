"""Connected components of a graph that is never held in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lumberline.llm.common import Stored


def components(edges: DataFrame, label: str) -> tuple[DataFrame, list[Stored]]:
    """``node, root`` for each node of ``edges`` (``a``, ``b`` long); also what it is read from.

    In each round every node hangs itself below its neighbour that comes first in an order drawn
    by hash for that round, two steps up at once, and the edges are drawn again between what
    remains. A round removes a constant share of the nodes, whatever the shape of the graph, and a
    node of any degree sends one row per task. All joins are between written tables, which the
    adaptive planner can split where one label holds many rows.
    """
    kept: list[Stored] = []
    rest = Stored(_plain(edges), f"{label}-edges")
    nodes = None
    round_no = 0
    while not rest.rows.isEmpty():
        order = _order(round_no)
        both = rest.rows.unionByName(rest.rows.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = F.min(F.struct(order(F.col("b")).alias("o"), "b")).alias("near")
        own = F.struct(order(F.col("a")).alias("o"), F.col("a").alias("b"))
        parent = both.groupBy("a").agg(first).select(
            F.col("a").alias("node"), F.least(own, "near")["b"].alias("up")
        )
        once = Stored(parent, f"{label}-near")
        up = once.rows.alias("x").join(
            once.rows.select(F.col("node").alias("up"), F.col("up").alias("top")), "up"
        )
        twice = Stored(up.select("node", F.col("top").alias("up")), f"{label}-up")
        once.discard()
        kept.append(twice)
        a, b = (twice.rows.select(F.col("node").alias(x), F.col("up").alias(f"{x}_up")) for x in "ab")
        moved = rest.rows.join(a, "a").join(b, "b").select(
            F.col("a_up").alias("a"), F.col("b_up").alias("b")
        )
        following = Stored(_plain(moved), f"{label}-edges")
        rest.discard()
        rest = following
        step = twice.rows.select(F.col("node").alias("root"), F.col("up").alias("next"))
        if nodes is None:
            nodes = twice.rows.select("node", F.col("up").alias("root"))
        else:
            nodes = nodes.join(step, "root", "left").select(
                "node", F.coalesce("next", "root").alias("root")
            )
        round_no += 1
    if nodes is None:
        nodes = rest.rows.select(F.col("a").alias("node"), F.col("b").alias("root"))
    kept.append(rest)
    return nodes, kept


def _plain(edges: DataFrame) -> DataFrame:
    """Each edge once, the smaller end first, without loops."""
    ends = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ends.filter("a < b").distinct()


def _order(round_no: int):
    def order(node: Column) -> Column:
        return F.xxhash64(node, F.lit(round_no))

    return order
