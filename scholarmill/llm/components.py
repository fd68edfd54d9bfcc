"""Connected components of links between ids, by alternating large and small stars.

Each round first contracts blocks of links inside tasks: what a block connects points to its smallest id. Then both
star steps replace links by links to a smaller id, with one aggregate and one join each, until nothing changes; the
number of rounds grows with the logarithm of the longest chain. No list of neighbours is ever built: a node's minimum
is a partial aggregate, written before it is joined, so that the planner knows its size and may split a node with very
many links. Each step is a written table, so a lost executor reads files instead of replaying rounds.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.session import write_once

#: Links that a task holds at once.
BLOCK_LINKS = 200_000


def contracted(edges: DataFrame) -> DataFrame:
    """``(u, v)`` with ``v`` the smallest id that a block of links connects to ``u``; the same components as before."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def stars(root: dict[int, int]) -> pa.RecordBatch:
        ends = [(x, find(root, x)) for x in root]
        ends = [(x, r) for x, r in ends if x != r]
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in ends], pa.int64()), pa.array([r for _, r in ends], pa.int64())], schema=schema)

    def run(batches):
        root: dict[int, int] = {}
        held = 0
        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x, y = find(root, x), find(root, y)
                if x != y:
                    root[max(x, y)] = min(x, y)
            held += batch.num_rows
            if held >= BLOCK_LINKS:
                yield stars(root)
                root, held = {}, 0
        if root:
            yield stars(root)

    return edges.select("u", "v").mapInArrow(run, "u bigint, v bigint")


def find(root: dict[int, int], x: int) -> int:
    """The smallest id known to be connected with ``x``."""
    while (up := root.setdefault(x, x)) != x:
        root[x] = x = root[up]
    return x


def components(links: DataFrame) -> DataFrame:
    """``(id, component_id)`` for every id in ``links(a, b)``; ``component_id`` is the smallest id reachable.

    Ids are integers. Null ends, links of an id to itself and repeated links change nothing; no links give no rows.
    """
    high, low = F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v")
    edges = write_once(contracted(links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(high, low)), "links")
    while not settled(edges):
        # large star: what is larger than u points to the least of u and its neighbours
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = write_once(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = write_once(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "links")
        # small star: what is smaller than u, and u itself, point to the least of them
        least = write_once(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        pointed = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = write_once(pointed.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        edges = write_once(contracted(after), "links")
    ends = edges.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    return ends.union(edges.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct())


def settled(edges: DataFrame) -> bool:
    """Whether every id points to one other and none of those points on."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("centre")).union(
        edges.select(F.col("v").alias("id"), F.lit(0), F.lit(1)))
    seen = ends.groupBy("id").agg(F.sum("out").alias("out"), F.max("centre").alias("centre"))
    return seen.filter("out > 1 OR (out = 1 AND centre = 1)").isEmpty()
