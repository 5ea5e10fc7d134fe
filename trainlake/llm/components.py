"""Distributed union-find: alternating large-star and small-star steps over a table of links, checkpointed each round."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

LINKS = "u long, v long"
#: Nodes that a task's forest holds before its links are given out and forgotten; bounds its memory.
NODES = 1 << 20


class Forest:
    """Union-find over the links that one task sees; keeps the smallest number as the root."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent.get(x, x)
        return top

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        self.parent.setdefault(min(a, b), min(a, b))
        return True

    def full(self) -> bool:
        return len(self.parent) >= NODES

    def take(self) -> list[tuple[int, int]]:
        """The links to the roots; the forest is empty after it."""
        out = [(x, self.root(x)) for x in list(self.parent) if self.root(x) != x]
        self.parent = {}
        return out


def star_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    rows = np.array(links or np.zeros((0, 2)), np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], ["u", "v"])


def contract(links: DataFrame) -> DataFrame:
    """The links of each partition replaced by stars of its own components (same components, fewer links), run by run of bounded size."""

    def run(batches):
        forest = Forest()
        for rb in batches:
            for u, v in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
                forest.join(u, v)
            if forest.full():
                yield star_batch(forest.take())
        yield star_batch(forest.take())

    return links.select("u", "v").mapInArrow(run, LINKS)


def components(links: DataFrame, *, rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has a link; component is the smallest node of its group. u, v: long."""
    edges = cut(contract(links.where("u != v")).where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    for _ in range(rounds):
        # large star: each node's larger neighbours are linked to its smallest neighbour
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # small star: each node's smaller neighbours, and itself, are linked to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").where("u != v").distinct()
        edges = cut(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
