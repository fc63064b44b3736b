"""Connected components by distributed union-find.

Each task joins its edges into a local forest and passes on one edge for each
node that isn't a root. Groups of forests are merged the same way, level by
level. A merge in one task is made only while all forests together stay below
`max_merge_rows`, a bound that is checked on the written forests; beyond it the
remaining edges are contracted to stars by joins and aggregates alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage


def union_find(pairs: Iterator[tuple[str, str]]) -> dict[str, str]:
    """Each node's root, the least node of its tree by string order."""
    parent: dict[str, str] = {}

    def find(x: str) -> str:
        root = x
        while parent[root] != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for a, b in pairs:
        parent.setdefault(a, a)
        parent.setdefault(b, b)
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in parent}


def _forest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def pairs() -> Iterator[tuple[str, str]]:
        for f in frames:
            yield from zip(f["a"], f["b"], strict=True)

    roots = union_find(pairs())
    kept = [(x, r) for x, r in roots.items() if x != r]
    yield pd.DataFrame(kept, columns=["a", "b"], dtype=object)


def _contract(edges: DataFrame, max_rounds: int) -> DataFrame:
    """Alternate star operations until nothing changes; every node then points to its component's least node."""
    last = None
    for _ in range(max_rounds):
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("x")).select("x.*").where("a <> b").distinct()
        edges = cut_lineage(small, "stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last:
            return edges
        last = state
    raise RuntimeError(f"components didn't settle in {max_rounds} rounds")


def connected_components(edges: DataFrame, fan_in: int = 8, max_merge_rows: int = 1_000_000, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of `edges` (a STRING, b STRING), root being the least node of its component.

    Edges with a NULL end are ignored; repeated edges and loops change nothing
    (a node with only a loop is its own root). No edges give no rows.
    """
    edges = edges.where("a is not null and b is not null").select("a", "b")
    edges = cut_lineage(edges.distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    parts = max(1, edges.rdd.getNumPartitions())
    forest = cut_lineage(edges.where("a <> b").mapInPandas(_forest, "a string, b string"), "forest")
    if forest.count() <= max_merge_rows:
        while parts > 1:
            parts = -(-parts // fan_in)
            forest = forest.repartition(parts).mapInPandas(_forest, "a string, b string")
        forest = cut_lineage(forest, "forest")
    else:
        forest = _contract(forest, max_rounds)
    return nodes.join(forest.select(F.col("a").alias("node"), F.col("b").alias("root")), "node", "left").select("node", F.coalesce("root", "node").alias("root"))
