"""Connected components by hooking to least neighbours and contracting edges; every table stays distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stash


def components(edges: DataFrame) -> DataFrame:
    """`node, root` for every node of edges (`a, b`, undirected, any orderable type): root is the least node of its component.

    In a round every node takes the least name among itself and its neighbours, then that one's; edges get the new names
    of their ends, and those within one name go. So edges are read in full in the first round alone, and a star or a
    group that shares a neighbour is one node after it. Tables between rounds are written to the shared folder. No edges: an
    empty result; edges from a node to itself don't count.
    """
    left = stash(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    names, known = [], None
    while True:
        both = left.select("a", "b").unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = stash(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("root")), "names")
        up = first.select(F.col("node").alias("_up"), F.col("root").alias("_top"))
        name = stash(first.join(up, F.col("root") == F.col("_up")).select("node", F.col("_top").alias("root")), "names")
        discard(first)
        names.append(name)
        one, two = (name.select(F.col("node").alias(f"_n{k}"), F.col("root").alias(f"_{k}")) for k in "ab")
        renamed = left.join(one, F.col("a") == F.col("_na")).join(two, F.col("b") == F.col("_nb"))
        after = stash(renamed.filter("_a <> _b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "edges")
        discard(left)
        left = after
        if left.isEmpty():
            break
    for name in names:
        if known is None:
            known = name
            continue
        later = name.select(F.col("node").alias("_up"), F.col("root").alias("_top"))
        known = known.join(later, F.col("root") == F.col("_up"), "left").select("node", F.coalesce("_top", "root").alias("root"))
    known = stash(known, "labels")
    discard(left, *names)
    return known
