"""Connected components by alternating large and small stars: each round two aggregations, and two joins of written tables, which Spark splits where a
node has very many links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataforge.llm.common import drop_written, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (u, v) with v < u. Large: each node hands its larger neighbours to the least of its neighbourhood.
    Small: each node hands itself and its smaller neighbours to the least of those. The least are written before they are joined:
    with an aggregation between shuffle and join Spark could not split the partition of a node that very many others link to."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        upward = both.filter("v > u")
        out = upward.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
        out = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    after = written(out.filter("u <> v").distinct(), "stars")
    drop_written(least)
    return after


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Takes links (u, v) of longs in either direction, with repeats and loops; returns (node, root), where root is the least
    node of the component, for every node that has a link to another. Rows with a null end are no links. No links: no rows.

    Every round halves the depth of the trees or better; the state is written to the shared folder after each, so that no
    round repeats an earlier one. Raises if max_rounds do not do, rather than return half a result.
    """
    now = written(edges.filter("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = None
    for _ in range(max_rounds):
        middle = _star(now, True)
        after = _star(middle, False)
        for old in (now, middle):
            drop_written(old)
        now = after
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1000003)).first()
        if seen == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = seen
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
