"""Connected components of an edge list by star contraction.

Every round is two grouped minima and two joins on the node key: a hub's rows
are combined map-side before the shuffle for the minimum, and the join back is
an ordinary skew-splittable join.  The edge list never grows, and each round is
checkpointed to the shared folder so the plan stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import cut

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("h"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("x")).first()
    return row["n"], row["h"], row["x"]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that occurs in ``edges``; root is the smallest reachable node.

    Loops and repeated edges are ignored; an empty edge list gives an empty result.
    """
    e = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct())
    state = _state(e)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        # Large star: every neighbour above u points at the smallest node around u.
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").distinct()
        # Small star: u and its lower neighbours point at the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        e = cut(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        now = _state(e)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
