"""Connected components of an edge table, by alternating star contractions.

Large star: every neighbour above a node points to the smallest node around
it.  Small star: the node and its neighbours below point to the smallest of
them.  The two alternate until no edge changes; each round's edges are
checkpointed in the shared folder, so the lineage stays short and a lost
executor costs one round.  Neighbour minima are aggregates (combined before
the shuffle) and meet the edges in joins that skew handling can split, so a
node with very many neighbours needs no single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.session import materialize

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    if large:
        sides = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = edges                                              # u > v holds for every edge
    least = sides.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    near = sides.join(least, "u")
    if large:
        out = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = near.select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        out = out.select("e.u", "e.v")
    return out.where("u <> v").distinct()


def _state(edges: DataFrame):
    """Order-free digest of an edge set."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum(F.shiftright(h, 20))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): each node of an edge and the smallest node it is connected to.

    Self-loops and repeated edges are allowed; null ends are ignored; an empty
    edge table gives an empty result.
    """
    e = edges.where(f"`{a}` is not null and `{b}` is not null and `{a}` <> `{b}`").select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e = materialize(e)
    state = _state(e)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        e = materialize(_star(_star(e, large=True), large=False))
        new = _state(e)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
