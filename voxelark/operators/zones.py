"""Connected zones of equal grey level, by graph contraction.

Voxels are first joined inside blocks (see ``blocks``). Pieces that touch across the
surface of a block form a graph, far smaller than the voxels; in each round nodes get a fresh pseudo-random order, every node hooks onto its first
neighbour in that order, and nodes and edges are contracted several hops at once.
At most half of the connected nodes come first among their neighbours, however
the pieces lie, so rounds grow with the logarithm of the nodes; the last node of an
order always goes, so the rounds end by themselves. Each round is written to the
shared folder so no lineage builds up, and hubs are handled by size-checked joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelark.functions.columns import KEYS
from voxelark.functions.sizing import attach, compact, materialize
from voxelark.operators.blocks import zone_contacts, zone_pieces

#: Hops a node moves in one round.
_HOPS = 4


def _order(node: str, turn: int) -> Column:
    """Place of a node in the order of one round; distinct nodes have distinct places."""
    return F.xxhash64(F.col(node).bitwiseXOR(F.xxhash64(F.lit(turn))))


def zone_sizes(levels: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``keys, node, level, size``: one row per connected zone, named by its smallest place."""
    keys = list(keys)
    pieces = compact(materialize(zone_pieces(levels, keys), "zone-pieces"))
    nodes = pieces.select(*keys, "node", "level", "size")
    edges = compact(materialize(zone_contacts(pieces, keys).distinct(), "zone-edges"))
    moves = []
    while edges.measured > 0:
        turn = len(moves)
        hooks = edges.groupBy(*keys, F.col("a").alias("node")).agg(F.min_by("b", _order("b", turn)).alias("up"))
        first = _order("node", turn) < _order("up", turn)
        hooks = hooks.withColumn("up", F.when(first, F.col("node")).otherwise(F.col("up")))
        # Every hooked node is itself in the table, so a hop always finds a row.
        hooks = compact(materialize(hooks, "zone-hooks"))
        above = hooks.select(*keys, F.col("node").alias("top"), F.col("up").alias("__to"))
        hops = hooks.withColumnRenamed("up", "top")
        for _ in range(_HOPS - 1):
            hops = attach(hops, above, [*keys, "top"], "inner", part_of=hooks)
            hops = hops.select(*keys, "node", F.col("__to").alias("top"))
        hops = compact(materialize(hops, "zone-hops"))
        moves.append(hops)
        for end in ("a", "b"):
            moved = hops.select(*keys, F.col("node").alias(end), F.col("top").alias("__to"))
            edges = attach(edges, moved, [*keys, end], "inner", part_of=hops)
            edges = edges.withColumn(end, F.col("__to")).drop("__to")
        edges = compact(materialize(edges.filter(F.col("a") != F.col("b")).distinct(), "zone-edges"))
    if not moves:
        return nodes
    # The moves of all rounds, put together from the last (smallest) to the first.
    roots = moves[-1]
    for earlier, later in zip(moves[-2::-1], moves[:0:-1]):
        final = roots.select(*keys, F.col("node").alias("top"), F.col("top").alias("__to"))
        roots = attach(earlier, final, [*keys, "top"], "left", part_of=later).select(
            *keys, "node", F.coalesce("__to", "top").alias("top")
        )
    named = attach(nodes, roots, [*keys, "node"], "left", part_of=moves[0])
    zones = named.groupBy(*keys, F.coalesce("top", "node").alias("__zone")).agg(
        F.min("node").alias("node"), F.first("level").alias("level"), F.sum("size").alias("size")
    )
    return compact(materialize(zones.drop("__zone"), "zone-nodes"))
