"""Connected components of links between documents, by alternating star contractions on DataFrames.

Each task first hangs the nodes of its own links on the least one that they connect. While more edges are left than one
task takes, each round hangs every node on the least node it can see (large star, then small star); the number of
rounds grows with the logarithm of the longest chain over tasks. Either star is a job of its own, written to the shared
folder: its edges joined with one row per node. The driver keeps a thread for every exchange of the last minute and
the plans and tasks of the jobs, so there are as few of them as that takes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.llm.support import give_back, ship, stored

#: Edges that one task takes.
TASK_LINKS = 1 << 18


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` to ``(node, root)`` for every linked node but the roots; ``root`` is the least node."""
    ship(links.sparkSession)
    kind = links.schema["a"].dataType.simpleString()
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, n, spare = _kept(_hung(edges, kind).withColumn("mark", F.lit(True)))
    while n > TASK_LINKS:
        # Joins by exchange: a broadcast would be built on the driver, round after round.
        both = edges.select(F.explode(F.array(_edge("u", "v"), _edge("v", "u"))).alias("e")).select("e.u", "e.v")
        least = both.groupBy("u").agg(F.least(F.min("v"), "u").alias("m"))
        large = both.join(least.hint("merge"), "u").where("v > u")
        large, _, moved = _kept(large.select(F.col("v").alias("u"), F.col("m").alias("v"), (F.col("m") != F.col("u")).alias("mark")))
        if not moved and not spare:
            break  # every node has one lesser neighbour, which has none
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least.hint("merge"), "u").select(
            F.explode(F.array(_edge("u", "m", F.lit(False)), _edge("v", "m", F.lit(True)))).alias("e")
        )
        edges, n, spare = _kept(small.select("e.*").where("u <> v").groupBy("u", "v").agg(F.max("mark").alias("mark")))
        if not moved and not spare:
            break
    else:
        edges = stored(_hung(edges.coalesce(1), kind), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _hung(edges: DataFrame, kind: str) -> DataFrame:
    """The edges of each task as (u, v), v the least node that they connect u with."""
    return edges.mapInArrow(_hang, f"a {kind}, b {kind}").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))


def _hang(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    table = pa.Table.from_batches(batches)
    nodes = pc.unique(pa.chunked_array([*table.column(0).chunks, *table.column(1).chunks]))
    nodes = nodes.take(pc.sort_indices(nodes))
    a, b = (pc.index_in(table.column(k), value_set=nodes).to_numpy() for k in (0, 1))
    root = np.arange(len(nodes))
    while True:
        x, y = root[a], root[b]
        low = np.minimum(x, y)
        new = root.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        while not np.array_equal(far := new[new], new):
            new = far
        if np.array_equal(new, root):
            break
        root = new
    low = np.flatnonzero(root != np.arange(len(nodes)))
    yield pa.RecordBatch.from_arrays([nodes.take(pa.array(low)), nodes.take(pa.array(root[low]))], names=["a", "b"])
    give_back()


def _edge(u: str, v: str, *mark: Column) -> Column:
    return F.struct(F.col(u).alias("u"), F.col(v).alias("v"), *[m.alias("mark") for m in mark])


def _kept(edges: DataFrame) -> tuple[DataFrame, int, int]:
    """The edges (u, v) stored, how many, and how many had a mark: ends that moved (large star) or were not the least (small star)."""
    seen = Observation()
    kept = stored(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if("mark").alias("marked")).drop("mark"), "links")
    return kept, seen.get["n"], seen.get["marked"]
