"""Connected components of a link table by repeated contraction; nothing but counts reaches the driver."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netscope.session import cut_lineage, unique_subdir


# links of one task: the driver keeps something of every task, and a round has a dozen stages
TASK_LINKS = 200_000


def _cut(rows: DataFrame, tasks: int) -> DataFrame:
    """The rows, written and read by at most ``tasks`` tasks.

    A checkpoint hands on the size estimated for its plan, and that of a join is a product: after many rounds such
    numbers took the driver seconds and its heap.  One task needs one round; several read their rows from a table.
    """
    if tasks == 1:
        return cut_lineage(rows.coalesce(1)).coalesce(1)
    at = unique_subdir(rows.sparkSession, "components")
    rows.coalesce(tasks).write.parquet(at)
    return rows.sparkSession.read.schema(rows.schema).parquet(at).coalesce(tasks)


def _forest(links: DataFrame) -> DataFrame:
    """``node, other`` that connect what the links ``node, other`` connect, one row per node and task: the smallest
    node that its links of this task lead to.
    """
    kinds = [links.schema[c].dataType.simpleString() for c in ("node", "other")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above, read = {}, 0

        def top(x):
            while x in above:
                above[x] = x = above.get(above[x], above[x])
            return x

        for batch in batches:
            types = [c.type for c in batch.columns]
            for pair in zip(*(c.to_pylist() for c in batch.columns)):
                low, high = sorted(map(top, pair))
                if low != high:
                    above[high] = low
            read += len(batch)
            if read >= TASK_LINKS:
                yield rows(above, types)
                above, read = {}, 0
        if above:
            yield rows(above, types)

    def rows(above: dict, types: list[pa.DataType]) -> pa.RecordBatch:
        for x in sorted(above):    # what lies above a node is smaller, and so done
            above[x] = above.get(above[x], above[x])
        return pa.RecordBatch.from_arrays([pa.array(above.keys(), types[0]), pa.array(above.values(), types[1])],
                                          names=["node", "other"])

    return links.select("node", "other").mapInArrow(run, f"node {kinds[0]}, other {kinds[1]}")


def _roots(parents: DataFrame, tasks: int) -> DataFrame:
    """``node, parent`` with parents smaller than nodes -> every node with the root above it."""
    parents = parents.coalesce(tasks)
    while True:
        up = parents.select(F.col("node").alias("up"), F.col("parent").alias("next"))
        joined = parents.join(up.hint("merge"), F.col("parent") == F.col("up"), "left")
        parents = _cut(joined.select(
            "node", F.coalesce("next", "parent").alias("parent"), F.col("next").isNotNull().alias("moved")), tasks)
        if not parents.agg(F.max("moved")).first()[0]:
            return parents.select("node", "parent")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node that is not the smallest of its component.

    Each task first replaces its links by a forest.  Each node hooks to its smallest smaller neighbour (a partial
    aggregate, so a hub's links are combined before the shuffle); chains are shortened by pointer jumping; links
    are then drawn between the roots and the rest repeats until none is left: one round if all links fit a task.
    Every round's tables stand in the shared folder.  Stages have no more tasks than their links need, however many
    partitions a shuffle has; merge joins, because a join that turns into a broadcast has a stage of all partitions.
    """
    edges = links.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("other")).filter("node != other")
    edges = cut_lineage(_forest(edges).distinct())
    total = None
    while True:
        n = edges.count()
        if not n:
            break
        if total is None:    # no later table has more rows than twice these links
            tasks = max(1, math.ceil(n / TASK_LINKS))
        edges = _cut(_forest(edges.coalesce(tasks)), tasks)
        roots = _roots(edges.groupBy("node").agg(F.min("other").alias("parent")), tasks)
        if total is None:
            total = roots.select("node", F.col("parent").alias("root"))
        else:
            below = total.join(roots.hint("merge"), F.col("root") == roots["node"], "left").select(
                total["node"], F.coalesce("parent", "root").alias("root"))
            total = _cut(below.unionByName(roots.select("node", F.col("parent").alias("root"))), tasks)
        one, two = roots.select("node", F.col("parent").alias("p")), roots.select(
            F.col("node").alias("other"), F.col("parent").alias("q"))
        moved = edges.join(one.hint("merge"), "node", "left").coalesce(tasks).join(
            two.hint("merge"), "other", "left").coalesce(tasks).select(
            F.coalesce("p", "node").alias("x"), F.coalesce("q", "other").alias("y"))
        edges = moved.filter("x != y").select(F.greatest("x", "y").alias("node"),
                                              F.least("x", "y").alias("other")).distinct()
        edges = _cut(edges, tasks)
    if total is None:
        return edges.select("node", F.col("other").alias("root"))
    return total
