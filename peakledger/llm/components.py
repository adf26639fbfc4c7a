"""Connected components of an edge table, by alternating stars: only minima per node and equi-joins, no list of neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import checkpoint


def _to_smallest(pairs: DataFrame, tasks: int | None) -> DataFrame:
    """Each pair (a, b) with the smallest partner of a, or a itself if that is smaller."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a"), F.least("a", "m").alias("m"))
    return in_tasks(pairs.join(least, "a"), tasks)


def _large_star(edges: DataFrame, tasks: int | None) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return in_tasks(_to_smallest(both, tasks).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), tasks)


def _small_star(edges: DataFrame, tasks: int | None) -> DataFrame:
    """edges point to the smaller node; a's partners and a itself are all tied to the smallest partner."""
    tied = _to_smallest(edges, tasks)
    out = tied.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("x"))
    return out.select("x.a", "x.b").where("a <> b").distinct()


def in_tasks(df: DataFrame, tasks: int | None) -> DataFrame:
    """df in at most so many tasks, without a shuffle, where a number is given."""
    return df.coalesce(tasks) if tasks else df


def components(edges: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """edges (a, b) of longs, any order, repeats and loops allowed -> (node, root): the smallest node that each can reach.

    Nodes without an edge to another are not listed; an empty table gives an empty one. Rows with a null are ignored. With rows_per_task
    the number of tasks follows the number of edges, for sessions whose partitions are not merged at run time.
    """
    now = checkpoint(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if seen == mark or seen["n"] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        mark = seen
        tasks = seen["n"] // rows_per_task + 1 if rows_per_task else None
        now = checkpoint(in_tasks(_small_star(_large_star(in_tasks(now, tasks), tasks), tasks), tasks))
