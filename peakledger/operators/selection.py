"""Exact order statistics without sorting everything in one place.

Whole numbers are counted per value in two steps: blocks of ``BLOCK`` values first, then the one block that holds the
wanted position. Counting combines on the map side, and no task sees more than the blocks or one block's values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK = 4096


def nth_values(df: DataFrame, group: list[str], value: str, positions: dict[str, Column], block: float = BLOCK) -> DataFrame:
    """Per group, the values at the 0-based positions of the sorted list; each position is an expression of ``n``.

    ``block`` is the width of a block of values; for fractions, one that holds few different ones.
    """
    counts = (df.where(F.col(value).isNotNull()).groupBy(*group, F.col(value).alias("_v"))
              .agg(F.count(F.lit(1)).alias("_c")))
    blocks = (counts.withColumn("_b", F.floor(F.col("_v") / block)).groupBy(*group, "_b")
              .agg(F.sum("_c").alias("_bc")))
    totals = blocks.groupBy(*group).agg(F.sum("_bc").alias("n"))
    wanted = totals.select(*group, "n", F.explode(F.array(*[
        F.struct(F.lit(name).alias("_name"), position.cast("bigint").alias("_pos"))
        for name, position in positions.items()])).alias("_w")).select(*group, "n", "_w.*")
    up_to = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranged = blocks.withColumn("_to", F.sum("_bc").over(up_to)).withColumn("_from", F.col("_to") - F.col("_bc"))
    found = _matched(wanted, ranged, group).where((F.col("_pos") >= F.col("_from")) & (F.col("_pos") < F.col("_to")))
    inside = counts.withColumn("_b", F.floor(F.col("_v") / block))
    needed = found.select(*group, "_b", "_from").distinct()
    cells = inside.join(needed, group + ["_b"])
    running = Window.partitionBy(*group, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = (cells.withColumn("_upto", F.col("_from") + F.sum("_c").over(running))
             .withColumn("_start", F.col("_upto") - F.col("_c")).select(*group, "_b", "_v", "_start", "_upto"))
    hits = (found.select(*group, "n", "_name", "_pos", "_b").join(cells, group + ["_b"])
            .where((F.col("_pos") >= F.col("_start")) & (F.col("_pos") < F.col("_upto"))))
    picked = [F.max(F.when(F.col("_name") == name, F.col("_v"))).alias(name) for name in positions]
    return hits.groupBy(*group).agg(F.first("n").alias("n"), *picked)


def _matched(wanted: DataFrame, ranged: DataFrame, group: list[str]) -> DataFrame:
    if group:
        return wanted.join(ranged, group)
    key = F.lit(0)
    return wanted.withColumn("_g", key).join(ranged.withColumn("_g", key), "_g").drop("_g")


def median(df: DataFrame, group: list[str], value: str, name: str = "median") -> DataFrame:
    """Mean of the two middle values."""
    n = F.col("n")
    both = nth_values(df, group, value, {"_lo": F.floor((n - 1) / 2), "_hi": F.floor(n / 2)})
    return both.select(*group, "n", ((F.col("_lo") + F.col("_hi")) / 2).alias(name))
