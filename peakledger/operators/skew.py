"""Keys that hold a large share of the rows.

A key is *hot* when it is among the ``SHARES`` fullest keys and holds more than ``FLOOR`` rows. Their number is bounded whatever
the data size, which allows broadcasting them; any other key holds at most one row in ``SHARES`` (or few rows), so the plain plan
serves it. No key or row is left out: being hot only decides how a key is spread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from peakledger.operators.durable import checkpoint

SHARES = 10_000   # most hot keys there are
FLOOR = 200_000   # a key with fewer rows than this is never worth splitting


def hot_keys(df: DataFrame, keys: list[str], floor: int | None = None) -> DataFrame | None:
    """The at most SHARES fullest keys with more than ``floor`` rows, or None if there are none.

    One pass over the key columns, combined on the map side; the few keys come to the driver once and serve every later use.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    fullest = (counts.where(F.col("_rows") > (FLOOR if floor is None else floor))
               .orderBy(F.desc("_rows"), *keys).limit(SHARES).select(*keys))
    found = fullest.collect()  # SHARES rows at most
    return df.sparkSession.createDataFrame(found, fullest.schema) if found else None


def split_hot_groups(df: DataFrame, keys: list[str], order: list[str], floor: int | None = None):
    """(cold rows, hot rows or None). Hot rows carry ``_slice``: contiguous, evenly filled runs of the (keys, order) sort.

    The slices are range partitions, fixed once by a checkpoint so that every later use sees the same cut.
    Rows equal in keys and order always share a slice.
    """
    hot = hot_keys(df, keys, floor)
    if hot is None:
        return df, None
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = (df.join(F.broadcast(hot), keys, "left_semi").repartitionByRange(slices, *keys, *order)
              .withColumn("_slice", F.spark_partition_id()))
    return df.join(F.broadcast(hot), keys, "left_anti"), checkpoint(sliced)


def previous(df: DataFrame, keys: list[str], order: list[str], value: str, name: str,
             floor: int | None = None) -> DataFrame:
    """Exact ``lag(value)`` per key in ``order``; no task holds more than a slice of a hot key.

    ``order`` must be a total order up to rows that are alike in ``value`` too, so exact copies may fall either way.
    """
    cold, hot = split_hot_groups(df, keys, order, floor)
    plain = cold.withColumn(name, F.lag(value).over(Window.partitionBy(*keys).orderBy(*order)))
    if hot is None:
        return plain
    # Last value of each slice; a key has at most as many slices as there are range partitions.
    ends = hot.groupBy(*keys, "_slice").agg(F.max_by(value, F.struct(*order)).alias("_end"))
    carried = ends.withColumn("_carry", F.lag("_end").over(Window.partitionBy(*keys).orderBy("_slice"))).drop("_end")
    inner = Window.partitionBy(*keys, "_slice").orderBy(*order)
    lagged = hot.withColumn(name, F.lag(value).over(inner)).withColumn("_first", F.row_number().over(inner) == 1)
    # At most SHARES hot keys plus one extra piece per range partition: small enough to broadcast.
    stitched = lagged.join(F.broadcast(carried), keys + ["_slice"], "left").withColumn(
        name, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col(name)))
    return plain.unionByName(stitched.drop("_carry", "_first", "_slice"))
