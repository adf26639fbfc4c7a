"""Where two tables differ, found from the top: sums per day add up to sums per zone and report, and only the days whose sums are
unequal are read again and compared row by row, at full precision.

The tables need columns report, zone and day; stored tables are partitioned by day, so the second look opens the unequal days
only (the few buckets are joined to the partition column, and Spark prunes by them at run time).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from peakledger.operators.durable import stored

BUCKET = ["report", "zone", "day"]
PARTS = ["low", "middle", "high"]
SUMS = ["n", *PARTS]


def row_hash(columns: list[str]) -> Column:
    """64 bits over values as they are; nulls count, as a hash alone passes over them."""
    return F.xxhash64(*[F.col(c).isNull() for c in columns], *columns)


def day_sums(table: DataFrame, columns: list[str]) -> DataFrame:
    """report, zone, day, n, and the summed hashes of the rows. Equal rows in any order and number of copies give equal sums.

    A hash is summed in parts of 22, 21 and 21 bits: no sum of under 2^41 rows leaves a bigint. Combined on the map side, so a
    bucket that holds a third of all rows is one row a task by then.
    """
    h = F.col("_h")
    parts = [h.bitwiseAND(0x3FFFFF), F.shiftrightunsigned(h, 22).bitwiseAND(0x1FFFFF), F.shiftrightunsigned(h, 43)]
    return table.select(*BUCKET, row_hash(columns).alias("_h")).groupBy(*BUCKET).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(p).alias(name) for p, name in zip(parts, PARTS)])


def compared(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two tables of day sums: report, zone, day, the differences of the sums, and ``unequal``."""
    signed = left.select(*BUCKET, *SUMS).unionByName(right.select(*BUCKET, *[(-F.col(c)).alias(c) for c in SUMS]))
    sums = signed.groupBy(*BUCKET).agg(*[F.sum(c).alias(c) for c in SUMS])
    return sums.withColumn("unequal", _any_left())


def _any_left() -> Column:
    out = F.lit(False)
    for c in SUMS:
        out = out | (F.col(c) != 0)
    return out


def levels(buckets: DataFrame) -> DataFrame:
    """level (report, zone, day), buckets, unequal: how far each level narrows the search. ``buckets``: from ``compared``."""
    rolled = buckets.rollup(*BUCKET).agg(*[F.sum(c).alias(c) for c in SUMS], F.grouping_id().alias("_level"))
    level = F.when(F.col("_level") == 3, "report").when(F.col("_level") == 1, "zone").when(F.col("_level") == 0, "day")
    return (rolled.select(level.alias("level"), _any_left().alias("unequal")).where(F.col("level").isNotNull())
            .groupBy("level").agg(F.count(F.lit(1)).alias("buckets"), F.count_if("unequal").alias("unequal")))


def in_buckets(table: DataFrame, unequal: DataFrame) -> DataFrame:
    """Rows of the unequal buckets. A row whose report, zone or day is null belongs to no join, so those always stay."""
    nowhere = " OR ".join(f"{c} IS NULL" for c in BUCKET)
    return table.join(unequal.select(*BUCKET), BUCKET, "left_semi").unionByName(table.where(nowhere))


def differing_rows(left: DataFrame, right: DataFrame, columns: list[str], buckets: DataFrame | None = None) -> DataFrame:
    """The columns, and ``surplus``: how often the left table holds a row more than the right one (negative: less).

    ``buckets`` may come from sums that were stored with the tables; otherwise they are taken here, in one pass over each.
    Empty tables and equal tables give no rows.
    """
    if buckets is None:
        buckets = stored(compared(day_sums(left, columns), day_sums(right, columns)), "buckets")
    unequal = buckets.where(_any_left())  # comparisons, as the flag alone would not count as a reason to prune by
    signed = (in_buckets(left, unequal).select(*columns, F.lit(1).alias("_s"))
              .unionByName(in_buckets(right, unequal).select(*columns, F.lit(-1).alias("_s"))))
    return signed.groupBy(*columns).agg(F.sum("_s").alias("surplus")).where(F.col("surplus") != 0)
