"""Content hash of a file's points, computed by counting rather than by collecting."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from peakledger.functions import clock


def content_hash(points: DataFrame, file: list[str]) -> DataFrame:
    """file columns, n_points, content_hash.

    Every (interval, value) pair is hashed; the halves of the hashes are summed per file and the sums hashed again. The result
    depends on the set of points alone, not on order, header lines or ingest time, and combines on the map side, so a file
    with very many rows needs no task of its own. Sums of 15 hex digits fit decimal(38) far beyond any row count.
    """
    text = F.concat(clock.iso(F.col("interval_start")), F.lit("="), F.col("value_mw").cast("decimal(30,6)").cast("string"))
    half = lambda at: F.conv(F.substring("_h", at, 15), 16, 10).cast("decimal(20,0)")
    sums = (points.withColumn("_h", F.md5(text)).groupBy(*file)
            .agg(F.count(F.lit(1)).alias("n_points"), F.sum(half(1)).alias("_a"), F.sum(half(16)).alias("_b")))
    joined = F.concat_ws("|", F.col("n_points").cast("string"), F.col("_a").cast("string"), F.col("_b").cast("string"))
    return sums.select(*file, "n_points", F.sha2(joined, 256).alias("content_hash"))
