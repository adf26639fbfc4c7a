"""Alert rules on a stream against the batch rules, with late samples and batches of any cut."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from peakledger.operators import metrics
from peakledger.streaming import monitors

SAMPLES = "service string, partition bigint, ts timestamp_ntz, value double"
BEGIN = datetime(2026, 3, 29, 0, 40)


def samples(seed):
    pick, rows = random.Random(seed), []
    for service in ("a", "b"):
        at = BEGIN
        for _ in range(150):
            at += timedelta(seconds=pick.choice([1, 20, 70, 400]))
            rows.append((service, pick.randrange(2), at, float(pick.randrange(0, 9000))))
    return sorted(rows, key=lambda r: r[2])


def streamed(spark, folder, rows, alerts, cuts=6):
    """Rows in files of time order, a minute shuffled inside each; a last sample moves the watermark past all windows."""
    pick, closing = random.Random(1), [("end", 0, rows[-1][2] + timedelta(days=1), 0.0)]
    size = -(-len(rows) // cuts)
    for k in range(0, len(rows), size):
        part = rows[k:k + size]
        pick.shuffle(part)
        spark.createDataFrame(part, SAMPLES).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    spark.createDataFrame(closing, SAMPLES).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    source = spark.readStream.schema(SAMPLES).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    query = (alerts(source, late="1 day").writeStream.outputMode("append").format("parquet").option("path", f"{folder}/out")
             .option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start())
    query.awaitTermination()
    assert query.exception() is None
    # What the last batches made final comes with the next start.
    spark.createDataFrame([("end", 0, closing[0][2] + timedelta(days=9), 0.0)], SAMPLES).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    again = (alerts(source, late="1 day").writeStream.outputMode("append").format("parquet").option("path", f"{folder}/out")
             .option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start())
    again.awaitTermination()
    return spark.read.schema("service string, tick timestamp_ntz, observed double").parquet(f"{folder}/out")


@pytest.mark.parametrize("name, threshold", [("stale_alerts", 8000.0), ("failure_alerts", 8.0), ("lag_alerts", 5000.0)])
def test_streams_give_what_batches_give(spark, tmp_path, name, threshold):
    rows = samples(4)
    batch = getattr(metrics, name)(spark.createDataFrame(rows, SAMPLES), threshold)
    want = sorted(map(tuple, batch.select("service", "tick", "observed").collect()))
    got = streamed(spark, str(tmp_path), rows, lambda df, late: getattr(monitors, name)(df, threshold, late=late))
    found = sorted(map(tuple, got.where(F.col("service") != "end").collect()))
    assert found == want and want
