"""Events on their way: keyed, routed by topic, read back as a stream.

Topics are folders of a file source here; with the Kafka connector on the class path the same rows go to and come from a broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from peakledger.functions import contract, events

# Fixed names.
DEMAND_TOPICS = list(events.TOPIC.values())
SIGNAL_TOPIC = "grid.signals"
MESSAGE = "key string, value string, topic string"
#: A micro-batch takes about this much at most, so that a replay is many batches of bounded size and not one.
BATCH_BYTES, BATCH_EVENTS = 256 << 20, 1_000_000


def routed(news: DataFrame) -> DataFrame:
    """key, value, topic for each event."""
    return news.select(events.routing_key(F.col("report"), F.col("zone"), F.col("interval_start")).alias("key"),
                       events.wire().alias("value"), events.topic(F.col("report")).alias("topic"))


def signal_messages(signals: DataFrame) -> DataFrame:
    return signals.select(F.col("variant").alias("key"), F.to_json(F.struct("*")).alias("value"), F.lit(SIGNAL_TOPIC).alias("topic"))


def send(messages: DataFrame, root: str, batch: str, kafka: dict | None = None) -> None:
    """Deliver all messages or raise. A retry of the same batch rewrites its own folder, so nothing is sent twice."""
    if kafka is not None:
        messages.write.format("kafka").options(**kafka).save()
    else:
        messages.write.mode("overwrite").partitionBy("topic").parquet(f"{root}/batch={batch}")


def stream(spark: SparkSession, root: str, topics: list[str] | None = None, files_per_batch: int | None = None,
           kafka: dict | None = None) -> DataFrame:
    """The topics from their beginning: key, value, topic. Batches are bounded, by ``files_per_batch`` if it is given."""
    topics = topics or DEMAND_TOPICS
    if kafka is not None:
        options = {"startingOffsets": "earliest", "subscribe": ",".join(topics), "maxOffsetsPerTrigger": str(BATCH_EVENTS), **kafka}
        source = spark.readStream.format("kafka").options(**options).load()
        return source.select(F.col("key").cast("string"), F.col("value").cast("string"), "topic")
    reader = spark.readStream.schema(f"{MESSAGE}, batch string").option("basePath", root)
    reader = reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader.option("maxBytesPerTrigger", BATCH_BYTES)
    return reader.parquet(root).where(F.col("topic").isin(topics)).select("key", "value", "topic")


def judged(messages: DataFrame) -> DataFrame:
    """Messages with the contract's verdict."""
    return contract.check(messages)
