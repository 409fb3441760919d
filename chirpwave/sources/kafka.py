"""Kafka source.

The container has no Kafka connector jar, so these functions are only
exercised for their options and column shapes in the tests; on a cluster
with ``spark-sql-kafka`` on the class path they are the real readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_source_options(brokers: str, topics: str | list[str],
                         starting_offsets: str = "latest",
                         max_offsets_per_trigger: int | None = None,
                         min_partitions: int | None = None, since_ms: int | None = None,
                         extra: dict | None = None) -> dict[str, str]:
    """Options for ``format("kafka")``: comma list of topics, newest offset
    by default (the reference starts at ``latest``).

    ``max_offsets_per_trigger`` caps a micro-batch (a backlog after a
    restart is then worked off in bounded batches, not one huge one);
    ``min_partitions`` splits large topic partitions over more tasks.
    ``since_ms`` starts at the first record of that time or later instead:
    several queries given the same time begin at the same records, which
    ``latest``, resolved by each query on its own, does not promise.
    """
    if not isinstance(topics, str):
        topics = ",".join(topics)
    opts = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topics,
        "startingOffsets": starting_offsets,
        # Spark tracks offsets in the checkpoint; a lost executor re-reads
        # its offset range instead of losing records.
        "failOnDataLoss": "true",
    }
    if since_ms is not None:
        del opts["startingOffsets"]
        opts["startingTimestamp"] = str(since_ms)
        opts["startingOffsetsByTimestampStrategy"] = "latest"  # partitions without such a record yet
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    opts.update(extra or {})
    return opts


def read_kafka(spark: SparkSession, brokers: str, topics: str | list[str],
               starting_offsets: str = "latest", stream: bool = True,
               max_offsets_per_trigger: int | None = None, since_ms: int | None = None,
               extra: dict | None = None) -> DataFrame:
    """Kafka records as ``(key, value, timestamp, topic, partition, offset)``
    with key and value decoded to strings (S6) and the broker timestamp
    as event time (S7)."""
    reader = spark.readStream if stream else spark.read
    if not stream and starting_offsets == "latest":
        starting_offsets = "earliest"
    opts = kafka_source_options(brokers, topics, starting_offsets,
                                max_offsets_per_trigger if stream else None, since_ms=since_ms, extra=extra)
    raw = reader.format("kafka").options(**opts).load()
    return kafka_values(raw)


def kafka_values(raw: DataFrame) -> DataFrame:
    """Decode the binary key/value of a Kafka frame to strings."""
    return raw.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("timestamp"),
        F.col("topic"),
        F.col("partition"),
        F.col("offset"),
    )


def with_ingestion_time(df: DataFrame, col: str = "timestamp") -> DataFrame:
    """Stamp rows with the time they enter the job (S7) for sources that
    carry no time of their own; Kafka records already carry one."""
    return df.withColumn(col, F.current_timestamp())
