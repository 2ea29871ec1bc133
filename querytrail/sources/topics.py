"""Topic sources and the file stand-in for a topic.

A topic frame always has a binary ``value`` column holding UTF-8 JSON; the
decoders in :mod:`querytrail.functions` take it from there.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from querytrail.schemas import MESSAGE

DEFAULT_SERVERS = "localhost:9092"


def bootstrap_servers(servers: str | None = None) -> str:
    """Explicit servers, else ``KAFKA_BOOTSTRAP_SERVERS``, else localhost (S3)."""
    return servers or os.environ.get("KAFKA_BOOTSTRAP_SERVERS") or DEFAULT_SERVERS


def kafka_options(topic: str, servers: str | None = None, starting: str | None = None, **extra: str) -> dict[str, str]:
    """Reader options for the Kafka source (needs the spark-sql-kafka jar)."""
    opts = {"kafka.bootstrap.servers": bootstrap_servers(servers), "subscribe": topic}
    if starting is not None:
        opts["startingOffsets"] = starting
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def _split_hot_partitions(spark: SparkSession, extra: dict) -> dict:
    """Default ``minPartitions`` to the cluster's parallelism.

    The Kafka source then cuts offset ranges in proportion to their size,
    so a topic partition holding a third of the messages is read by a third
    of the tasks instead of by one.
    """
    if "minPartitions" in extra:
        return extra
    return {**extra, "minPartitions": str(spark.sparkContext.defaultParallelism)}


def read_topic(spark: SparkSession, topic: str, servers: str | None = None, starting: str = "earliest", **extra: str) -> DataFrame:
    """Batch scan of one topic, from the earliest offset by default.

    Offset ranges are split over at least the cluster's parallelism
    (``minPartitions``), so one hot topic partition does not become one
    long task.
    """
    opts = kafka_options(topic, servers, starting, **_split_hot_partitions(spark, extra))
    return spark.read.format("kafka").options(**opts).load()


def stream_topic(spark: SparkSession, topic: str, servers: str | None = None, starting: str | None = None, **extra: str) -> DataFrame:
    """Streaming scan of one topic (S2).  No start option by default: the
    first run starts at ``latest``, later runs at the checkpoint (M12).
    ``maxOffsetsPerTrigger`` in ``extra`` bounds a micro-batch; each batch's
    offset ranges are split like :func:`read_topic`'s."""
    opts = kafka_options(topic, servers, starting, **_split_hot_partitions(spark, extra))
    return spark.readStream.format("kafka").options(**opts).load()


def read_topic_files(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of a file topic: Parquet files with a ``value binary`` column."""
    return spark.read.schema(MESSAGE).parquet(path)


def stream_topic_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of a file topic; each new file is new messages."""
    reader = spark.readStream.schema(MESSAGE)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def write_topic_files(
    messages: DataFrame, path: str, files: int | None = None, rows_per_file: int | None = None, mode: str = "append"
) -> str:
    """Write a message frame as a file topic and return ``path``.

    ``files`` spreads the messages over that many files first (a shuffle);
    ``rows_per_file`` bounds a file's messages without one, so that a stream
    with a fixed number of files per trigger has micro-batches of a fixed
    size, however many messages there are.
    """
    out = messages.select("value")
    if files is not None:
        out = out.repartition(files)
    writer = out.write.mode(mode)
    if rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", str(rows_per_file))
    writer.parquet(path)
    return path
