"""Publish rows as messages to a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame

from querytrail.functions.encode import encode_json
from querytrail.sources.topics import bootstrap_servers


def publish_options(topic: str, servers: str | None = None) -> dict[str, str]:
    """Writer options for the Kafka sink."""
    return {"kafka.bootstrap.servers": bootstrap_servers(servers), "topic": topic}


def publish(df: DataFrame, topic: str, servers: str | None = None, columns: list[str] | None = None, key: str | None = None) -> None:
    """Serialise rows to UTF-8 JSON and write them to a Kafka topic.

    Each executor sends its own partitions; nothing passes the driver.
    Needs the spark-sql-kafka jar on the classpath.
    """
    messages = encode_json(df, columns, key)
    messages.write.format("kafka").options(**publish_options(topic, servers)).save()
