"""Message topics.

A :class:`Topic` is a format and its options, so the same job reads a broker's topic or a folder that holds messages in
the same ``value`` column. The broker connector is an extra package that spark-submit has to load.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.functions import message_text, parse_message


@dataclass(frozen=True)
class Topic:
    format: str
    read_options: Mapping[str, str]
    write_options: Mapping[str, str]
    schema: str | None = None
    stream_options: Mapping[str, str] = field(default_factory=dict)

    def stream(self, spark: SparkSession) -> DataFrame:
        """New messages as they arrive, from the earliest one on; a restart continues from the checkpoint."""
        return self._load(spark.readStream, {**self.read_options, **self.stream_options})

    def read(self, spark: SparkSession) -> DataFrame:
        """All messages present now, as a bounded table."""
        return self._load(spark.read, self.read_options)

    def append(self, messages: DataFrame) -> None:
        """Write messages from the executors. A failed task fails the job after its retries."""
        messages.write.format(self.format).options(**self.write_options).mode("append").save()

    def limited(self, **stream_options: str | int) -> Topic:
        """The same topic with limits on how much one micro-batch admits."""
        options = {name: str(value) for name, value in stream_options.items()}
        return replace(self, stream_options={**self.stream_options, **options})

    def _load(self, reader, options: Mapping[str, str]) -> DataFrame:
        reader = reader.format(self.format).options(**options)
        return (reader.schema(self.schema) if self.schema else reader).load()


def kafka_connection(env: Mapping[str, str] = os.environ, client_id: str | None = None) -> dict[str, str]:
    """Broker address and SASL/PLAIN credentials from the environment.

    Names of options, login module and environment variables are fixed values of the connector and of the deployment.
    """
    options = {"kafka.bootstrap.servers": env.get("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092")}
    client_id = client_id or env.get("KAFKA_CLIENT_ID")
    if client_id:
        options["kafka.client.id"] = client_id
    user, password = env.get("KAFKA_USERNAME"), env.get("KAFKA_PASSWORD")
    if user and password is not None:
        login = "org.apache.kafka.common.security.plain.PlainLoginModule"
        options |= {
            "kafka.security.protocol": "SASL_PLAINTEXT",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": f'{login} required username="{user}" password="{password}";',
        }
    return options


def kafka_topic(
    name: str,
    connection: Mapping[str, str] | None = None,
    group_id: str | None = None,
    retries: int = 3,
    max_offsets_per_trigger: int | None = None,
) -> Topic:
    """A broker topic, read from its earliest offset. A stream goes on where the broker has already dropped messages; a
    bounded read fails there, as its result would not be whole."""
    connection = dict(kafka_connection() if connection is None else connection)
    # The connector's option names.
    reading = {**connection, "subscribe": name, "startingOffsets": "earliest"}
    if group_id:
        reading["kafka.group.id"] = group_id
    writing = {**connection, "topic": name, "kafka.retries": str(retries)}
    topic = Topic("kafka", reading, writing).limited(failOnDataLoss="false")
    return topic.limited(maxOffsetsPerTrigger=max_offsets_per_trigger) if max_offsets_per_trigger else topic


def folder_topic(path: str, schema: str = "value BINARY") -> Topic:
    """A folder of Parquet files with a ``value`` column (and ``partition``, ``offset`` if the schema has them)."""
    return Topic("parquet", {"path": path}, {"path": path}, schema)


def read_back(messages: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Every message decoded, next to the partition and offset it has in its topic."""
    position = [name for name in ("partition", "offset") if name in messages.columns]
    return messages.select(*position, parse_message(message_text("value"), schema).alias("message")).select(
        *position, F.col("message.*")
    )
