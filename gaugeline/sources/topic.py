"""Topic sources: a Kafka-compatible broker, or files with the same records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeline.schemas import RECORD


def namespace_of(connection_string: str) -> str:
    head = connection_string.partition("Endpoint=sb://")[2]
    return head.partition(".servicebus.windows.net")[0]


def kafka_options(
    connection_string: str,
    topic: str,
    starting_offsets: str = "latest",
    login_module_prefix: str = "",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Kafka options for an event hub given by its connection string.

    ``login_module_prefix`` is for runtimes that ship a relocated Kafka client;
    ``max_offsets_per_trigger`` bounds how much one micro-batch reads.
    """
    # Endpoint format, port and time limits of the broker.
    namespace = namespace_of(connection_string)
    if not namespace:
        raise ValueError("the connection string names no Endpoint=sb://<namespace> host")
    module = f"{login_module_prefix}org.apache.kafka.common.security.plain.PlainLoginModule"
    bound = (
        {} if max_offsets_per_trigger is None
        else {"maxOffsetsPerTrigger": str(max_offsets_per_trigger)}
    )
    return {
        **bound,
        "kafka.bootstrap.servers": f"{namespace}.servicebus.windows.net:9093",
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": (
            f'{module} required username="$ConnectionString" password="{connection_string}";'
        ),
        "kafka.request.timeout.ms": "60000",
        "kafka.session.timeout.ms": "30000",
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
    }


def live_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Continuous read; ``options`` as from ``kafka_options``."""
    return spark.readStream.format("kafka").options(**options).load()


def replay_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Bounded read of every partition from its beginning."""
    bounded = {**options, "startingOffsets": "earliest", "endingOffsets": "latest"}
    return spark.read.format("kafka").options(**bounded).load()


def file_topic(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of records from Parquet files that carry the topic's columns."""
    reader = spark.readStream.schema(RECORD)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
