"""Kafka-protocol source. The frame it returns has the broker's row schema."""

from pyspark.sql import DataFrame, SparkSession


def broker_options(
    servers: str,
    topic: str,
    username: str | None = None,
    password: str | None = None,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = True,
    max_offsets_per_trigger: int | None = None,
    login_module: str = "org.apache.kafka.common.security.plain.PlainLoginModule",
) -> dict[str, str]:
    """Options for one topic, over SASL_SSL when credentials are given.

    ``starting_offsets="latest"`` skips the backlog on the first start only; later starts resume
    from the checkpoint. ``fail_on_data_loss=False`` lets offsets the broker has expired be
    skipped silently. ``login_module`` is the class that logs in; a platform that relocates the
    connector's classes names its own.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if username is not None:
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": (
                f'{login_module} required username="{username}" password="{password}";'
            ),
        }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def broker_stream(spark: SparkSession, **options) -> DataFrame:
    """Unbounded frame over the topic. Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**broker_options(**options)).load()
