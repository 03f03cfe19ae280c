"""Streaming sources that deliver broker-shaped records."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lendspark.sources.schemas import BROKER_RECORD_SCHEMA


@dataclass(frozen=True)
class BrokerSource:
    """Where and how fast to read one change topic. Servers come from the deployment."""

    servers: str
    topic: str
    starting_offsets: str = "latest"
    max_offsets_per_trigger: int = 50
    fail_on_data_loss: bool = True
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
            "maxOffsetsPerTrigger": str(self.max_offsets_per_trigger),
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
            **self.extra,
        }


def read_broker(spark: SparkSession, source: BrokerSource) -> DataFrame:
    """Change topic as a stream. Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**source.options()).load()


def read_files(
    spark: SparkSession,
    path: str,
    schema: StructType = BROKER_RECORD_SCHEMA,
    file_format: str = "parquet",
    max_files_per_trigger: int = 50,
) -> DataFrame:
    """The same records from a growing folder, a bounded number of files per batch."""
    return (
        spark.readStream.format(file_format)
        .schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(path)
    )
