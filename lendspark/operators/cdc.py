"""Change events: parse, filter, current state, typing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendspark.functions.columns import try_double
from lendspark.sources.schemas import APPLICATION_NUMERIC_TEXT, CDC_PAYLOAD_SCHEMA

# Operations that carry a row to keep (create, snapshot read, update).
KEPT_OPERATIONS = ("c", "r", "u")

EVENT_COLUMNS = [
    "cdc_operation", "cdc_timestamp_ms", "source_database", "source_schema", "source_table",
    "kafka_key", "kafka_timestamp", "kafka_topic", "kafka_partition", "kafka_offset",
]
RECORD_COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp"]


def either_envelope(payload: T.StructType) -> T.StructType:
    """Schema that reads an event with or without its ``payload`` wrapper in one parse."""
    return T.StructType([T.StructField("payload", payload), *payload.fields])


def _unwrapped(records: DataFrame, payload: T.StructType, fields: Sequence[str] | None = None) -> DataFrame:
    """Records with the parts of their events in ``after``, ``source``, ``op`` and ``ts_ms``.

    With ``fields`` only these of the row image are copied. They are parsed with all others, as
    what a damaged text still gives depends on the fields that are read.
    """
    text = F.col("value").cast("string")

    def parts(event: Column) -> Column:
        """Taken out while the event is as it was parsed, so that nothing is copied but what is kept."""
        wrapped = event["payload"]
        found = {
            name: F.when(wrapped.isNotNull(), wrapped[name]).otherwise(event[name])
            for name in ("after", "source", "op", "ts_ms")
        }
        if fields is not None:
            found["after"] = F.struct(*(found["after"][name].alias(name) for name in fields))
        return F.struct(*(part.alias(name) for name, part in found.items()))

    # Generating a single row keeps later filters above the parse; pushed below a plain
    # projection they would parse every record a second time.
    events = F.transform(F.array(F.from_json(text, either_envelope(payload))), parts)
    return records.select(F.inline(events), *RECORD_COLUMNS)


def _image_and_source(fields: Sequence[str]) -> list[Column]:
    after, source = F.col("after"), F.col("source")
    return [
        *(after[name].alias(name) for name in fields),
        F.col("op").alias("cdc_operation"),
        F.col("ts_ms").alias("cdc_timestamp_ms"),
        source["db"].alias("source_database"),
        source["schema"].alias("source_schema"),
        source["table"].alias("source_table"),
    ]


def _record_facts() -> list[Column]:
    return [
        F.col("key").cast("string").alias("kafka_key"),
        F.col("timestamp").cast("timestamp").alias("kafka_timestamp"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    ]


def parse_events(records: DataFrame, payload: T.StructType = CDC_PAYLOAD_SCHEMA) -> DataFrame:
    """Broker records to row images plus event columns; one output row per record.

    Text that is not JSON gives nulls throughout, and a field of the wrong type is null
    by itself.
    """
    fields = payload["after"].dataType.fieldNames()
    return _unwrapped(records, payload).select(*_image_and_source(fields), *_record_facts())


def with_heads(records: DataFrame) -> DataFrame:
    """Broker records next to their key, operation, time and source, as ``parse_events`` gives them.

    The row image's many other fields, mostly empty, are not copied.
    """
    fields = ["reco_id_curr"]
    return _unwrapped(records, CDC_PAYLOAD_SCHEMA, fields).select(*_image_and_source(fields), *RECORD_COLUMNS)


def heads(records: DataFrame) -> DataFrame:
    """Key and event columns of records ``with_heads``."""
    return records.select("reco_id_curr", *EVENT_COLUMNS[:5], *_record_facts())


def keep_row_events(events: DataFrame) -> DataFrame:
    """Creates, snapshot reads and updates; deletes and unparsed events go."""
    return events.where(F.col("cdc_operation").isin(*KEPT_OPERATIONS))


def event_key(name: str = "reco_id_curr", data_type: str = "bigint") -> Column:
    """Key field of an event: out of the JSON record key, flat or in its ``payload``
    wrapper, and out of the row image where the record key lacks it. Deletes have no row
    image, so without a usable record key theirs is null."""
    from_key = (F.get_json_object("kafka_key", path) for path in (f"$.{name}", f"$.payload.{name}"))
    return F.coalesce(*(found.try_cast(data_type) for found in from_key), F.col(name).try_cast(data_type))


def current_state(events: DataFrame, key: Column | None = None) -> DataFrame:
    """Latest row image of every key, without keys whose last event is a delete.

    Give it parsed events that still hold the deletes. Events without a key are states of
    their own, told apart by their position in the topic, so they neither fold into one
    row nor meet in one task. It aggregates instead of ranking, so each map task sends one
    row per key and a key with very many versions stays cheap.
    """
    order = F.struct("cdc_timestamp_ms", "kafka_offset", "kafka_partition")
    position = F.struct("kafka_topic", "kafka_partition", "kafka_offset")
    state_key = event_key() if key is None else key
    latest = (
        events.where(F.col("cdc_operation").isNotNull())
        .groupBy(state_key.alias("state_key"), F.when(state_key.isNull(), position).alias("unkeyed"))
        .agg(F.max_by(F.struct(*events.columns), order).alias("row"))
    )
    return keep_row_events(latest.select("row.*"))


def typed_applications(applications: DataFrame) -> DataFrame:
    """Row images with their text-encoded decimals as doubles."""
    return try_double(applications, APPLICATION_NUMERIC_TEXT)
