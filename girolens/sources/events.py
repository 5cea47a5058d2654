"""Signed JSON payloads on topics, and their stand-in on files.

A delivery always has the shape of a Kafka record
(``key, value, topic, partition, offset, timestamp``).  The file source reads
JSON lines of that shape, so a job runs unchanged on either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from girolens import model
from girolens.functions import ids

RECORD_DDL = (
    "key STRING, value STRING, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
)
TOPIC_PATTERN = r"iso20022\.pain\..*"
_POSITION = ["topic", "partition", "offset", "timestamp"]


def kafka_stream(spark: SparkSession, servers: str, pattern: str = TOPIC_PATTERN) -> DataFrame:
    """Every topic of the pattern as one stream, from the earliest offset."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribePattern", pattern)
        .option("startingOffsets", "earliest")
        .load()
    )
    return raw.select(
        F.col("key").cast("string"), F.col("value").cast("string"), *_POSITION
    )


def file_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(RECORD_DDL)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def content(of: str = "") -> Column:
    """Raw bytes of a decoded record; ``of`` is the prefix of its fields."""
    return F.coalesce(
        F.try_to_binary(F.col(f"{of}xml_base64"), F.lit("base64")), F.encode(F.col(f"{of}xml_content"), "UTF-8")
    )


def decode(records: DataFrame) -> DataFrame:
    """Payload fields plus the position of the record in its topic.

    Records that are no JSON, and base64 text that is none, give NULL content. That matches no digest, so such a
    record goes to quarantine and does not stop the stream.
    """
    ddl = model.PAYLOAD_DDL + ", xml_base64 STRING"
    return records.select(
        F.from_json("value", ddl).alias("payload"), *_POSITION
    ).select(
        "payload.*",
        content("payload.").alias("content"),
        *_POSITION,
    )


def payloads(messages: DataFrame, schema_name, sent_at) -> DataFrame:
    """Corpus messages as keyed, signed records ready for a topic.

    Bytes that are not UTF-8 cannot live in a JSON string, so they also travel
    in ``xml_base64`` and keep their digest valid.
    """
    whole = F.is_valid_utf8(F.col("content").cast("string"))
    return messages.select(
        F.col("message_id").alias("key"),
        ids.topic_name(F.col("domain"), F.col("message_set")).alias("topic"),
        F.to_json(
            F.struct(
                "message_id",
                "domain",
                "message_set",
                schema_name.alias("schema_name"),
                "file_name",
                sent_at.cast("string").alias("sent_at"),
                F.make_valid_utf8(F.col("content").cast("string")).alias("xml_content"),
                ids.content_digest(F.col("content")).alias("signature"),
                F.when(~whole, F.base64("content")).alias("xml_base64"),
            )
        ).alias("value"),
    )


def publish(records: DataFrame, servers: str) -> None:
    """Write keyed records to the topics they name."""
    (
        records.select("key", "value", "topic")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .save()
    )


def new_to_log(messages: DataFrame, sent_log: DataFrame) -> DataFrame:
    """Messages that the sent log does not hold yet."""
    return messages.join(sent_log.select("message_id"), "message_id", "left_anti")


def topics_of(messages: DataFrame) -> DataFrame:
    """Distinct topics that a set of messages needs."""
    return messages.select(
        ids.topic_name(F.col("domain"), F.col("message_set")).alias("topic")
    ).distinct()
