"""Jobs that sign new corpus messages, publish them and log them: over the whole corpus, or over new files only."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from girolens.functions import ids
from girolens.functions.text import label
from girolens.sources import corpus, events, id_index, state
from girolens.sources.commits import snapshot


def unsent(messages: DataFrame, sent_log: DataFrame) -> DataFrame:
    """Messages to send: not in the log, and one file per content.

    The file is picked by its name, a minimum over unique (id, name) pairs, so
    the content itself is never regrouped.
    """
    new = events.new_to_log(messages, sent_log)
    picked = new.groupBy("message_id").agg(F.min("file_name").alias("file_name"))
    return new.join(picked, ["message_id", "file_name"], "left_semi")


def schema_name(domain: Column, message_set: Column, names: dict[str, str]) -> Column:
    """Schema file name per ``domain.set``; ``unknown.xsd`` when there is none."""
    if not names:
        return F.lit("unknown.xsd")
    return label(ids.schema_label(domain, message_set), names, "unknown.xsd")


def send(
    messages: DataFrame, root: str, publish: Callable[[DataFrame], None], schemas: dict[str, str] | None = None
) -> None:
    """Publish what the sent log does not know, then extend the log.

    A crash between the two steps leads to a second delivery, which the receiver
    records as a duplicate.
    """
    spark = messages.sparkSession
    messages = messages.persist()
    # of the log only the folders of the ids at hand are read
    log = id_index.lookup(spark, root, snapshot(spark, root), id_index.prefixes_of(messages), id_index.SENT)
    now = F.lit(datetime.now(timezone.utc)).cast("timestamp")
    name = schema_name(F.col("domain"), F.col("message_set"), schemas or {})
    new = unsent(messages, log).persist()
    try:
        publish(events.payloads(new, name, now))
        state.append(
            new.select(
                "message_id", "domain", "message_set", "file_name", name.alias("schema_name"),
                ids.topic_name(F.col("domain"), F.col("message_set")).alias("kafka_topic"),
                now.alias("sent_at"),
            ),
            root, "sent_messages",
        )
    finally:
        new.unpersist()
        messages.unpersist()


def follow(
    spark: SparkSession, corpus_root: str, root: str, checkpoint: str, publish: Callable[[DataFrame], None],
    schemas: dict[str, str] | None = None, files_per_batch: int | None = None,
) -> StreamingQuery:
    """Send the files that came since the last run with this checkpoint; the query ends when there are no more.

    A batch that is run again publishes what its log does not hold yet, as ``send`` does.
    """
    def write(messages: DataFrame, batch_id: int) -> None:
        send(messages, root, publish, schemas)

    stream = corpus.follow_corpus(spark, corpus_root, files_per_batch)
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()
