"""Joins between messages and pipeline state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from girolens.functions.times import latency_millis


def pipeline_view(
    tx: DataFrame, processed: DataFrame, sent: DataFrame, message_set: str = "001",
    on: str = "file_name",
) -> DataFrame:
    """Transactions with the state of their file; NULLs where it was never sent.

    Joining on the file name fans out when a name was sent with several
    contents.  ``on="message_id"`` avoids that when the transactions carry ids.
    """
    done = processed.where(F.col("message_set") == message_set).select(
        on, "validation_status", "error_detail", "processed_at"
    )
    out = sent.where(F.col("message_set") == message_set).select(on, "sent_at")
    return (
        tx.join(done, on, "left")
        .join(out, on, "left")
        .withColumn(
            "latency_ms",
            latency_millis(F.col("sent_at"), F.col("processed_at")),
        )
    )


def recon_status(sent: DataFrame, processed: DataFrame) -> DataFrame:
    """Sent messages with their outcome, ``not_processed`` when there is none."""
    outcome = processed.select("message_id", "validation_status", "processed_at", "error_detail")
    return sent.join(outcome, "message_id", "left").withColumn(
        "status", F.coalesce("validation_status", F.lit("not_processed"))
    )


def unprocessed(sent: DataFrame, processed: DataFrame) -> DataFrame:
    return sent.join(processed.select("message_id"), "message_id", "left_anti")


def matched(sent: DataFrame, processed: DataFrame) -> DataFrame:
    """Processed messages with the time they were sent and the latency."""
    done = processed.select("message_id", "processed_at")
    return sent.join(done, "message_id").withColumn(
        "latency_ms",
        latency_millis(F.col("sent_at"), F.col("processed_at")),
    )


def hot_lookup(
    rows: DataFrame, lookup: DataFrame, key: str, weight: str, hot_share: int = 1000, total: Column | None = None
) -> DataFrame:
    """Left join to a lookup with unique keys that survives hot keys.

    ``weight`` is the number of rows per key, ``total`` their sum where the caller has it for less than grouping again.  Keys holding more than one in
    ``hot_share`` rows are looked up from a broadcast that has fewer than
    ``hot_share`` entries, all others by an ordinary shuffle join.  The streaming
    writer needs this, because skew splitting at run time is not available to
    every micro-batch plan.
    """
    total = lookup.agg(F.sum(weight)).scalar() if total is None else total
    hot = F.broadcast(lookup.where(F.col(weight) * hot_share > total))
    hot_rows = rows.join(hot, key)
    cold_rows = rows.join(hot.select(key), key, "left_anti").join(lookup, key, "left")
    return hot_rows.unionByName(cold_rows).drop(weight)
