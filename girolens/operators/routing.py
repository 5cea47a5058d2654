"""Routing of deliveries: duplicate, tampered, or on to validation.

The order is fixed: an id that was already processed is a duplicate whatever the
delivery looks like; only then is the digest checked.  A tampered copy does not
use up the id, so a later clean copy is still processed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from girolens.operators.joins import hot_lookup

DUPLICATE, TAMPERED, FRESH = "duplicate", "tampered", "fresh"


def first_sound(deliveries: DataFrame, position: list[str], sound: Column) -> DataFrame:
    """First delivery of each id that passed the integrity check, and the number of copies.

    A minimum, so it is combined before the shuffle and a hot id costs one row
    per task.
    """
    return (
        deliveries.groupBy("message_id")
        .agg(
            F.min(F.when(sound, F.struct(*position))).alias("first"),
            F.count(F.lit(1)).alias("copies"),
        )
    )


def route(
    deliveries: DataFrame,
    processed: DataFrame | None,
    position: list[str],
    sound: Column,
) -> DataFrame:
    """Add ``route`` to deliveries with a unique ``position`` each.

    ``processed`` holds the ids of earlier batches.  It is joined to one row per
    id of this batch, never to the deliveries themselves.
    """
    firsts = first_sound(deliveries, position, sound)
    if processed is None:
        known = firsts.withColumn("seen", F.lit(False))
    else:
        # reduce the history to the ids of this batch before anything is shuffled
        old = processed.select("message_id").join(
            firsts.select("message_id"), "message_id", "left_semi"
        ).distinct().withColumn("seen", F.lit(True))
        known = firsts.join(old, "message_id", "left").withColumn(
            "seen", F.coalesce("seen", F.lit(False))
        )
    # the copies of all ids are the deliveries; counting those shuffles nothing
    placed = hot_lookup(deliveries, known, "message_id", weight="copies", total=deliveries.agg(F.count(F.lit(1))).scalar())
    here = F.struct(*position)
    return placed.withColumn(
        "route",
        F.when(F.col("seen"), DUPLICATE)
        .when(F.coalesce(here > F.col("first"), F.lit(False)), DUPLICATE)
        .when(~sound, TAMPERED)
        .otherwise(FRESH),
    ).drop("seen", "first")
