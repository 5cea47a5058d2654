"""Global order, exact quantiles, shares and top-k without one-task windows."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Window, functions as F

#: rows of a table of offsets that may be broadcast
MOST_BROADCAST = 200_000
_OFFSET_BITS = 33  # layout of monotonically_increasing_id: partition << 33 | row


def ensure_checkpoint_dir(frame: DataFrame) -> None:
    """Use the cluster's shared checkpoint folder; fall back only in local mode."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = context.getConf().get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def _ranged(frame: DataFrame, order: list[str]) -> DataFrame:
    """Range-partition and sort by ``order``, then fix the result.

    Adds ``_part`` and ``_row`` (position inside the partition).  Range bounds
    come from sampling, so the result is checkpointed: whoever reads it later,
    also after the loss of an executor, sees the same positions.
    """
    ensure_checkpoint_dir(frame)
    placed = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    tagged = placed.withColumn("_id", F.monotonically_increasing_id())
    fixed = tagged.checkpoint(eager=True)
    return fixed.withColumn("_part", F.shiftright("_id", _OFFSET_BITS)).withColumn(
        "_row", F.col("_id").bitwiseAND((1 << _OFFSET_BITS) - 1)
    ).drop("_id")


def broadcast_small(frame: DataFrame, most: int = MOST_BROADCAST) -> DataFrame:
    """``frame`` with a broadcast hint if it is counted to have ``most`` rows at most."""
    return F.broadcast(frame) if frame.limit(most + 1).count() <= most else frame


def row_number(frame: DataFrame, order: list[str], name: str) -> DataFrame:
    """1-based global row number in the order of unique sort columns.

    Every partition is numbered on its own and shifted by the size of the
    partitions before it.  The table of shifts has one row per partition, which
    is why it may be broadcast and why its window may run in one task.
    """
    ranged = _ranged(frame, order)
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        F.col("_part"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift")
    )
    return ranged.join(F.broadcast(shifts), "_part").select(
        *frame.columns, (F.col("_shift") + F.col("_row") + 1).alias(name)
    )


def quantile(frame: DataFrame, key: str, value: str, q: float, name: str) -> DataFrame:
    """Exact interpolated quantile of ``value`` per ``key``.

    Equal values are counted before they are shuffled, the counted values are
    range-partitioned, and only the one or two partitions per key that hold the
    wanted ranks are looked into.  No task ever sees all values of a key.
    """
    counted = frame.where(F.col(value).isNotNull()).groupBy(key, value).agg(
        F.count(F.lit(1)).alias("_n")
    )
    ranged = _ranged(counted, [key, value])
    parts = ranged.groupBy(key, "_part").agg(F.sum("_n").alias("_size"))
    # at most one row per key and partition; a partition rarely spans many keys
    running = Window.partitionBy(key).orderBy("_part")
    whole = Window.partitionBy(key)
    spans = parts.select(
        key,
        "_part",
        (F.sum("_size").over(running) - F.col("_size")).alias("_from"),
        F.sum("_size").over(running).alias("_to"),
        (F.lit(q) * (F.sum("_size").over(whole) - 1)).alias("_rank"),
    )
    low, high = F.floor("_rank"), F.ceil("_rank")

    def inside(rank: Column) -> Column:
        return (rank >= F.col("_from")) & (rank < F.col("_to"))

    wanted = spans.where(inside(low) | inside(high))
    in_part = Window.partitionBy(key, "_part").orderBy(value)
    placed = ranged.join(broadcast_small(wanted), [key, "_part"]).withColumn(
        "_end", F.col("_from") + F.sum("_n").over(in_part)
    ).withColumn("_begin", F.col("_end") - F.col("_n"))

    def at(rank: Column) -> Column:
        hit = (rank >= F.col("_begin")) & (rank < F.col("_end"))
        return F.max(F.when(hit, F.col(value))).cast("double")

    picked = placed.groupBy(key).agg(
        at(low).alias("_low"), at(high).alias("_high"), F.max("_rank").alias("_rank")
    )
    weight = F.col("_rank") - F.floor("_rank")
    return picked.select(key, (F.col("_low") + (F.col("_high") - F.col("_low")) * weight).alias(name))


def _bucket(value: Column) -> Column:
    """Number of a bucket that grows with a whole number and holds one in 256 of its size, so a key has a few thousand."""
    size = F.abs(value)
    shift = F.greatest(F.length(F.bin(size)) - 9, F.lit(0)).cast("int")
    scaled = F.call_function("shiftright", size, shift)
    place = F.when(size < 256, size).otherwise((shift + 1) * 256 + scaled - 256)
    return F.when(value < 0, -place).otherwise(place)


def counted_quantile(counted: DataFrame, key: str, value: str, n: str, q: float, name: str) -> DataFrame:
    """Exact interpolated quantile of whole numbers that are counted already: unique ``key, value`` with ``n`` rows each.

    Counts per bucket say in which one or two buckets of a key the wanted ranks are; only the values of those are put
    in order.  Nothing is sorted or kept as a whole, and a bucket has few different values whatever the number of rows.
    """
    held = counted.where(F.col(value).isNotNull()).select(key, value, F.col(n).alias("_n"), _bucket(F.col(value)).alias("_bucket"))
    sizes = held.groupBy(key, "_bucket").agg(F.sum("_n").alias("_size"))
    running, whole = Window.partitionBy(key).orderBy("_bucket"), Window.partitionBy(key)
    spans = sizes.select(
        key, "_bucket", (F.sum("_size").over(running) - F.col("_size")).alias("_from"), F.sum("_size").over(running).alias("_to"),
        (F.lit(q) * (F.sum("_size").over(whole) - 1)).alias("_rank"),
    )

    def inside(rank: Column, low: str, high: str) -> Column:
        return (rank >= F.col(low)) & (rank < F.col(high))

    low, high = F.floor("_rank"), F.ceil("_rank")
    wanted = spans.where(inside(low, "_from", "_to") | inside(high, "_from", "_to")).drop("_to")
    order = Window.partitionBy(key, "_bucket").orderBy(value)
    placed = held.join(wanted, [key, "_bucket"]).withColumn("_end", F.col("_from") + F.sum("_n").over(order))
    placed = placed.withColumn("_begin", F.col("_end") - F.col("_n"))

    def at(rank: Column) -> Column:
        return F.max(F.when(inside(rank, "_begin", "_end"), F.col(value))).cast("double")

    picked = placed.groupBy(key).agg(at(low).alias("_low"), at(high).alias("_high"), F.max("_rank").alias("_rank"))
    weight = F.col("_rank") - F.floor("_rank")
    return picked.select(key, (F.col("_low") + (F.col("_high") - F.col("_low")) * weight).alias(name))


def share_of_total(grouped: DataFrame, count: str, name: str = "pct", digits: int = 1) -> DataFrame:
    """Percentage of the grand total.

    The total is a scalar subquery over the same exchange, so the grouped rows
    stay distributed however many groups there are.
    """
    total = grouped.agg(F.sum(count).cast("double")).scalar()
    return grouped.withColumn(name, F.round(F.lit(100.0) * F.col(count) / total, digits))


def share_of_max(grouped: DataFrame, value: str, name: str, of: str | None = None, digits: int = 1) -> DataFrame:
    """Percentage of the largest ``of`` (default: of the largest ``value``)."""
    top = grouped.agg(F.max(of or value).cast("double")).scalar()
    return grouped.withColumn(name, F.round(F.lit(100.0) * F.col(value) / top, digits))


def share_within(grouped: DataFrame, key: str, count: str, name: str = "pct") -> DataFrame:
    """Percentage within a key that has a handful of values per group."""
    totals = grouped.groupBy(key).agg(F.sum(count).alias("_total"))
    return grouped.join(totals, key).select(
        *grouped.columns,
        F.round(F.lit(100.0) * F.col(count) / F.col("_total").cast("double"), 1).alias(name),
    )


def top(frame: DataFrame, by: str, ties: list[str], k: int) -> DataFrame:
    """Largest ``k`` rows; ties are settled by ``ties`` so that reruns agree."""
    return frame.orderBy(F.desc(by), *[F.asc_nulls_first(t) for t in ties]).limit(k)


def top_per(frame: DataFrame, key: list[str], by: str, ties: list[str], k: int) -> DataFrame:
    """Largest ``k`` rows per key; only k candidates per task reach the shuffle."""
    window = Window.partitionBy(*key).orderBy(F.desc(by), *[F.asc_nulls_first(t) for t in ties])
    return frame.withColumn("_k", F.row_number().over(window)).where(F.col("_k") <= k).drop("_k")
