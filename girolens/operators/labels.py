"""Labels, running names and samples of generated message files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from girolens.operators.ranking import _ranged, broadcast_small


def relabel(requested: Column, valid: Column) -> Column:
    """Category that a generated case really has."""
    return (
        F.when(valid & (requested == "edge"), "edge").when(valid, "pass").otherwise("fail")
    )


def with_outcome(cases: DataFrame) -> DataFrame:
    """Add ``actual_category`` and ``mismatch`` to ``(requested_category, valid)``."""
    actual = relabel(F.col("requested_category"), F.col("valid"))
    return cases.withColumn("actual_category", actual).withColumn(
        "mismatch", F.col("requested_category") != F.col("actual_category")
    )


def label_audit(cases: DataFrame, by: str = "schema") -> DataFrame:
    """Cases per outcome and number of relabelled cases per schema."""
    actual = F.col("actual_category")
    return with_outcome(cases).groupBy(by).agg(
        F.count_if(actual == "pass").alias("pass_cases"),
        F.count_if(actual == "fail").alias("fail_cases"),
        F.count_if(actual == "edge").alias("edge_cases"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("mismatch")).alias("recategorised"),
    )


def number_within(frame: DataFrame, key: list[str], order: list[str], name: str) -> DataFrame:
    """1-based number per key, also for keys that hold a large share of all rows.

    Rows are range-partitioned by key and order, so a hot key spans partitions;
    each partition numbers its part of a key and adds the parts before it.
    """
    ranged = _ranged(frame, [*key, *order])
    parts = ranged.groupBy(*key, "_part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_start")
    )
    before = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.select(
        *key, "_part", "_start", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift")
    )
    on = ["_part", *key]
    return ranged.join(broadcast_small(shifts), on).select(
        *frame.columns, (F.col("_shift") + F.col("_row") - F.col("_start") + 1).alias(name)
    )


def sequence_names(cases: DataFrame, order: list[str], stamp: Column) -> DataFrame:
    """File names ``gen-<category>-NNN-MMDDYYYY.xml`` numbered per category."""
    numbered = number_within(cases, ["actual_category"], order, "seq")
    return numbered.withColumn(
        "file_name",
        F.concat(
            F.lit("gen-"), F.col("actual_category"), F.lit("-"),
            F.when(F.col("seq") < 1000, F.lpad(F.col("seq").cast("string"), 3, "0"))
            .otherwise(F.col("seq").cast("string")),
            F.lit("-"), F.date_format(stamp, "MMddyyyy"), F.lit(".xml"),
        ),
    )


def spread_sample(files: DataFrame, by: list[str], order: str, n: int) -> DataFrame:
    """``n`` files taken round robin: the first of every set, then the second, …

    No set can give more than ``n`` files, so each task passes on at most its
    first ``n`` per set.
    """
    window = Window.partitionBy(*by).orderBy(order)
    turns = files.withColumn("turn", F.row_number().over(window)).where(F.col("turn") <= n)
    return turns.orderBy("turn", *by).limit(n).withColumn("turn", F.col("turn").cast("bigint"))
