"""Credit-transfer rules over transactions that are already flat.

Counts per message and rule from grouped aggregates, for transactions that are
kept as rows and no longer as messages.  Every step is a partial aggregate, so a
message that holds a large share of all transactions is combined map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from girolens import model
from girolens.functions import ids

#: columns of the flat form; one row per transaction with ``real`` true, or one
#: placeholder with ``real`` false for a message without transactions; ``ccy`` is
#: the only currency of a transaction
FLAT_COLUMNS = [
    "file_name", "msg_id", "declared", "ctrl_sum", "pmt_inf_id", "pmt_declared", "pmt_ctrl_sum",
    "req_exec_date", "debtor_iban", "debtor_bic", "real", "end_to_end_id", "uetr", "instd_amount", "ccy",
    "creditor_iban", "creditor_bic", "intermediary_bic",
]


def _ones(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("bigint")


def _off(stated: Column, actual: Column) -> Column:
    tolerance = F.lit(model.CONTROL_SUM_TOLERANCE).cast("decimal(38,5)")
    return _ones(F.abs(stated.cast("decimal(38,5)") - actual.cast("decimal(38,5)")) > tolerance)


def credit_rule_counts(flat: DataFrame, as_of: Column) -> DataFrame:
    """``(file_name, rule_id, violations)`` for rules that fired."""
    real = F.col("real")
    payment_keys = [
        "file_name", "msg_id", "declared", "ctrl_sum", "pmt_inf_id", "pmt_declared",
        "pmt_ctrl_sum", "req_exec_date", "debtor_iban", "debtor_bic",
    ]
    # no reference among the keys: almost every transaction has its own, and all payment texts would be shuffled with it
    per_payment = flat.groupBy(*payment_keys).agg(
        F.count_if(real).alias("n"),
        F.sum("instd_amount").alias("amount"),
        F.sum(_ones((F.col("uetr") != "") & ~ids.uetr_is_valid(F.col("uetr")))).alias("BR-006"),
        F.sum(_ones(F.col("instd_amount") <= 0)).alias("BR-007"),
        F.sum(_ones((F.col("creditor_iban") != "") & ~ids.iban_is_valid(F.col("creditor_iban")))).alias("iban"),
        F.sum(
            _ones((F.col("creditor_bic") != "") & ~ids.bic_is_valid(F.col("creditor_bic")))
            + _ones((F.col("intermediary_bic") != "") & ~ids.bic_is_valid(F.col("intermediary_bic")))
        ).alias("bic"),
        F.sum(_ones((F.col("ccy") != "") & ~ids.currency_is_active(F.col("ccy")))).alias("BR-010"),
    )
    # a reference may recur under another payment, so BR-005 needs its own grouping, of two narrow columns
    repeats = (
        flat.where(real & F.col("end_to_end_id").isNotNull()).groupBy("file_name", "end_to_end_id")
        .agg((F.count(F.lit(1)) - 1).alias("again"))
        .groupBy("file_name").agg(F.sum("again").alias("BR-005"))
    )
    has_payment = F.col("pmt_inf_id").isNotNull()
    per_message = per_payment.groupBy("file_name", "msg_id", "declared", "ctrl_sum").agg(
        F.sum("n").alias("n"),
        F.sum("amount").alias("amount"),
        F.sum(_off(F.col("pmt_ctrl_sum"), F.col("amount"))).alias("BR-003"),
        F.sum(_ones(F.col("pmt_declared") != F.col("n"))).alias("BR-004"),
        F.sum("`BR-006`").alias("BR-006"),
        F.sum("`BR-007`").alias("BR-007"),
        (F.sum("iban") + F.sum(_ones(has_payment & (F.col("debtor_iban") != "") & ~ids.iban_is_valid(F.col("debtor_iban"))))).alias("BR-008"),
        (F.sum("bic") + F.sum(_ones(has_payment & (F.col("debtor_bic") != "") & ~ids.bic_is_valid(F.col("debtor_bic"))))).alias("BR-009"),
        F.sum("`BR-010`").alias("BR-010"),
        F.sum(_ones(has_payment & (F.col("req_exec_date") < as_of))).alias("BR-011"),
    )
    whole = per_message.join(repeats, "file_name", "left").select(
        "file_name",
        _ones(F.col("declared") != F.col("n")).alias("BR-001"),
        _off(F.col("ctrl_sum"), F.col("amount")).alias("BR-002"),
        "BR-003", "BR-004", F.coalesce("`BR-005`", F.lit(0)).alias("BR-005"),
        "BR-006", "BR-007", "BR-008", "BR-009", "BR-010", "BR-011",
        _ones(F.coalesce("msg_id", F.lit("")) == "").alias("BR-012"),
    )
    return _as_rows(whole)


def _as_rows(whole: DataFrame) -> DataFrame:
    """One row per rule column that fired."""
    fired = [c for c in whole.columns if c.startswith("BR-")]
    pairs = F.array(
        *[F.struct(F.lit(r).alias("rule_id"), F.col(f"`{r}`").cast("bigint").alias("violations")) for r in fired]
    )
    return whole.select("file_name", F.inline(pairs)).where("violations > 0")
