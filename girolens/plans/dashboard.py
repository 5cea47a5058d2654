"""Multi-set dashboard: pipeline outcome per message set and the detail blocks
of payments, status reports, reversals and mandates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from girolens import model
from girolens.functions.amounts import (
    REPORT_RANGE, REPORT_STEPS, REPORT_TOP, count_if, ladder, money_avg, money_sum, percent,
)
from girolens.functions.text import error_type, failing_element, set_label
from girolens.operators.ranking import share_of_max, share_of_total, top, top_per

def _rows() -> Column:
    return F.count(F.lit(1))


def _passed() -> Column:
    return F.count_if(F.col("validation_status") == "pass")


def _failed() -> Column:
    return F.count_if(F.col("validation_status") == "fail")


def _in_range(amount: Column) -> Column:
    return F.when(amount.between(*REPORT_RANGE), amount)


def _domain(processed: DataFrame, domain: str = "pain") -> DataFrame:
    return processed.where(F.col("domain") == domain)


def totals(processed: DataFrame) -> DataFrame:
    """Files, messages and pass rate of the whole domain."""
    per_file = _domain(processed).groupBy("file_name").agg(
        _rows().alias("n"), _passed().alias("p"), _failed().alias("f")
    )
    return per_file.agg(
        F.count("file_name").alias("files"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("processed"),
        F.coalesce(F.sum("p"), F.lit(0)).alias("passed"),
        F.coalesce(F.sum("f"), F.lit(0)).alias("failed"),
        percent(F.sum("p"), F.sum("n")).alias("pass_rate"),
    )


def set_outcome(processed: DataFrame) -> DataFrame:
    return (
        _domain(processed)
        .groupBy("message_set")
        .agg(_passed().alias("passed"), _failed().alias("failed"), _rows().alias("total"))
        .orderBy("message_set")
    )


def set_rate(processed: DataFrame) -> DataFrame:
    return (
        _domain(processed)
        .groupBy("message_set")
        .agg(
            _passed().alias("pass_count"),
            _failed().alias("fail_count"),
            _rows().alias("total"),
            percent(_passed(), _rows()).alias("pass_pct"),
        )
        .orderBy("message_set")
    )


def set_bars(processed: DataFrame) -> DataFrame:
    """Passed and failed as a share of the largest set, with the pass rate."""
    outcome = _domain(processed).groupBy("message_set").agg(
        _passed().alias("passed"), _failed().alias("failed"), _rows().alias("total")
    )
    bars = share_of_max(outcome, "passed", "passed_pct", of="total")
    bars = share_of_max(bars, "failed", "failed_pct", of="total")
    return bars.withColumn("pass_rate", percent(F.col("passed"), F.col("total"))).orderBy("message_set")


def set_status(processed: DataFrame, message_set: str | None = None) -> DataFrame:
    """Outcome of one set, or of all sets in one pass."""
    rows = _domain(processed)
    if message_set is not None:
        rows = rows.where(F.col("message_set") == message_set)
    return (
        rows.groupBy("message_set")
        .agg(
            _passed().alias("passed"),
            _failed().alias("failed"),
            percent(_passed(), _passed() + _failed()).alias("pass_rate"),
        )
        .orderBy("message_set")
    )


def set_categories(base: DataFrame) -> DataFrame:
    """Files per set and category; categories without files show 0."""
    counts = base.groupBy("message_set").agg(
        *[F.count_if(F.col("category") == c).alias(c) for c in model.CATEGORIES]
    )
    pairs = F.array(
        *[F.struct(F.lit(c).alias("category"), F.col(f"`{c}`").alias("files")) for c in model.CATEGORIES]
    )
    return counts.select("message_set", F.inline(pairs)).orderBy("message_set", "category")


def _set_failures(processed: DataFrame) -> DataFrame:
    return processed.where("validation_status = 'fail' AND error_detail IS NOT NULL")


def set_error_element(processed: DataFrame, k: int = 8) -> DataFrame:
    """Most frequent failing elements of every set."""
    grouped = (
        _set_failures(processed)
        .groupBy("message_set", failing_element(F.col("error_detail"), closed=False).alias("element"))
        .agg(_rows().alias("count"))
        .where("element != ''")
    )
    return top_per(grouped, ["message_set"], "count", ["element"], k)


def set_error_type(processed: DataFrame) -> DataFrame:
    return (
        _set_failures(processed)
        .groupBy("message_set", error_type(F.col("error_detail"), short=True).alias("error_type"))
        .agg(_rows().alias("count"))
        .orderBy("message_set", F.desc("count"), "error_type")
    )


# --- payments (001, 008, 013) ----------------------------------------------


def pay_currency(detail: DataFrame, k: int = 12) -> DataFrame:
    counted = _in_range(F.col("amount"))
    grouped = detail.where("currency IS NOT NULL").groupBy("currency").agg(
        _rows().alias("transactions"),
        money_sum(counted).alias("total_value"),
        money_avg(counted).alias("avg_amount"),
    )
    return top(grouped, "transactions", ["currency"], k)


def _buckets(detail: DataFrame, amount: str) -> DataFrame:
    return (
        detail.where(F.col(amount).between(*REPORT_RANGE))
        .groupBy(ladder(F.col(amount), REPORT_STEPS, REPORT_TOP).alias("bucket"))
        .agg(
            _rows().alias("count"),
            money_avg(F.col(amount)).alias("avg_amount"),
            F.min(amount).alias("_least"),
        )
        .orderBy("_least")
        .drop("_least")
    )


def pay_buckets(detail: DataFrame) -> DataFrame:
    return _buckets(detail, "amount")


def pay_corridors(detail: DataFrame, k: int = 10) -> DataFrame:
    flow = F.when(F.col("debtor_pfx").eqNullSafe(F.col("creditor_pfx")), "domestic").otherwise("cross-border")
    grouped = (
        detail.where("debtor_pfx IS NOT NULL AND creditor_pfx IS NOT NULL")
        .groupBy(F.col("debtor_pfx").alias("debtor"), F.col("creditor_pfx").alias("creditor"), flow.alias("flow"))
        .agg(_rows().alias("count"))
    )
    return top(grouped, "count", ["debtor", "creditor"], k)


def pay_charge_bearer(detail: DataFrame) -> DataFrame:
    return _code_counts(detail, "charge_bearer", "charge_bearer", absent="(absent)", share=True)


# --- code counts -----------------------------------------------------------


def _code_counts(
    detail: DataFrame, column: str, name: str, absent: str | None = None,
    share: bool = False, k: int | None = None,
) -> DataFrame:
    """Rows per code, with a label for NULL or without NULLs."""
    if absent is None:
        rows, code = detail.where(F.col(column).isNotNull()), F.col(column)
    else:
        rows, code = detail, F.coalesce(F.col(column), F.lit(absent))
    grouped = rows.groupBy(code.alias(name)).agg(_rows().alias("count"))
    if share:
        grouped = share_of_total(grouped, "count")
    if k is not None:
        return top(grouped, "count", [name], k)
    return grouped.orderBy(F.desc("count"), name)


def status_group(detail: DataFrame) -> DataFrame:
    return _code_counts(detail, "grp_status", "group_status")


def status_tx(detail: DataFrame) -> DataFrame:
    return _code_counts(detail, "tx_status", "tx_status")


def status_reason(detail: DataFrame, k: int = 10) -> DataFrame:
    return _code_counts(detail, "reason_code", "reason_code", k=k)


def reversal_reason(detail: DataFrame) -> DataFrame:
    return _code_counts(detail, "reversal_reason", "reason", share=True)


def reversal_currency(detail: DataFrame) -> DataFrame:
    return (
        detail.where("currency IS NOT NULL")
        .groupBy("currency")
        .agg(_rows().alias("count"), money_sum(_in_range(F.col("orig_amount"))).alias("total"))
        .orderBy(F.desc("count"), "currency")
    )


def reversal_buckets(detail: DataFrame) -> DataFrame:
    return _buckets(detail, "orig_amount").drop("avg_amount")


def mandate_tracking(detail: DataFrame) -> DataFrame:
    return _code_counts(detail, "tracking_ind", "tracking", absent="(absent)", share=True)


def mandate_country(detail: DataFrame, k: int = 10) -> DataFrame:
    return _code_counts(detail, "creditor_pfx", "creditor_country", k=k)


def reason_codes(detail: DataFrame, column: str) -> DataFrame:
    """Reason codes of amendments, cancellations or suspensions."""
    return _code_counts(detail, column, "reason_code", share=True)


def mandate_acceptance(detail: DataFrame) -> DataFrame:
    """Acceptance counts; the share is over rows that say true or false."""
    grouped = detail.groupBy(F.coalesce("accepted", F.lit("(absent)")).alias("accepted")).agg(_rows().alias("count"))
    flag = F.lower("accepted")
    decided = grouped.agg(F.sum(F.when(flag.isin("true", "false"), F.col("count"))).cast("double")).scalar()
    return grouped.withColumn(
        "share_pct",
        F.when(flag.isin("true", "false"), F.round(F.lit(100.0) * F.col("count") / decided, 0)),
    ).orderBy(F.desc("count"), "accepted")


def mandate_rejection(detail: DataFrame) -> DataFrame:
    return _code_counts(detail, "rejection_reason", "rejection_reason")


def mandate_copy(detail: DataFrame) -> DataFrame:
    return detail.agg(F.count_distinct("orig_mandate_id").alias("unique_mandate_ids"))


def bar_lengths(grouped: DataFrame, value: str) -> DataFrame:
    """Bar length of every row: its value as a share of the largest value."""
    return share_of_max(grouped, value, "bar_pct")


# --- whole report ----------------------------------------------------------


def section(message_set: str, base: DataFrame, detail: DataFrame, processed: DataFrame) -> dict[str, DataFrame]:
    """Datasets behind one section of the report."""
    mine = processed.where(F.col("message_set") == message_set)
    out = {
        "status": set_status(mine),
        "categories": set_categories(base),
        "error_element": set_error_element(mine),
        "error_type": set_error_type(mine),
    }
    if message_set in ("001", "008", "013"):
        out |= {
            "currency": pay_currency(detail),
            "buckets": pay_buckets(detail),
            "corridors": pay_corridors(detail),
        }
        if message_set == "001":
            out["charge_bearer"] = pay_charge_bearer(detail)
    elif message_set in ("002", "014"):
        out |= {
            "group_status": bar_lengths(status_group(detail), "count"),
            "tx_status": status_tx(detail),
            "reason": status_reason(detail),
        }
    elif message_set == "007":
        out |= {
            "reason": bar_lengths(reversal_reason(detail), "count"),
            "currency": reversal_currency(detail),
            "buckets": reversal_buckets(detail),
        }
    elif message_set == "009":
        out |= {"tracking": mandate_tracking(detail), "country": mandate_country(detail)}
    elif message_set == "012":
        out |= {"acceptance": mandate_acceptance(detail), "rejection": mandate_rejection(detail)}
    elif message_set == "017":
        out["copies"] = mandate_copy(detail)
    else:
        column = {"010": "amendment_reason", "011": "cancellation_reason", "018": "suspension_reason"}
        out["reason"] = reason_codes(detail, column[message_set])
    return out


def labelled(rows: DataFrame) -> DataFrame:
    """Add the name of the message set."""
    return rows.withColumn("set_label", set_label(F.col("message_set")))


def write(datasets: dict[str, DataFrame], root: str, fmt: str = "parquet") -> None:
    """Save report datasets, one folder each."""
    for name, frame in datasets.items():
        frame.write.mode("overwrite").format(fmt).save(f"{root.rstrip('/')}/{name}")
