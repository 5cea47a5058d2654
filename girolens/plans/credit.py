"""Credit-transfer analytics over shredded transactions (``tx``) and their
pipeline view (``view``: tx plus validation status and times)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from girolens.functions.amounts import (
    CREDIT_STEPS, CREDIT_TOP, count_if, ladder, money_avg, money_sum, percent,
)
from girolens.functions.text import error_type as error_type_of, failing_element
from girolens.operators.ranking import share_of_total, top

def _rows() -> Column:
    return F.count(F.lit(1))


def _or(column: str, fallback: str) -> Column:
    return F.coalesce(F.col(column), F.lit(fallback))


def overview(tx: DataFrame) -> DataFrame:
    """Files, rows, amounts, currencies and enrichment in one row.

    Distinct counts are taken from per-file and per-currency partials, so that
    only one pass over the rows is needed.
    """
    by_file = tx.groupBy("file_name", "currency").agg(
        _rows().alias("n"),
        F.sum("amount").alias("amount"),
        F.count("amount").alias("amounts"),
        count_if(F.col("has_uetr")).alias("uetr"),
        count_if(F.col("has_remittance_info")).alias("remittance"),
    )
    return by_file.agg(
        F.count_distinct("file_name").alias("total_files"),
        F.sum("n").alias("total_tx_rows"),
        F.round(F.sum("amount").cast("double") / F.sum("amounts"), 2).alias("avg_amount"),
        money_sum(F.col("amount")).alias("total_value"),
        F.count_distinct("currency").alias("currencies"),
        F.sum("uetr").alias("with_uetr"),
        F.sum("remittance").alias("with_remittance"),
    )


def category_outcome(view: DataFrame) -> DataFrame:
    """Files by category and outcome; a file counts once per outcome it had."""
    status = F.col("validation_status")
    per_file = view.groupBy("category", "file_name").agg(
        F.max((status == "pass").cast("int")).alias("passed"),
        F.max((status == "fail").cast("int")).alias("failed"),
        F.max(status.isNull().cast("int")).alias("absent"),
        F.count(status).alias("known"),
    )
    passed = F.count_if(F.col("passed") == 1)
    return per_file.groupBy("category").agg(
        _rows().alias("files"),
        passed.alias("pipeline_pass"),
        F.count_if(F.col("failed") == 1).alias("pipeline_fail"),
        F.count_if(F.col("absent") == 1).alias("not_sent"),
        percent(passed, F.count_if(F.col("known") > 0)).alias("pass_pct"),
    ).orderBy("category")


def currency_dist(tx: DataFrame) -> DataFrame:
    return (
        tx.where("amount IS NOT NULL")
        .groupBy(_or("currency", "(missing)").alias("currency"))
        .agg(
            _rows().alias("tx_count"),
            money_sum(F.col("amount")).alias("total_value"),
            F.round(F.min("amount").cast("double"), 2).alias("min_amt"),
            F.round(F.max("amount").cast("double"), 2).alias("max_amt"),
            money_avg(F.col("amount")).alias("avg_amt"),
        )
        .orderBy(F.desc("tx_count"), "currency")
    )


def amount_buckets(view: DataFrame) -> DataFrame:
    return (
        view.where("amount IS NOT NULL AND validation_status = 'pass'")
        .groupBy(ladder(F.col("amount"), CREDIT_STEPS, CREDIT_TOP).alias("bucket"))
        .agg(
            _rows().alias("tx_count"),
            money_avg(F.col("amount")).alias("avg_amount"),
            money_sum(F.col("amount")).alias("total_value"),
            F.min("amount").alias("_least"),
        )
        .orderBy("_least")
        .drop("_least")
    )


def debtor_country(tx: DataFrame, k: int = 15) -> DataFrame:
    """Debtor countries with value and number of destinations, most used first."""
    pairs = (
        tx.where("amount IS NOT NULL")
        .groupBy(_or("debtor_iban_prefix", "(unknown)").alias("debtor_country"), "creditor_iban_prefix")
        .agg(_rows().alias("n"), F.sum("amount").alias("amount"))
    )
    grouped = pairs.groupBy("debtor_country").agg(
        F.sum("n").alias("tx_count"),
        money_sum(F.col("amount")).alias("total_value"),
        F.count("creditor_iban_prefix").alias("unique_dest_countries"),
    )
    return top(grouped, "tx_count", ["debtor_country"], k)


def _flow(debtor: str, creditor: str) -> Column:
    return F.when(F.col(debtor).eqNullSafe(F.col(creditor)), "domestic").otherwise("cross-border")


def flow_matrix(tx: DataFrame, k: int = 20) -> DataFrame:
    grouped = (
        tx.where(
            "amount IS NOT NULL AND debtor_iban_prefix IS NOT NULL AND creditor_iban_prefix IS NOT NULL"
        )
        .groupBy(
            F.col("debtor_iban_prefix").alias("from_country"),
            F.col("creditor_iban_prefix").alias("to_country"),
            _flow("debtor_iban_prefix", "creditor_iban_prefix").alias("flow_type"),
        )
        .agg(_rows().alias("tx_count"), money_sum(F.col("amount")).alias("total_value"))
    )
    return top(grouped, "tx_count", ["from_country", "to_country"], k)


def charge_bearer(tx: DataFrame) -> DataFrame:
    grouped = tx.groupBy(_or("charge_bearer", "(absent)").alias("charge_bearer")).agg(
        _rows().alias("tx_count"), money_avg(F.col("amount")).alias("avg_amount")
    )
    return share_of_total(grouped, "tx_count").orderBy(F.desc("tx_count"), "charge_bearer")


def payment_method(tx: DataFrame) -> DataFrame:
    per_file = tx.groupBy(_or("pmt_method", "(absent)").alias("pmt_method"), "file_name").agg(_rows().alias("n"))
    return (
        per_file.groupBy("pmt_method")
        .agg(F.count("file_name").alias("files"), F.sum("n").alias("tx_count"))
        .orderBy(F.desc("tx_count"), "pmt_method")
    )


def purpose_code(tx: DataFrame, k: int = 15) -> DataFrame:
    grouped = tx.groupBy(_or("purpose_code", "(none)").alias("purpose_code")).agg(
        _rows().alias("tx_count"), money_sum(F.col("amount")).alias("total_value")
    )
    return top(grouped, "tx_count", ["purpose_code"], k)


def enrichment_coverage(tx: DataFrame) -> DataFrame:
    return (
        tx.groupBy("category")
        .agg(
            _rows().alias("tx_count"),
            percent(count_if(F.col("has_uetr")), _rows()).alias("uetr_pct"),
            percent(count_if(F.col("has_remittance_info")), _rows()).alias("remittance_pct"),
            percent(F.count("purpose_code"), _rows()).alias("purpose_pct"),
        )
        .orderBy("category")
    )


def _failures(processed: DataFrame, message_set: str | None) -> DataFrame:
    failed = processed.where("validation_status = 'fail'")
    return failed if message_set is None else failed.where(F.col("message_set") == message_set)


def error_element(processed: DataFrame, message_set: str | None = "001", k: int = 12) -> DataFrame:
    """Element named by the error text; '' collects texts that name none."""
    grouped = (
        _failures(processed, message_set)
        .where("error_detail IS NOT NULL")
        .groupBy(failing_element(F.col("error_detail")).alias("failing_element"))
        .agg(_rows().alias("occurrence"))
    )
    shared = share_of_total(grouped, "occurrence", "pct_of_failures")
    return top(shared, "occurrence", ["failing_element"], k)


def error_type(processed: DataFrame, message_set: str | None = "001") -> DataFrame:
    grouped = (
        _failures(processed, message_set)
        .groupBy(error_type_of(F.col("error_detail")).alias("error_type"))
        .agg(_rows().alias("count"))
    )
    return share_of_total(grouped, "count").orderBy(F.desc("count"), "error_type")


def declared_vs_actual(view: DataFrame) -> DataFrame:
    """Declared against parsed transactions: per file first, then per outcome."""
    per_file = view.groupBy("file_name", "category", "validation_status").agg(
        F.max("nb_txs_declared").alias("declared"), _rows().alias("parsed")
    )
    return (
        per_file.groupBy("category", "validation_status")
        .agg(
            _rows().alias("files"),
            F.sum("declared").alias("total_declared"),
            F.sum("parsed").alias("total_parsed"),
            count_if(F.col("declared") != F.col("parsed")).alias("mismatch_files"),
        )
        .orderBy("category", "validation_status")
    )


def bank_country(tx: DataFrame, k: int = 12) -> DataFrame:
    per_bank = tx.groupBy(
        _or("debtor_bic_country", "(no BIC)").alias("bank_country"), "debtor_bic"
    ).agg(_rows().alias("n"))
    grouped = per_bank.groupBy("bank_country").agg(
        F.sum("n").alias("tx_count"), F.count("debtor_bic").alias("unique_bics")
    )
    return top(grouped, "tx_count", ["bank_country"], k)


def high_value(view: DataFrame, k: int = 10) -> DataFrame:
    """Largest passing transactions; sorts only the columns that are shown."""
    ranked = (
        view.where("validation_status = 'pass' AND amount IS NOT NULL")
        .orderBy(F.desc("amount"), "file_name", "end_to_end_id", "creditor_name")
        .limit(k)
    )
    return ranked.select(
        "file_name",
        "creditor_name",
        _or("creditor_iban_prefix", "??").alias("cdtr_ctry"),
        "currency",
        F.round(F.col("amount").cast("double"), 2).alias("amount"),
        "charge_bearer",
        _or("purpose_code", "—").alias("purpose"),
    )
