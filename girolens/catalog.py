"""Every query of the engine over the given tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from girolens import demo, model
from girolens.functions import ids
from girolens.functions.text import (
    domain_label, error_summary, file_category, label, set_label, strip_namespaces, suggest_fix,
)
from girolens.operators import joins, labels, rules, rules_flat, shred, validate
from girolens.operators.ranking import ensure_checkpoint_dir
from girolens.plans import credit, dashboard, recon, runs
from girolens.sources import corpus, events, state, store
from girolens.streaming import receiver

Query = Callable[[SparkSession, str], DataFrame]


def _on_tx(build: Callable[[DataFrame], DataFrame], *sides: str) -> Query:
    """Query over the transactions; ``sides`` are the dimensions it reads."""
    return lambda spark, folder: build(demo.tx_001(demo.order_lines(spark, folder, sides)))


def _view(spark: SparkSession, folder: str, *sides: str) -> DataFrame:
    processed, sent = demo.order_state(demo.order_headers(spark, folder))
    return joins.pipeline_view(demo.tx_001(demo.order_lines(spark, folder, sides)), processed, sent)


def _on_view(build: Callable[[DataFrame], DataFrame], *sides: str) -> Query:
    return lambda spark, folder: build(_view(spark, folder, *sides))


def _on_detail(build: Callable[[DataFrame], DataFrame], *sides: str) -> Query:
    return lambda spark, folder: build(demo.payment_detail(demo.order_lines(spark, folder, sides)))


def _on(source: Callable[[SparkSession, str], DataFrame], build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: build(source(spark, folder))


def _on_state(build: Callable[..., DataFrame], *tables: str) -> Query:
    """Query over state tables; one-table queries get that table."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        derived = demo.state(spark, folder, once=len(tables) > 2)
        return build(*[derived[t] for t in tables])

    return run


SENT, DONE, DUPES, BAD, HITS = (
    "sent_messages", "processed_messages", "duplicate_events", "tampered_messages", "rule_violations",
)


def _seconds(frame: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        frame = frame.withColumn(column, F.date_format(column, "yyyy-MM-dd HH:mm:ss"))
    return frame


def _millis(frame: DataFrame, column: str) -> DataFrame:
    return frame.withColumn(column, F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSS"))


def _pipeline_view(spark: SparkSession, folder: str) -> DataFrame:
    shown = _view(spark, folder).select(
        "file_name", "category", "end_to_end_id", F.col("amount").cast("double").alias("amount"), "currency",
        "validation_status", "error_detail", "processed_at", "sent_at", "latency_ms",
    )
    return _seconds(shown, "processed_at", "sent_at")


CREDIT: dict[str, Query] = {
    "overview": _on_tx(credit.overview),
    "category_outcome": _on_view(credit.category_outcome),
    "currency_dist": _on_tx(credit.currency_dist),
    "amount_buckets": _on_view(credit.amount_buckets),
    "debtor_country": _on_tx(credit.debtor_country, demo.CREDITOR),
    "flow_matrix": _on_tx(credit.flow_matrix, demo.CREDITOR),
    "charge_bearer": _on_tx(credit.charge_bearer),
    "payment_method": _on_tx(credit.payment_method),
    "purpose_code": _on_tx(credit.purpose_code, demo.KIND),
    "enrichment_coverage": _on_tx(credit.enrichment_coverage, demo.KIND),
    "error_element": _on_state(credit.error_element, DONE),
    "error_type_7": _on_state(credit.error_type, DONE),
    "declared_vs_actual": _on_view(credit.declared_vs_actual),
    "bank_country": _on_tx(credit.bank_country),
    "high_value": _on_view(credit.high_value, demo.CREDITOR, demo.KIND),
    "pipeline_view": _pipeline_view,
}

DASHBOARD: dict[str, Query] = {
    "dash_totals": _on_state(dashboard.totals, DONE),
    "dash_set_outcome": _on_state(dashboard.set_outcome, DONE),
    "dash_set_rate": _on_state(dashboard.set_rate, DONE),
    "dash_set_bars": _on_state(dashboard.set_bars, DONE),
    "set_status": _on_state(dashboard.set_status, DONE),
    "set_categories": _on(demo.order_headers, lambda h: dashboard.set_categories(demo.order_base(h))),
    "set_error_element": _on_state(dashboard.set_error_element, DONE),
    "set_error_type": _on_state(dashboard.set_error_type, DONE),
    "pay_currency": _on_detail(dashboard.pay_currency),
    "pay_buckets": _on_detail(dashboard.pay_buckets),
    "pay_corridors": _on_detail(dashboard.pay_corridors, demo.CREDITOR),
    "pay_charge_bearer": _on_detail(dashboard.pay_charge_bearer),
    "status_group": _on(demo.status_detail, dashboard.status_group),
    "status_tx": _on(demo.status_detail, dashboard.status_tx),
    "status_reason": _on(demo.status_detail, dashboard.status_reason),
    "reversal_reason": _on(demo.reversal_detail, dashboard.reversal_reason),
    "reversal_currency": _on(demo.reversal_detail, dashboard.reversal_currency),
    "reversal_buckets": _on(demo.reversal_detail, dashboard.reversal_buckets),
    "mandate_tracking": _on(demo.mandate_detail, dashboard.mandate_tracking),
    "mandate_country": _on(demo.mandate_detail, dashboard.mandate_country),
    "mandate_acceptance": _on(demo.accept_detail, dashboard.mandate_acceptance),
    "mandate_rejection": _on(demo.accept_detail, dashboard.mandate_rejection),
    "mandate_copy": _on(demo.copy_detail, dashboard.mandate_copy),
    "share_of_max": _on(
        demo.status_detail, lambda d: dashboard.bar_lengths(dashboard.status_group(d), "count")
    ),
}
for _set, _column in (
    ("010", "amendment_reason"), ("011", "cancellation_reason"), ("018", "suspension_reason"),
):
    DASHBOARD[f"reason_codes_{_set}"] = (
        lambda spark, folder, c=_column: dashboard.reason_codes(demo.reason_detail(spark, folder, c), c)
    )


def _dedup_antijoin(spark: SparkSession, folder: str) -> DataFrame:
    """Deliveries of ids that were never processed."""
    done = demo.state(spark, folder)[DONE].select("message_id")
    rows = demo.deliveries(spark, folder).select("event_id", "message_id")
    return rows.join(done, "message_id", "left_anti")


def _integrity(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the raw event bytes, some dropped and some altered."""
    raw = demo.read(spark, folder, "events").select(
        "event_id", F.encode(F.col("props"), "UTF-8").alias("content"), "value"
    )
    value = F.col("value")
    altered = (value >= demo.BAD_DIGEST[0]) & (value < demo.BAD_DIGEST[1])
    dropped = (value >= demo.NO_DIGEST[0]) & (value < demo.NO_DIGEST[1])
    digest = F.when(dropped, "").when(
        altered, ids.content_digest(F.concat(F.col("content"), F.encode(F.lit("!"), "UTF-8")))
    ).otherwise(ids.content_digest(F.col("content")))
    return raw.select("event_id", validate.integrity(F.col("content"), digest).alias("integrity"))


def _manifest_split(spark: SparkSession, folder: str) -> DataFrame:
    """Deliveries against the log of what was sent; some carry other content with a digest made for it."""
    value, k = F.col("value"), F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    domain, message_set = F.lit("pain"), F.lit("017")
    raw = demo.read(spark, folder, "events").select("event_id", "value", F.encode("props", "UTF-8").alias("sent"), k.alias("k"))
    extra = F.encode(F.lit("!"), "UTF-8")
    content = F.when(F.col("k") % 7 == 3, F.concat("sent", extra)).otherwise(F.col("sent"))
    digest = F.when(value < demo.BAD_DIGEST[0], "").otherwise(ids.content_digest(F.col("content")))
    # of those with other content every second one also carries the id of that content
    told = F.when((F.col("k") % 7 == 3) & (F.col("event_id") % 2 == 0), F.col("content")).otherwise(F.col("sent"))
    rows = raw.withColumn("content", content).select(
        "event_id", domain.alias("domain"), message_set.alias("message_set"), "content",
        ids.content_id(domain, message_set, told).alias("message_id"), validate.integrity(F.col("content"), digest).alias("integrity"),
    )
    log = raw.select(ids.content_id(domain, message_set, F.col("sent")).alias("message_id")).distinct()
    return validate.against_manifest(rows, log).select("event_id", "integrity")


RECON: dict[str, Query] = {
    "schema_breakdown": _on_state(recon.schema_breakdown, SENT, DONE),
    "error_patterns": _on_state(recon.error_patterns, DONE),
    "category_outcomes": _on_state(recon.category_outcomes, DONE),
    "category_share": _on_state(recon.category_share, DONE),
    "unexpected_outcomes": _on_state(recon.unexpected_outcomes, DONE),
    "latency_by_schema": _on_state(recon.latency_by_schema, SENT, DONE),
    "latency_scatter": _on_state(recon.latency_scatter, SENT, DONE),
    "pipeline_timeline": _on_state(recon.pipeline_timeline, SENT, DONE),
    "tampered_by_set": _on_state(recon.tampered_by_set, BAD),
    "rule_violation_summary": _on_state(recon.rule_violation_summary, HITS),
    "violation_severity_totals": _on_state(recon.violation_severity_totals, HITS),
    "recon_summary": _on_state(recon.recon_summary, SENT, DONE, DUPES, BAD, HITS),
    "message_detail": _on_state(recon.message_detail, SENT, DONE),
    "report_cube": _on_state(
        lambda *t: recon.report_cube(*t).select("set_id", "key", "status", "sent", "done", "n", "passed", "failed", "sets", "first_sent", "last_done"),
        SENT, DONE, DUPES, BAD, HITS),
    "duplicate_log": _on_state(recon.duplicate_log, DUPES),
    "tampered_log": _on_state(recon.tampered_log, BAD),
    "pass_band": _on_state(recon.pass_band, SENT, DONE),
    "recon_status": _on_state(
        lambda s, p: joins.recon_status(s, p).select("message_id", "message_set", "file_name", "status"), SENT, DONE
    ),
    "unprocessed": _on_state(
        lambda s, p: joins.unprocessed(s, p).select("message_id", "file_name"), SENT, DONE
    ),
    "dedup_antijoin": _dedup_antijoin,
    "route": lambda spark, folder: demo.routed(demo.deliveries(spark, folder)).select(
        "event_id", "message_id", "route"
    ),
    "integrity_split": _integrity,
    "manifest_split": _manifest_split,
    "adhoc_status_counts": _on_state(runs.status_counts, DONE),
    "adhoc_failed": _on_state(runs.failed, DONE),
    "adhoc_duplicates": _on_state(lambda d: _millis(runs.duplicates(d), "detected_at"), DUPES),
    "adhoc_tampered": _on_state(lambda t: _millis(runs.tampered(t), "detected_at"), BAD),
}


# --- shredding: tables -> XML -> rows ----------------------------------------


def _shredded(
    build: DataFrame, message_set: str, shred_rows: Callable[[DataFrame], DataFrame], reads: str
) -> DataFrame:
    """Round trip through XML; ``reads`` names the shredder whose elements are parsed."""
    return shred_rows(corpus.well_formed(corpus.parse(build, message_set, reads=shred.READS[reads])))


def _money(frame: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        frame = frame.withColumn(column, F.col(column).cast("double"))
    return frame


def _shred_001(spark: SparkSession, folder: str) -> DataFrame:
    messages = demo.messages(demo.order_lines(spark, folder))
    return _money(_shredded(messages, "001", shred.shred_001, "shred_001"), "amount", "ctrl_sum")


def _shred_payment(spark: SparkSession, folder: str) -> DataFrame:
    messages = demo.messages(demo.order_lines(spark, folder))
    return _money(_shredded(messages, "001", shred.shred_payment, "shred_payment"), "amount")


def _shred_direct_debit(spark: SparkSession, folder: str) -> DataFrame:
    messages = demo.messages(demo.order_lines(spark, folder), "008")
    return _money(_shredded(messages, "008", shred.shred_direct_debit, "shred_direct_debit"), "amount")


def _shred_status(spark: SparkSession, folder: str) -> DataFrame:
    return _shredded(demo.status_messages(demo.order_items(spark, folder)), "002", shred.shred_status, "shred_status")


def _shred_reversal(spark: SparkSession, folder: str) -> DataFrame:
    messages = demo.reversal_messages(demo.order_items(spark, folder))
    return _money(_shredded(messages, "007", shred.shred_reversal, "shred_reversal"), "orig_amount")


def _shred_mandate(message_set: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        parsed = corpus.parse(demo.mandate_messages(spark, folder, message_set), message_set)
        return shred.shred(corpus.well_formed(parsed), message_set)

    return run


def _file_base(spark: SparkSession, folder: str) -> DataFrame:
    messages = demo.messages(demo.order_lines(spark, folder))
    return _shredded(messages, "001", lambda parsed: shred.file_base(parsed, "001"), "file_base")


SHRED: dict[str, Query] = {
    "shred_001": _shred_001,
    "shred_payment": _shred_payment,
    "shred_direct_debit": _shred_direct_debit,
    "shred_status": _shred_status,
    "shred_reversal": _shred_reversal,
    "shred_mandate_init": _shred_mandate("009"),
    "shred_amend": _shred_mandate("010"),
    "shred_cancel": _shred_mandate("011"),
    "shred_accept": _shred_mandate("012"),
    "shred_copy": _shred_mandate("017"),
    "shred_suspend": _shred_mandate("018"),
    "file_base": _file_base,
}


# --- report sections over shredded messages ------------------------------------

# message set -> dataset -> its builder and the column it groups by
_SECTIONS: dict[str, dict[str, tuple[Callable[[DataFrame], DataFrame], str]]] = {
    "002": {"group_status": (dashboard.status_group, "group_status"), "tx_status": (dashboard.status_tx, "tx_status"),
            "reason": (dashboard.status_reason, "reason_code")},
    "007": {"reason": (dashboard.reversal_reason, "reason"), "currency": (dashboard.reversal_currency, "currency")},
    "009": {"tracking": (dashboard.mandate_tracking, "tracking"), "country": (dashboard.mandate_country, "creditor_country")},
    "010": {"reason": (lambda d: dashboard.reason_codes(d, "amendment_reason"), "reason_code")},
    "011": {"reason": (lambda d: dashboard.reason_codes(d, "cancellation_reason"), "reason_code")},
    "012": {"acceptance": (dashboard.mandate_acceptance, "accepted"), "rejection": (dashboard.mandate_rejection, "rejection_reason")},
    "017": {"copies": (lambda d: dashboard.mandate_copy(d).select(F.lit("all").alias("key"), F.col("unique_mandate_ids").alias("count")), "key")},
    "018": {"reason": (lambda d: dashboard.reason_codes(d, "suspension_reason"), "reason_code")},
}
_SHREDDED = {
    "002": "shred_status", "007": "shred_reversal", "009": "shred_mandate_init", "010": "shred_amend", "011": "shred_cancel",
    "012": "shred_accept", "017": "shred_copy", "018": "shred_suspend",
}


def _section(message_set: str) -> Query:
    """Datasets of a report section in long form, from messages that are shredded once."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        detail = SHRED[_SHREDDED[message_set]](spark, folder)
        ensure_checkpoint_dir(detail)
        detail = detail.checkpoint()
        parts = [
            build(detail).select(F.lit(name).alias("dataset"), F.col(key).alias("key"), "count")
            for name, (build, key) in _SECTIONS[message_set].items()
        ]
        return reduce(DataFrame.unionByName, parts)

    return run


SECTIONS: dict[str, Query] = {f"section_{s}": _section(s) for s in _SECTIONS}


# --- business rules ----------------------------------------------------------


def _checked(messages: DataFrame, message_set: str) -> DataFrame:
    reads = rules.CREDIT_READS if message_set == "001" else rules.READS.get(message_set)
    parsed = corpus.well_formed(corpus.parse(messages, message_set, reads=reads))
    as_of = F.lit(demo.AS_OF).cast("date")
    return rules.violations(rules.with_violations(parsed, message_set, as_of), "file_name")


def _counted(hits: DataFrame) -> DataFrame:
    return hits.groupBy("file_name", "rule_id").agg(F.count(F.lit(1)).alias("violations"))


def _rule_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rule hits per message."""
    return _counted(_checked(demo.messages(demo.order_lines(spark, folder)), "001"))


def _rules_flat(spark: SparkSession, folder: str) -> DataFrame:
    flat = demo.flat_rules_input(demo.order_lines(spark, folder))
    return rules_flat.credit_rule_counts(flat, F.lit(demo.AS_OF).cast("date"))


def _severity() -> Column:
    return label(F.col("rule_id"), {rule: text[0] for rule, text in model.RULES.items()})


def _rules_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _rule_counts(spark, folder).groupBy("rule_id").agg(
        F.sum("violations").alias("violations"), F.count(F.lit(1)).alias("messages")
    ).withColumn("severity", _severity())


def _rules_direct_debit(spark: SparkSession, folder: str) -> DataFrame:
    return _counted(_checked(demo.messages(demo.order_lines(spark, folder), "008"), "008"))


def _rules_status(spark: SparkSession, folder: str) -> DataFrame:
    messages = demo.status_messages(demo.order_items(spark, folder))
    return _checked(messages, "002").select("file_name", "rule_id", "actual", "message")


def _rules_reversal(spark: SparkSession, folder: str) -> DataFrame:
    messages = demo.reversal_messages(demo.order_items(spark, folder))
    return _checked(messages, "007").select("file_name", "rule_id", "actual")


def _rules_mandates(spark: SparkSession, folder: str) -> DataFrame:
    parts = [
        _checked(demo.mandate_messages(spark, folder, s), s).select(
            F.lit(s).alias("message_set"), "file_name", "rule_id", "actual"
        )
        for s in ("009", "010", "011", "012", "017", "018")
    ]
    return reduce(DataFrame.unionByName, parts)


def _decided(spark: SparkSession, folder: str) -> DataFrame:
    """Outcome per order message from its rule hits."""
    hits = _rule_counts(spark, folder).withColumn("severity", _severity()).groupBy("file_name").agg(
        F.sum(F.when(F.col("severity") == "ERROR", F.col("violations"))).alias("e"),
        F.sum(F.when(F.col("severity") == "WARNING", F.col("violations"))).alias("w"),
    )
    files = demo.order_headers(spark, folder).select("file_name")
    return files.join(hits, "file_name", "left").select(
        "file_name",
        F.coalesce("e", F.lit(0)).alias("br_errors"),
        F.coalesce("w", F.lit(0)).alias("br_warnings"),
    ).withColumn("passed", F.col("br_errors") == 0)


RULES: dict[str, Query] = {
    "rules_credit": _rule_counts,
    "rules_credit_flat": _rules_flat,
    "rules_credit_summary": _rules_summary,
    "rules_direct_debit": _rules_direct_debit,
    "rules_status": _rules_status,
    "rules_reversal": _rules_reversal,
    "rules_mandates": _rules_mandates,
    "validation_summary": _on(_decided, runs.validation_summary),
    "validation_status": _on(_decided, lambda d: runs.validation_status(d, "file_name")),
}


# --- single expressions --------------------------------------------------------


def _cases(spark: SparkSession, folder: str) -> DataFrame:
    """Generated cases: orders with a requested category and a validation result."""
    orders = demo.read(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    headers = demo.order_headers(spark, folder).select("o_orderkey", "file_name", "message_set", "order_ts")
    priority = F.col("o_orderpriority")
    return headers.join(orders, "o_orderkey").select(
        F.col("file_name").alias("source_file"),
        F.col("message_set").alias("schema"),
        "order_ts", "o_orderkey",
        F.when(priority.isin("1-URGENT", "4-NOT SPECIFIED"), "pass").when(priority == "2-HIGH", "fail")
        .otherwise("edge").alias("requested_category"),
        (F.col("o_orderstatus") != "F").alias("valid"),
    )


def _sequence_names(spark: SparkSession, folder: str) -> DataFrame:
    named = labels.sequence_names(
        labels.with_outcome(_cases(spark, folder)), ["order_ts", "o_orderkey"], F.lit("2026-06-30").cast("date")
    )
    return named.select("source_file", "file_name")


def _over_deliveries(*columns: Callable[[], Column], failed: bool = False) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = demo.deliveries(spark, folder)
        if failed:
            rows = rows.where("error_detail IS NOT NULL")
        return rows.select("event_id", *[c() for c in columns])

    return run


def _error_texts() -> Column:
    detail = F.col("error_detail")
    return F.array(detail, detail, F.col("message_id"), detail, detail, detail)


# Facets of four elements, as a schema would state them.
FACETS = [
    ("Document/Dbtr/Nm", "maxLength", "17"),
    ("Document/Dbtr/Nm", "pattern", "Customer#[0-8]+"),
    ("Document/Amt/@Ccy", "required", ""),
    ("Document/ChrgBr", "enumeration", "F O"),
    ("Document/Amt", "minInclusive", "0"),
    ("Document/Amt", "fractionDigits", "1"),
    ("Document/Amt", "totalDigits", "5"),
]


def _facet_check(spark: SparkSession, folder: str) -> DataFrame:
    customer, orders = demo.read(spark, folder, "customer"), demo.read(spark, folder, "orders")
    party = F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("message_id")
    pairs = F.array(
        F.struct(F.lit("Document/Dbtr/Nm").alias("path"), F.col("c_name").alias("value")),
        F.struct(F.lit("Document/Amt/@Ccy").alias("path"), demo.currency_of("c_mktsegment").alias("value")),
        F.struct(F.lit("Document/Amt").alias("path"), F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("value")),
    )
    values = customer.select(party, F.inline(pairs)).unionByName(
        orders.select(
            F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("message_id"),
            F.lit("Document/ChrgBr").alias("path"), F.col("o_orderstatus").alias("value"),
        )
    )
    facets = spark.createDataFrame(FACETS, validate.FACET_RULES_DDL)
    return validate.facet_check(values, facets).select("message_id", "path", "facet")


EXPRESSIONS: dict[str, Query] = {
    "file_category": _on(demo.order_headers, lambda h: h.select(
        "file_name", file_category(F.col("file_name")).alias("category"),
        file_category(F.col("file_name"), strict=True).alias("strict_category"),
    )),
    "iban_country": _on(demo.customer_ibans, lambda c: c.select(
        "c_custkey", ids.iban_country(F.col("iban")).alias("country")
    )),
    "bic_country": _on(demo.order_headers, lambda h: h.select(
        "file_name", ids.bic_country(F.col("debtor_bic")).alias("country")
    )),
    "iban_valid": _on(demo.customer_ibans, lambda c: c.withColumn("valid", ids.iban_is_valid(F.col("iban")))),
    "bic_valid": _on(demo.order_headers, lambda h: h.where("debtor_bic IS NOT NULL").select(
        "file_name", ids.bic_is_valid(F.col("debtor_bic")).alias("valid")
    )),
    "uetr_valid": _on(demo.order_lines, lambda x: x.where("uetr IS NOT NULL").select(
        "file_name", "end_to_end_id", "instr_id", ids.uetr_is_valid(F.col("uetr")).alias("valid")
    )),
    "content_id": lambda spark, folder: demo.read(spark, folder, "events").select(
        "event_id",
        ids.content_id(F.lit("pain"), F.col("event_type"), F.encode(F.col("props"), "UTF-8")).alias("message_id"),
    ),
    "topic_name": _over_deliveries(lambda: ids.topic_name(F.col("domain"), F.col("message_set")).alias("topic")),
    "schema_label": _over_deliveries(lambda: ids.schema_label(F.col("domain"), F.col("message_set")).alias("label")),
    "set_label": _over_deliveries(
        lambda: set_label(F.col("message_set")).alias("label"),
        lambda: domain_label(F.col("domain")).alias("domain_label"),
    ),
    "strip_ns": _over_deliveries(lambda: strip_namespaces(F.col("error_detail")).alias("message"), failed=True),
    "suggest_fix": _over_deliveries(lambda: suggest_fix(F.col("error_detail")).alias("suggestion"), failed=True),
    "error_summary": _over_deliveries(
        lambda: error_summary(_error_texts()).alias("schema_text"),
        lambda: error_summary(_error_texts(), first=3).alias("rule_text"),
        failed=True,
    ),
    "relabel_outcome": _on(_cases, lambda c: labels.with_outcome(c).select("source_file", "actual_category", "mismatch")),
    "sequence_names": _sequence_names,
    "label_audit": _on(_cases, labels.label_audit),
    "spread_sample": _on(demo.order_headers, lambda h: labels.spread_sample(
        demo.order_base(h), ["message_set"], "file_name", 12
    ).select("message_set", "file_name", "turn")),
    "facet_check": _facet_check,
}


# --- jobs that write and read back ---------------------------------------------

_RESOURCES = Path(__file__).parent / "resources"
_XSD = _RESOURCES / "credit_demo.xsd"
_RECORDS_A_FILE = 20_000
_STREAM_XSD = {"017": "copy_demo.xsd", "018": "suspension_demo.xsd"}


def _xsd_flag(spark: SparkSession, folder: str) -> DataFrame:
    """Order messages against a schema file that is shipped to every executor."""
    spark.sparkContext.addFile(str(_XSD))
    return demo.messages(demo.order_lines(spark, folder)).select(
        "file_name", validate.xsd_flag(F.col("xml"), "001", _XSD.name).alias("valid")
    )


def _outcomes(tables: dict[str, DataFrame]) -> DataFrame:
    """Deliveries per message and outcome, rule hits included, from the state tables."""
    outcomes = [
        tables["processed_messages"].select("message_id", F.col("validation_status").alias("outcome")),
        tables["duplicate_events"].select("message_id", F.lit("duplicate").alias("outcome")),
        tables["tampered_messages"].select("message_id", F.lit("tampered").alias("outcome")),
        tables["rule_violations"].select("message_id", F.col("rule_id").alias("outcome")),
    ]
    return reduce(DataFrame.unionByName, outcomes).groupBy("message_id", "outcome").agg(
        F.count(F.lit(1)).alias("deliveries")
    )


def _streamed(spark: SparkSession, folder: str, parts: int, sets: tuple[str, ...] | None = None, **options) -> DataFrame:
    """Deliveries through the streaming job, in ``parts`` in the order of their offsets, one part a batch.

    A part is written by as many tasks as the events are read with, and the job takes up its checkpoint for each part, so
    that a batch is a part however many files it has.  Outcomes are of all message sets, or read from the folders of some.
    """
    records = demo.stream_records(spark, folder)
    ensure_checkpoint_dir(records)
    base = f"{spark.sparkContext.getCheckpointDir()}/stream-{uuid.uuid4()}"
    for file in _STREAM_XSD.values():
        spark.sparkContext.addFile(str(_RESOURCES / file))
    if parts > 1:
        low, high = records.agg(F.min("offset"), F.max("offset")).first()
        part = F.floor((F.col("offset") - low) * parts / (high - low + 1))
    for k in range(parts):
        rows = records if parts == 1 else records.where(part == k)
        # packed files are read by one task each, so they are kept small
        rows.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", _RECORDS_A_FILE).json(f"{base}/records")
        query = receiver.start(
            events.file_stream(spark, f"{base}/records"), f"{base}/state", f"{base}/offsets", xsd_paths=_STREAM_XSD, **options,
        )
        query.awaitTermination()
    return _outcomes(state.load_all(spark, f"{base}/state", sets))


def _stream_state(spark: SparkSession, folder: str) -> DataFrame:
    """Deliveries through the streaming job; outcome counts from the tables it wrote."""
    return _streamed(spark, folder, 1)


def _stream_commits(spark: SparkSession, folder: str) -> DataFrame:
    """The same over four batches, whose commits are merged two by two; ids of earlier batches come from the index."""
    return _streamed(spark, folder, 4, fan=2)


def _stream_of_set(spark: SparkSession, folder: str) -> DataFrame:
    """Outcomes of one message set, from the folders of the state tables that hold it."""
    return _streamed(spark, folder, 2, sets=("018",), fan=2)


def _corpus_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """A corpus of all sets, one unknown and some malformed messages, validated in one pass."""
    done = validate.validate_corpus(demo.mixed_messages(spark, folder), as_of=F.lit(demo.AS_OF).cast("date"))
    return done.select(
        "file_name", "message_set", "validation_status", F.size("errors").alias("structural"), "br_errors",
        F.array_join(F.array_sort(F.array_distinct("violations.rule_id")), ",").alias("rules"),
    )


def _from_store(message_set: str, shredder: Callable[[DataFrame], DataFrame]) -> Query:
    """Rows of one set from a store of parsed messages that got them in two steps, the second time new ones only."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        messages = demo.mixed_messages(spark, folder)
        ensure_checkpoint_dir(messages)
        root = f"{spark.sparkContext.getCheckpointDir()}/store-{uuid.uuid4()}"
        store.extend(messages.where(F.xxhash64("file_name") % 2 == 0), root)
        store.extend(messages, root)
        return shredder(corpus.well_formed(store.read_set(spark, root, message_set)))

    return run


JOBS: dict[str, Query] = {
    "xsd_flag": _xsd_flag, "stream_state": _stream_state, "stream_commits": _stream_commits, "stream_of_set": _stream_of_set,
    "corpus_outcomes": _corpus_outcomes,
    "store_payment_013": _from_store("013", lambda parsed: shred.shred_payment(parsed, "013").select(
        "file_name", "category", F.col("amount").cast("decimal(18,2)").alias("amount"), "currency", "has_uetr")),
    "store_status_014": _from_store("014", shred.shred_status),
}


def all_queries() -> dict[str, Query]:
    return {**CREDIT, **DASHBOARD, **RECON, **SHRED, **SECTIONS, **RULES, **EXPRESSIONS, **JOBS}
