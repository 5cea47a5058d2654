"""Reconciliation of what was sent with what was processed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from girolens.functions.amounts import count_if, percent
from girolens.functions.text import error_category, file_category, pass_band as band
from girolens.functions.ids import schema_label
from girolens.functions.times import epoch_millis
from girolens.operators.joins import matched, recon_status
from girolens.operators.ranking import (
    counted_quantile, ensure_checkpoint_dir, row_number, share_of_max, share_of_total, share_within,
)

def _rows() -> Column:
    return F.count(F.lit(1))


def schema_breakdown(sent: DataFrame, processed: DataFrame) -> DataFrame:
    status = F.col("validation_status")
    done = F.count(status)
    return (
        recon_status(sent, processed)
        .groupBy("message_set")
        .agg(
            _rows().alias("total_sent"),
            done.alias("processed"),
            count_if(status == "pass").alias("pass_count"),
            count_if(status == "fail").alias("fail_count"),
            (_rows() - done).alias("pending"),
            F.coalesce(percent(count_if(status == "pass"), done), F.lit(0.0)).alias("pass_rate"),
        )
        .orderBy("message_set")
    )


def error_patterns(processed: DataFrame) -> DataFrame:
    """Twelve classes of error with the number of sets that show them."""
    per_set = (
        processed.where("validation_status = 'fail' AND error_detail IS NOT NULL")
        .groupBy(error_category(F.col("error_detail")).alias("error_category"), "message_set")
        .agg(_rows().alias("n"))
    )
    return (
        per_set.groupBy("error_category")
        .agg(F.sum("n").alias("occurrences"), F.count("message_set").alias("schemas_affected"))
        .orderBy(F.desc("occurrences"), "error_category")
    )


def category_outcomes(processed: DataFrame) -> DataFrame:
    return (
        processed.groupBy(
            file_category(F.col("file_name"), strict=True).alias("test_category"), "validation_status"
        )
        .agg(_rows().alias("count"))
        .orderBy("test_category", "validation_status")
    )


def category_share(processed: DataFrame) -> DataFrame:
    """Outcomes as a share of their category."""
    return share_within(category_outcomes(processed), "test_category", "count")


def unexpected_outcomes(processed: DataFrame) -> DataFrame:
    """Outcomes that contradict what the file name promised."""
    failed = F.col("validation_status") == "fail"
    surprise = (F.col("test_category").isin("gen-pass", "gen-edge") & failed) | (
        (F.col("test_category") == "gen-fail") & (F.col("validation_status") == "pass")
    )
    return category_outcomes(processed).withColumn("unexpected", F.coalesce(surprise, F.lit(False)))


def _seconds(millis: Column, digits: int) -> Column:
    return F.round(millis.cast("double") / F.lit(1000.0), digits)


def latency_by_schema(sent: DataFrame, processed: DataFrame) -> DataFrame:
    """Latency statistics per set; the 95th percentile is exact and interpolated."""
    # counted once: all that follows reads the same shuffled counts
    counted = matched(sent, processed).groupBy("message_set", "latency_ms").agg(
        _rows().alias("n"), F.min("processed_at").alias("first"), F.max("processed_at").alias("last")
    )
    timed = F.sum(F.when(F.col("latency_ms").isNotNull(), F.col("n")))
    stats = counted.groupBy("message_set").agg(
        F.sum("n").alias("msg_count"),
        _seconds(F.min("latency_ms"), 2).alias("min_sec"),
        F.round(F.sum(F.col("latency_ms") * F.col("n")).cast("double") / timed / F.lit(1000.0), 2).alias("avg_sec"),
        _seconds(F.max("latency_ms"), 2).alias("max_sec"),
        (epoch_millis(F.max("last")) - epoch_millis(F.min("first"))).cast("double").alias("receiver_span_ms"),
    )
    p95 = counted_quantile(counted, "message_set", "latency_ms", "n", 0.95, "_p95")
    return (
        stats.join(p95, "message_set", "left")
        .select(
            "message_set", "msg_count", "min_sec", "avg_sec",
            _seconds(F.col("_p95"), 2).alias("p95_sec"), "max_sec", "receiver_span_ms",
        )
        .orderBy(F.desc("avg_sec"), "message_set")
    )


def latency_scatter(sent: DataFrame, processed: DataFrame) -> DataFrame:
    """Latency of every message with its rank in sending order."""
    pairs = matched(sent, processed).select(
        "sent_at", "message_id", "message_set", "file_name", "latency_ms"
    )
    ranked = row_number(pairs, ["sent_at", "message_id"], "seq_num")
    return ranked.select(
        "message_set", "file_name", "seq_num", _seconds(F.col("latency_ms"), 3).alias("latency_sec")
    )


def pipeline_timeline(sent: DataFrame, processed: DataFrame) -> DataFrame:
    pairs = matched(sent, processed)
    ends = pairs.agg(
        epoch_millis(F.min("sent_at")).alias("s0"),
        epoch_millis(F.max("sent_at")).alias("s1"),
        epoch_millis(F.min("processed_at")).alias("p0"),
        epoch_millis(F.max("processed_at")).alias("p1"),
        _rows().alias("total_messages"),
    )
    span = F.col("p1") - F.col("p0")
    return ends.select(
        _seconds(F.col("s1") - F.col("s0"), 3).alias("sender_sec"),
        _seconds(F.col("p0") - F.col("s1"), 3).alias("wait_sec"),
        _seconds(span, 3).alias("receiver_sec"),
        "total_messages",
        F.round(
            F.col("total_messages") * F.lit(1000.0) / F.nullif(span.cast("double"), F.lit(0.0)), 0
        ).alias("throughput_per_sec"),
    )


def tampered_by_set(tampered: DataFrame) -> DataFrame:
    return (
        tampered.groupBy(schema_label(F.col("domain"), F.col("message_set")).alias("schema_label"))
        .agg(_rows().alias("tampered_count"))
        .orderBy(F.desc("tampered_count"), "schema_label")
    )


def tampered_bars(tampered: DataFrame) -> DataFrame:
    return share_of_max(tampered_by_set(tampered), "tampered_count", "bar_pct")


def rule_violation_summary(violations: DataFrame) -> DataFrame:
    """Violations per rule with sets, messages and one sample each.

    Counts are first taken per message, so a rule that fires on every message
    is spread over all tasks by message id.
    """
    sample = F.min(F.struct("message_id", "field_path", "message"))
    per_message = violations.groupBy("rule_id", "severity", "message_set", "message_id").agg(
        _rows().alias("n"), sample.alias("sample")
    )
    per_set = per_message.groupBy("rule_id", "severity", "message_set").agg(
        F.sum("n").alias("n"), F.min("sample").alias("sample")
    )
    ids = per_message.groupBy("rule_id", "severity", "message_id").agg(F.lit(1).alias("one"))
    messages = ids.groupBy("rule_id", "severity").agg(_rows().alias("messages_affected"))
    totals = per_set.groupBy("rule_id", "severity").agg(
        F.sum("n").alias("total_violations"),
        F.count("message_set").alias("schemas_affected"),
        F.min("sample").alias("sample"),
    )
    return (
        totals.join(messages, ["rule_id", "severity"])
        .select(
            "rule_id", "severity", "total_violations", "schemas_affected", "messages_affected",
            F.col("sample.field_path").alias("sample_field"),
            F.col("sample.message").alias("sample_message"),
        )
        .orderBy(F.desc("severity"), F.desc("total_violations"), "rule_id")
    )


def violation_severity_totals(violations: DataFrame) -> DataFrame:
    return violations.agg(
        F.count_if(F.col("severity") == "ERROR").alias("errors"),
        F.count_if(F.col("severity") == "WARNING").alias("warnings"),
    )


def recon_summary(
    sent: DataFrame, processed: DataFrame, duplicates: DataFrame, tampered: DataFrame,
    violations: DataFrame,
) -> DataFrame:
    """Headline numbers and the verdict in one row.

    Every side total is a scalar subquery, so no join is needed.
    """
    status = F.col("status")
    joined = recon_status(sent, processed).agg(
        _rows().alias("total_sent"),
        F.count_if(status == "pass").alias("passed"),
        F.count_if(status == "fail").alias("failed"),
        F.count_if(status == "not_processed").alias("not_processed"),
    )
    severities = violation_severity_totals(violations)
    return joined.select(
        "*",
        duplicates.agg(_rows()).scalar().alias("duplicates"),
        tampered.agg(_rows()).scalar().alias("tampered"),
        severities.select("errors").scalar().alias("br_errors"),
        severities.select("warnings").scalar().alias("br_warnings"),
        (F.col("not_processed") == 0).alias("fully_reconciled"),
    )


def _to_second(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def message_detail(sent: DataFrame, processed: DataFrame) -> DataFrame:
    """Every sent message with its outcome; sort when showing, not here."""
    return recon_status(sent, processed).select(
        "message_id",
        "file_name",
        schema_label(F.col("domain"), F.col("message_set")).alias("schema_label"),
        "status",
        _to_second(F.col("processed_at")).alias("processed_second"),
        F.substring("error_detail", 1, 200).alias("error"),
    )


def duplicate_log(duplicates: DataFrame) -> DataFrame:
    return duplicates.select(
        "file_name",
        schema_label(F.col("domain"), F.col("message_set")).alias("schema_label"),
        F.substring("message_id", 1, 16).alias("short_id"),
        _to_second(F.col("detected_at")).alias("detected_second"),
    ).orderBy("detected_second", "short_id")


def tampered_log(tampered: DataFrame) -> DataFrame:
    return tampered.select(
        "file_name",
        schema_label(F.col("domain"), F.col("message_set")).alias("schema_label"),
        F.substring("message_id", 1, 16).alias("short_id"),
        _to_second(F.col("detected_at")).alias("detected_second"),
        "tampered_topic",
    ).orderBy("detected_second", "short_id")


def pass_band(sent: DataFrame, processed: DataFrame) -> DataFrame:
    """Traffic light per message set."""
    return schema_breakdown(sent, processed).select(
        "message_set", "pass_rate", band(F.col("pass_rate")).alias("band")
    )


def error_bars(processed: DataFrame) -> DataFrame:
    return share_of_max(error_patterns(processed), "occurrences", "bar_pct")


def report_cube(
    sent: DataFrame, processed: DataFrame, duplicates: DataFrame, tampered: DataFrame, violations: DataFrame
) -> DataFrame:
    """All counts of the report in one pass: every state table is read once.

    ``set_id`` names the grouping of a row, ``key`` and ``status`` are what it groups by: ``schema`` (message set of
    sent messages), ``error`` (class), ``category`` (category and outcome), ``all``, ``tampered`` (set label),
    ``severity`` and ``duplicate``.  ``sent`` counts sent messages, ``done`` those that were processed too, ``n`` the rows of the grouped
    table; times are of messages that were sent and processed.
    """
    status = F.col("p.validation_status")
    joined = sent.select("message_id", F.struct("message_set", "sent_at").alias("s")).join(
        processed.select("message_id", F.struct("message_set", "file_name", "validation_status", "error_detail", "processed_at").alias("p")),
        "message_id", "full",
    )
    here, done = F.col("s").isNotNull(), F.col("p").isNotNull()
    failed = (status == "fail") & F.col("p.error_detail").isNotNull()
    flat = joined.select(
        F.col("s.message_set").alias("sent_set"), F.when(failed, F.col("p.message_set")).alias("done_set"),
        F.when(failed, error_category(F.col("p.error_detail"))).alias("error"),
        F.when(done, file_category(F.col("p.file_name"), strict=True)).alias("category"), status.alias("status"),
        here.alias("here"), done.alias("done"), (here & done).alias("both"), F.col("s.sent_at"), F.col("p.processed_at"),
    )
    both = F.col("both")
    sets = [["sent_set"], ["error", "done_set"], ["category", "status"], []]
    names = ["sent_set", "error", "done_set", "category", "status"]
    counts = [
        F.count_if("here").alias("sent"), F.count_if(both).alias("done"), F.count_if("done").alias("n"),
        F.count_if(both & (F.col("status") == "pass")).alias("passed"), F.count_if(both & (F.col("status") == "fail")).alias("failed"),
        F.min(F.when(both, epoch_millis(F.col("sent_at")))).alias("first_sent"), F.max(F.when(both, epoch_millis(F.col("sent_at")))).alias("last_sent"),
        F.min(F.when(both, epoch_millis(F.col("processed_at")))).alias("first_done"), F.max(F.when(both, epoch_millis(F.col("processed_at")))).alias("last_done"),
    ]
    grouped = flat.groupingSets(sets, *names).agg(F.grouping_id().alias("g"), F.count("done_set").alias("in_set"), *counts)
    measures = ["sent", "done", "n", "passed", "failed", "first_sent", "last_sent", "first_done", "last_done"]
    # bit 4 is sent_set, 3 error, 2 done_set, 1 category, 0 status; a set bit is not grouped by
    named = grouped.select(
        F.when(F.col("g") == 0b01111, "schema").when(F.col("g") == 0b10011, "error").when(F.col("g") == 0b11100, "category").otherwise("all").alias("set_id"),
        F.coalesce("sent_set", "error", "category").alias("key"), "status", F.when(F.col("in_set") > 0, 1).otherwise(0).alias("one"), *measures,
    ).where(
        ((F.col("set_id") != "schema") | (F.col("sent") > 0)) & ((F.col("set_id") != "error") | F.col("key").isNotNull())
        & ((F.col("set_id") != "category") | (F.col("n") > 0))
    )
    total = [F.sum(m).alias(m) for m in measures[:5]] + [F.min("first_sent").alias("first_sent"), F.max("last_sent").alias("last_sent"),
                                                         F.min("first_done").alias("first_done"), F.max("last_done").alias("last_done")]
    # of the classes of errors the sets are counted; all other groups have one row
    main = named.groupBy("set_id", "key", "status").agg(*total, F.when(F.col("set_id") == "error", F.sum("one")).alias("sets"))

    def side(rows: DataFrame, set_id: str, key: Column) -> DataFrame:
        grouped = rows.groupBy(key.alias("key")).agg(_rows().alias("n"))
        return grouped.select(F.lit(set_id).alias("set_id"), "key", "n")

    others = [
        side(tampered, "tampered", schema_label(F.col("domain"), F.col("message_set"))),
        side(violations, "severity", F.col("severity")), side(duplicates, "duplicate", F.lit("all")),
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), others, main)


def datasets_of(cube: DataFrame) -> dict[str, DataFrame]:
    """The grouped datasets of the report from ``report_cube``, which has a few hundred rows and should be kept."""
    def of(set_id: str) -> DataFrame:
        return cube.where(F.col("set_id") == set_id)

    share = F.coalesce(percent(F.col("passed"), F.col("done")), F.lit(0.0))
    breakdown = of("schema").select(
        F.col("key").alias("message_set"), F.col("sent").alias("total_sent"), F.col("done").alias("processed"),
        F.col("passed").alias("pass_count"), F.col("failed").alias("fail_count"), (F.col("sent") - F.col("done")).alias("pending"),
        share.alias("pass_rate"),
    ).orderBy("message_set")
    patterns = of("error").select(
        F.col("key").alias("error_category"), F.col("n").alias("occurrences"), F.col("sets").alias("schemas_affected")
    ).orderBy(F.desc("occurrences"), "error_category")
    outcomes = of("category").select(
        F.col("key").alias("test_category"), F.col("status").alias("validation_status"), F.col("n").alias("count")
    ).orderBy("test_category", "validation_status")
    bad = of("tampered").select(F.col("key").alias("schema_label"), F.col("n").alias("tampered_count")).orderBy(
        F.desc("tampered_count"), "schema_label")

    def number(set_id: str, key: str) -> Column:
        return F.coalesce(F.sum(F.when((F.col("set_id") == set_id) & (F.col("key") == key), F.col("n"))), F.lit(0))

    whole = F.col("set_id") == "all"

    def first(name: str) -> Column:
        return F.coalesce(F.sum(F.when(whole, F.col(name))), F.lit(0))

    summary = cube.agg(
        first("sent").alias("total_sent"), first("passed").alias("passed"), first("failed").alias("failed"),
        (first("sent") - first("done")).alias("not_processed"), number("duplicate", "all").alias("duplicates"),
        F.coalesce(F.sum(F.when(F.col("set_id") == "tampered", F.col("n"))), F.lit(0)).alias("tampered"),
        number("severity", "ERROR").alias("br_errors"), number("severity", "WARNING").alias("br_warnings"),
    ).withColumn("fully_reconciled", F.col("not_processed") == 0)
    span = F.col("last_done") - F.col("first_done")
    timeline = of("all").select(
        _seconds(F.col("last_sent") - F.col("first_sent"), 3).alias("sender_sec"), _seconds(F.col("first_done") - F.col("last_sent"), 3).alias("wait_sec"),
        _seconds(span, 3).alias("receiver_sec"), F.col("done").alias("total_messages"),
        F.round(F.col("done") * F.lit(1000.0) / F.nullif(span.cast("double"), F.lit(0.0)), 0).alias("throughput_per_sec"),
    )
    return {
        "summary": summary, "schema_breakdown": breakdown, "error_patterns": share_of_max(patterns, "occurrences", "bar_pct"),
        "category_outcomes": share_within(outcomes, "test_category", "count"), "tampered_by_set": share_of_max(bad, "tampered_count", "bar_pct"),
        "pipeline_timeline": timeline,
    }


def run_all(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All datasets of the reconciliation report; the grouped ones come from one pass over the tables, which is run here."""
    sent, processed = tables["sent_messages"], tables["processed_messages"]
    duplicates, tampered = tables["duplicate_events"], tables["tampered_messages"]
    violations = tables["rule_violations"]
    ensure_checkpoint_dir(sent)
    cube = report_cube(sent, processed, duplicates, tampered, violations).checkpoint(eager=True)
    return datasets_of(cube) | {
        "latency_by_schema": latency_by_schema(sent, processed),
        "latency_scatter": latency_scatter(sent, processed),
        "rule_violations": rule_violation_summary(violations),
        "messages": message_detail(sent, processed).orderBy("schema_label", "file_name"),
        "duplicates": duplicate_log(duplicates),
        "tampered": tampered_log(tampered),
    }
