"""Whole reports from messages of all twelve sets, and saved tables."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from girolens import model
from girolens.operators import shred, validate
from girolens.plans import dashboard, recon, runs
from girolens.session import configured
from girolens.sources import corpus, state
from tests import samples as s

SAMPLES = {
    "001": s.credit(s.payment(s.credit_tx(extra="<Purp><Cd>SALA</Cd></Purp>"))), "002": s.status(), "007": s.reversal(),
    "008": s.debit(s.debit_tx()), "009": s.mandate(), "010": s.amendment(), "011": s.cancellation(),
    "012": s.acceptance("false", "<RjctRsn><Cd>AC01</Cd></RjctRsn>"),
    "013": s.document("013", "CdtrPmtActvtnReq", s.header() + s.payment(s.credit_tx(name="CdtTrfTx"))),
    "014": s.status("014"), "017": s.copy_request(), "018": s.suspension(),
}
PROCESSED = [
    ("m1", "pain", "gen-pass-000.xml", "pass", None),
    ("m2", "pain", "gen-fail-001.xml", "fail", "Element '{urn}Nm': [facet 'maxLength'] too long"),
]


def processed(spark, message_set):
    rows = spark.createDataFrame(PROCESSED, "message_id string, domain string, file_name string, validation_status string, error_detail string")
    return rows.withColumn("message_set", F.lit(message_set))


@pytest.mark.parametrize("message_set", sorted(SAMPLES))
def test_section(spark, message_set, tmp_path):
    frame = corpus.well_formed(corpus.parse(s.frame(spark, message_set, SAMPLES[message_set]), message_set))
    base, detail = shred.file_base(frame, message_set), shred.shred(frame, message_set)
    sections = dashboard.section(message_set, base, detail, processed(spark, message_set))
    counts = {name: data.count() for name, data in sections.items()}
    assert all(counts.values()), counts
    categories = {r.category: r.files for r in sections["categories"].collect()}
    assert categories == {"gen-pass": 1, "gen-fail": 0, "gen-edge": 0, "hand-crafted": 0}
    assert sections["error_element"].first().element == "Nm"
    assert dashboard.labelled(sections["status"]).first().set_label == model.SET_LABELS[message_set]
    dashboard.write({"status": sections["status"]}, str(tmp_path), "json")
    assert spark.read.json(f"{tmp_path}/status").first().passed == 1


def test_corpus_validation(spark):
    rows = [(k, k, k, bytearray(v.encode())) for k, v in SAMPLES.items()] + [("x", "x", "999", bytearray(b"<D/>"))]
    frame = spark.createDataFrame(rows, "message_id string, file_name string, message_set string, content binary")
    out = validate.validate_corpus(frame, as_of=F.lit("2026-01-01").cast("date"))
    got = {r.message_set: (r.validation_status, r.error_detail) for r in out.select("message_set", "validation_status", "error_detail").collect()}
    assert got.pop("999") == ("fail", "Schema unavailable")
    assert got == {k: ("pass", None) for k in SAMPLES}
    assert runs.validation_summary(out).first().passed == 12


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    ids = spark.range(200).select(F.sha2(F.col("id").cast("string"), 256).alias("message_id"), F.lit("001").alias("message_set"))
    state.save_bucketed(ids, "bucketed_sent", 4)
    state.save_bucketed(ids.withColumn("validation_status", F.lit("pass")), "bucketed_done", 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bucketed_sent").join(spark.table("bucketed_done").drop("message_set"), "message_id", "left")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP TABLE bucketed_sent")
        spark.sql("DROP TABLE bucketed_done")


def test_reconciliation_verdicts(spark):
    """Pending messages decide the verdict; duplicates and tampering do not."""
    sent = spark.createDataFrame([("a", "001"), ("b", "001")], "message_id string, message_set string")
    done = spark.createDataFrame([("a", "pass")], "message_id string, validation_status string").withColumn(
        "processed_at", F.lit("2026-01-01").cast("timestamp")).withColumn("error_detail", F.lit(None).cast("string"))
    none, one = spark.range(0), spark.range(1)
    hits = spark.createDataFrame([("ERROR",), ("WARNING",), ("WARNING",)], "severity string")
    row = recon.recon_summary(sent, done, one, one, hits).first()
    assert tuple(row) == (2, 1, 0, 1, 1, 1, 1, 2, False)
    assert recon.recon_summary(sent.where("message_id = 'a'"), done, one, one, hits).first().fully_reconciled
    assert recon.recon_summary(sent, done, none, none, hits).first().duplicates == 0


def test_session_settings():
    class Recorder(dict):
        def config(self, key, value):
            self[key] = value
            return self

    assert configured(Recorder(), 100)["spark.sql.shuffle.partitions"] == "300"
    assert Path(state.path_of("/x/", "t")).name == "t"
