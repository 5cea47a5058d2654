"""Shredders, the corpus reader and the placeholder rule."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from girolens.operators import shred
from girolens.sources import corpus
from tests import samples as s


def parsed(spark, message_set, *documents, **kw):
    return corpus.well_formed(corpus.parse(s.frame(spark, message_set, *documents, **kw), message_set))


def rows(frame, *columns):
    return [tuple(r) for r in frame.orderBy("file_name").select(*columns).collect()]


def test_credit_transfer_columns(spark):
    xml = s.credit(s.payment(
        s.credit_tx(" E1 ", "12.34567", extra="<Purp><Prtry>OWN</Prtry></Purp><RmtInf><Ustrd>x</Ustrd></RmtInf>"),
        s.credit_tx("E2", uetr=None, money="<EqvtAmt><Amt Ccy='EUR'>7.5</Amt><CcyOfTrf>USD</CcyOfTrf></EqvtAmt>"),
    ), head=s.header(count="2x", total="1e2"))
    out = shred.shred_001(parsed(spark, "001", xml))
    assert len(out.columns) == 27
    first, second = out.orderBy("end_to_end_id").collect()
    assert (first.end_to_end_id, first.amount, first.currency) == ("E1", Decimal("12.34567"), "EUR")
    assert (first.nb_txs_declared, first.ctrl_sum) == (None, Decimal(100))
    assert (first.debtor_country, first.debtor_bic_country, first.creditor_bic_country) == ("GB", "DE", "DE")
    assert (first.purpose_code, first.has_remittance_info, first.has_uetr) == ("OWN", True, True)
    assert (second.amount, second.currency, second.has_uetr, second.purpose_code) == (Decimal("7.5"), "USD", False, None)
    assert first.initiating_party == "Café Ünïcode"


def test_placeholder_and_rejects(spark):
    docs = [
        s.credit(), s.credit(s.payment(), s.payment(s.credit_tx())), "<Document><broken>", s.credit(s.payment(s.credit_tx()), prefix="n"),
        s.credit(s.payment()),
    ]
    frame = corpus.parse(s.frame(spark, "001", *docs), "001")
    assert [r.file_name for r in corpus.rejects(frame).collect()] == ["gen-pass-002.xml"]
    out = shred.shred_001(corpus.well_formed(frame))
    assert rows(out, "file_name", "msg_id", "end_to_end_id", "has_uetr") == [
        ("gen-pass-000.xml", None, None, None), ("gen-pass-001.xml", "M1", "E1", True),
        ("gen-pass-003.xml", "M1", "E1", True), ("gen-pass-004.xml", None, None, None),
    ]
    short = shred.shred_payment(corpus.well_formed(frame))
    assert rows(short, "has_uetr")[0] == (False,)


def test_row_count_is_transactions_or_one(spark):
    sizes = [0, 1, 2, 5]
    docs = [s.credit(s.payment(*[s.credit_tx(f"E{i}") for i in range(n)])) for n in sizes]
    counts = shred.shred_001(parsed(spark, "001", *docs)).groupBy("file_name").count()
    assert [r["count"] for r in counts.orderBy("file_name").collect()] == [max(1, n) for n in sizes]


def test_activation_blocks(spark):
    xml = s.document("013", "CdtrPmtActvtnReq", s.header() + s.payment(s.credit_tx(name="CdtTrfTx")))
    frame = parsed(spark, "013", xml)
    assert rows(shred.shred(frame, "013"), "amount", "currency") == [(Decimal(100), "EUR")]
    assert rows(shred.shred(frame, "013", compat=True), "amount", "currency") == [(None, None)]


def test_status_levels(spark):
    frame = parsed(spark, "002", s.status(), s.document("002", "CstmrPmtStsRpt", ""))
    got = shred.shred_status(frame).orderBy("file_name", F.col("grp_status").isNull()).collect()
    assert [(r.grp_status, r.tx_status, r.reason_code) for r in got] == [
        ("ACCP", None, None), (None, "ACSP", "AC01"), (None, None, None)]


def test_other_sets(spark):
    assert rows(shred.shred(parsed(spark, "007", s.reversal()), "007"), "orig_amount", "currency", "reversal_reason") == [
        (Decimal(10), "EUR", "DUPL")]
    assert rows(shred.shred(parsed(spark, "008", s.debit(s.debit_tx())), "008"), "amount", "currency", "debtor_pfx", "creditor_pfx") == [
        (Decimal(100), "EUR", "GB", "GB")]
    assert rows(shred.shred(parsed(spark, "009", s.mandate()), "009"), "tracking_ind", "creditor_pfx", "debtor_pfx") == [
        ("true", "GB", None)]
    assert rows(shred.shred(parsed(spark, "010", s.amendment()), "010"), "amendment_reason") == [("MD01",)]
    assert rows(shred.shred(parsed(spark, "011", s.cancellation()), "011"), "cancellation_reason") == [("CUST",)]
    assert rows(shred.shred(parsed(spark, "018", s.suspension()), "018"), "suspension_reason") == [("SSPD",)]
    assert rows(shred.shred(parsed(spark, "017", s.copy_request()), "017"), "orig_mandate_id") == [("MD1",)]
    flat, deep = "<RjctRsn><Cd>AC01</Cd></RjctRsn>", "<RjctRsn><Rsn><Cd>AC04</Cd></Rsn></RjctRsn>"
    frame = parsed(spark, "012", s.acceptance("false", flat), s.acceptance("false", deep))
    assert rows(shred.shred(frame, "012"), "rejection_reason") == [("AC01",), (None,)]
    assert rows(shred.shred(frame, "012", compat=True), "rejection_reason") == [(None,), ("AC04",)]


def test_corpus_reader(spark, tmp_path):
    good = s.credit(s.payment(s.credit_tx())).encode()
    latin = good.replace("Café".encode(), b"Caf\xe9")
    for path, content in {
        "pain/001/gen-pass-001.xml": good, "pain/001/gen-fail-002.xml": latin, "pain/002/other.xml": s.status().encode(),
        "pain/stray.xml": good, "pain/001/deep/x.xml": good, "pain/001/readme.txt": b"no",
        "pain/001/huge.xml": b"<Document>" + b" " * (10 * 1024 * 1024) + b"</Document>",
    }.items():
        target = tmp_path / "data" / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(content)
    corpus_rows = corpus.read_corpus(spark, str(tmp_path / "data"))
    got = {r.file_name: r for r in corpus_rows.collect()}
    assert sorted(got) == ["gen-fail-002.xml", "gen-pass-001.xml", "huge.xml", "other.xml"]
    assert not got["huge.xml"].oversize and len(got["huge.xml"].xml) > 10 * 1024 * 1024
    bounded = {r.file_name: r for r in corpus.read_corpus(spark, str(tmp_path / "data"), max_bytes=1 << 20).collect()}
    assert bounded["huge.xml"].oversize and bounded["huge.xml"].xml is None and sorted(bounded) == sorted(got)
    assert {r.file_name for r in corpus.read_corpus(spark, str(tmp_path / "da*"), "002").collect()} == {"other.xml"}
    assert corpus.read_corpus(spark, str(tmp_path / "data"), "099").count() == 0
    plan = corpus.read_corpus(spark, str(tmp_path / "data"), "002", max_bytes=5)._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(length,5)" in plan and "/002]" in plan.replace("/*", "/").replace("pain/002", "/002"), plan
    import hashlib

    assert got["gen-pass-001.xml"].message_id == hashlib.sha256(b"pain.001:" + good).hexdigest()
    assert got["gen-fail-002.xml"].message_id == hashlib.sha256(b"pain.001:" + latin).hexdigest()
    assert got["gen-fail-002.xml"].category == "gen-fail" and got["other.xml"].category == "hand-crafted"
    only = corpus.read_corpus(spark, f"file:{tmp_path}/data/", "002").collect()
    assert [r.file_name for r in only] == ["other.xml"]
    assert corpus.well_formed(corpus.parse(corpus_rows.where("message_set = '001'"), "001")).count() == 3  # the huge one is empty but well-formed


def test_amounts_are_never_rounded(spark):
    from girolens.functions.amounts import amount

    cases = {"0.000004": None, "1.000010": "1.00001", "1.00000": "1.00000", "7": "7.00000", "1.1234500": "1.12345", "1.123456": None, "x": None, "": None,
             "123456789012345678": "123456789012345678.00000", "-0.00001": "-0.00001"}
    got = {r.raw: r.a for r in spark.createDataFrame([(c,) for c in cases], "raw string").select("raw", amount(F.col("raw")).cast("string").alias("a")).collect()}
    assert got == cases
