"""Every rule with a firing and a non-firing message."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from girolens import model
from girolens.operators import rules
from girolens.sources import corpus
from tests import samples as s

AS_OF = datetime.date(2026, 1, 1)


def check(spark, message_set, *documents, compat=False):
    """Per document: list of (rule, path, message, actual, expected) in order."""
    parsed = corpus.parse(s.frame(spark, message_set, *documents), message_set)
    done = rules.with_violations(parsed, message_set, F.lit(AS_OF), compat)
    rows = {r.file_name: r.violations for r in done.select("file_name", "violations").collect()}
    return [
        [(v.rule_id, v.field_path, v.message, v.actual, v.expected) for v in rows[name]] for name in sorted(rows)
    ]


def fired(spark, message_set, *documents, compat=False):
    return [[v[0] for v in hits] for hits in check(spark, message_set, *documents, compat=compat)]


CREDIT_CASES = {
    "clean": (s.credit(s.payment(s.credit_tx())), []),
    "count": (s.credit(s.payment(s.credit_tx()), head=s.header(count="3")), ["BR-001"]),
    "count text": (s.credit(s.payment(s.credit_tx()), head=s.header(count="x")), ["BR-001"]),
    "count absent": (s.credit(s.payment(s.credit_tx()), head=s.header(count=None)), []),
    "sum": (s.credit(s.payment(s.credit_tx()), head=s.header(total="100.02")), ["BR-002"]),
    "sum in tolerance": (s.credit(s.payment(s.credit_tx()), head=s.header(total="100.01")), []),
    "sum text": (s.credit(s.payment(s.credit_tx()), head=s.header(total="abc")), ["BR-002"]),
    "sum without amounts": (s.credit(s.payment(s.credit_tx(money="<EqvtAmt/>")), head=s.header(total="5")), []),
    "payment sum": (s.credit(s.payment(s.credit_tx(), total="99")), ["BR-003"]),
    "payment count": (s.credit(s.payment(s.credit_tx(), count="2")), ["BR-004"]),
    "both in order": (
        s.credit(s.payment(s.credit_tx(), count="2", total="99"), s.payment(s.credit_tx("E2"), count="5"),
                 head=s.header(count="2", total="200")),
        ["BR-004", "BR-003", "BR-004"],
    ),
    "payment count text": (s.credit(s.payment(s.credit_tx(), count="two")), []),
    "repeats": (
        s.credit(s.payment(s.credit_tx("A"), s.credit_tx("B"), s.credit_tx("A")), s.payment(s.credit_tx("A")),
                 head=s.header(count="4", total="400")),
        ["BR-005", "BR-005"],
    ),
    "empty reference repeats": (
        s.credit(s.payment(s.credit_tx(""), s.credit_tx("")), head=s.header(count="2", total="200")), ["BR-005"]),
    "absent reference": (
        s.credit(s.payment(s.credit_tx(None), s.credit_tx(None)), head=s.header(count="2", total="200")), []),
    "uetr": (s.credit(s.payment(s.credit_tx(uetr=s.GOOD_UETR.replace("-4", "-1", 1)))), ["BR-006"]),
    "uetr upper": (s.credit(s.payment(s.credit_tx(uetr=s.GOOD_UETR.upper()))), []),
    "zero": (s.credit(s.payment(s.credit_tx(amount="0.00")), head=s.header(total="0")), ["BR-007"]),
    "empty amount": (s.credit(s.payment(s.credit_tx(amount=""))), ["BR-007"]),
    "debtor iban": (s.credit(s.payment(s.credit_tx(), iban=s.BAD_IBAN)), ["BR-008"]),
    "creditor iban": (s.credit(s.payment(s.credit_tx(iban=s.BAD_IBAN))), ["BR-008"]),
    "iban with blanks": (s.credit(s.payment(s.credit_tx(iban="gb82 WEST 1234 5698 7654 32"))), []),
    "bics": (
        s.credit(s.payment(s.credit_tx(bic="X", mid_bic="1EUTDEFF"), bic="DEUTDEF")), ["BR-009"] * 3),
    "intermediary": (s.credit(s.payment(s.credit_tx(mid_bic="deutdeff"))), []),
    "currency": (s.credit(s.payment(s.credit_tx(ccy="ZZZ"))), ["BR-010"]),
    "currency elsewhere": (
        s.credit(s.payment(s.credit_tx(extra="<Tax><TtlTaxAmt Ccy='QQQ'>1</TtlTaxAmt></Tax>"))), ["BR-010"]),
    "currency in comment": (s.credit(s.payment(s.credit_tx(extra='<!-- <A Ccy="QQQ"/> -->'))), []),
    "date": (s.credit(s.payment(s.credit_tx(), date="2025-12-31")), ["BR-011"]),
    "date today": (s.credit(s.payment(s.credit_tx(), date="2026-01-01")), []),
    "date text": (s.credit(s.payment(s.credit_tx(), date="20250101")), []),
    "message id": (s.credit(s.payment(s.credit_tx()), head=s.header(msg_id=" ")), ["BR-012"]),
    "no message id": (s.credit(s.payment(s.credit_tx()), head=s.header(msg_id=None)), ["BR-012"]),
    "no transactions": (s.credit(), ["BR-001"]),
    "prefixed": (s.credit(s.payment(s.credit_tx(ccy="ZZZ")), prefix="p"), ["BR-010"]),
}


def test_credit_rules(spark):
    got = fired(spark, "001", *[xml for xml, _ in CREDIT_CASES.values()])
    for name, hits in zip(CREDIT_CASES, got):
        assert hits == CREDIT_CASES[name][1], name


def test_texts(spark):
    xml = s.credit(
        s.payment(s.credit_tx("A", "60.50"), s.credit_tx("A", "40"), total="1"), head=s.header(count="3", total="90.00")
    )
    (hits,) = check(spark, "001", xml)
    assert hits == [
        ("BR-001", "GrpHdr/NbOfTxs", "Declared NbOfTxs (3) does not match actual transaction count (2)", "2", "3"),
        ("BR-002", "GrpHdr/CtrlSum", "CtrlSum (90.0) does not match sum of InstdAmt (100.5)", "100.5", "90.0"),
        ("BR-003", "PmtInf[1]/CtrlSum", "PmtInf CtrlSum (1) != sum of InstdAmt (100.5)", "100.5", "1"),
        ("BR-005", "CdtTrfTxInf/PmtId/EndToEndId", "Duplicate EndToEndId within the message", "A", None),
    ]


def test_activation_paths(spark):
    """Activation requests name their block differently; the compatible mode does not see it."""
    xml = s.document("013", "CdtrPmtActvtnReq", s.header() + s.payment(s.credit_tx(name="CdtTrfTx", ccy="ZZZ")))
    assert fired(spark, "013", xml) == [["BR-010"]]
    assert fired(spark, "013", xml, compat=True) == [["BR-001", "BR-010"]]


def test_status_rules(spark):
    good, bad = s.status(), s.status(group="NOPE", orig="<OrgnlMsgId> </OrgnlMsgId>", tx="NOPE", reason="XX01", group_reason="XX02", payment_reason="XX03")
    assert fired(spark, "002", good, bad) == [[], ["BR-020", "BR-021", "BR-022", "BR-022", "BR-022", "BR-023"]]
    hits = check(spark, "014", s.status("014", group="NOPE", reason="XX01", group_reason="XX02"))[0]
    assert [h[3] for h in hits] == ["NOPE", "XX02", "XX01"]
    assert hits[0][4] == "one of ['ACCP', 'ACSP', 'ACTC', 'ACWC', 'PART', 'PDNG', 'RCVD', 'RJCT']"


def test_reversal_rules(spark):
    bad = s.reversal(e2e="", amount="0", ccy="QQQ", reason="XX01", payment_reason="XX02")
    assert fired(spark, "007", s.reversal(), bad) == [[], ["BR-030", "BR-031", "BR-031", "BR-032", "BR-010"]]
    assert check(spark, "007", bad)[0][0][1] == "OrgnlPmtInfAndRvsl/TxInf[1]/OrgnlEndToEndId"


def test_direct_debit_rules(spark):
    bad = s.debit(
        s.debit_tx(mandate=None, iban=s.BAD_IBAN, bic="X", ccy="QQQ"), head=s.header(count="2", total="5"),
        date="2020-01-01", iban=s.BAD_IBAN, bic="Y",
    )
    assert fired(spark, "008", s.debit(s.debit_tx()), bad) == [
        [], ["BR-040", "BR-041", "BR-042", "BR-043", "BR-043", "BR-044", "BR-044", "BR-010", "BR-046"],
    ]
    # the compatible mode looks for the mandate where the schema does not have it
    assert fired(spark, "008", s.debit(s.debit_tx()), s.debit(s.debit_tx(None, "MD1")), compat=True) == [["BR-042"], []]


def test_mandate_rules(spark):
    assert fired(spark, "009", s.mandate(), s.mandate(" ", "maybe", s.BAD_IBAN, "X")) == [
        [], ["BR-050", "BR-051", "BR-052", "BR-053"]]
    assert fired(spark, "010", s.amendment(), s.amendment("XX01", " ")) == [[], ["BR-060", "BR-061"]]
    assert fired(spark, "011", s.cancellation(), s.cancellation("XX01", "")) == [[], ["BR-070", "BR-071"]]
    assert fired(spark, "017", s.copy_request(), s.copy_request(" ")) == [[], ["BR-090"]]
    assert fired(spark, "018", s.suspension(), s.suspension("XX01", " ")) == [[], ["BR-100", "BR-101"]]


def test_acceptance_rules(spark):
    right, deep = "<RjctRsn><Cd>AC01</Cd></RjctRsn>", "<RjctRsn><Rsn><Cd>AC01</Cd></Rsn></RjctRsn>"
    cases = [s.acceptance(), s.acceptance("no"), s.acceptance("false"), s.acceptance("0", right), s.acceptance("FALSE", deep)]
    assert fired(spark, "012", *cases) == [[], ["BR-080"], ["BR-081"], [], []]
    assert fired(spark, "012", *cases, compat=True) == [[], ["BR-080"], ["BR-081"], ["BR-081"], []]


def test_every_rule_is_in_the_catalogue():
    assert len(model.RULES) == 38
    assert len(model.CURRENCIES) == 150


@pytest.mark.parametrize("message_set", ["999"])
def test_unknown_set_has_no_rules(spark, message_set):
    parsed = corpus.parse(s.frame(spark, "001", s.credit()), "001")
    done = rules.with_violations(parsed, message_set)
    assert done.select(F.size("violations")).first()[0] == 0
