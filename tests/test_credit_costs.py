"""Rules of credit transfers: what they parse and how they are evaluated, with the same hits."""

from __future__ import annotations

import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from girolens import catalog
from girolens.functions import ids
from girolens.operators import rules
from girolens.sources import corpus
from tests import samples as s
from tests.test_narrow_layouts import DOCUMENTS, damaged

AS_OF = datetime.date(2026, 1, 1)
BICS = ["DEUTDEFF", "DEUTDEFF500", "deutdeff", " DEUTDEFF", "DEUTDEF", "", " ", "DEUTDEFF\nDEUTDEFF", "DEUTDEFF\n", None]
UETRS = ["c5337cbd-f5b9-48f4-a19f-1107ceede330", "C5337CBD-F5B9-48F4-A19F-1107CEEDE330", " c5337cbd-f5b9-48f4-a19f-1107ceede330 ",
         "c5337cbd-f5b9-18f4-a19f-1107ceede330", "", " ", "x", None]


def _violations(spark, texts, reads=None):
    frame = spark.createDataFrame([(f"{n:04d}", t) for n, t in enumerate(texts)], "file_name string, xml string")
    parsed = corpus.well_formed(corpus.parse(frame, "001", reads=reads))
    rows = rules.with_violations(parsed, "001", F.lit(AS_OF)).select("file_name", "violations").collect()
    return {r.file_name: r.violations for r in rows}


def test_rules_find_the_same_in_what_they_read(spark):
    xml = DOCUMENTS["001"]
    texts = [xml, *(damaged(xml, n) for n in range(300))]
    found = [_violations(spark, texts, reads) for reads in (None, rules.CREDIT_READS)]
    assert found[0] == found[1] and any(found[0].values())


def test_query_parses_what_its_rules_read(spark, folder):
    """The whole layout was built; the time of the parser is that of the values it builds."""
    plan = catalog.all_queries()["rules_credit"](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    layouts = re.findall(r"xmltostructs\(.*?_corrupt", plan) or re.findall(r"StructField\(.*?_corrupt", plan)
    assert layouts and not [w for w in ("EqvtAmt", "Purp", "RmtInf", "InitgPty", "Cdtr,") for layout in layouts if w in layout]


def test_rules_do_not_stand_in_a_generator(spark, folder):
    """A generator with a lambda is interpreted as a whole, and so were all rules; now it reads a column of them."""
    plan = catalog.all_queries()["rules_credit"](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Generate explode\(array\(_found#\d+\)\)", plan)


@pytest.mark.parametrize("values, column, fails, pattern", [
    (BICS, "bic", lambda v: v.strip(" \t\r\n") != "" and not re.fullmatch("[A-Z]{6}[A-Z0-9]{2}([A-Z0-9]{3})?", v.strip(" \t\r\n").upper()), "BR-009"),
    (UETRS, "uetr", lambda v: v.strip(" \t\r\n") != "" and not re.fullmatch("(?i)[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}", v.strip(" \t\r\n")), "BR-006"),
])
def test_texts_that_are_matched_at_once_give_the_hits_of_each(spark, values, column, fails, pattern):
    """All pairs of odd values; a line break within a value must not pass for two values."""
    def transaction(value):
        inner = "" if value is None else value
        bic = "" if column != "bic" or value is None else f"<CdtrAgt><FinInstnId><BICFI>{inner}</BICFI></FinInstnId></CdtrAgt>"
        uetr = "" if column != "uetr" or value is None else f"<UETR>{inner}</UETR>"
        return f"<CdtTrfTxInf><PmtId>{uetr}</PmtId>{bic}</CdtTrfTxInf>"

    pairs = [(a, b) for a in values for b in values]
    texts = [f"<Document><CstmrCdtTrfInitn><PmtInf>{transaction(a)}{transaction(b)}</PmtInf></CstmrCdtTrfInitn></Document>" for a, b in pairs]
    found = _violations(spark, texts)
    got = [[v.actual for v in found[f"{n:04d}"] if v.rule_id == pattern] for n in range(len(pairs))]
    assert got == [[v.strip(" \t\r\n") for v in pair if v is not None and fails(v)] for pair in pairs]


def test_account_numbers_of_any_length_by_integers(spark):
    choose = random.Random(5)
    numbers = ["".join(choose.choice("0123456789" if n % 2 else "0123456789ABCXYZ") for _ in range(choose.randint(1, 30))) for n in range(300)]

    def complete(country: str, rest: str, wrong: int) -> str:
        digits = "".join(str(int(c, 36)) for c in rest + country + "00")
        return f"{country}{(98 - int(digits) % 97 + wrong) % 100:02d}{rest}"

    cases = [(complete(choose.choice(["DE", "GB", "ZZ", "AA"]), rest, n % 3), n) for n, rest in enumerate(numbers)]
    frame = spark.createDataFrame(cases, "iban string, n int")
    for row in frame.select("iban", ids.iban_is_valid(F.col("iban")).alias("v")).collect():
        whole = int("".join(str(int(c, 36)) for c in row.iban[4:] + row.iban[:4]))
        assert row.v == (whole % 97 == 1), row.iban


def test_totals_and_repeats_over_payments_without_transactions(spark):
    one = s.payment(s.credit_tx("E1"), s.credit_tx("E2")).replace("<PmtInf>", "<PmtInf><NbOfTxs>7</NbOfTxs><CtrlSum>1</CtrlSum>", 1)
    found = _violations(spark, [s.credit(one, "<PmtInf/>", "<PmtInf><NbOfTxs>0</NbOfTxs></PmtInf>", s.payment(s.credit_tx(" E1 ")))])["0000"]
    rules_found = [v.rule_id for v in found]
    assert "BR-003" in rules_found and "BR-004" in rules_found and [v.actual for v in found if v.rule_id == "BR-005"] == ["E1"]
