"""Parsing with the elements that a query reads: the same rows and the same rejects as with the whole layout."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from girolens import catalog, model
from girolens.operators import shred
from girolens.sources import corpus
from tests import samples as s

CASES = {
    "file_base": ("001", lambda parsed: shred.file_base(parsed, "001")),
    "shred_001": ("001", shred.shred_001), "shred_payment": ("001", shred.shred_payment),
    "shred_status": ("002", shred.shred_status), "shred_reversal": ("007", shred.shred_reversal),
    "shred_direct_debit": ("008", shred.shred_direct_debit),
}
_AGENT = "<FinInstnId><BICFI>DEUTDEFF</BICFI></FinInstnId>"
_REASON = "<Rsn><Cd>AM05</Cd></Rsn>"
DOCUMENTS = {
    "001": s.credit(s.payment(
        s.credit_tx("E1", mid_bic="DEUTDEFF", extra="<Purp><Cd>SALA</Cd></Purp><RmtInf><Ustrd>x</Ustrd></RmtInf>"),
        s.credit_tx("E2", uetr=None, money="<EqvtAmt><Amt Ccy='EUR'>7.5</Amt><CcyOfTrf>USD</CcyOfTrf></EqvtAmt>"),
    ), s.payment(s.credit_tx("E3", ccy=None))),
    "002": s.document("002", "CstmrPmtStsRpt", f"{s.header()}<OrgnlGrpInfAndSts><OrgnlMsgId>M</OrgnlMsgId><GrpSts>RJCT</GrpSts><StsRsnInf>{_REASON}</StsRsnInf>"
                      f"</OrgnlGrpInfAndSts><OrgnlPmtInfAndSts><TxInfAndSts><TxSts>ACSP</TxSts><StsRsnInf>{_REASON}</StsRsnInf></TxInfAndSts><TxInfAndSts/></OrgnlPmtInfAndSts>"),
    "007": s.document("007", "CstmrPmtRvsl", f"{s.header()}<OrgnlGrpInf><RvslRsnInf>{_REASON}</RvslRsnInf></OrgnlGrpInf><OrgnlPmtInfAndRvsl><TxInf><OrgnlEndToEndId>E</OrgnlEndToEndId>"
                      f"<OrgnlInstdAmt Ccy='EUR'>1.5</OrgnlInstdAmt><RvslRsnInf><Rsn/></RvslRsnInf><RvslRsnInf>{_REASON}</RvslRsnInf></TxInf><TxInf>x</TxInf></OrgnlPmtInfAndRvsl>"),
    "008": s.document("008", "CstmrDrctDbtInitn", f"{s.header()}<PmtInf><ReqdColltnDt>2020-01-01</ReqdColltnDt><CdtrAcct><Id><IBAN>{s.GOOD_IBAN}</IBAN></Id></CdtrAcct><CdtrAgt>{_AGENT}</CdtrAgt>"
                      f"<DrctDbtTxInf><InstdAmt Ccy='EUR'>3</InstdAmt><DrctDbtTx><MndtRltdInf><MndtId>m</MndtId></MndtRltdInf></DrctDbtTx><DbtrAgt>{_AGENT}</DbtrAgt>"
                      f"<DbtrAcct><Id><IBAN>{s.BAD_IBAN}</IBAN></Id></DbtrAcct></DrctDbtTxInf><DrctDbtTxInf/></PmtInf>"),
}
PIECES = [
    "<", "</", ">", "&", "&amp;", "&bad;", "]]>", "<!--", "<!-- a -->", "<![CDATA[x]]>", "<?pi x?>", "<x/>", "<x>", "</x>", '"', "\x01", "</PmtInf>", "<PmtInf/>",
    "<PmtInf>t</PmtInf>", "<GrpHdr/>", "<TxInf/>", "<a b='1' b='2'/>", "<a b=1/>", "<p:q/>", "<!DOCTYPE a>", "<?xml version='1.0'?>", "é",
]


def damaged(xml: str, seed: int) -> str:
    """The message with one piece put in somewhere, a tag left out or a few characters lost."""
    choose = random.Random(seed)
    tags = [m.span() for m in re.finditer("<[^>]*>", xml)]
    kind, place = seed % 4, choose.randrange(len(xml))
    if kind == 0:
        return xml[:place] + xml[place + choose.randint(1, 6):]
    if kind == 1:
        return xml[:place] + choose.choice(PIECES) + xml[place:]
    start, end = choose.choice(tags)
    return xml[:start] + (choose.choice(PIECES) + xml[start:] if kind == 2 else xml[end:])


@pytest.mark.parametrize("name", CASES)
def test_narrow_layout_gives_the_rows_and_rejects_of_the_whole_one(spark, name):
    message_set, build = CASES[name]
    texts = [DOCUMENTS[message_set], "", None, "<Document/>"] + [damaged(DOCUMENTS[message_set], seed) for seed in range(400)]
    frame = spark.createDataFrame(
        [(f"gen-pass-{n:03d}.xml", "gen-pass", text) for n, text in enumerate(texts)], "file_name string, category string, xml string")
    whole, narrow = corpus.parse(frame, message_set), corpus.parse(frame, message_set, reads=shred.READS[name])
    told = whole.select("file_name", F.col("parsed").alias("p")).join(narrow.select("file_name", "parsed"), "file_name").collect()
    assert all(r.p == r.parsed for r in told) and {r.parsed for r in told} == {True, False}
    rows = [sorted(build(corpus.well_formed(parsed)).collect(), key=str) for parsed in (whole, narrow)]
    assert rows[0] == rows[1] and len(rows[0]) > 1


@pytest.mark.parametrize("query, absent", [
    ("file_base", ["PmtInf"]), ("shred_001", ["IntrmyAgt1"]), ("shred_payment", ["GrpHdr", "Cdtr "]), ("shred_status", ["OrgnlMsgId"]),
    ("shred_reversal", ["GrpHdr", "OrgnlEndToEndId"]), ("shred_direct_debit", ["GrpHdr", "MndtRltdInf", "DbtrAgt"]),
])
def test_queries_parse_what_they_read(spark, folder, query, absent):
    """The whole layout was built for every query; the time of the parser is that of the values it builds."""
    plan = catalog.all_queries()[query](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    layouts = re.findall(r"xmltostructs\(.*?_corrupt", plan) or re.findall(r"StructField\(.*?_corrupt", plan)
    assert layouts and not [word for word in absent for layout in layouts if word in layout]


def test_paths_outside_of_the_layout_are_refused():
    with pytest.raises(ValueError):
        model.document_ddl("001", ("GrpHdr.Nope",))
    assert model.document_ddl("002", ("GrpHdr", "OrgnlGrpInfAndSts", "OrgnlPmtInfAndSts")) == model.document_ddl("002")
