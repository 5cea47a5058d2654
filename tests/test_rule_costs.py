"""Rules of reversals, status reports and mandates: what they parse, how often they look, with the same hits."""

from __future__ import annotations

import datetime
import re

import pytest
from pyspark.sql import functions as F

from girolens import catalog, demo, model
from girolens.operators import rules
from girolens.sources import corpus
from tests import samples as s
from tests.test_narrow_layouts import DOCUMENTS, damaged

AS_OF = datetime.date(2026, 1, 1)


def _reason(code: str) -> str:
    return f"<Rsn><Cd>{code}</Cd></Rsn>"


_MANDATE = {
    "009": ("Mndt", "<MndtId>m</MndtId><MndtReqId> </MndtReqId><TrckgInd> yes </TrckgInd><CdtrAcct><Id><IBAN>DE00</IBAN></Id></CdtrAcct>"
                    "<DbtrAgt><FinInstnId><BICFI>x</BICFI></FinInstnId></DbtrAgt>"),
    "010": ("UndrlygAmdmntDtls", f"<AmdmntRsn>{_reason(' ZZ ')}</AmdmntRsn><Mndt><MndtId/></Mndt>"),
    "011": ("UndrlygCxlDtls", f"<CxlRsn>{_reason('CUST ')}</CxlRsn><OrgnlMndt><OrgnlMndtId> </OrgnlMndtId></OrgnlMndt>"),
    "012": ("UndrlygAccptncDtls", "<AccptncRslt><Accptd>false</Accptd></AccptncRslt><OrgnlMndt><OrgnlMndtId>m</OrgnlMndtId></OrgnlMndt>"),
    "017": ("UndrlygCpyReqDtls", "<OrgnlMndt><OrgnlMndtId>\t</OrgnlMndtId></OrgnlMndt>"),
    "018": ("UndrlygSspnsnDtls", f"<SspnsnRsn>{_reason('cust')}</SspnsnRsn><OrgnlMndt><OrgnlMndtId/></OrgnlMndt>"),
}
MESSAGES = {k: DOCUMENTS[k] for k in ("002", "007")} | {
    k: s.document(k, model.LAYOUTS[k][0], f"{s.header()}<{block}>{inner}</{block}><{block}/>") for k, (block, inner) in _MANDATE.items()
}


@pytest.mark.parametrize("message_set", sorted(rules.READS))
def test_rules_find_the_same_in_what_they_read(spark, message_set):
    xml = MESSAGES[message_set]
    amounts = [xml.replace(">1.5<", f">{v}<") for v in ("", " ", "0", " -1 ", "x", "<a/>", "<!-- -->0", "<![CDATA[0]]>")]
    texts = [xml, *amounts, xml.replace(">1.5</OrgnlInstdAmt>", "/>"), *(damaged(xml, n) for n in range(300))]
    frame = spark.createDataFrame([(f"{n:03d}", t) for n, t in enumerate(texts)], "file_name string, xml string")
    found = []
    for reads in (None, rules.READS[message_set]):
        parsed = corpus.well_formed(corpus.parse(frame, message_set, reads=reads))
        rows = rules.with_violations(parsed, message_set, F.lit(AS_OF)).select("file_name", "violations").collect()
        found.append({r.file_name: r.violations for r in rows})
    assert found[0] == found[1] and any(found[0].values())


def test_codes_of_payments_stand_before_those_of_their_transactions(spark):
    def block(own: str, *txs: str) -> str:
        return f"<OrgnlPmtInfAndRvsl>{own}{''.join(f'<TxInf>{t}</TxInf>' for t in txs)}</OrgnlPmtInfAndRvsl>"

    def info(code: str) -> str:
        return f"<RvslRsnInf>{_reason(code)}</RvslRsnInf>"

    xml = s.document("007", "CstmrPmtRvsl", "<OrgnlGrpInf>" + info("G1") + "</OrgnlGrpInf>"
                     + block(info("P1"), info("T1") + info("CUST"), "", info("T2")) + block("", info(" T3 ")) + block(info("P2")))
    done = rules.with_violations(corpus.parse(s.frame(spark, "007", xml), "007"), "007", F.lit(AS_OF))
    hits = [(v.rule_id, v.field_path if v.rule_id == "BR-030" else v.actual) for v in done.first().violations]
    numbers = [re.sub(r"\D", "", path) for rule, path in hits if rule == "BR-030"]
    assert [a for rule, a in hits if rule == "BR-031"] == ["G1", "P1", "T1", "T2", "T3", "P2"] and len(numbers) == 4
    assert [int(n[-1]) for n in numbers] == [1, 2, 3, 4]


@pytest.mark.parametrize("query, absent", [("rules_reversal", ["GrpHdr", "_Ccy"]), ("rules_status", ["GrpHdr"]), ("rules_mandates", ["GrpHdr"])])
def test_rule_queries_parse_what_they_read(spark, folder, query, absent):
    """The whole layout was built; the time of the parser is that of the values it builds."""
    plan = catalog.all_queries()[query](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    layouts = re.findall(r"xmltostructs\(.*?_corrupt", plan) or re.findall(r"StructField\(.*?_corrupt", plan)
    assert layouts and not [word for word in absent for layout in layouts if word in layout]


@pytest.mark.parametrize("build", [demo.status_messages, demo.reversal_messages])
def test_texts_of_lines_are_made_before_they_are_grouped(spark, folder, build):
    """Inside of the aggregate they were interpreted row by row."""
    plan = build(demo.order_items(spark, folder))._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"collect_list\(fragment#\d+", plan)


def test_rules_take_fields_of_all_items_without_a_lambda(spark):
    """A lambda for each field of each transaction was most of the time of the rules."""
    frame = corpus.parse(s.frame(spark, "007", MESSAGES["007"]), "007")
    plan = rules.with_violations(frame, "007", F.lit(AS_OF))._jdf.queryExecution().analyzed().toString()
    assert plan.count("lambdafunction") < 30


def test_line_without_a_number_has_no_reason(spark):
    items = spark.createDataFrame(
        [(1, "a.xml", "F", "1-URGENT", 1, n, "R") for n in (None, 7)],
        "o_orderkey long, file_name string, o_orderstatus string, o_orderpriority string, l_orderkey long, l_linenumber int, l_returnflag string")
    xml = demo.status_messages(items.repartition(2)).first().xml
    assert xml.count("<TxInfAndSts>") == 2 and re.findall("<Cd>(.*?)</Cd>", xml) == ["XX99"]
