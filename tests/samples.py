"""Hand-written messages, one builder per message set."""

from __future__ import annotations

URN = "urn:iso:std:iso:20022:tech:xsd:pain."

GOOD_IBAN = "GB82WEST12345698765432"
BAD_IBAN = "GB82WEST12345698765431"
GOOD_BIC = "DEUTDEFF500"
GOOD_UETR = "6f1d2c3b-aa5e-4c7d-8e9f-0a1b2c3d4e5f"


def document(message_set: str, root: str, body: str, prefix: str = "") -> str:
    if not prefix:
        return f'<Document xmlns="{URN}{message_set}.001"><{root}>{body}</{root}></Document>'
    import re

    inner = re.sub(r"<(/?)(\w)", rf"<\1{prefix}:\2", f"<{root}>{body}</{root}>")
    return f'<{prefix}:Document xmlns:{prefix}="{URN}{message_set}.001">{inner}</{prefix}:Document>'


def header(msg_id: str | None = "M1", count: str | None = "1", total: str | None = "100.00") -> str:
    parts = []
    if msg_id is not None:
        parts.append(f"<MsgId>{msg_id}</MsgId>")
    if count is not None:
        parts.append(f"<NbOfTxs>{count}</NbOfTxs>")
    if total is not None:
        parts.append(f"<CtrlSum>{total}</CtrlSum>")
    return "<GrpHdr>" + "".join(parts) + "<InitgPty><Nm>Café Ünïcode</Nm></InitgPty></GrpHdr>"


def credit_tx(
    e2e: str | None = "E1", amount: str = "100.00", ccy: str | None = "EUR", uetr: str | None = GOOD_UETR,
    iban: str = GOOD_IBAN, bic: str = GOOD_BIC, mid_bic: str | None = None, name: str = "CdtTrfTxInf",
    money: str | None = None, extra: str = "",
) -> str:
    attribute = f' Ccy="{ccy}"' if ccy is not None else ""
    money = money or f"<InstdAmt{attribute}>{amount}</InstdAmt>"
    ids = (f"<EndToEndId>{e2e}</EndToEndId>" if e2e is not None else "") + (f"<UETR>{uetr}</UETR>" if uetr else "")
    middle = f"<IntrmyAgt1><FinInstnId><BICFI>{mid_bic}</BICFI></FinInstnId></IntrmyAgt1>" if mid_bic else ""
    return (
        f"<{name}><PmtId>{ids}</PmtId><Amt>{money}</Amt><ChrgBr>SHAR</ChrgBr>{middle}"
        f"<CdtrAgt><FinInstnId><BICFI>{bic}</BICFI></FinInstnId></CdtrAgt><Cdtr><Nm>Bob</Nm></Cdtr>"
        f"<CdtrAcct><Id><IBAN>{iban}</IBAN></Id></CdtrAcct>{extra}</{name}>"
    )


def payment(*txs: str, count: str | None = None, total: str | None = None, date: str = "2030-01-31",
            iban: str = GOOD_IBAN, bic: str = GOOD_BIC) -> str:
    stated = (f"<NbOfTxs>{count}</NbOfTxs>" if count else "") + (f"<CtrlSum>{total}</CtrlSum>" if total else "")
    return (
        f"<PmtInf><PmtInfId>P1</PmtInfId><PmtMtd>TRF</PmtMtd>{stated}<ReqdExctnDt><Dt>{date}</Dt></ReqdExctnDt>"
        f"<Dbtr><Nm>Ann</Nm></Dbtr><DbtrAcct><Id><IBAN>{iban}</IBAN></Id></DbtrAcct>"
        f"<DbtrAgt><FinInstnId><BICFI>{bic}</BICFI></FinInstnId></DbtrAgt>{''.join(txs)}</PmtInf>"
    )


def credit(*payments: str, head: str | None = None, prefix: str = "") -> str:
    return document("001", "CstmrCdtTrfInitn", (header() if head is None else head) + "".join(payments), prefix)


def debit_tx(mandate: str | None = "MD1", old_mandate: str | None = None, amount: str = "100.00", ccy: str = "EUR",
             iban: str = GOOD_IBAN, bic: str = GOOD_BIC) -> str:
    new = f"<DrctDbtTx><MndtRltdInf><MndtId>{mandate}</MndtId></MndtRltdInf></DrctDbtTx>" if mandate else ""
    old = f"<MndtRltdInf><MndtId>{old_mandate}</MndtId></MndtRltdInf>" if old_mandate else ""
    return (
        f'<DrctDbtTxInf><InstdAmt Ccy="{ccy}">{amount}</InstdAmt>{new}{old}'
        f"<DbtrAgt><FinInstnId><BICFI>{bic}</BICFI></FinInstnId></DbtrAgt>"
        f"<DbtrAcct><Id><IBAN>{iban}</IBAN></Id></DbtrAcct></DrctDbtTxInf>"
    )


def debit(*txs: str, head: str | None = None, date: str = "2030-01-31", iban: str = GOOD_IBAN, bic: str = GOOD_BIC) -> str:
    body = (
        f"<PmtInf><ReqdColltnDt>{date}</ReqdColltnDt><CdtrAcct><Id><IBAN>{iban}</IBAN></Id></CdtrAcct>"
        f"<CdtrAgt><FinInstnId><BICFI>{bic}</BICFI></FinInstnId></CdtrAgt>{''.join(txs)}</PmtInf>"
    )
    return document("008", "CstmrDrctDbtInitn", (header() if head is None else head) + body)


def status(message_set: str = "002", group: str = "ACCP", orig: str = "<OrgnlMsgId>O1</OrgnlMsgId>", tx: str = "ACSP",
           reason: str = "AC01", group_reason: str = "AC04", payment_reason: str = "AM05") -> str:
    def rsn(code: str) -> str:
        return f"<StsRsnInf><Rsn><Cd>{code}</Cd></Rsn></StsRsnInf>"

    root = "CstmrPmtStsRpt" if message_set == "002" else "CdtrPmtActvtnReqStsRpt"
    body = (
        f"<OrgnlGrpInfAndSts>{orig}<GrpSts>{group}</GrpSts>{rsn(group_reason)}</OrgnlGrpInfAndSts>"
        f"<OrgnlPmtInfAndSts>{rsn(payment_reason)}<TxInfAndSts><TxSts>{tx}</TxSts>{rsn(reason)}{rsn('NARR')}"
        f"</TxInfAndSts></OrgnlPmtInfAndSts>"
    )
    return document(message_set, root, header(count=None, total=None) + body)


def reversal(e2e: str = "<OrgnlEndToEndId>E1</OrgnlEndToEndId>", amount: str = "10.00", ccy: str = "EUR",
             reason: str = "DUPL", payment_reason: str = "CUST") -> str:
    body = (
        f"<OrgnlPmtInfAndRvsl><RvslRsnInf><Rsn><Cd>{payment_reason}</Cd></Rsn></RvslRsnInf><TxInf>{e2e}"
        f'<OrgnlInstdAmt Ccy="{ccy}">{amount}</OrgnlInstdAmt><RvslRsnInf><Rsn><Cd>{reason}</Cd></Rsn></RvslRsnInf>'
        "</TxInf></OrgnlPmtInfAndRvsl>"
    )
    return document("007", "CstmrPmtRvsl", header() + body)


def mandate(request: str = "R1", tracking: str = "true", iban: str = GOOD_IBAN, bic: str = GOOD_BIC) -> str:
    body = (
        f"<Mndt><MndtReqId>{request}</MndtReqId><TrckgInd>{tracking}</TrckgInd>"
        f"<CdtrAcct><Id><IBAN>{iban}</IBAN></Id></CdtrAcct>"
        f"<CdtrAgt><FinInstnId><BICFI>{bic}</BICFI></FinInstnId></CdtrAgt></Mndt>"
    )
    return document("009", "MndtInitnReq", body)


def amendment(reason: str = "MD01", mandate_id: str = "MD1") -> str:
    body = f"<UndrlygAmdmntDtls><AmdmntRsn><Rsn><Cd>{reason}</Cd></Rsn></AmdmntRsn><Mndt><MndtId>{mandate_id}</MndtId></Mndt></UndrlygAmdmntDtls>"
    return document("010", "MndtAmdmntReq", body)


def cancellation(reason: str = "CUST", original: str = "MD1") -> str:
    body = f"<UndrlygCxlDtls><CxlRsn><Rsn><Cd>{reason}</Cd></Rsn></CxlRsn><OrgnlMndt><OrgnlMndtId>{original}</OrgnlMndtId></OrgnlMndt></UndrlygCxlDtls>"
    return document("011", "MndtCxlReq", body)


def acceptance(accepted: str = "true", reason: str = "") -> str:
    body = f"<UndrlygAccptncDtls><AccptncRslt><Accptd>{accepted}</Accptd>{reason}</AccptncRslt></UndrlygAccptncDtls>"
    return document("012", "MndtAccptncRpt", body)


def copy_request(original: str = "MD1") -> str:
    return document("017", "MndtCpyReq", f"<UndrlygCpyReqDtls><OrgnlMndt><OrgnlMndtId>{original}</OrgnlMndtId></OrgnlMndt></UndrlygCpyReqDtls>")


def suspension(reason: str = "SSPD", original: str = "MD1") -> str:
    body = f"<UndrlygSspnsnDtls><SspnsnRsn><Rsn><Cd>{reason}</Cd></Rsn></SspnsnRsn><OrgnlMndt><OrgnlMndtId>{original}</OrgnlMndtId></OrgnlMndt></UndrlygSspnsnDtls>"
    return document("018", "MndtSspnsnReq", body)


def frame(spark, message_set: str, *documents: str, names: list[str] | None = None):
    rows = [
        ("pain", message_set, names[i] if names else f"gen-pass-{i:03d}.xml", "gen-pass", xml)
        for i, xml in enumerate(documents)
    ]
    return spark.createDataFrame(rows, "domain string, message_set string, file_name string, category string, xml string")
