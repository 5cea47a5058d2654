"""Message layouts, code sets and table schemas.

Every message set has a narrow ``from_xml`` layout: only the elements that a
shredder or a rule reads.  All leaves are strings; typing happens in the
projections, so a malformed amount becomes NULL instead of a lost message.
"""

from __future__ import annotations

_PARTY = "STRUCT<Nm STRING, PstlAdr STRUCT<Ctry STRING>>"
_ACCOUNT = "STRUCT<Id STRUCT<IBAN STRING>>"
_AGENT = "STRUCT<FinInstnId STRUCT<BICFI STRING>>"
_AMOUNT = "STRUCT<_VALUE STRING, _Ccy STRING>"
_REASON = "STRUCT<Rsn STRUCT<Cd STRING>>"
_HEADER = (
    "STRUCT<MsgId STRING, NbOfTxs STRING, CtrlSum STRING, InitgPty STRUCT<Nm STRING>>"
)
_ORIGINAL_MANDATE = "STRUCT<OrgnlMndtId STRING>"

_CREDIT_TX = (
    "STRUCT<PmtId STRUCT<InstrId STRING, EndToEndId STRING, UETR STRING>, "
    f"Amt STRUCT<InstdAmt {_AMOUNT}, EqvtAmt STRUCT<Amt {_AMOUNT}, CcyOfTrf STRING>>, "
    f"ChrgBr STRING, IntrmyAgt1 {_AGENT}, CdtrAgt {_AGENT}, Cdtr {_PARTY}, "
    f"CdtrAcct {_ACCOUNT}, Purp STRUCT<Cd STRING, Prtry STRING>, "
    "RmtInf STRUCT<Ustrd ARRAY<STRING>>, ReqdExctnDt STRUCT<Dt STRING>>"
)


def _credit_payment(*tx_names: str) -> str:
    blocks = ", ".join(f"{name} ARRAY<{_CREDIT_TX}>" for name in tx_names)
    return (
        "STRUCT<PmtInfId STRING, PmtMtd STRING, NbOfTxs STRING, CtrlSum STRING, "
        f"ReqdExctnDt STRUCT<Dt STRING>, Dbtr {_PARTY}, DbtrAcct {_ACCOUNT}, "
        f"DbtrAgt {_AGENT}, {blocks}>"
    )


_STATUS_BODY = (
    f"STRUCT<GrpHdr {_HEADER}, "
    f"OrgnlGrpInfAndSts ARRAY<STRUCT<OrgnlMsgId STRING, GrpSts STRING, StsRsnInf ARRAY<{_REASON}>>>, "
    f"OrgnlPmtInfAndSts ARRAY<STRUCT<StsRsnInf ARRAY<{_REASON}>, "
    f"TxInfAndSts ARRAY<STRUCT<TxSts STRING, StsRsnInf ARRAY<{_REASON}>>>>>>"
)


def _mandate_body(block: str, fields: str) -> str:
    return f"STRUCT<GrpHdr {_HEADER}, {block} ARRAY<STRUCT<{fields}>>>"


#: message set -> (element below Document, layout of that element)
LAYOUTS: dict[str, tuple[str, str]] = {
    "001": (
        "CstmrCdtTrfInitn",
        f"STRUCT<GrpHdr {_HEADER}, PmtInf ARRAY<{_credit_payment('CdtTrfTxInf')}>>",
    ),
    "002": ("CstmrPmtStsRpt", _STATUS_BODY),
    "007": (
        "CstmrPmtRvsl",
        f"STRUCT<GrpHdr {_HEADER}, OrgnlGrpInf STRUCT<RvslRsnInf ARRAY<{_REASON}>>, "
        f"OrgnlPmtInfAndRvsl ARRAY<STRUCT<RvslRsnInf ARRAY<{_REASON}>, "
        f"TxInf ARRAY<STRUCT<OrgnlEndToEndId STRING, OrgnlInstdAmt {_AMOUNT}, "
        f"RvslRsnInf ARRAY<{_REASON}>>>>>>",
    ),
    "008": (
        "CstmrDrctDbtInitn",
        f"STRUCT<GrpHdr {_HEADER}, PmtInf ARRAY<STRUCT<PmtInfId STRING, ReqdColltnDt STRING, "
        f"CdtrAcct {_ACCOUNT}, CdtrAgt {_AGENT}, "
        f"DrctDbtTxInf ARRAY<STRUCT<InstdAmt {_AMOUNT}, "
        "DrctDbtTx STRUCT<MndtRltdInf STRUCT<MndtId STRING>>, "
        "MndtRltdInf STRUCT<MndtId STRING>, "
        f"DbtrAgt {_AGENT}, DbtrAcct {_ACCOUNT}>>>>>",
    ),
    "009": (
        "MndtInitnReq",
        _mandate_body(
            "Mndt",
            "MndtId STRING, MndtReqId STRING, TrckgInd STRING, "
            f"CdtrAcct {_ACCOUNT}, CdtrAgt {_AGENT}, DbtrAcct {_ACCOUNT}, DbtrAgt {_AGENT}",
        ),
    ),
    "010": (
        "MndtAmdmntReq",
        _mandate_body(
            "UndrlygAmdmntDtls", f"AmdmntRsn {_REASON}, Mndt STRUCT<MndtId STRING>"
        ),
    ),
    "011": (
        "MndtCxlReq",
        _mandate_body("UndrlygCxlDtls", f"CxlRsn {_REASON}, OrgnlMndt {_ORIGINAL_MANDATE}"),
    ),
    "012": (
        "MndtAccptncRpt",
        _mandate_body(
            "UndrlygAccptncDtls",
            "AccptncRslt STRUCT<Accptd STRING, RjctRsn STRUCT<Cd STRING, Rsn STRUCT<Cd STRING>>>, "
            f"OrgnlMndt {_ORIGINAL_MANDATE}",
        ),
    ),
    "013": (
        "CdtrPmtActvtnReq",
        f"STRUCT<GrpHdr {_HEADER}, PmtInf ARRAY<{_credit_payment('CdtTrfTx', 'CdtTrfTxInf')}>>",
    ),
    "014": ("CdtrPmtActvtnReqStsRpt", _STATUS_BODY),
    "017": (
        "MndtCpyReq",
        _mandate_body("UndrlygCpyReqDtls", f"OrgnlMndt {_ORIGINAL_MANDATE}"),
    ),
    "018": (
        "MndtSspnsnReq",
        _mandate_body(
            "UndrlygSspnsnDtls", f"SspnsnRsn {_REASON}, OrgnlMndt {_ORIGINAL_MANDATE}"
        ),
    ),
}

MESSAGE_SETS: list[str] = sorted(LAYOUTS)

CORRUPT = "_corrupt"


def document_ddl(message_set: str, reads: tuple[str, ...] | None = None) -> str:
    """``from_xml`` layout of a whole document of one message set.

    ``reads`` names the elements below the body that are wanted, by their paths; a path takes what is below it along.
    """
    child, body = LAYOUTS[message_set]
    if reads is not None:
        body = _narrowed(body, [path.split(".") for path in reads])
    return f"{child} {body}, {CORRUPT} STRING"


def _fields(struct: str) -> dict[str, str]:
    """Name and layout of each field of ``STRUCT<...>``."""
    parts, depth = [""], 0
    for char in struct.removeprefix("STRUCT<").removesuffix(">"):
        depth += (char == "<") - (char == ">")
        if char == "," and depth == 0:
            parts.append("")
        else:
            parts[-1] += char
    return dict(part.strip().split(" ", 1) for part in parts)


def _narrowed(layout: str, paths: list[list[str]]) -> str:
    """The layout with the named fields only, in its own order."""
    if layout.startswith("ARRAY<"):
        return f"ARRAY<{_narrowed(layout.removeprefix('ARRAY<').removesuffix('>'), paths)}>"
    if any(not path for path in paths):
        return layout
    fields = _fields(layout) if layout.startswith("STRUCT<") else {}
    absent = {path[0] for path in paths} - fields.keys()
    if absent:
        raise ValueError(f"not in the layout: {', '.join(sorted(absent))}")
    kept = [
        f"{name} {_narrowed(inner, [path[1:] for path in paths if path[0] == name])}"
        for name, inner in fields.items() if any(path[0] == name for path in paths)
    ]
    return f"STRUCT<{', '.join(kept)}>"


# ---------------------------------------------------------------------------
# Fixed values (published code sets, labels and wording that results depend on)
# ---------------------------------------------------------------------------

MAX_XML_BYTES = 10 * 1024 * 1024
CONTROL_SUM_TOLERANCE = "0.01"
ERROR_DETAIL_LENGTH = 500
TOPIC_PREFIX = "iso20022"
DEAD_LETTER_TOPIC = "iso20022.dlq"
QUARANTINE_TOPIC = "iso20022.tampered"

SET_LABELS = {
    "001": "Customer Credit Transfer Initiation",
    "002": "Customer Payment Status Report",
    "007": "Customer Payment Reversal",
    "008": "Customer Direct Debit Initiation",
    "009": "Mandate Initiation Request",
    "010": "Mandate Amendment Request",
    "011": "Mandate Cancellation Request",
    "012": "Mandate Acceptance Report",
    "013": "Creditor Payment Activation Request",
    "014": "Creditor Payment Activation Status Report",
    "017": "Mandate Copy Request",
    "018": "Mandate Suspension Request",
}

DOMAIN_LABELS = {
    "pain": "Payments Initiation",
    "pacs": "Payments Clearing and Settlement",
    "camt": "Cash Management",
    "acmt": "Account Management",
    "auth": "Authorities Financial Investigations",
    "colr": "Collateral Management",
    "reda": "Reference Data",
    "remt": "Payments Remittance Advice",
}
DOMAIN_FALLBACK = "ISO 20022 Message Domain"

CATEGORIES = ["gen-pass", "gen-fail", "gen-edge", "hand-crafted"]

# Active ISO 4217 currency codes.
CURRENCIES = [
    "AED", "AFN", "ALL", "AMD", "ANG", "AOA", "ARS", "AUD", "AWG", "AZN", "BAM", "BBD", "BDT",
    "BGN", "BHD", "BIF", "BMD", "BND", "BOB", "BRL", "BSD", "BTN", "BWP", "BYN", "BZD", "CAD",
    "CDF", "CHF", "CLP", "CNY", "COP", "CRC", "CUP", "CVE", "CZK", "DJF", "DKK", "DOP", "DZD",
    "EGP", "ERN", "ETB", "EUR", "FJD", "FKP", "GBP", "GEL", "GHS", "GIP", "GMD", "GNF", "GTQ",
    "GYD", "HKD", "HNL", "HTG", "HUF", "IDR", "ILS", "INR", "IQD", "IRR", "ISK", "JMD", "JOD",
    "JPY", "KES", "KGS", "KHR", "KMF", "KRW", "KWD", "KYD", "KZT", "LAK", "LBP", "LKR", "LRD",
    "LSL", "LYD", "MAD", "MDL", "MGA", "MKD", "MMK", "MNT", "MOP", "MUR", "MVR", "MWK", "MXN",
    "MYR", "MZN", "NAD", "NGN", "NIO", "NOK", "NPR", "NZD", "OMR", "PAB", "PEN", "PGK", "PHP",
    "PKR", "PLN", "PYG", "QAR", "RON", "RSD", "RUB", "RWF", "SAR", "SBD", "SCR", "SDG", "SEK",
    "SGD", "SHP", "SOS", "SRD", "SSP", "STN", "SZL", "THB", "TJS", "TMT", "TND", "TOP", "TRY",
    "TTD", "TWD", "TZS", "UAH", "UGX", "USD", "UYU", "UZS", "VES", "VND", "VUV", "WST", "XAF",
    "XCD", "XOF", "XPF", "YER", "ZAR", "ZMW", "ZWL",
]

GROUP_STATUSES = ["ACCP", "ACSP", "ACTC", "ACWC", "PART", "PDNG", "RCVD", "RJCT"]
TX_STATUSES = ["ACCP", "ACSP", "ACTC", "ACWC", "CANC", "PDNG", "RJCT"]
REVERSAL_REASONS = ["AC04", "AM09", "CUST", "DUPL", "FRAD", "NARR", "NOAS", "TECH", "UPAY"]
CANCELLATION_REASONS = ["AGNT", "AM09", "CUST", "DUPL", "FRAD", "NARR", "UPAY"]
AMENDMENT_REASONS = ["AM05", "AM06", "AM09", "MD01", "MD02", "MD06", "MD07", "NARR"]
SUSPENSION_REASONS = ["CUST", "NARR", "SSPD", "UPAY"]
STATUS_REASONS = [
    "AC01", "AC04", "AC06", "AC13", "AG01", "AG02", "AM01", "AM02", "AM03", "AM04", "AM05", "AM06",
    "AM07", "AM09", "AM10", "BE01", "BE04", "BE05", "CH03", "CH16", "CUST", "DT01", "ED01", "ED03",
    "EMVL", "FF01", "FF05", "FOCR", "FR01", "MD01", "MD02", "MD06", "MD07", "MS02", "MS03", "NARR",
    "RC01", "RF01", "RR01", "RR02", "RR03", "RR04", "SL01", "SL02", "SL11", "SL12", "SL13", "SL14",
    "UPAY",
]

BIC_PATTERN = "^[A-Z]{4}[A-Z]{2}[A-Z0-9]{2}([A-Z0-9]{3})?$"
UUID4_PATTERN = "(?i)^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
DOMAIN_PATTERN = r"^[a-z]{4}(\.\d{3}){0,3}$"

E, W = "ERROR", "WARNING"

#: rule id -> (severity, field path, message); %s marks the values filled in.
RULES: dict[str, tuple[str, str, str]] = {
    "BR-001": (E, "GrpHdr/NbOfTxs",
               "Declared NbOfTxs (%s) does not match actual transaction count (%s)"),
    "BR-002": (E, "GrpHdr/CtrlSum", "CtrlSum (%s) does not match sum of InstdAmt (%s)"),
    "BR-003": (E, "PmtInf[%s]/CtrlSum", "PmtInf CtrlSum (%s) != sum of InstdAmt (%s)"),
    "BR-004": (E, "PmtInf[%s]/NbOfTxs", "PmtInf NbOfTxs (%s) != transaction count (%s)"),
    "BR-005": (E, "CdtTrfTxInf/PmtId/EndToEndId", "Duplicate EndToEndId within the message"),
    "BR-006": (E, "CdtTrfTxInf/PmtId/UETR",
               "UETR must be a valid UUID v4 (third group starts with '4', "
               "fourth group starts with 8/9/a/b)"),
    "BR-007": (E, "CdtTrfTxInf/Amt/InstdAmt", "InstdAmt must be greater than zero"),
    "BR-008": (E, "%s/Id/IBAN", "IBAN failed ISO 7064 MOD-97 check digit validation"),
    "BR-009": (E, "%s/FinInstnId/BICFI",
               "BIC must be 8 or 11 uppercase alphanumeric characters (AAAA BB CC [DDD])"),
    "BR-010": (E, "%s/@Ccy", "Currency code is not a valid ISO 4217 active currency code"),
    "BR-011": (W, "PmtInf/ReqdExctnDt/Dt", "Requested execution date is in the past"),
    "BR-012": (E, "GrpHdr/MsgId", "MsgId is missing or empty"),
    "BR-020": (E, "OrgnlGrpInfAndSts/GrpSts",
               "GrpSts '%s' is not a recognised ISO 20022 group status code"),
    "BR-021": (E, "TxInfAndSts/TxSts",
               "TxSts '%s' is not a recognised ISO 20022 transaction status code"),
    "BR-022": (W, "StsRsnInf/Rsn/Cd",
               "Status reason code '%s' is not in the common ISO 20022 reason code set"),
    "BR-023": (E, "OrgnlGrpInfAndSts/OrgnlMsgId",
               "Original message reference OrgnlMsgId is missing or empty"),
    "BR-030": (E, "OrgnlPmtInfAndRvsl/TxInf[%s]/OrgnlEndToEndId",
               "OrgnlEndToEndId is required for each reversal transaction — "
               "it must match the EndToEndId from the original pain.001"),
    "BR-031": (W, "RvslRsnInf/Rsn/Cd",
               "Reversal reason code '%s' is not in the recognised set"),
    "BR-032": (E, "TxInf/OrgnlInstdAmt", "OrgnlInstdAmt must be greater than zero"),
    "BR-040": (E, "GrpHdr/NbOfTxs",
               "Declared NbOfTxs (%s) != actual DrctDbtTxInf count (%s)"),
    "BR-041": (E, "GrpHdr/CtrlSum", "CtrlSum (%s) != sum of InstdAmt (%s)"),
    "BR-042": (E, "DrctDbtTxInf[%s]/MndtRltdInf/MndtId",
               "MndtId is required — each direct debit transaction must reference a mandate"),
    "BR-043": (E, "%s/Id/IBAN", "IBAN failed ISO 7064 MOD-97 check digit validation"),
    "BR-044": (E, "%s/FinInstnId/BICFI",
               "BIC must be 8 or 11 uppercase alphanumeric characters (AAAA BB CC [DDD])"),
    "BR-046": (W, "PmtInf/ReqdColltnDt", "Requested collection date is in the past"),
    "BR-050": (E, "Mndt/MndtReqId", "MndtReqId is required and must not be empty"),
    "BR-051": (E, "Mndt/TrckgInd", "TrckgInd must be 'true' or 'false'"),
    "BR-052": (E, "%s/Id/IBAN", "IBAN failed ISO 7064 MOD-97 check digit validation"),
    "BR-053": (E, "%s/FinInstnId/BICFI",
               "BIC must be 8 or 11 uppercase alphanumeric characters (AAAA BB CC [DDD])"),
    "BR-060": (W, "AmdmntRsn/Rsn/Cd",
               "Amendment reason code '%s' is not in the recognised set"),
    "BR-061": (E, "UndrlygAmdmntDtls/Mndt/MndtId", "MndtId is required in mandate amendment"),
    "BR-070": (W, "CxlRsn/Rsn/Cd",
               "Cancellation reason code '%s' is not in the recognised set"),
    "BR-071": (E, "UndrlygCxlDtls/OrgnlMndt/OrgnlMndtId",
               "Original mandate ID is required in cancellation request"),
    "BR-080": (E, "UndrlygAccptncDtls/AccptncRslt/Accptd", "Accptd must be 'true' or 'false'"),
    "BR-081": (W, "AccptncRslt/RjctRsn/Rsn/Cd",
               "Rejection reason code is recommended when Accptd=false"),
    "BR-090": (E, "UndrlygCpyReqDtls/OrgnlMndt/OrgnlMndtId",
               "Original mandate ID is required in copy request"),
    "BR-100": (W, "SspnsnRsn/Rsn/Cd",
               "Suspension reason code '%s' is not in the recognised set"),
    "BR-101": (E, "UndrlygSspnsnDtls/OrgnlMndt/OrgnlMndtId",
               "Original mandate ID is required in suspension request"),
}
NOT_AN_INTEGER = "NbOfTxs is not a valid integer"
NOT_A_DECIMAL = "CtrlSum is not a valid decimal"

# ---------------------------------------------------------------------------
# Table schemas
# ---------------------------------------------------------------------------

VIOLATION_DDL = (
    "STRUCT<rule_id: STRING, severity: STRING, field_path: STRING, "
    "message: STRING, actual: STRING, expected: STRING>"
)

PAYLOAD_DDL = (
    "message_id STRING, domain STRING, message_set STRING, schema_name STRING, "
    "file_name STRING, sent_at STRING, xml_content STRING, signature STRING"
)

STATE_DDL: dict[str, str] = {
    "sent_messages": (
        "message_id STRING, domain STRING, message_set STRING, file_name STRING, "
        "schema_name STRING, kafka_topic STRING, sent_at TIMESTAMP"
    ),
    "processed_messages": (
        "message_id STRING, domain STRING, message_set STRING, file_name STRING, "
        "validation_status STRING, processed_at TIMESTAMP, error_detail STRING, "
        "dlq_topic STRING"
    ),
    "duplicate_events": (
        "message_id STRING, domain STRING, message_set STRING, file_name STRING, "
        "detected_at TIMESTAMP"
    ),
    "tampered_messages": (
        "message_id STRING, domain STRING, message_set STRING, file_name STRING, "
        "detected_at TIMESTAMP, tampered_topic STRING"
    ),
    "rule_violations": (
        "message_id STRING, message_set STRING, file_name STRING, rule_id STRING, "
        "severity STRING, field_path STRING, message STRING, actual STRING, "
        "expected STRING, detected_at TIMESTAMP"
    ),
}
