"""Parsed messages to typed rows.

Every shredder takes the result of ``sources.corpus.parse`` restricted to
well-formed messages.  A message without any repeating block still yields one
row with NULLs in every column but file name and category.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from girolens.functions.amounts import amount, control_sum, count_text
from girolens.functions.ids import bic_country, iban_country
from girolens.functions.text import text
from girolens.operators.once import bound


_TX = "PmtInf.CdtTrfTxInf"
#: shredder -> the elements below the body that it reads, for ``sources.corpus.parse``
READS: dict[str, tuple[str, ...]] = {
    "file_base": ("GrpHdr.MsgId",),
    "shred_001": (
        "GrpHdr", "PmtInf.PmtInfId", "PmtInf.PmtMtd", "PmtInf.ReqdExctnDt", "PmtInf.Dbtr", "PmtInf.DbtrAcct", "PmtInf.DbtrAgt",
        f"{_TX}.PmtId", f"{_TX}.Amt.InstdAmt", f"{_TX}.Amt.EqvtAmt", f"{_TX}.ChrgBr", f"{_TX}.CdtrAgt", f"{_TX}.Cdtr",
        f"{_TX}.CdtrAcct", f"{_TX}.Purp", f"{_TX}.RmtInf",
    ),
    "shred_payment": (
        "PmtInf.PmtMtd", "PmtInf.DbtrAcct", "PmtInf.DbtrAgt", f"{_TX}.PmtId.UETR", f"{_TX}.Amt.InstdAmt", f"{_TX}.ChrgBr",
        f"{_TX}.CdtrAcct", f"{_TX}.Purp.Cd",
    ),
    "shred_status": ("OrgnlGrpInfAndSts.GrpSts", "OrgnlPmtInfAndSts.TxInfAndSts"),
    "shred_reversal": ("OrgnlPmtInfAndRvsl.TxInf.OrgnlInstdAmt", "OrgnlPmtInfAndRvsl.TxInf.RvslRsnInf"),
    "shred_direct_debit": ("PmtInf.CdtrAcct", "PmtInf.DrctDbtTxInf.InstdAmt", "PmtInf.DrctDbtTxInf.DbtrAcct"),
}


def _children(outer: Column, inner: str, keep: dict[str, str], inner_name: str) -> Column:
    """Flat array of ``struct(kept outer fields, inner element)``."""
    def pairs(parent: Column) -> Column:
        kept = [parent[path].alias(name) if "." not in path else _path(parent, path).alias(name)
                for name, path in keep.items()]
        return F.transform(parent[inner], lambda child: F.struct(*kept, child.alias(inner_name)))

    nested = F.transform(outer, pairs)
    return F.flatten(F.filter(nested, lambda block: block.isNotNull()))


def _path(start: Column, path: str) -> Column:
    for step in path.split("."):
        start = start[step]
    return start


def credit_blocks(message_set: str, compat: bool = False) -> list[str]:
    """Names under which a set keeps its credit transfers."""
    if message_set == "013":
        return ["CdtTrfTxInf"] if compat else ["CdtTrfTx", "CdtTrfTxInf"]
    return ["CdtTrfTxInf"]


def _credit_rows(parsed: DataFrame, keep: dict[str, str], blocks: list[str], *head: Column) -> DataFrame:
    payments = F.col("body.PmtInf")
    arrays = [_children(payments, block, keep, "tx") for block in blocks]
    rows = arrays[0] if len(arrays) == 1 else F.concat(
        *[F.coalesce(a, F.array().cast(_as_type(parsed, arrays[0]))) for a in arrays]
    )
    return parsed.select("file_name", "category", *head, F.explode_outer(rows).alias("r"))


def _as_type(frame: DataFrame, column: Column):
    return frame.select(column.alias("c")).schema["c"].dataType


def shred_001(parsed: DataFrame) -> DataFrame:
    """Credit transfers, 27 columns, one row per transaction."""
    rows = _credit_rows(
        parsed,
        {
            "pmt_inf_id": "PmtInfId", "pmt_method": "PmtMtd", "req_exec_date": "ReqdExctnDt.Dt",
            "debtor_name": "Dbtr.Nm", "debtor_country": "Dbtr.PstlAdr.Ctry",
            "debtor_iban": "DbtrAcct.Id.IBAN", "debtor_bic": "DbtrAgt.FinInstnId.BICFI",
        },
        ["CdtTrfTxInf"],
        F.col("body.GrpHdr").alias("hdr"),
    )
    present = F.col("r.tx").isNotNull()

    def head(column: Column) -> Column:
        return F.when(present, column)

    debtor_iban, creditor_iban = text(F.col("r.debtor_iban")), text(F.col("r.tx.CdtrAcct.Id.IBAN"))
    debtor_bic = text(F.col("r.debtor_bic"))
    creditor_bic = text(F.col("r.tx.CdtrAgt.FinInstnId.BICFI"))
    instructed, equivalent = F.col("r.tx.Amt.InstdAmt"), F.col("r.tx.Amt.EqvtAmt")
    return rows.select(
        "file_name",
        "category",
        head(text(F.col("hdr.MsgId"))).alias("msg_id"),
        head(count_text(F.col("hdr.NbOfTxs"))).alias("nb_txs_declared"),
        head(control_sum(F.col("hdr.CtrlSum"))).alias("ctrl_sum"),
        head(text(F.col("hdr.InitgPty.Nm"))).alias("initiating_party"),
        text(F.col("r.pmt_inf_id")).alias("pmt_inf_id"),
        text(F.col("r.pmt_method")).alias("pmt_method"),
        text(F.col("r.req_exec_date")).alias("req_exec_date"),
        text(F.col("r.debtor_name")).alias("debtor_name"),
        F.coalesce(text(F.col("r.debtor_country")), iban_country(debtor_iban)).alias("debtor_country"),
        iban_country(debtor_iban).alias("debtor_iban_prefix"),
        debtor_bic.alias("debtor_bic"),
        bic_country(debtor_bic).alias("debtor_bic_country"),
        text(F.col("r.tx.PmtId.EndToEndId")).alias("end_to_end_id"),
        text(F.col("r.tx.PmtId.InstrId")).alias("instr_id"),
        head(text(F.col("r.tx.PmtId.UETR")).isNotNull()).alias("has_uetr"),
        F.when(instructed.isNotNull(), amount(instructed["_VALUE"]))
        .otherwise(amount(equivalent["Amt"]["_VALUE"])).alias("amount"),
        F.coalesce(F.nullif(instructed["_Ccy"], F.lit("")), text(equivalent["CcyOfTrf"])).alias("currency"),
        text(F.col("r.tx.ChrgBr")).alias("charge_bearer"),
        text(F.col("r.tx.Cdtr.Nm")).alias("creditor_name"),
        F.coalesce(text(F.col("r.tx.Cdtr.PstlAdr.Ctry")), iban_country(creditor_iban)).alias("creditor_country"),
        iban_country(creditor_iban).alias("creditor_iban_prefix"),
        creditor_bic.alias("creditor_bic"),
        bic_country(creditor_bic).alias("creditor_bic_country"),
        F.coalesce(text(F.col("r.tx.Purp.Cd")), text(F.col("r.tx.Purp.Prtry"))).alias("purpose_code"),
        # a lambda keeps the columns out of whole-stage code, whose one method for all of them is too long to be compiled
        head(bound(F.get(F.col("r.tx.RmtInf.Ustrd"), F.lit(0)), lambda first: text(first).isNotNull())).alias("has_remittance_info"),
    )


def shred_payment(parsed: DataFrame, message_set: str = "001", compat: bool = False) -> DataFrame:
    """Short form of credit transfers (001, 013), 11 columns."""
    rows = _credit_rows(
        parsed,
        {"pmt_method": "PmtMtd", "debtor_iban": "DbtrAcct.Id.IBAN",
         "debtor_bic": "DbtrAgt.FinInstnId.BICFI"},
        credit_blocks(message_set, compat),
    )
    instructed = F.col("r.tx.Amt.InstdAmt")
    return rows.select(
        "file_name",
        "category",
        text(F.col("r.pmt_method")).alias("pmt_method"),
        iban_country(text(F.col("r.debtor_iban"))).alias("debtor_pfx"),
        text(F.col("r.debtor_bic")).alias("debtor_bic"),
        amount(instructed["_VALUE"]).alias("amount"),
        instructed["_Ccy"].alias("currency"),
        iban_country(text(F.col("r.tx.CdtrAcct.Id.IBAN"))).alias("creditor_pfx"),
        text(F.col("r.tx.ChrgBr")).alias("charge_bearer"),
        text(F.col("r.tx.Purp.Cd")).alias("purpose"),
        F.coalesce(F.col("r.tx.PmtId.UETR").isNotNull(), F.lit(False)).alias("has_uetr"),
    )


def _first_code(reasons: Column) -> Column:
    """Code of the first reason block that has one."""
    codes = F.filter(F.transform(reasons, lambda r: r["Rsn"]["Cd"]), lambda c: c.isNotNull())
    return text(F.get(codes, F.lit(0)))


def shred_status(parsed: DataFrame) -> DataFrame:
    """Status reports (002, 014): group rows followed by transaction rows."""
    none = F.lit(None).cast("string")
    groups = F.transform(
        F.col("body.OrgnlGrpInfAndSts"),
        lambda g: F.struct(
            text(g["GrpSts"]).alias("grp_status"), none.alias("tx_status"), none.alias("reason_code")
        ),
    )
    payments = F.transform(
        F.col("body.OrgnlPmtInfAndSts"),
        lambda p: F.transform(
            p["TxInfAndSts"],
            lambda t: F.struct(
                none.alias("grp_status"), text(t["TxSts"]).alias("tx_status"),
                _first_code(t["StsRsnInf"]).alias("reason_code"),
            ),
        ),
    )
    txs = F.flatten(F.filter(payments, lambda block: block.isNotNull()))
    empty = F.array().cast("array<struct<grp_status:string,tx_status:string,reason_code:string>>")
    rows = F.concat(F.coalesce(groups, empty), F.coalesce(txs, empty))
    return parsed.select(
        "file_name", "category", F.explode_outer(rows).alias("r")
    ).select("file_name", "category", "r.grp_status", "r.tx_status", "r.reason_code")


def shred_reversal(parsed: DataFrame) -> DataFrame:
    """Reversals (007): original amount, currency and first reason."""
    rows = F.flatten(
        F.filter(
            F.transform(F.col("body.OrgnlPmtInfAndRvsl"), lambda p: p["TxInf"]),
            lambda block: block.isNotNull(),
        )
    )
    return parsed.select("file_name", "category", F.explode_outer(rows).alias("tx")).select(
        "file_name",
        "category",
        amount(F.col("tx.OrgnlInstdAmt._VALUE")).alias("orig_amount"),
        F.col("tx.OrgnlInstdAmt._Ccy").alias("currency"),
        _first_code(F.col("tx.RvslRsnInf")).alias("reversal_reason"),
    )


def shred_direct_debit(parsed: DataFrame) -> DataFrame:
    """Direct debits (008)."""
    rows = _children(
        F.col("body.PmtInf"), "DrctDbtTxInf", {"creditor_iban": "CdtrAcct.Id.IBAN"}, "tx"
    )
    return parsed.select("file_name", "category", F.explode_outer(rows).alias("r")).select(
        "file_name",
        "category",
        amount(F.col("r.tx.InstdAmt._VALUE")).alias("amount"),
        F.col("r.tx.InstdAmt._Ccy").alias("currency"),
        iban_country(text(F.col("r.tx.DbtrAcct.Id.IBAN"))).alias("debtor_pfx"),
        iban_country(text(F.col("r.creditor_iban"))).alias("creditor_pfx"),
    )


def _shred_blocks(parsed: DataFrame, block: str, columns: dict[str, Column]) -> DataFrame:
    """One row per top-level block; column expressions read from ``b``."""
    return parsed.select(
        "file_name", "category", F.explode_outer(F.col(f"body.{block}")).alias("b")
    ).select("file_name", "category", *[c.alias(name) for name, c in columns.items()])


def shred_mandate_init(parsed: DataFrame) -> DataFrame:
    return _shred_blocks(
        parsed,
        "Mndt",
        {
            "tracking_ind": text(F.col("b.TrckgInd")),
            "creditor_pfx": iban_country(text(F.col("b.CdtrAcct.Id.IBAN"))),
            "debtor_pfx": iban_country(text(F.col("b.DbtrAcct.Id.IBAN"))),
        },
    )


#: message set -> (block, reason element, column)
REASON_BLOCKS = {
    "010": ("UndrlygAmdmntDtls", "AmdmntRsn", "amendment_reason"),
    "011": ("UndrlygCxlDtls", "CxlRsn", "cancellation_reason"),
    "018": ("UndrlygSspnsnDtls", "SspnsnRsn", "suspension_reason"),
}


def shred_reason(parsed: DataFrame, message_set: str) -> DataFrame:
    """Reason code per detail block of amendments, cancellations, suspensions."""
    block, element, column = REASON_BLOCKS[message_set]
    return _shred_blocks(parsed, block, {column: text(F.col(f"b.{element}.Rsn.Cd"))})


def shred_accept(parsed: DataFrame, compat: bool = False) -> DataFrame:
    """Acceptance reports (012).  ``compat`` reads the reason one level too deep."""
    reason = "b.AccptncRslt.RjctRsn" + (".Rsn.Cd" if compat else ".Cd")
    return _shred_blocks(
        parsed,
        "UndrlygAccptncDtls",
        {"accepted": text(F.col("b.AccptncRslt.Accptd")), "rejection_reason": text(F.col(reason))},
    )


def shred_copy(parsed: DataFrame) -> DataFrame:
    return _shred_blocks(
        parsed, "UndrlygCpyReqDtls", {"orig_mandate_id": text(F.col("b.OrgnlMndt.OrgnlMndtId"))}
    )


def file_base(parsed: DataFrame, message_set: str) -> DataFrame:
    """One row per well-formed file."""
    return parsed.select(
        "file_name",
        F.lit(message_set).alias("message_set"),
        "category",
        text(F.col("body.GrpHdr.MsgId")).alias("msg_id"),
    )


def shred(parsed: DataFrame, message_set: str, compat: bool = False) -> DataFrame:
    """Detail rows of any message set."""
    if message_set in ("001", "013"):
        return shred_payment(parsed, message_set, compat)
    if message_set in ("002", "014"):
        return shred_status(parsed)
    if message_set in REASON_BLOCKS:
        return shred_reason(parsed, message_set)
    if message_set == "012":
        return shred_accept(parsed, compat)
    return {
        "007": shred_reversal, "008": shred_direct_debit,
        "009": shred_mandate_init, "017": shred_copy,
    }[message_set](parsed)
