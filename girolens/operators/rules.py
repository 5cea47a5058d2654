"""Business rules as one array column per message.

Each rule looks at a single message, so the whole catalogue is a projection: no
shuffle, no UDF.  The arrays of all rules are concatenated in catalogue order;
``violations`` explodes them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from girolens import model
from girolens.functions import amounts, ids
from girolens.functions.text import stripped, text
from girolens.operators.once import bound, once
from girolens.operators.shred import credit_blocks


def _none() -> Column:
    return F.lit(None).cast("string")


def _violation(
    rule: str,
    *,
    path: list[Column] | None = None,
    message: list[Column] | str | None = None,
    actual: Column | None = None,
    expected: Column | None = None,
) -> Column:
    """Violation struct; ``path`` and ``message`` fill the slots of the catalogue texts."""
    severity, path_text, message_text = model.RULES[rule]
    shown_path = F.format_string(path_text, *path) if path else F.lit(path_text)
    if isinstance(message, str):
        shown = F.lit(message)
    else:
        shown = F.format_string(message_text, *message) if message else F.lit(message_text)
    return F.struct(
        F.lit(rule).alias("rule_id"),
        F.lit(severity).alias("severity"),
        shown_path.alias("field_path"),
        shown.alias("message"),
        (_none() if actual is None else actual).alias("actual"),
        (_none() if expected is None else expected).alias("expected"),
    )


def _empty() -> Column:
    return F.array().cast(f"array<{model.VIOLATION_DDL}>")


def _some(violations: Column) -> Column:
    """Typed array that is never NULL."""
    return F.coalesce(violations.cast(f"array<{model.VIOLATION_DDL}>"), _empty())


def _check(fails: Column, violation: Column) -> Column:
    """Zero or one violation for the whole message."""
    return _some(F.when(fails, F.array(violation)))


def _each(items: Column, fails: Callable, violation: Callable) -> Column:
    """One violation per failing element."""
    return _some(F.transform(F.filter(items, fails), violation))


def _each_indexed(items: Column, fails: Callable, violation: Callable) -> Column:
    """As ``_each``; ``violation`` also gets the 1-based position as text.  Only items that fail are numbered."""
    numbered = F.filter(
        F.transform(items, lambda x, i: F.when(fails(x), F.struct((i + 1).alias("n"), x.alias("x")))),
        lambda s: s.isNotNull(),
    )
    return _some(F.transform(numbered, lambda s: violation(s["x"], s["n"].cast("string"))))


def _present(items: Column) -> Column:
    return F.filter(items, lambda x: x.isNotNull())


def _flat(nested: Column) -> Column:
    """One array of arrays that may be absent; ``items["field"]`` takes a field of all items without a lambda."""
    return F.flatten(_present(nested))


def _sum(values: Column) -> Column:
    zero = F.lit(0).cast(amounts.MONEY_SUM)
    return F.aggregate(values, zero, lambda acc, x: (acc + x).cast(amounts.MONEY_SUM))


def _money(instructed: Column) -> Column:
    """Parsable amounts of an array of ``InstdAmt`` elements."""
    return _present(F.transform(instructed, lambda a: amounts.amount(a["_VALUE"])))


def _is_integer(raw: Column) -> Column:
    return raw.rlike("^[+-]?[0-9]+$") & raw.try_cast("bigint").isNotNull()


# --- shared checks ---------------------------------------------------------


def _unless_all(values: Column, pattern: str, found: Column) -> Column:
    """``found``, or nothing where every text fits a pattern that leaves no violation.

    The texts are put together, with the one character between them that XML cannot hold, and matched at once, in
    generated code; a lambda over them is interpreted.  What has blanks around it does not fit, so ``found`` looks at it.
    """
    fit = F.array_join(values, "\0").rlike(rf"\A(?:(?:{pattern})(?:\x00|\z))*+\z")
    return F.when(fit | values.isNull(), _empty()).otherwise(found)


def _ibans(values: Column, rule: str, element: str) -> Column:
    return _each(
        F.transform(values, stripped),
        lambda v: v.isNotNull() & (v != "") & ~ids.iban_is_valid(v, bound),
        lambda v: _violation(rule, path=[F.lit(element)], actual=v),
    )


def _bics(values: Column, rule: str, element: str) -> Column:
    return _unless_all(values, model.BIC_PATTERN.strip("^$"), _each(
        F.transform(values, stripped),
        lambda v: v.isNotNull() & (v != "") & ~ids.bic_is_valid(v),
        lambda v: _violation(rule, path=[F.lit(element)], actual=v),
    ))


#: names hold no blank, no ``<``, no ``>`` and no ``:``, so they need not be tried shorter
_CCY_PATTERN = r"<(?:[\w.-]++:)?([\w.-]++)\s(?:[^<>]*?\s)?Ccy\s*=\s*[\"']([^\"']*)[\"']"
#: the end of every text that ``_CCY_PATTERN`` finds; a known code holds no other beginning of it
_CCY_CODE = r"Ccy\s*=\s*[\"']([^\"']*)[\"']"
_HIDDEN = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>"


def _currencies(xml: Column) -> Column:
    """Any ``@Ccy`` anywhere in the document, in document order.

    The attribute occurs on dozens of paths (taxes, charges, remittance), so it
    is read from the text of the message rather than from the narrow layout.
    Tags are only located where a code is unknown.
    """
    def code(tag: Column) -> Column:
        return F.regexp_extract(tag, _CCY_PATTERN, 2)

    def unknown(value: Column) -> Column:
        return (value != "") & ~ids.currency_is_active(value)

    def found(visible: Column) -> Column:
        tags = F.regexp_extract_all(visible, F.lit(_CCY_PATTERN), F.lit(0))
        return _each(
            tags,
            lambda tag: unknown(code(tag)),
            lambda tag: _violation("BR-010", path=[F.regexp_extract(tag, _CCY_PATTERN, 1)], actual=code(tag)),
        )

    def checked(visible: Column) -> Column:
        codes = F.array_distinct(F.regexp_extract_all(visible, F.lit(_CCY_CODE), F.lit(1)))
        return F.when(F.exists(codes, unknown), found(visible)).otherwise(_empty())

    visible = F.when(xml.contains("<!"), F.regexp_replace(xml, _HIDDEN, "")).otherwise(xml)
    return bound(visible, checked)


def _past_dates(values: Column, rule: str, as_of: Column) -> Column:
    return _each(
        F.transform(values, stripped),
        lambda v: amounts.iso_date(v) < as_of,
        lambda v: _violation(
            rule, actual=v, expected=F.concat(F.lit(">= "), as_of.cast("string"))
        ),
    )


def _unknown(values: Column, rule: str, known: list[str], listed: bool = True) -> Column:
    """Codes outside a set; ``listed`` shows the set as the expectation."""
    expected = F.lit("one of [" + ", ".join(f"'{code}'" for code in sorted(known)) + "]")
    filled = "%s" in model.RULES[rule][2]
    # few are left once plainly known codes are out, so few are trimmed
    return _each(
        F.transform(F.filter(values, lambda v: ~v.isin(known)), stripped),
        lambda v: (v != "") & ~v.isin(known),
        lambda v: _violation(
            rule, message=[v] if filled else None, actual=v, expected=expected if listed else None
        ),
    )


def _blank(values: Column, rule: str) -> Column:
    """Elements that are there but hold nothing."""
    return _each(values, lambda v: stripped(v) == "", lambda v: _violation(rule))


def _not_boolean(values: Column, rule: str) -> Column:
    return _each(
        values,
        lambda v: v.isNotNull() & ~F.lower(stripped(v)).isin("true", "false", "1", "0"),
        lambda v: _violation(rule, actual=F.nullif(v, F.lit(""))),
    )


# --- credit transfers (001, 013) -------------------------------------------


def _of_payment(payment: Column, blocks: list[str]) -> Column:
    """Transactions of one payment, whichever of the block names it uses."""
    arrays = [payment[b] for b in blocks]
    if len(arrays) == 1:
        return arrays[0]
    return F.when(arrays[0].isNull(), arrays[1]).when(arrays[1].isNull(), arrays[0]).otherwise(
        F.concat(*arrays)
    )


def _prepare_credit(parsed: DataFrame, blocks: list[str]) -> DataFrame:
    """Arrays that many rules read, computed once per message."""
    payments = F.transform(
        F.col("body.PmtInf"),
        lambda p: F.struct(
            text(p["NbOfTxs"]).alias("declared"),
            text(p["CtrlSum"]).alias("control"),
            F.coalesce(F.array_size(_of_payment(p, blocks)), F.lit(0)).alias("n"),
            _money(_present(_of_payment(p, blocks)["Amt"]["InstdAmt"])).alias("money"),
        ),
    )
    txs = _flat(
        F.col("body.PmtInf")[blocks[0]] if len(blocks) == 1
        else F.transform(F.col("body.PmtInf"), lambda p: _of_payment(p, blocks))
    )
    ready = parsed.withColumn("_payments", payments).withColumn("_txs", txs)
    summed = F.transform("_payments", lambda p: F.struct(
        p["declared"].alias("declared"), p["control"].alias("control"), p["n"].alias("n"),
        F.coalesce(F.size(p["money"]), F.lit(0)).alias("stated"),
        F.coalesce(_sum(p["money"]), F.lit(0).cast(amounts.MONEY_SUM)).alias("sum"),
    ))
    totals = ready.withColumn("_payments", summed)
    return (
        totals.withColumn("_money", F.coalesce(F.aggregate(F.col("_payments.stated"), F.lit(0), lambda acc, n: acc + n), F.lit(-1)))
        .withColumn("_refs", F.transform(F.col("_txs")["PmtId"]["EndToEndId"], stripped))
        .withColumn("_total", _sum(F.col("_payments.sum")))
    )


def _credit_transfer(as_of: Column) -> Column:
    header, payments, all_txs = F.col("body.GrpHdr"), F.col("_payments"), F.col("_txs")
    blocks = F.col("body.PmtInf")
    count = F.coalesce(F.array_size(all_txs), F.lit(0))
    declared = text(header["NbOfTxs"])
    integer = _is_integer(declared)

    control = text(header["CtrlSum"])
    declared_sum = amounts.control_sum(control).cast(amounts.MONEY_SUM)
    total = F.col("_total")
    tolerance = F.lit(model.CONTROL_SUM_TOLERANCE).cast("decimal(38,5)")

    def wrong_count(payment: Column) -> Column:
        raw = payment["declared"]
        return _is_integer(raw) & (raw.try_cast("bigint") != payment["n"])

    def wrong_sum(payment: Column) -> Column:
        stated = amounts.control_sum(payment["control"]).cast(amounts.MONEY_SUM)
        return (payment["stated"] > 0) & (F.abs(stated - payment["sum"]) > tolerance)

    def payment_checks(payment: Column, i: Column) -> Column:
        n = (i + 1).cast("string")
        counted = payment["n"].cast("string")
        summed = amounts.plain(payment["sum"])
        return F.concat(
            _check(
                wrong_count(payment),
                _violation(
                    "BR-004", path=[n], message=[payment["declared"], counted],
                    actual=counted, expected=payment["declared"],
                ),
            ),
            _check(
                wrong_sum(payment),
                _violation(
                    "BR-003", path=[n], message=[payment["control"], summed],
                    actual=summed, expected=payment["control"],
                ),
            ),
        )

    per_payment = _some(F.flatten(F.transform(payments, payment_checks)))
    raw_uetrs = all_txs["PmtId"]["UETR"]
    uetrs = _unless_all(raw_uetrs, model.UUID4_PATTERN.removeprefix("(?i)").strip("^$").join(("(?i:", ")")), _each(
        F.transform(F.filter(raw_uetrs, lambda v: ~ids.uetr_is_valid(v)), stripped),
        lambda v: (v != "") & ~ids.uetr_is_valid(v),
        lambda v: _violation("BR-006", actual=v),
    ))
    # a cast to double trims by itself; what is blank counts as zero
    not_positive = F.filter(
        _present(all_txs["Amt"]["InstdAmt"])["_VALUE"],
        lambda v: F.coalesce(v.try_cast("double") <= 0, _absent(v)),
    )
    dates = _joined(blocks["ReqdExctnDt"]["Dt"], all_txs["ReqdExctnDt"]["Dt"])
    return F.concat(
        _check(
            declared.isNotNull() & ~integer,
            _violation("BR-001", message=model.NOT_AN_INTEGER, actual=declared),
        ),
        _check(
            integer & (declared.try_cast("bigint") != count),
            _violation(
                "BR-001",
                message=[declared.try_cast("bigint").cast("string"), count.cast("string")],
                actual=count.cast("string"),
                expected=declared.try_cast("bigint").cast("string"),
            ),
        ),
        _check(
            control.isNotNull() & control.try_cast("double").isNull(),
            _violation("BR-002", message=model.NOT_A_DECIMAL, actual=control),
        ),
        _check(
            (F.col("_money") > 0) & (F.abs(declared_sum - total) > tolerance),
            _violation(
                "BR-002",
                message=[amounts.plain(declared_sum), amounts.plain(total)],
                actual=amounts.plain(total), expected=amounts.plain(declared_sum),
            ),
        ),
        per_payment,
        _repeats(),
        uetrs,
        _some(F.transform(not_positive, lambda v: _violation("BR-007", actual=F.coalesce(text(v), F.lit("0"))))),
        _ibans(blocks["DbtrAcct"]["Id"]["IBAN"], "BR-008", "DbtrAcct"),
        _ibans(all_txs["CdtrAcct"]["Id"]["IBAN"], "BR-008", "CdtrAcct"),
        _bics(blocks["DbtrAgt"]["FinInstnId"]["BICFI"], "BR-009", "DbtrAgt"),
        _bics(all_txs["CdtrAgt"]["FinInstnId"]["BICFI"], "BR-009", "CdtrAgt"),
        _bics(all_txs["IntrmyAgt1"]["FinInstnId"]["BICFI"], "BR-009", "IntrmyAgt1"),
        _currencies(F.col("xml")),
        _past_dates(dates, "BR-011", as_of),
        _check(text(header["MsgId"]).isNull(), _violation("BR-012")),
    )


def _sorted_references() -> Column:
    """End-to-end references of a message, sorted by value and then position.

    Sorting makes repeats neighbours, so finding them stays n log n even for a
    message with tens of thousands of transactions.
    """
    placed = F.transform("_refs", lambda v, i: F.struct(v.alias("v"), i.alias("i")))
    return F.sort_array(F.filter(placed, lambda s: s["v"].isNotNull()))


def _repeats() -> Column:
    """One violation per repeat of an end-to-end reference, in document order."""
    def again(refs: Column) -> Column:
        later = F.slice(refs, F.lit(2), F.size(refs))
        pairs = F.arrays_zip(
            later.alias("this"), F.slice(refs, F.lit(1), F.size(later)).alias("before")
        )
        return F.filter(pairs, lambda p: p["this"]["v"] == p["before"]["v"])

    ordered = F.sort_array(
        F.transform(bound(_sorted_references(), again), lambda p: F.struct(p["this"]["i"].alias("i"), p["this"]["v"].alias("v")))
    )
    # most messages repeat none, which needs no order
    repeated = F.size(F.array_distinct(F.col("_refs"))) < F.size(F.col("_refs"))
    return F.when(repeated, _some(F.transform(ordered, lambda s: _violation("BR-005", actual=s["v"])))).otherwise(_empty())


# --- the other message sets ------------------------------------------------


def _codes(reasons: Column) -> Column:
    return reasons["Rsn"]["Cd"]


def _absent(value: Column) -> Column:
    """Whether ``text`` gives nothing."""
    return F.coalesce(stripped(value), F.lit("")) == ""


def _joined(*arrays: Column) -> Column:
    empty = F.array().cast("array<string>")
    return F.concat(*[F.coalesce(a, empty) for a in arrays])


def _reasons_of(payments: Column, own: str, block: str) -> Column:
    """Codes of each payment, followed by those of its transactions."""
    return F.flatten(F.transform(
        payments, lambda p: _joined(_codes(p[own]), _codes(_flat(p[block][own])))
    ))


def _status_report() -> Column:
    groups, payments = F.col("body.OrgnlGrpInfAndSts"), F.col("body.OrgnlPmtInfAndSts")
    reasons = _joined(_codes(_flat(groups["StsRsnInf"])), _reasons_of(payments, "StsRsnInf", "TxInfAndSts"))
    return F.concat(
        _unknown(groups["GrpSts"], "BR-020", model.GROUP_STATUSES),
        _unknown(_flat(payments["TxInfAndSts"])["TxSts"], "BR-021", model.TX_STATUSES, listed=False),
        _unknown(reasons, "BR-022", model.STATUS_REASONS, listed=False),
        _each(groups["OrgnlMsgId"], _absent, lambda v: _violation("BR-023")),
    )


def _reversal() -> Column:
    payments, txs = F.col("body.OrgnlPmtInfAndRvsl"), F.col("_txs")
    reasons = _joined(_codes(F.col("body.OrgnlGrpInf.RvslRsnInf")), _reasons_of(payments, "RvslRsnInf", "TxInf"))
    # a cast to double trims by itself; what is blank counts as zero
    not_positive = F.filter(
        _present(txs["OrgnlInstdAmt"])["_VALUE"],
        lambda v: F.coalesce(v.try_cast("double") <= 0, _absent(v)),
    )
    return F.concat(
        _each_indexed(txs["OrgnlEndToEndId"], _absent, lambda v, n: _violation("BR-030", path=[n])),
        _unknown(reasons, "BR-031", model.REVERSAL_REASONS),
        _some(F.transform(not_positive, lambda v: _violation("BR-032", actual=F.coalesce(text(v), F.lit("0"))))),
        _currencies(F.col("xml")),
    )


def _prepare_debit(parsed: DataFrame) -> DataFrame:
    txs = _flat(F.transform(F.col("body.PmtInf"), lambda p: p["DrctDbtTxInf"]))
    ready = parsed.withColumn("_txs", txs)
    ready = ready.withColumn("_money", _money(_present(F.transform("_txs", lambda t: t["InstdAmt"]))))
    return ready.withColumn("_total", _sum(F.col("_money")))


def _direct_debit(as_of: Column, compat: bool) -> Column:
    header, payments, txs = F.col("body.GrpHdr"), F.col("body.PmtInf"), F.col("_txs")
    count = F.coalesce(F.array_size(txs), F.lit(0))
    declared, control = text(header["NbOfTxs"]), text(header["CtrlSum"])
    total = F.col("_total")
    stated = amounts.control_sum(control).cast(amounts.MONEY_SUM)
    tolerance = F.lit(model.CONTROL_SUM_TOLERANCE).cast("decimal(38,5)")

    def mandate(tx: Column) -> Column:
        direct = text(tx["MndtRltdInf"]["MndtId"])
        return direct if compat else F.coalesce(text(tx["DrctDbtTx"]["MndtRltdInf"]["MndtId"]), direct)

    return F.concat(
        _check(
            _is_integer(declared) & (declared.try_cast("bigint") != count),
            _violation(
                "BR-040",
                message=[declared.try_cast("bigint").cast("string"), count.cast("string")],
                actual=count.cast("string"), expected=declared.try_cast("bigint").cast("string"),
            ),
        ),
        _check(
            (F.size("_money") > 0) & (F.abs(stated - total) > tolerance),
            _violation(
                "BR-041",
                message=[amounts.plain(stated), amounts.plain(total)],
                actual=amounts.plain(total), expected=amounts.plain(stated),
            ),
        ),
        _each_indexed(txs, lambda t: mandate(t).isNull(), lambda t, n: _violation("BR-042", path=[n])),
        _ibans(F.transform(payments, lambda p: p["CdtrAcct"]["Id"]["IBAN"]), "BR-043", "CdtrAcct"),
        _ibans(F.transform(txs, lambda t: t["DbtrAcct"]["Id"]["IBAN"]), "BR-043", "DbtrAcct"),
        _bics(F.transform(payments, lambda p: p["CdtrAgt"]["FinInstnId"]["BICFI"]), "BR-044", "CdtrAgt"),
        _bics(F.transform(txs, lambda t: t["DbtrAgt"]["FinInstnId"]["BICFI"]), "BR-044", "DbtrAgt"),
        _currencies(F.col("xml")),
        _past_dates(F.transform(payments, lambda p: p["ReqdColltnDt"]), "BR-046", as_of),
    )


def _mandate_init() -> Column:
    blocks = F.col("body.Mndt")
    return F.concat(
        _blank(blocks["MndtReqId"], "BR-050"),
        _not_boolean(blocks["TrckgInd"], "BR-051"),
        _ibans(blocks["CdtrAcct"]["Id"]["IBAN"], "BR-052", "CdtrAcct"),
        _ibans(blocks["DbtrAcct"]["Id"]["IBAN"], "BR-052", "DbtrAcct"),
        _bics(blocks["CdtrAgt"]["FinInstnId"]["BICFI"], "BR-053", "CdtrAgt"),
        _bics(blocks["DbtrAgt"]["FinInstnId"]["BICFI"], "BR-053", "DbtrAgt"),
    )


def _mandate_amend() -> Column:
    blocks = F.col("body.UndrlygAmdmntDtls")
    return F.concat(
        _unknown(blocks["AmdmntRsn"]["Rsn"]["Cd"], "BR-060", model.AMENDMENT_REASONS),
        _blank(blocks["Mndt"]["MndtId"], "BR-061"),
    )


def _mandate_cancel() -> Column:
    blocks = F.col("body.UndrlygCxlDtls")
    return F.concat(
        _unknown(blocks["CxlRsn"]["Rsn"]["Cd"], "BR-070", model.CANCELLATION_REASONS),
        _blank(blocks["OrgnlMndt"]["OrgnlMndtId"], "BR-071"),
    )


def _mandate_accept(compat: bool) -> Column:
    blocks = F.col("body.UndrlygAccptncDtls")

    def reason(block: Column) -> Column:
        deep = text(block["AccptncRslt"]["RjctRsn"]["Rsn"]["Cd"])
        return deep if compat else F.coalesce(text(block["AccptncRslt"]["RjctRsn"]["Cd"]), deep)

    return F.concat(
        _not_boolean(blocks["AccptncRslt"]["Accptd"], "BR-080"),
        _each(
            blocks,
            lambda b: F.lower(text(b["AccptncRslt"]["Accptd"])).isin("false", "0") & reason(b).isNull(),
            lambda b: _violation("BR-081"),
        ),
    )


def _mandate_copy() -> Column:
    return _blank(F.col("body.UndrlygCpyReqDtls")["OrgnlMndt"]["OrgnlMndtId"], "BR-090")


def _mandate_suspend() -> Column:
    blocks = F.col("body.UndrlygSspnsnDtls")
    return F.concat(
        _unknown(blocks["SspnsnRsn"]["Rsn"]["Cd"], "BR-100", model.SUSPENSION_REASONS),
        _blank(blocks["OrgnlMndt"]["OrgnlMndtId"], "BR-101"),
    )


# --- entry points ----------------------------------------------------------

_TX = "PmtInf.CdtTrfTxInf"
#: the elements that the rules of credit transfers (001) read, for ``corpus.parse``
CREDIT_READS = (
    "GrpHdr.MsgId", "GrpHdr.NbOfTxs", "GrpHdr.CtrlSum",
    "PmtInf.NbOfTxs", "PmtInf.CtrlSum", "PmtInf.ReqdExctnDt", "PmtInf.DbtrAcct", "PmtInf.DbtrAgt",
    f"{_TX}.PmtId.EndToEndId", f"{_TX}.PmtId.UETR", f"{_TX}.Amt.InstdAmt._VALUE", f"{_TX}.IntrmyAgt1", f"{_TX}.CdtrAgt",
    f"{_TX}.CdtrAcct", f"{_TX}.ReqdExctnDt",
)
#: message set -> elements that its rules read, for ``corpus.parse``; currencies are read from the text
READS: dict[str, tuple[str, ...]] = {
    "002": ("OrgnlGrpInfAndSts", "OrgnlPmtInfAndSts"),
    "007": (
        "OrgnlGrpInf", "OrgnlPmtInfAndRvsl.RvslRsnInf", "OrgnlPmtInfAndRvsl.TxInf.OrgnlEndToEndId",
        "OrgnlPmtInfAndRvsl.TxInf.OrgnlInstdAmt._VALUE", "OrgnlPmtInfAndRvsl.TxInf.RvslRsnInf",
    ),
    "009": ("Mndt.MndtReqId", "Mndt.TrckgInd", "Mndt.CdtrAcct", "Mndt.CdtrAgt", "Mndt.DbtrAcct", "Mndt.DbtrAgt"),
    "010": ("UndrlygAmdmntDtls",), "011": ("UndrlygCxlDtls",), "012": ("UndrlygAccptncDtls.AccptncRslt",),
    "017": ("UndrlygCpyReqDtls",), "018": ("UndrlygSspnsnDtls",),
}


def with_violations(
    parsed: DataFrame, message_set: str, as_of: Column | None = None, compat: bool = False
) -> DataFrame:
    """Add ``violations`` to parsed messages of one set; unknown sets have no rules.

    ``compat`` keeps the element paths that do not exist in the published
    schemas (mandate id, rejection reason, activation transactions).
    """
    as_of = F.current_date() if as_of is None else as_of
    if message_set in ("001", "013"):
        ready = _prepare_credit(parsed, credit_blocks(message_set, compat))
    elif message_set == "008":
        ready = _prepare_debit(parsed)
    elif message_set == "007":
        ready = parsed.withColumn("_txs", _flat(F.col("body.OrgnlPmtInfAndRvsl")["TxInf"]))
    else:
        ready = parsed
    rule_sets = {
        "001": lambda: _credit_transfer(as_of), "013": lambda: _credit_transfer(as_of),
        "002": _status_report, "014": _status_report, "007": _reversal,
        "008": lambda: _direct_debit(as_of, compat), "009": _mandate_init,
        "010": _mandate_amend, "011": _mandate_cancel, "012": lambda: _mandate_accept(compat),
        "017": _mandate_copy, "018": _mandate_suspend,
    }
    build = rule_sets.get(message_set, _empty)
    # a projection is generated code but for its lambdas, a generator with a lambda is interpreted as a whole
    found = ready.withColumn("_found", build())
    return once(found, "violations", F.col("_found")).drop("_payments", "_txs", "_money", "_refs", "_total", "_found")


def violations(checked: DataFrame, *keys: str) -> DataFrame:
    """One row per violation."""
    rows = checked.select(*keys, F.explode_outer("violations").alias("v"))
    return rows.where("v IS NOT NULL").select(*keys, "v.*")
