"""Payment data derived from the star-schema tables.

The given tables hold no payment messages, so this module states how an order
becomes a message, a line item a transaction and an event a delivery.  It is
only a mapping; every operator applied afterwards lives in the library.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from girolens import model
from girolens.functions import ids
from girolens.functions.text import file_category, xml_escape
from girolens.operators.once import once
from girolens.operators.ranking import ensure_checkpoint_dir
from girolens.operators.routing import DUPLICATE, FRESH, TAMPERED, route
from girolens.sources.corpus import with_identity

AS_OF = "1998-01-01"

_SCHEMAS: dict[str, T.StructType] = {}


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One of the given tables; its footer is read once per process."""
    path = f"{folder}/{table}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _country(nation: str) -> str:
    """Two letters per nation key."""
    return f"concat(char(65 + pmod({nation}, 26)), char(65 + pmod({nation} * 7 + 3, 26)))"


def _iban(nation: str, key: str, balance: str) -> str:
    """Account number of a party; wrong check digits for negative balances."""
    letters = f"(pmod({nation}, 26) + 10) * 10000 + (pmod({nation} * 7 + 3, 26) + 10) * 100"
    rest = f"pmod(CAST({key} AS BIGINT) * 1000000 + {letters}, 97)"
    check = f"IF({balance} < 0, 99, 98) - {rest}"
    return f"concat({_country(nation)}, lpad(CAST({check} AS STRING), 2, '0'), lpad(CAST({key} AS STRING), 14, '0'))"


_PREFIX = {
    "1-URGENT": "gen-pass-", "2-HIGH": "gen-fail-", "3-MEDIUM": "gen-edge-", "4-NOT SPECIFIED": "gen-passage-",
}
_CURRENCY = {"AUTOMOBILE": "EUR", "BUILDING": "USD", "FURNITURE": "GBP", "MACHINERY": "XXQ"}


def _quoted(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _mapped(column: str, values: dict[str, str], other: str | None = None) -> str:
    whens = " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in values.items())
    return f"CASE {column} {whens} ELSE {_quoted(other)} END"


def currency_of(segment: str) -> Column:
    return F.expr(_mapped(segment, _CURRENCY))


_ORDER_FILE = f"concat({_mapped('o_orderpriority', _PREFIX, 'manual-')}, o_orderkey, '.xml')"


def _raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their debtor, joined before any line multiplies the rows."""
    orders, customer = read(spark, folder, "orders"), read(spark, folder, "customer")
    nation = read(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    debtor = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    return orders.join(debtor, orders.o_custkey == debtor.c_custkey)


def _header_columns() -> list[str]:
    country = _country("c_nationkey")
    return [
        "o_orderkey",
        f"{_ORDER_FILE} AS file_name",
        "element_at(array('001', '002', '007', '008', '013'), n_regionkey + 1) AS message_set",
        "concat('M', o_orderkey) AS msg_id",
        "pmod(o_orderkey, 7) + 1 AS nb_txs_declared",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS ctrl_sum",
        "c_name AS initiating_party",
        "CAST(o_orderdate AS DATE) AS order_date",
        "o_orderdate AS order_ts",
        "c_name AS debtor_name",
        f"{country} AS debtor_country",
        f"{_iban('c_nationkey', 'c_custkey', 'c_acctbal')} AS debtor_iban",
        f"""CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal > 9000 THEN concat('B1NK', {country}, '22')
            ELSE concat('GIRO', {country}, lpad(CAST(pmod(c_custkey, 90) AS STRING), 2, '0')) END AS debtor_bic""",
        f"{_mapped('c_mktsegment', _CURRENCY)} AS currency",
        "CASE o_orderstatus WHEN 'F' THEN 'fail' WHEN 'O' THEN 'pass' END AS outcome",
    ]


CREDITOR, KIND = "creditor", "kind"


def _line_columns(sides: tuple[str, ...]) -> list[str]:
    reference = "concat(l_orderkey, '-', l_linenumber)"
    digest = f"md5(concat({reference}, '-', l_partkey))"
    country = _country("s_nationkey")
    creditor = [
        "s_name AS creditor_name",
        f"{country} AS creditor_country",
        f"{_iban('s_nationkey', 's_suppkey', 's_acctbal')} AS creditor_iban",
        f"concat('BENE', {country}, '33XXX') AS creditor_bic",
    ]
    kind = ["IF(l_tax >= 0.02D, substring(p_type, 1, 4), NULL) AS purpose_code", "p_size <= 25 AS coded"]
    return [
        *(creditor if CREDITOR in sides else []),
        *(kind if KIND in sides else []),
        f"{reference} AS end_to_end_id",
        "concat('P', l_orderkey, '-', l_linestatus) AS pmt_inf_id",
        "CASE l_linestatus WHEN 'O' THEN 'TRF' WHEN 'F' THEN 'CHK' END AS pmt_method",
        "concat(l_partkey, '-', l_suppkey) AS instr_id",
        "l_discount >= 0.05D AS tracked",
        f"""IF(l_discount >= 0.05D, regexp_replace({digest},
             '^(.{{8}})(.{{4}}).(.{{3}}).(.{{3}})(.{{12}}).*$',
             IF(l_discount > 0.09D, '$1-$2-1$3-a$4-$5', '$1-$2-4$3-a$4-$5')), NULL) AS uetr""",
        "CAST(l_extendedprice AS DECIMAL(18,2)) AS amount",
        "l_tax >= 0.08D AS equivalent",
        "CASE l_returnflag WHEN 'A' THEN 'SHAR' WHEN 'R' THEN 'DEBT' END AS charge_bearer",
        "l_tax >= 0.04D AS remitted",
        f"IF(l_tax >= 0.04D, concat('Invoice ', {reference}), NULL) AS remittance",
    ]


def order_headers(spark: SparkSession, folder: str) -> DataFrame:
    """One message header per order, with its debtor."""
    return _raw_orders(spark, folder).selectExpr(*_header_columns())


def order_lines(
    spark: SparkSession, folder: str, sides: tuple[str, ...] = (CREDITOR, KIND)
) -> DataFrame:
    """Transactions of every order; an order without lines keeps one empty row.

    Raw columns are joined first and texts are made from them afterwards, so the
    shuffles carry keys and numbers rather than texts.  The optimizer cannot know
    that a left join to a dimension keeps the rows as they are, so a query names
    the ``sides`` it reads and no other dimension is joined.
    """
    lines = read(spark, folder, "lineitem")
    if CREDITOR in sides:
        supplier = read(spark, folder, "supplier")
        lines = lines.join(supplier, lines.l_suppkey == supplier.s_suppkey, "left")
    if KIND in sides:
        part = read(spark, folder, "part")
        lines = lines.join(part, lines.l_partkey == part.p_partkey, "left")
    orders = _raw_orders(spark, folder)
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
    return joined.selectExpr(*_header_columns(), *_line_columns(sides))


_REAL = "end_to_end_id IS NOT NULL"


def _prefix(iban: str) -> str:
    return f"upper(substring({iban}, 1, 2))"


def _bank_country(bic: str) -> str:
    return f"upper(substring({bic}, 5, 2))"


def _available(lines: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Projection without the columns of dimensions that were not joined."""
    absent = set()
    if "creditor_iban" not in lines.columns:
        absent |= {"creditor_name", "creditor_country", "creditor_iban_prefix", "creditor_bic",
                   "creditor_bic_country", "creditor_pfx"}
    if "purpose_code" not in lines.columns:
        absent |= {"purpose_code", "purpose"}
    kept = [f"{expression} AS {name}" for name, expression in columns.items() if name not in absent]
    return lines.withColumn("category", file_category(F.col("file_name"))).selectExpr(*kept)


def _if_real(expression: str) -> str:
    return f"IF({_REAL}, {expression}, NULL)"


def tx_001(lines: DataFrame) -> DataFrame:
    """The 27-column transaction table, straight from the tables."""
    header = ["msg_id", "nb_txs_declared", "ctrl_sum", "initiating_party"]
    plain = ["charge_bearer", "creditor_name", "creditor_country"]
    return _available(lines, {
        "file_name": "file_name",
        "category": "category",
        **{c: _if_real(c) for c in header},
        "pmt_inf_id": "pmt_inf_id",
        "pmt_method": "pmt_method",
        "req_exec_date": _if_real("CAST(order_date AS STRING)"),
        "debtor_name": _if_real("debtor_name"),
        "debtor_country": _if_real("debtor_country"),
        "debtor_iban_prefix": _if_real(_prefix("debtor_iban")),
        "debtor_bic": _if_real("debtor_bic"),
        "debtor_bic_country": _if_real(_bank_country("debtor_bic")),
        "end_to_end_id": "end_to_end_id",
        "instr_id": "instr_id",
        "has_uetr": "tracked",
        "amount": "amount",
        "currency": _if_real("currency"),
        **{c: c for c in plain},
        "creditor_iban_prefix": _prefix("creditor_iban"),
        "creditor_bic": "creditor_bic",
        "creditor_bic_country": _bank_country("creditor_bic"),
        "purpose_code": "purpose_code",
        "has_remittance_info": "remitted",
    })


def payment_detail(lines: DataFrame) -> DataFrame:
    """Short form of the transactions (instructed amounts and coded purposes only)."""
    return _available(lines, {
        "file_name": "file_name",
        "category": "category",
        "pmt_method": "pmt_method",
        "debtor_pfx": _if_real(_prefix("debtor_iban")),
        "debtor_bic": _if_real("debtor_bic"),
        "amount": "IF(NOT equivalent, amount, NULL)",
        "currency": "IF(NOT equivalent, currency, NULL)",
        "creditor_pfx": _prefix("creditor_iban"),
        "charge_bearer": "charge_bearer",
        "purpose": "IF(coded, purpose_code, NULL)",
        "has_uetr": "coalesce(tracked, false)",
    })


def direct_debit_detail(lines: DataFrame) -> DataFrame:
    """Direct debits: the supplier collects from the customer."""
    return lines.withColumn("category", file_category(F.col("file_name"))).selectExpr(
        "file_name",
        "category",
        "amount",
        f"{_if_real('currency')} AS currency",
        f"{_prefix('creditor_iban')} AS debtor_pfx",
        f"{_if_real(_prefix('debtor_iban'))} AS creditor_pfx",
    )


def order_base(headers: DataFrame) -> DataFrame:
    return headers.select(
        "file_name", "message_set", file_category(F.col("file_name")).alias("category"), "msg_id"
    )


def order_state(headers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Processed and sent tables of the orders; open orders were never processed."""
    sent_at = F.col("order_ts")
    sent = headers.select(
        "file_name", F.lit("001").alias("message_set"), F.col("msg_id").alias("message_id"), sent_at.alias("sent_at")
    )
    seconds = F.make_dt_interval(secs=F.col("nb_txs_declared").cast("decimal(18,6)") * 37)
    processed = headers.where("outcome IS NOT NULL").select(
        "file_name",
        F.lit("001").alias("message_set"),
        F.col("msg_id").alias("message_id"),
        F.col("outcome").alias("validation_status"),
        (sent_at + seconds).alias("processed_at"),
        F.when(F.col("outcome") == "fail", F.concat(F.lit("[BR-001] order "), "msg_id")).alias("error_detail"),
    )
    return processed, sent


# --- XML -------------------------------------------------------------------


def _element(name: str, value: Column) -> Column:
    """Element, or nothing for NULL."""
    return F.coalesce(F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>")), F.lit(""))


def _wrap(name: str, *parts: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), *parts, F.lit(f"</{name}>"))


def _money(name: str, value: Column, currency: Column) -> Column:
    attribute = F.coalesce(F.concat(F.lit(' Ccy="'), currency, F.lit('"')), F.lit(""))
    return F.concat(F.lit(f"<{name}"), attribute, F.lit(">"), value.cast("string"), F.lit(f"</{name}>"))


def _account(name: str, iban: Column) -> Column:
    return F.coalesce(_wrap(name, _wrap("Id", F.concat(F.lit("<IBAN>"), iban, F.lit("</IBAN>")))), F.lit(""))


def _agent(name: str, bic: Column) -> Column:
    return F.coalesce(
        _wrap(name, _wrap("FinInstnId", F.concat(F.lit("<BICFI>"), bic, F.lit("</BICFI>")))), F.lit("")
    )


def _header(count: Column) -> Column:
    return _wrap(
        "GrpHdr",
        _element("MsgId", F.col("msg_id")),
        _element("NbOfTxs", count.cast("string")),
        _element("CtrlSum", F.col("ctrl_sum").cast("string")),
        _wrap("InitgPty", _element("Nm", xml_escape(F.col("initiating_party")))),
    )


def _credit_fragment() -> Column:
    currency = F.col("currency")
    amount = F.when(
        F.col("equivalent"),
        _wrap("EqvtAmt", _money("Amt", F.col("amount"), F.lit("EUR")), _element("CcyOfTrf", currency)),
    ).otherwise(_money("InstdAmt", F.col("amount"), currency))
    purpose = F.coalesce(
        F.when(F.col("coded"), _wrap("Purp", F.concat(F.lit("<Cd>"), F.col("purpose_code"), F.lit("</Cd>"))))
        .otherwise(_wrap("Purp", F.concat(F.lit("<Prtry>"), F.col("purpose_code"), F.lit("</Prtry>")))),
        F.lit(""),
    )
    return _wrap(
        "CdtTrfTxInf",
        _wrap(
            "PmtId", _element("InstrId", F.col("instr_id")), _element("EndToEndId", F.col("end_to_end_id")),
            _element("UETR", F.col("uetr")),
        ),
        _wrap("Amt", amount),
        _element("ChrgBr", F.col("charge_bearer")),
        _agent("CdtrAgt", F.col("creditor_bic")),
        _wrap(
            "Cdtr", _element("Nm", xml_escape(F.col("creditor_name"))),
            F.coalesce(_wrap("PstlAdr", F.concat(F.lit("<Ctry>"), F.col("creditor_country"), F.lit("</Ctry>"))), F.lit("")),
        ),
        _account("CdtrAcct", F.col("creditor_iban")),
        purpose,
        F.coalesce(_wrap("RmtInf", F.concat(F.lit("<Ustrd>"), F.col("remittance"), F.lit("</Ustrd>"))), F.lit("")),
    )


def _debit_fragment() -> Column:
    return _wrap(
        "DrctDbtTxInf",
        _wrap("PmtId", _element("EndToEndId", F.col("end_to_end_id"))),
        _money("InstdAmt", F.col("amount"), F.col("currency")),
        _wrap("DrctDbtTx", _wrap("MndtRltdInf", _element("MndtId", F.col("instr_id")))),
        _agent("DbtrAgt", F.col("creditor_bic")),
        _wrap("Dbtr", _element("Nm", xml_escape(F.col("creditor_name")))),
        _account("DbtrAcct", F.col("creditor_iban")),
    )


_HEADER_COLUMNS = [
    "o_orderkey", "file_name", "msg_id", "nb_txs_declared", "ctrl_sum", "initiating_party", "order_date",
    "debtor_name", "debtor_country", "debtor_iban", "debtor_bic",
]


def messages(lines: DataFrame, message_set: str = "001") -> DataFrame:
    """XML messages of orders, of any size.

    Payments of one order are split by method; stated payment totals are right
    for transfers and fixed wrong figures for cheques.
    """
    credit = message_set == "001"
    fragment = _credit_fragment() if credit else _debit_fragment()
    # made in a step of its own: inside of the aggregate it is interpreted, and the sort carries what it is made from
    texts = once(lines, "fragment", F.when(F.col("end_to_end_id").isNotNull(), fragment))
    payments = texts.groupBy(*_HEADER_COLUMNS, "pmt_inf_id", "pmt_method").agg(
        F.array_join(F.sort_array(F.collect_list("fragment")), "").alias("txs"),
        F.count("end_to_end_id").alias("n"),
        F.sum(F.when(~F.col("equivalent"), F.col("amount"))).alias("total"),
    )
    transfer = F.col("pmt_method") == "TRF"
    if credit:
        body = _wrap(
            "PmtInf",
            _element("PmtInfId", F.col("pmt_inf_id")),
            _element("PmtMtd", F.col("pmt_method")),
            _element("NbOfTxs", F.when(transfer, F.col("n").cast("string")).otherwise("2")),
            _element("CtrlSum", F.when(transfer, F.col("total").cast("string")).otherwise("50000.00")),
            _wrap("ReqdExctnDt", _element("Dt", F.col("order_date").cast("string"))),
            _wrap("Dbtr", _element("Nm", xml_escape(F.col("debtor_name"))), _wrap("PstlAdr", _element("Ctry", F.col("debtor_country")))),
            _account("DbtrAcct", F.col("debtor_iban")),
            _agent("DbtrAgt", F.col("debtor_bic")),
            F.col("txs"),
        )
        root, namespace = "CstmrCdtTrfInitn", "urn:iso:std:iso:20022:tech:xsd:pain.001.001.13"
    else:
        body = _wrap(
            "PmtInf",
            _element("PmtInfId", F.col("pmt_inf_id")),
            _element("ReqdColltnDt", F.col("order_date").cast("string")),
            _account("CdtrAcct", F.col("debtor_iban")),
            _agent("CdtrAgt", F.col("debtor_bic")),
            F.col("txs"),
        )
        root, namespace = "CstmrDrctDbtInitn", "urn:iso:std:iso:20022:tech:xsd:pain.008.001.12"
    whole = payments.groupBy(*_HEADER_COLUMNS).agg(
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("pmt_inf_id").isNotNull(), body))), "").alias("payments")
    )
    return whole.select(
        F.lit("pain").alias("domain"),
        F.lit(message_set).alias("message_set"),
        "file_name",
        file_category(F.col("file_name")).alias("category"),
        F.concat(
            F.lit(f'<Document xmlns="{namespace}"><{root}>'), _header(F.col("nb_txs_declared")),
            F.col("payments"), F.lit(f"</{root}></Document>"),
        ).alias("xml"),
    )


def flat_rules_input(lines: DataFrame) -> DataFrame:
    """Lines in the column layout of the flat rule form."""
    transfer = F.col("pmt_method") == "TRF"
    # a window stays in the partitions of the order key, a join with the totals would move all texts once more
    payment = Window.partitionBy("o_orderkey", "pmt_inf_id")
    counted = F.count("end_to_end_id").over(payment)
    found = F.col("o_orderkey").isNotNull() & F.col("pmt_inf_id").isNotNull() & (F.col("_count") > 0)
    real = F.col("end_to_end_id").isNotNull()
    totals = lines.select(
        "*", counted.alias("_count"), F.sum(F.when(real & ~F.col("equivalent"), F.col("amount"))).over(payment).alias("_sum")
    ).select("*", F.when(found, F.col("_count")).alias("_n"), F.when(found, F.col("_sum")).alias("_total"))
    return totals.select(
        "file_name", "msg_id",
        F.col("nb_txs_declared").alias("declared"),
        "ctrl_sum", "pmt_inf_id",
        F.when(transfer, F.col("_n")).otherwise(F.when(real, 2)).alias("pmt_declared"),
        F.when(transfer, F.col("_total")).otherwise(F.when(real, F.lit("50000.00").cast("decimal(18,2)"))).alias("pmt_ctrl_sum"),
        F.col("order_date").alias("req_exec_date"),
        F.when(real, F.col("debtor_iban")).alias("debtor_iban"),
        F.when(real, F.col("debtor_bic")).alias("debtor_bic"),
        real.alias("real"), "end_to_end_id", "uetr",
        F.when(~F.col("equivalent"), F.col("amount")).alias("instd_amount"),
        F.when(real, F.when(F.col("equivalent"), "EUR").otherwise(F.col("currency"))).alias("ccy"),
        "creditor_iban", "creditor_bic", F.lit(None).cast("string").alias("intermediary_bic"),
    )


# --- detail tables of the other message sets --------------------------------


def _choice(position: Column, values: list[str | None]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), position)


# Fixed stand-in codes, chosen by position in the list.
STATUS_CODES = ["AC01", "AC04", "AM05", "BE01", "MD01", "NARR", "XX99"]
REVERSAL_CODES = ["DUPL", "FRAD", "TECH", "CUST", "UPAY", "ZZ99", None]
PRIORITY_CODES = {
    "amendment_reason": ["MD01", "MD02", "AM05", "ZZ01", None],
    "cancellation_reason": ["CUST", "DUPL", "ZZ02", None, "NARR"],
    "suspension_reason": ["SSPD", "CUST", None, "ZZ03", "NARR"],
    "rejection_reason": ["AC01", "AC04", "MD01", None, "NARR"],
}
TRACKING = {"AUTOMOBILE": "true", "BUILDING": "false", "FURNITURE": "1", "MACHINERY": "0"}


def _group_status() -> Column:
    return F.expr(_mapped("o_orderstatus", {"F": "RJCT", "O": "ACCP", "P": "PEND"}))


def _tx_status() -> Column:
    return F.expr(_mapped("l_returnflag", {"A": "ACSP", "R": "RJCT", "N": "WAIT"}))


def _status_reason() -> Column:
    return F.when(F.col("l_returnflag") == "R", _choice(F.col("l_linenumber"), STATUS_CODES))


def status_detail(spark: SparkSession, folder: str) -> DataFrame:
    """Group rows from orders, transaction rows from line items."""
    none = F.lit(None).cast("string")
    groups = read(spark, folder, "orders").select(
        _group_status().alias("grp_status"), none.alias("tx_status"), none.alias("reason_code")
    )
    txs = read(spark, folder, "lineitem").select(
        none.alias("grp_status"), _tx_status().alias("tx_status"), _status_reason().alias("reason_code")
    )
    return groups.unionByName(txs)


def reversal_detail(spark: SparkSession, folder: str) -> DataFrame:
    return _reversal_rows(read(spark, folder, "lineitem"))


def _reversal_rows(lines: DataFrame, *keys: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return lines.select(
        *keys,
        (price * F.col("l_quantity").cast("int")).cast("decimal(18,2)").alias("orig_amount"),
        F.expr(_mapped("l_returnflag", {"A": "EUR", "R": "USD"})).alias("currency"),
        _choice(F.col("l_linenumber"), REVERSAL_CODES).alias("reversal_reason"),
    )


def mandate_detail(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "customer").select(
        F.expr(_mapped("c_mktsegment", TRACKING)).alias("tracking_ind"),
        F.expr(_country("c_nationkey")).alias("creditor_pfx"),
    )


def reason_detail(spark: SparkSession, folder: str, column: str) -> DataFrame:
    position = F.substring("o_orderpriority", 1, 1).cast("int")
    return read(spark, folder, "orders").select(_choice(position, PRIORITY_CODES[column]).alias(column))


def accept_detail(spark: SparkSession, folder: str) -> DataFrame:
    position = F.substring("o_orderpriority", 1, 1).cast("int")
    status = F.col("o_orderstatus")
    return read(spark, folder, "orders").select(
        F.when(status == "F", "true").when(status == "O", "false").alias("accepted"),
        F.when(status == "O", _choice(position, PRIORITY_CODES["rejection_reason"])).alias("rejection_reason"),
    )


def copy_detail(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "orders").select(
        F.concat(F.lit("MND"), F.col("o_custkey").cast("string")).alias("orig_mandate_id")
    )


def customer_ibans(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "customer").selectExpr(
        "c_custkey", f"{_iban('c_nationkey', 'c_custkey', 'c_acctbal')} AS iban"
    )


# --- XML of the other message sets -------------------------------------------


def _document(message_set: str, *body: Column) -> Column:
    root = model.LAYOUTS[message_set][0]
    head = F.lit(f'<Document xmlns="urn:iso:std:iso:20022:tech:xsd:pain.{message_set}.001"><{root}>')
    return F.concat(head, *body, F.lit(f"</{root}></Document>"))


def _as_messages(rows: DataFrame, message_set: str, xml: Column) -> DataFrame:
    return rows.select(
        F.lit("pain").alias("domain"), F.lit(message_set).alias("message_set"), "file_name",
        file_category(F.col("file_name")).alias("category"), xml.alias("xml"),
    )


def _optional(name: str, inner: Column) -> Column:
    """Element around text that may be NULL; then the element is left out."""
    return F.coalesce(F.concat(F.lit(f"<{name}>"), inner, F.lit(f"</{name}>")), F.lit(""))


def _reason(name: str, code: Column) -> Column:
    return _optional(name, F.concat(F.lit("<Rsn><Cd>"), code, F.lit("</Cd></Rsn>")))


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    """Raw orders with their raw lines."""
    orders, line = read(spark, folder, "orders"), read(spark, folder, "lineitem")
    joined = orders.join(line, orders.o_orderkey == line.l_orderkey, "left")
    return joined.withColumn("file_name", F.expr(_ORDER_FILE))


def _line_messages(items: DataFrame, message_set: str, head: Column, block: str, fragment: Column) -> DataFrame:
    """One message per order, of any size."""
    # made in a step of its own, as in ``messages``
    texts = once(items, "fragment", F.when(F.col("l_orderkey").isNotNull(), fragment))
    grouped = texts.groupBy("o_orderkey", "file_name", "o_orderstatus", "o_orderpriority").agg(
        F.array_join(F.sort_array(F.collect_list("fragment")), "").alias("txs")
    )
    return _as_messages(grouped, message_set, _document(message_set, head, _wrap(block, F.col("txs"))))


def status_messages(items: DataFrame) -> DataFrame:
    """Payment status reports; low-priority orders lack the original reference."""
    key = F.concat(F.lit("M"), F.col("o_orderkey").cast("string"))
    head = _wrap(
        "OrgnlGrpInfAndSts",
        _element("OrgnlMsgId", F.when(F.col("o_orderpriority") != "5-LOW", key)),
        _element("GrpSts", _group_status()),
    )
    # generated code takes an element at NULL of an array without NULLs for its last one
    reason = F.when(F.col("l_linenumber").isNotNull(), _status_reason())
    fragment = _wrap("TxInfAndSts", _element("TxSts", _tx_status()), _reason("StsRsnInf", reason))
    return _line_messages(items, "002", head, "OrgnlPmtInfAndSts", fragment)


def status_rows(items: DataFrame) -> DataFrame:
    """Status rows of orders too large for one message."""
    none = F.lit(None).cast("string")
    name = ["file_name", file_category(F.col("file_name")).alias("category")]
    groups = items.select(*name, _group_status().alias("grp_status"), none.alias("tx_status"), none.alias("reason_code")).distinct()
    txs = items.where("l_orderkey IS NOT NULL").select(
        *name, none.alias("grp_status"), _tx_status().alias("tx_status"), _status_reason().alias("reason_code")
    )
    return groups.unionByName(txs)


def reversal_messages(items: DataFrame) -> DataFrame:
    """Reversals; the last line number lacks the original reference."""
    rows = _reversal_rows(items, "o_orderkey", "file_name", "o_orderstatus", "o_orderpriority", "l_orderkey", "l_linenumber")
    reference = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    fragment = _wrap(
        "TxInf",
        _element("OrgnlEndToEndId", F.when(F.col("l_linenumber") < 7, reference)),
        _money("OrgnlInstdAmt", F.col("orig_amount"), F.col("currency")),
        _reason("RvslRsnInf", F.col("reversal_reason")),
    )
    return _line_messages(rows, "007", F.lit(""), "OrgnlPmtInfAndRvsl", fragment)


def reversal_rows(items: DataFrame) -> DataFrame:
    rows = _reversal_rows(items, "file_name")
    return rows.withColumn("category", file_category(F.col("file_name")))


def mandate_messages(spark: SparkSession, folder: str, message_set: str) -> DataFrame:
    """Mandate messages: initiations from customers, all others from orders."""
    if message_set == "009":
        customer = read(spark, folder, "customer").withColumn(
            "file_name", F.concat(F.lit("gen-pass-"), F.col("c_custkey").cast("string"), F.lit(".xml"))
        )
        iban = F.expr(_iban("c_nationkey", "c_custkey", "c_acctbal"))
        request = F.when(F.col("c_acctbal") < 0, " ").otherwise(F.concat(F.lit("R"), F.col("c_custkey").cast("string")))
        xml = _document("009", _wrap(
            "Mndt", _element("MndtReqId", request), _element("TrckgInd", F.expr(_mapped("c_mktsegment", TRACKING))),
            _account("CdtrAcct", iban),
        ))
        return _as_messages(customer, "009", xml)
    orders = read(spark, folder, "orders").withColumn("file_name", F.expr(_ORDER_FILE))
    position = F.substring("o_orderpriority", 1, 1).cast("int")
    mandate = F.when(F.col("o_orderstatus") == "P", " ").otherwise(F.concat(F.lit("MND"), F.col("o_custkey").cast("string")))
    original = _wrap("OrgnlMndt", _element("OrgnlMndtId", mandate))

    def code(column: str) -> Column:
        return _choice(position, PRIORITY_CODES[column])

    status = F.col("o_orderstatus")
    bodies = {
        "010": lambda: _wrap("UndrlygAmdmntDtls", _reason("AmdmntRsn", code("amendment_reason")), _wrap("Mndt", _element("MndtId", mandate))),
        "011": lambda: _wrap("UndrlygCxlDtls", _reason("CxlRsn", code("cancellation_reason")), original),
        "012": lambda: _wrap(
            "UndrlygAccptncDtls",
            _wrap(
                "AccptncRslt",
                _element("Accptd", F.when(status == "F", "true").when(status == "O", "false")),
                F.when(status == "O", _optional("RjctRsn", F.concat(F.lit("<Cd>"), code("rejection_reason"), F.lit("</Cd>")))).otherwise(""),
            ),
        ),
        "017": lambda: _wrap("UndrlygCpyReqDtls", original),
        "018": lambda: _wrap("UndrlygSspnsnDtls", _reason("SspnsnRsn", code("suspension_reason")), original),
    }
    return _as_messages(orders, message_set, _document(message_set, bodies[message_set]()))


# --- a corpus of all sets -----------------------------------------------------

#: the set of a customer's message, by the remainder of the key; the last one has no layout
MIXED_SETS = [*model.MESSAGE_SETS, "999"]
CUT_SHORT = 17  # every so many messages are not well-formed


def mixed_messages(spark: SparkSession, folder: str) -> DataFrame:
    """One message per customer, of the set that the key chooses; rules fire by key, balance, segment and nation."""
    key = F.col("c_custkey")
    amount = F.col("c_acctbal").cast("decimal(18,2)")
    number = F.concat(F.lit("M"), key.cast("string"))

    def blank(every: int, rest: int = 0) -> Column:
        return F.when(key % every == rest, F.lit(" ")).otherwise(number)

    header = _wrap("GrpHdr", _element("MsgId", blank(5)), _element("NbOfTxs", F.lit("1")), _element("CtrlSum", amount.cast("string")))

    def credit(block: str, twice: Column) -> Column:
        one = _wrap(block, _wrap("PmtId", _element("EndToEndId", number)), _wrap("Amt", _money("InstdAmt", amount, F.lit("EUR"))))
        return F.concat(header, _wrap("PmtInf", one, F.when(twice, one).otherwise("")))

    status = F.concat(
        _wrap("OrgnlGrpInfAndSts", _element("OrgnlMsgId", number), _element("GrpSts", F.when(key % 4 == 0, "XXXX").otherwise("ACCP"))),
        _wrap("OrgnlPmtInfAndSts", _wrap("TxInfAndSts", _element("TxSts", F.when(key % 3 == 0, "YYYY").otherwise("ACSP")))),
    )
    original = _wrap("OrgnlMndt", _element("OrgnlMndtId", blank(2, 1)))
    bodies = {
        "001": credit("CdtTrfTxInf", F.lit(False)),
        "002": status,
        "007": _wrap("OrgnlPmtInfAndRvsl", _wrap("TxInf", _element("OrgnlEndToEndId", number), _money("OrgnlInstdAmt", amount, F.lit("EUR")))),
        "008": F.concat(header, _wrap("PmtInf", _wrap(
            "DrctDbtTxInf", _money("InstdAmt", amount, F.lit("EUR")), _wrap("DrctDbtTx", _wrap("MndtRltdInf", _element("MndtId", blank(2, 1))))))),
        "009": _wrap(
            "Mndt", _element("MndtReqId", number),
            _element("TrckgInd", F.when(F.col("c_mktsegment") == "AUTOMOBILE", "maybe").otherwise("true")),
            _agent("CdtrAgt", F.when(F.col("c_nationkey") % 2 == 0, "GIRODE22").otherwise("short")),
        ),
        "010": _wrap("UndrlygAmdmntDtls", _wrap("Mndt", _element("MndtId", blank(2, 1)))),
        "011": _wrap("UndrlygCxlDtls", original),
        "012": _wrap("UndrlygAccptncDtls", _wrap("AccptncRslt", _element("Accptd", F.when(key % 3 == 0, "yes").otherwise("true")))),
        "013": credit("CdtTrfTx", key % 3 == 0),
        "014": status,
        "017": _wrap("UndrlygCpyReqDtls", original),
        "018": _wrap("UndrlygSspnsnDtls", original),
    }
    turn = F.pmod(key, F.lit(len(MIXED_SETS))).cast("int")
    xml = F.lit("<Document/>")
    for place, message_set in enumerate(model.MESSAGE_SETS):
        xml = F.when(turn == place, _document(message_set, bodies[message_set])).otherwise(xml)
    xml = F.when(key % CUT_SHORT == 0, F.substring(xml, 1, 30)).otherwise(xml)
    rows = read(spark, folder, "customer").select(
        F.lit("pain").alias("domain"), _choice(turn + 1, MIXED_SETS).alias("message_set"),
        F.concat(F.lit("gen-pass-"), key.cast("string"), F.lit(".xml")).alias("file_name"), F.encode(xml, "UTF-8").alias("content"),
    )
    return with_identity(rows)


# --- deliveries -------------------------------------------------------------

# Fixed error texts, one per class of error, chosen by position.
ERROR_TEXTS: list[str | None] = [
    "Element '{urn:x}ChrgBr': [facet 'enumeration'] The value 'ABCD' is not an element of the set.",
    "Element '{urn:x}IBAN': [facet 'pattern'] The value 'x1' is not accepted by the pattern '[A-Z]{2}'.",
    "Element '{urn:x}Nm': [facet 'maxLength'] The value has a length of 200; this exceeds the allowed maximum length of 140.",
    "Element '{urn:x}MsgId': [facet 'minLength'] The value has a length of 0; this underruns the allowed minimum length of 1.",
    "Element '{urn:x}InstdAmt': [facet 'minInclusive'] The value '-1' is less than the minimum value allowed ('0').",
    "Element '{urn:x}CtrlSum': [facet 'totalDigits'] The value '1234567890123456789' has more digits than are allowed ('18').",
    "Element '{urn:x}InstdAmt': [facet 'fractionDigits'] The value '1.123456' has more fractional digits than are allowed ('5').",
    "Element '{urn:x}PmtInf': Missing child element(s). Expected is ( {urn:x}ReqdExctnDt ).",
    "Element '{urn:x}Cdtr': This element is not expected. Expected is ( {urn:x}CdtrAcct ).",
    "XML syntax error: Opening and ending tag mismatch",
    "Element '{urn:x}Amt': The attribute 'Ccy' is required but missing.",
    "[BR-001] Declared NbOfTxs (5) does not match actual transaction count (3)",
    "Element '{urn:x}NbOfTxs': 'abc' is not a valid value of the atomic type 'xs:string'.",
    None,
]
EVENT_SETS = {"click": "001", "view": "002", "purchase": "008", "signup": "009", "error": "013"}
LOST_BELOW, FAILED_ABOVE = 5, 60
BAD_DIGEST = (20, 23)
NO_DIGEST = (23, 24)
WARNED = (40, 60)


def deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """One delivery per event; equal content has an equal id."""
    texts = ", ".join(_quoted(text) for text in ERROR_TEXTS)
    failed = f"value > {FAILED_ABOVE}"
    return read(spark, folder, "events").selectExpr(
        "*", r"CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k"
    ).selectExpr(
        "event_id",
        "ts AS sent_at",
        "timestampadd(MILLISECOND, CAST(round(value * 1000) AS BIGINT), ts) AS received_at",
        "sha2(concat_ws('|', event_type, user_id, props), 256) AS message_id",
        "'pain' AS domain",
        f"{_mapped('event_type', EVENT_SETS)} AS message_set",
        """concat(CASE WHEN k < 30 THEN 'gen-pass-' WHEN k < 50 THEN 'gen-fail-' WHEN k < 60 THEN 'gen-edge-'
                  WHEN k < 70 THEN 'gen-passage' ELSE 'case-' END, user_id, '-', k, '.xml') AS file_name""",
        f"NOT (value >= {BAD_DIGEST[0]} AND value < {NO_DIGEST[1]}) AS sound",
        f"value >= {LOST_BELOW} AS received",
        f"IF({failed}, 'fail', 'pass') AS validation_status",
        f"IF({failed}, element_at(array({texts}), pmod(k, {len(ERROR_TEXTS)}) + 1), NULL) AS error_detail",
        "k",
        f"value BETWEEN {WARNED[0]} AND {WARNED[1]} AS warned",
    )


_POSITION = ["sent_at", "event_id"]


def sent_messages(all_deliveries: DataFrame) -> DataFrame:
    """First delivery of every id; a minimum, so hot ids combine before the shuffle."""
    first = all_deliveries.groupBy("message_id").agg(
        F.min(F.struct(*_POSITION, "domain", "message_set", "file_name")).alias("f")
    )
    return first.select(
        "message_id", "f.domain", "f.message_set", "f.file_name",
        ids.topic_name(F.col("f.domain"), F.col("f.message_set")).alias("kafka_topic"), "f.sent_at",
    )


def routed(all_deliveries: DataFrame) -> DataFrame:
    return route(all_deliveries.where("received"), None, _POSITION, F.col("sound"))


def state(spark: SparkSession, folder: str, once: bool = False) -> dict[str, DataFrame]:
    """The five state tables that the deliveries lead to.

    ``once`` routes the deliveries a single time and keeps the result in the
    checkpoint folder, for queries that read several of the tables.
    """
    everything = deliveries(spark, folder)
    flow = routed(everything)
    if once:
        ensure_checkpoint_dir(flow)
        flow = flow.checkpoint()
    fresh = flow.where(F.col("route") == FRESH)
    kept = ["message_id", "domain", "message_set", "file_name"]
    processed = fresh.select(
        *kept, "validation_status", F.col("received_at").alias("processed_at"), "error_detail",
        F.when(F.col("validation_status") == "fail", "iso20022.dlq").alias("dlq_topic"), "k", "warned",
    )
    return {
        "sent_messages": sent_messages(everything),
        "processed_messages": processed,
        "duplicate_events": flow.where(F.col("route") == DUPLICATE).select(
            *kept, F.col("received_at").alias("detected_at")
        ),
        "tampered_messages": flow.where(F.col("route") == TAMPERED).select(
            *kept, F.col("received_at").alias("detected_at"), F.lit("iso20022.tampered").alias("tampered_topic")
        ),
        "rule_violations": rule_violations(processed),
    }


def rule_violations(processed: DataFrame) -> DataFrame:
    """Rule hits of processed messages: errors explain failures, warnings pass."""
    ruled = F.coalesce(F.col("error_detail").startswith("[BR-"), F.lit(False))

    def hit(when: Column, rule: str, severity: str, path: str, message: str) -> Column:
        return F.when(
            when,
            F.struct(
                F.lit(rule).alias("rule_id"), F.lit(severity).alias("severity"),
                F.lit(path).alias("field_path"), F.lit(message).alias("message"),
            ),
        )

    hits = F.array(
        hit(ruled, "BR-001", "ERROR", "GrpHdr/NbOfTxs", "count differs"),
        hit(ruled & (F.col("k") > 50), "BR-008", "ERROR", "DbtrAcct/Id/IBAN", "check digits"),
        hit(F.col("warned"), "BR-011", "WARNING", "PmtInf/ReqdExctnDt/Dt", "date in the past"),
    )
    return processed.select(
        "message_id", "message_set", "file_name",
        F.explode(F.filter(hits, lambda h: h.isNotNull())).alias("v"),
    ).select("message_id", "message_set", "file_name", "v.*")


# --- deliveries as a stream ----------------------------------------------------

_STREAM_SET = "CASE event_type WHEN 'signup' THEN '018' WHEN 'error' THEN '010' ELSE '017' END"
_STREAM_XML = (
    "concat('<Document><', root, '><', block, '><OrgnlMndt><OrgnlMndtId>', IF(k < 10, ' ', concat(user_id, '-', k)), "
    "'</OrgnlMndtId></OrgnlMndt>', IF(k BETWEEN 10 AND 14, '<Extra/>', ''), '</', block, '></', root, '><!-- ', event_type, ' ', "
    "props, ' --></Document>')"
)


def stream_records(spark: SparkSession, folder: str) -> DataFrame:
    """Received events as topic records: mandate copies and suspensions, some damaged, and a set without a schema.

    The content depends on type, user and properties, so repeated events are
    repeated messages; blank mandate ids break a rule, extra elements the schema.
    """
    rows = read(spark, folder, "events").where(F.col("value") >= LOST_BELOW).selectExpr(
        "*", "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k"
    ).selectExpr("*", f"{_STREAM_SET} AS message_set").selectExpr(
        "*", "IF(message_set = '018', 'MndtSspnsnReq', 'MndtCpyReq') AS root",
        "IF(message_set = '018', 'UndrlygSspnsnDtls', 'UndrlygCpyReqDtls') AS block",
    ).selectExpr("*", f"{_STREAM_XML} AS xml")
    content = F.encode("xml", "UTF-8")
    value = F.col("value")
    altered = (value >= BAD_DIGEST[0]) & (value < BAD_DIGEST[1])
    dropped = (value >= NO_DIGEST[0]) & (value < NO_DIGEST[1])
    signature = F.when(dropped, "").when(altered, "altered").otherwise(ids.content_digest(content))
    payload = F.struct(
        ids.content_id(F.lit("pain"), F.col("message_set"), content).alias("message_id"),
        F.lit("pain").alias("domain"),
        F.col("message_set"),
        F.concat(F.col("message_set"), F.lit(".xsd")).alias("schema_name"),
        F.concat(F.lit("gen-pass-"), F.col("event_id").cast("string"), F.lit(".xml")).alias("file_name"),
        F.col("ts").cast("string").alias("sent_at"),
        F.col("xml").alias("xml_content"),
        signature.alias("signature"),
    )
    return rows.select(
        payload["message_id"].alias("key"),
        F.to_json(payload).alias("value"),
        ids.topic_name(F.lit("pain"), F.col("message_set")).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
