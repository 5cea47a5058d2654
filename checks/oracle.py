"""The same results in ANSI SQL, for an independent engine over the same tables.

The text starts from the tables every time; nothing is shared with the Spark
side but the fixed texts and codes of the demo mapping.
"""

from __future__ import annotations

from girolens import demo


def _q(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _country(nation: str) -> str:
    return f"(chr(CAST({nation} % 26 + 65 AS INT)) || chr(CAST(({nation} * 7 + 3) % 26 + 65 AS INT)))"


def _iban(nation: str, key: str, balance: str) -> str:
    rest = (
        f"((CAST({key} AS HUGEINT) * 1000000 + ({nation} % 26 + 10) * 10000 "
        f"+ (({nation} * 7 + 3) % 26 + 10) * 100) % 97)"
    )
    return (
        f"({_country(nation)} || lpad(CAST(CASE WHEN {balance} < 0 THEN 99 - {rest} ELSE 98 - {rest} END AS VARCHAR), 2, '0') "
        f"|| lpad(CAST({key} AS VARCHAR), 14, '0'))"
    )


def _case(column: str, mapping: dict, other: str = "NULL") -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in mapping.items())
    return f"CASE {column} {whens} ELSE {other} END"


def _pick(position: str, values: list) -> str:
    whens = " ".join(f"WHEN {i + 1} THEN {_q(v)}" for i, v in enumerate(values))
    return f"CASE {position} {whens} END"


HDR = f"""
hdr AS (
  SELECT o_orderkey,
    {_case('o_orderpriority', {'1-URGENT': 'gen-pass-', '2-HIGH': 'gen-fail-', '3-MEDIUM': 'gen-edge-', '4-NOT SPECIFIED': 'gen-passage-'}, "'manual-'")}
      || o_orderkey || '.xml' AS file_name,
    {_case('o_orderpriority', {'1-URGENT': 'gen-pass', '2-HIGH': 'gen-fail', '3-MEDIUM': 'gen-edge', '4-NOT SPECIFIED': 'gen-pass'}, "'hand-crafted'")} AS category,
    CASE n_regionkey WHEN 0 THEN '001' WHEN 1 THEN '002' WHEN 2 THEN '007' WHEN 3 THEN '008' WHEN 4 THEN '013' END AS message_set,
    'M' || o_orderkey AS msg_id, 1 + o_orderkey % 7 AS nb_txs_declared,
    CAST(o_totalprice AS DECIMAL(18,2)) AS ctrl_sum, c_name AS initiating_party,
    CAST(o_orderdate AS DATE) AS order_date, o_orderdate AS order_ts, c_name AS debtor_name,
    {_country('c_nationkey')} AS debtor_country,
    {_iban('c_nationkey', 'c_custkey', 'c_acctbal')} AS debtor_iban,
    CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal > 9000 THEN 'B1NK' || {_country('c_nationkey')} || '22'
         ELSE 'GIRO' || {_country('c_nationkey')} || lpad(CAST(c_custkey % 90 AS VARCHAR), 2, '0') END AS debtor_bic,
    {_case('c_mktsegment', {'AUTOMOBILE': 'EUR', 'BUILDING': 'USD', 'FURNITURE': 'GBP', 'MACHINERY': 'XXQ'})} AS currency,
    CASE o_orderstatus WHEN 'F' THEN 'fail' WHEN 'O' THEN 'pass' END AS outcome,
    o_orderpriority, o_orderstatus, o_custkey
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
)"""

LINES = HDR + f""",
lines AS (
  SELECT hdr.*, l_orderkey IS NOT NULL AS filled,
    'P' || l_orderkey || '-' || l_linestatus AS pmt_inf_id,
    CASE l_linestatus WHEN 'O' THEN 'TRF' WHEN 'F' THEN 'CHK' END AS pmt_method,
    l_orderkey || '-' || l_linenumber AS end_to_end_id, l_partkey || '-' || l_suppkey AS instr_id,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_tax >= 0.08 AS equivalent,
    CASE l_returnflag WHEN 'A' THEN 'SHAR' WHEN 'R' THEN 'DEBT' END AS charge_bearer,
    l_discount >= 0.05 AS uetr_given, l_discount > 0.09 AS uetr_bad,
    s_name AS creditor_name, {_country('s_nationkey')} AS creditor_country,
    {_iban('s_nationkey', 's_suppkey', 's_acctbal')} AS creditor_iban,
    CASE WHEN s_acctbal < 0 THEN 1 ELSE 0 END AS creditor_iban_bad,
    'BENE' || {_country('s_nationkey')} || '33XXX' AS creditor_bic,
    CASE WHEN l_tax >= 0.02 THEN substr(p_type, 1, 4) END AS purpose_code, p_size <= 25 AS coded,
    l_tax >= 0.04 AS remitted
  FROM hdr LEFT JOIN (
    SELECT * FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN part ON p_partkey = l_partkey
  ) ON l_orderkey = o_orderkey
)"""

TX = LINES + """,
tx AS (
  SELECT file_name, category,
    CASE WHEN filled THEN msg_id END AS msg_id, CASE WHEN filled THEN nb_txs_declared END AS nb_txs_declared,
    CASE WHEN filled THEN ctrl_sum END AS ctrl_sum, CASE WHEN filled THEN initiating_party END AS initiating_party,
    pmt_inf_id, pmt_method, CASE WHEN filled THEN strftime(order_date, '%Y-%m-%d') END AS req_exec_date,
    CASE WHEN filled THEN debtor_name END AS debtor_name, CASE WHEN filled THEN debtor_country END AS debtor_country,
    CASE WHEN filled THEN substr(debtor_iban, 1, 2) END AS debtor_iban_prefix,
    CASE WHEN filled THEN debtor_bic END AS debtor_bic,
    CASE WHEN filled THEN substr(debtor_bic, 5, 2) END AS debtor_bic_country,
    end_to_end_id, instr_id, uetr_given AS has_uetr, amount, CASE WHEN filled THEN currency END AS currency,
    charge_bearer, creditor_name, creditor_country, substr(creditor_iban, 1, 2) AS creditor_iban_prefix,
    creditor_bic, substr(creditor_bic, 5, 2) AS creditor_bic_country, purpose_code,
    remitted AS has_remittance_info
  FROM lines
)"""

VIEW = TX + """,
processed AS (
  SELECT file_name, outcome AS validation_status, order_ts + to_seconds(CAST(nb_txs_declared * 37 AS BIGINT)) AS processed_at,
    CASE outcome WHEN 'fail' THEN '[BR-001] order ' || msg_id END AS error_detail
  FROM hdr WHERE outcome IS NOT NULL
),
sent AS (SELECT file_name, order_ts AS sent_at FROM hdr),
pipe AS (
  SELECT tx.*, validation_status, error_detail, processed_at, sent_at,
    epoch_ms(processed_at) - epoch_ms(sent_at) AS latency_ms
  FROM tx LEFT JOIN processed USING (file_name) LEFT JOIN sent USING (file_name)
)"""

DETAIL = LINES + """,
detail AS (
  SELECT file_name, category, pmt_method, CASE WHEN filled THEN substr(debtor_iban, 1, 2) END AS debtor_pfx,
    CASE WHEN filled THEN debtor_bic END AS debtor_bic,
    CASE WHEN NOT equivalent THEN amount END AS amount, CASE WHEN NOT equivalent THEN currency END AS currency,
    substr(creditor_iban, 1, 2) AS creditor_pfx, charge_bearer, CASE WHEN coded THEN purpose_code END AS purpose,
    coalesce(uetr_given, FALSE) AS has_uetr
  FROM lines
)"""

_BAD, _NONE, _WARN = demo.BAD_DIGEST, demo.NO_DIGEST, demo.WARNED
STATE = f"""
raw AS (
  SELECT event_id, ts, event_type, user_id, props, value,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events
),
del AS (
  SELECT event_id, ts AS sent_at, ts + to_milliseconds(CAST(round(value * 1000) AS BIGINT)) AS received_at,
    sha256(event_type || '|' || user_id || '|' || props) AS message_id, 'pain' AS domain,
    {_case('event_type', demo.EVENT_SETS)} AS message_set,
    CASE WHEN k < 30 THEN 'gen-pass-' WHEN k < 50 THEN 'gen-fail-' WHEN k < 60 THEN 'gen-edge-' WHEN k < 70 THEN 'gen-passage' ELSE 'case-' END
      || user_id || '-' || k || '.xml' AS file_name,
    value >= {_BAD[0]} AND value < {_NONE[1]} AS unsound, value >= {_NONE[0]} AND value < {_NONE[1]} AS unsigned,
    value >= {demo.LOST_BELOW} AS received,
    CASE WHEN value > {demo.FAILED_ABOVE} THEN 'fail' ELSE 'pass' END AS validation_status,
    CASE WHEN value > {demo.FAILED_ABOVE} THEN {_pick(f'k % {len(demo.ERROR_TEXTS)} + 1', demo.ERROR_TEXTS)} END AS error_detail,
    value BETWEEN {_WARN[0]} AND {_WARN[1]} AS warned, k
  FROM raw
),
sent AS (
  SELECT * FROM del QUALIFY row_number() OVER (PARTITION BY message_id ORDER BY sent_at, event_id) = 1
),
flow AS (
  SELECT *, CASE
      WHEN count(*) FILTER (WHERE NOT unsound) OVER (
        PARTITION BY message_id ORDER BY sent_at, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 0 THEN 'duplicate'
      WHEN unsound THEN 'tampered' ELSE 'fresh' END AS route
  FROM del WHERE received
),
processed AS (SELECT *, received_at AS processed_at FROM flow WHERE route = 'fresh'),
duplicates AS (SELECT *, received_at AS detected_at FROM flow WHERE route = 'duplicate'),
tampered AS (SELECT *, received_at AS detected_at FROM flow WHERE route = 'tampered'),
violations AS (
  SELECT message_id, message_set, 'BR-001' AS rule_id, 'ERROR' AS severity, 'GrpHdr/NbOfTxs' AS field_path, 'count differs' AS message
  FROM processed WHERE error_detail LIKE '[BR-%'
  UNION ALL SELECT message_id, message_set, 'BR-008', 'ERROR', 'DbtrAcct/Id/IBAN', 'check digits'
  FROM processed WHERE error_detail LIKE '[BR-%' AND k > 50
  UNION ALL SELECT message_id, message_set, 'BR-011', 'WARNING', 'PmtInf/ReqdExctnDt/Dt', 'date in the past'
  FROM processed WHERE warned
),
pairs AS (
  SELECT s.*, p.processed_at, epoch_ms(p.processed_at) - epoch_ms(s.sent_at) AS latency_ms
  FROM sent s JOIN processed p USING (message_id)
)"""


def _money(column: str, name: str, fn: str = "sum") -> str:
    if fn == "avg":
        return f"round(CAST(sum({column}) AS DOUBLE) / count({column}), 2) AS {name}"
    return f"round(CAST({fn}({column}) AS DOUBLE), 2) AS {name}"


def _pct(part: str, whole: str, name: str, digits: int = 1) -> str:
    return f"round(100.0 * CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0), {digits}) AS {name}"


def _ladder(column: str, steps, topmost: str) -> str:
    whens = " ".join(f"WHEN {column} < {bound} THEN {_q(label)}" for bound, label in steps)
    return f"CASE {whens} ELSE {_q(topmost)} END"


def _classes(column: str, rules, fallback: str) -> str:
    whens = " ".join(
        "WHEN " + " OR ".join(f"contains({column}, {_q(m)})" for m in markers) + f" THEN {_q(label)}"
        for markers, label in rules
    )
    return f"CASE {whens} ELSE {_q(fallback)} END"


CREDIT_BUCKET = _ladder("amount", [(100, "< 100"), (1000, "100 – 999"), (10000, "1k – 9,999"), (100000, "10k – 99,999"), (1000000, "100k – 999,999")], "≥ 1M")


def _report_bucket(column: str) -> str:
    return _ladder(column, [(1000, "< 1,000"), (10000, "1k – 9,999"), (100000, "10k – 99,999"), (1000000, "100k – 999,999")], "1M – 10M")


# Fixed values, written out here so that a wrong one in the library shows: classes of errors in the order in which
# their markers are tried, advice per kind of schema error ({0}, {1} are capture groups), names of the message sets.
TYPES = [(['is not expected'], 'Wrong element order / unexpected element'),
 (['Missing child element'], 'Missing required element'),
 (['not a valid value'], 'Invalid field value'),
 (['minLength', 'maxLength'], 'String length constraint'),
 (['pattern'], 'Pattern / regex mismatch'),
 (['facet'], 'Facet constraint violation')]
TYPES_SHORT = [(['is not expected'], 'Element order'),
 (['Missing child element'], 'Missing required'),
 (['not a valid value'], 'Invalid value'),
 (['minLength', 'maxLength'], 'Length constraint'),
 (['pattern'], 'Pattern mismatch'),
 (['facet'], 'Facet violation')]
CATEGORIES = [(["facet 'enumeration'"], 'Invalid enumeration value'),
 (["facet 'pattern'"], 'Pattern / format violation'),
 (["facet 'maxLength'"], 'String exceeds max length'),
 (["facet 'minLength'"], 'Empty required field'),
 (["facet 'minInclusive'"], 'Value below minimum'),
 (["facet 'totalDigits'"], 'Too many digits'),
 (["facet 'fractionDigits'"], 'Too many decimal places'),
 (['Missing child element'], 'Missing required element'),
 (['not expected'], 'Wrong element order'),
 (['XML syntax error'], 'XML syntax error'),
 (["attribute 'Ccy'"], 'Missing currency (Ccy) attribute')]
ADVICE = [('(?s)not expected.*Expected is[^{]*\\{[^}]+\\}(\\w+)',
  "Element is in the wrong position or misspelled. The schema expects '{0}' at this point — verify the element sequence in the XSD."),
 ("\\[facet 'enumeration'\\].*value '([^']+)' is not an element of the set",
  "'{0}' is not an allowed code for this field. Consult the schema enumeration. Common sets — ChargeBearerType: DEBT, CRED, SHAR, SLEV; "
  'PaymentMethod: TRF, CHK, TRA; ChequeType: CCHQ, CCCH, BCHQ, DRFT, ELDR; ExchangeRateType: SPOT, SALE, AGRD; Priority: NORM, HIGH.'),
 ("attribute 'Ccy'", "The 'Ccy' attribute is missing or invalid. Currency codes must be exactly 3 uppercase letters (e.g. EUR, USD, GBP)."),
 ("\\[facet 'pattern'\\].*not accepted by the pattern '([^']+)'",
  'Value does not match the required format pattern. Common issues — IBAN: 2 uppercase letters + 2 digits + 1-30 alphanumeric; BIC: 8 or 11 '
  "uppercase alphanumeric characters; UETR (UUID v4): third group must start with '4', fourth with '8', '9', 'a', or 'b'. Schema pattern: {0}"),
 ('Missing child element.*Expected is[^{]*\\{[^}]+\\}(\\w+)',
  "Required child element '{0}' is absent. Insert it in the correct sequence position within the parent element."),
 ("\\[facet 'minLength'\\].*length of 0", 'Field is empty but requires at least one character. Provide a non-empty value.'),
 ("\\[facet 'maxLength'\\].*length of (\\d+).*maximum.*?(\\d+)", 'Value is {0} characters — maximum allowed is {1}. Shorten the value.'),
 ("\\[facet 'minInclusive'\\].*value '([^']+)'.*minimum value.*'([^']+)'",
  "'{0}' is below the minimum allowed ({1}). Amounts and rates must be zero or positive."),
 ("\\[facet 'totalDigits'\\]", 'Too many digits in total. ISO 20022 amounts allow at most 18 digits in total.'),
 ("\\[facet 'fractionDigits'\\]", 'Too many decimal places. Amounts allow up to 5 decimal places; exchange rates allow up to 10.')]
ADVICE_FALLBACK = 'Review this element against the XSD definition. Check value format, length constraints, allowed codes, and element ordering.'
SET_LABELS = {'001': 'Customer Credit Transfer Initiation',
 '002': 'Customer Payment Status Report',
 '007': 'Customer Payment Reversal',
 '008': 'Customer Direct Debit Initiation',
 '009': 'Mandate Initiation Request',
 '010': 'Mandate Amendment Request',
 '011': 'Mandate Cancellation Request',
 '012': 'Mandate Acceptance Report',
 '013': 'Creditor Payment Activation Request',
 '014': 'Creditor Payment Activation Status Report',
 '017': 'Mandate Copy Request',
 '018': 'Mandate Suspension Request'}
STRICT = """CASE WHEN file_name LIKE 'gen-pass-%' THEN 'gen-pass' WHEN file_name LIKE 'gen-fail-%' THEN 'gen-fail'
  WHEN file_name LIKE 'gen-edge-%' THEN 'gen-edge' ELSE 'hand-crafted' END"""


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


def credit() -> dict[str, str]:
    return {
        "overview": _with(TX, f"""
            SELECT count(DISTINCT file_name) AS total_files, count(*) AS total_tx_rows, {_money('amount', 'avg_amount', 'avg')},
              {_money('amount', 'total_value')}, count(DISTINCT currency) AS currencies,
              count(*) FILTER (WHERE has_uetr) AS with_uetr, count(*) FILTER (WHERE has_remittance_info) AS with_remittance FROM tx"""),
        "category_outcome": _with(VIEW, f"""
            SELECT category, count(DISTINCT file_name) AS files,
              count(DISTINCT file_name) FILTER (WHERE validation_status = 'pass') AS pipeline_pass,
              count(DISTINCT file_name) FILTER (WHERE validation_status = 'fail') AS pipeline_fail,
              count(DISTINCT file_name) FILTER (WHERE validation_status IS NULL) AS not_sent,
              {_pct("count(DISTINCT file_name) FILTER (WHERE validation_status = 'pass')", "count(DISTINCT file_name) FILTER (WHERE validation_status IS NOT NULL)", 'pass_pct')}
            FROM pipe GROUP BY category"""),
        "currency_dist": _with(TX, f"""
            SELECT coalesce(currency, '(missing)') AS currency, count(*) AS tx_count, {_money('amount', 'total_value')},
              {_money('amount', 'min_amt', 'min')}, {_money('amount', 'max_amt', 'max')}, {_money('amount', 'avg_amt', 'avg')}
            FROM tx WHERE amount IS NOT NULL GROUP BY 1"""),
        "amount_buckets": _with(VIEW, f"""
            SELECT {CREDIT_BUCKET} AS bucket, count(*) AS tx_count, {_money('amount', 'avg_amount', 'avg')}, {_money('amount', 'total_value')}
            FROM pipe WHERE amount IS NOT NULL AND validation_status = 'pass' GROUP BY 1"""),
        "debtor_country": _with(TX, f"""
            SELECT coalesce(debtor_iban_prefix, '(unknown)') AS debtor_country, count(*) AS tx_count, {_money('amount', 'total_value')},
              count(DISTINCT creditor_iban_prefix) AS unique_dest_countries
            FROM tx WHERE amount IS NOT NULL GROUP BY 1 ORDER BY tx_count DESC, debtor_country LIMIT 15"""),
        "flow_matrix": _with(TX, f"""
            SELECT debtor_iban_prefix AS from_country, creditor_iban_prefix AS to_country, count(*) AS tx_count, {_money('amount', 'total_value')},
              CASE WHEN debtor_iban_prefix = creditor_iban_prefix THEN 'domestic' ELSE 'cross-border' END AS flow_type
            FROM tx WHERE amount IS NOT NULL AND debtor_iban_prefix IS NOT NULL AND creditor_iban_prefix IS NOT NULL
            GROUP BY ALL ORDER BY tx_count DESC, from_country, to_country LIMIT 20"""),
        "charge_bearer": _with(TX, f"""
            SELECT coalesce(charge_bearer, '(absent)') AS charge_bearer, count(*) AS tx_count,
              round(100.0 * count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 1) AS pct, {_money('amount', 'avg_amount', 'avg')} FROM tx GROUP BY 1"""),
        "payment_method": _with(TX, """
            SELECT coalesce(pmt_method, '(absent)') AS pmt_method, count(DISTINCT file_name) AS files, count(*) AS tx_count FROM tx GROUP BY 1"""),
        "purpose_code": _with(TX, f"""
            SELECT coalesce(purpose_code, '(none)') AS purpose_code, count(*) AS tx_count, {_money('amount', 'total_value')}
            FROM tx GROUP BY 1 ORDER BY tx_count DESC, purpose_code LIMIT 15"""),
        "enrichment_coverage": _with(TX, f"""
            SELECT category, count(*) AS tx_count, {_pct('count(*) FILTER (WHERE has_uetr)', 'count(*)', 'uetr_pct')},
              {_pct('count(*) FILTER (WHERE has_remittance_info)', 'count(*)', 'remittance_pct')},
              {_pct('count(purpose_code)', 'count(*)', 'purpose_pct')} FROM tx GROUP BY 1"""),
        "error_element": _with(STATE, """
            SELECT regexp_extract(error_detail, '[}]([A-Za-z]+)['':]', 1) AS failing_element, count(*) AS occurrence,
              round(100.0 * count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 1) AS pct_of_failures
            FROM processed WHERE message_set = '001' AND validation_status = 'fail' AND error_detail IS NOT NULL
            GROUP BY 1 ORDER BY occurrence DESC, failing_element LIMIT 12"""),
        "error_type_7": _with(STATE, f"""
            SELECT {_classes('error_detail', TYPES, 'Other')} AS error_type, count(*) AS count,
              round(100.0 * count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 1) AS pct
            FROM processed WHERE message_set = '001' AND validation_status = 'fail' GROUP BY 1"""),
        "declared_vs_actual": _with(VIEW, """
            SELECT category, validation_status, count(*) AS files, CAST(sum(declared) AS BIGINT) AS total_declared,
              CAST(sum(parsed) AS BIGINT) AS total_parsed, count(*) FILTER (WHERE declared <> parsed) AS mismatch_files
            FROM (SELECT file_name, category, validation_status, max(nb_txs_declared) AS declared, count(*) AS parsed FROM pipe GROUP BY ALL)
            GROUP BY ALL"""),
        "bank_country": _with(TX, """
            SELECT coalesce(debtor_bic_country, '(no BIC)') AS bank_country, count(*) AS tx_count, count(DISTINCT debtor_bic) AS unique_bics
            FROM tx GROUP BY 1 ORDER BY tx_count DESC, bank_country LIMIT 12"""),
        "high_value": _with(VIEW, """
            SELECT file_name, creditor_name, coalesce(creditor_iban_prefix, '??') AS cdtr_ctry, currency, round(CAST(amount AS DOUBLE), 2) AS amount,
              charge_bearer, coalesce(purpose_code, '—') AS purpose
            FROM pipe WHERE validation_status = 'pass' AND amount IS NOT NULL
            ORDER BY pipe.amount DESC, file_name, end_to_end_id, creditor_name LIMIT 10"""),
        "pipeline_view": _with(VIEW, """
            SELECT file_name, category, end_to_end_id, CAST(amount AS DOUBLE) AS amount, currency, validation_status, error_detail,
              strftime(processed_at, '%Y-%m-%d %H:%M:%S') AS processed_at, strftime(sent_at, '%Y-%m-%d %H:%M:%S') AS sent_at, latency_ms FROM pipe"""),
    }


SET_ERRORS = "FROM processed WHERE validation_status = 'fail' AND error_detail IS NOT NULL"
RANGE = "amount BETWEEN 0 AND 10000000"


def _codes(source: str, column: str, name: str, absent: str | None = None, share: bool = False, k: int | None = None) -> str:
    code = column if absent is None else f"coalesce({column}, {_q(absent)})"
    where = f"WHERE {column} IS NOT NULL" if absent is None else ""
    pct = ", round(100.0 * count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 1) AS pct" if share else ""
    limit = f"ORDER BY count DESC, {name} LIMIT {k}" if k else ""
    return f"SELECT {code} AS {name}, count(*) AS count{pct} FROM ({source}) AS t {where} GROUP BY 1 {limit}"


STATUS_SRC = f"""
  SELECT CASE o_orderstatus WHEN 'F' THEN 'RJCT' WHEN 'O' THEN 'ACCP' WHEN 'P' THEN 'PEND' END AS grp_status, NULL AS tx_status, NULL AS reason_code FROM orders
  UNION ALL SELECT NULL, CASE l_returnflag WHEN 'A' THEN 'ACSP' WHEN 'R' THEN 'RJCT' WHEN 'N' THEN 'WAIT' END,
    CASE WHEN l_returnflag = 'R' THEN {_pick('l_linenumber', demo.STATUS_CODES)} END FROM lineitem"""
REVERSAL_SRC = f"""
  SELECT CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS INT) AS DECIMAL(18,2)) AS orig_amount,
    CASE l_returnflag WHEN 'A' THEN 'EUR' WHEN 'R' THEN 'USD' END AS currency, {_pick('l_linenumber', demo.REVERSAL_CODES)} AS reversal_reason FROM lineitem"""
MANDATE_SRC = f"SELECT {_case('c_mktsegment', demo.TRACKING)} AS tracking_ind, {_country('c_nationkey')} AS creditor_pfx FROM customer"
PRIORITY = "CAST(substr(o_orderpriority, 1, 1) AS INT)"
ACCEPT_SRC = f"""
  SELECT CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' END AS accepted,
    CASE WHEN o_orderstatus = 'O' THEN {_pick(PRIORITY, demo.PRIORITY_CODES['rejection_reason'])} END AS rejection_reason FROM orders"""


def _reason_src(column: str) -> str:
    return f"SELECT {_pick(PRIORITY, demo.PRIORITY_CODES[column])} AS {column} FROM orders"


def dashboard() -> dict[str, str]:
    outcome = """SELECT message_set, count(*) FILTER (WHERE validation_status = 'pass') AS passed,
        count(*) FILTER (WHERE validation_status = 'fail') AS failed, count(*) AS total FROM processed GROUP BY 1"""
    out = {
        "dash_totals": _with(STATE, f"""
            SELECT count(DISTINCT file_name) AS files, count(*) AS processed, count(*) FILTER (WHERE validation_status = 'pass') AS passed,
              count(*) FILTER (WHERE validation_status = 'fail') AS failed,
              {_pct("count(*) FILTER (WHERE validation_status = 'pass')", 'count(*)', 'pass_rate')} FROM processed"""),
        "dash_set_outcome": _with(STATE, outcome),
        "dash_set_rate": _with(STATE, f"""
            SELECT message_set, passed AS pass_count, failed AS fail_count, total, {_pct('passed', 'total', 'pass_pct')} FROM ({outcome})"""),
        "dash_set_bars": _with(STATE, f"""
            SELECT message_set, passed, failed, total, round(100.0 * passed / CAST(max(total) OVER () AS DOUBLE), 1) AS passed_pct,
              round(100.0 * failed / CAST(max(total) OVER () AS DOUBLE), 1) AS failed_pct, {_pct('passed', 'total', 'pass_rate')} FROM ({outcome})"""),
        "set_status": _with(STATE, f"""
            SELECT message_set, passed, failed, {_pct('passed', '(passed + failed)', 'pass_rate')} FROM ({outcome})"""),
        "set_categories": _with(HDR, """
            SELECT s.message_set, c.category, count(hdr.o_orderkey) AS files
            FROM (SELECT DISTINCT message_set FROM hdr) s CROSS JOIN (VALUES ('gen-pass'), ('gen-fail'), ('gen-edge'), ('hand-crafted')) c(category)
            LEFT JOIN hdr ON hdr.message_set = s.message_set AND hdr.category = c.category GROUP BY ALL"""),
        "set_error_element": _with(STATE, f"""
            SELECT message_set, element, count FROM (
              SELECT message_set, regexp_extract(error_detail, '[}}]([A-Za-z]+)', 1) AS element, count(*) AS count {SET_ERRORS}
              GROUP BY 1, 2 HAVING element <> '')
            QUALIFY row_number() OVER (PARTITION BY message_set ORDER BY count DESC, element) <= 8"""),
        "set_error_type": _with(STATE, f"""
            SELECT message_set, {_classes('error_detail', TYPES_SHORT, 'Other')} AS error_type, count(*) AS count {SET_ERRORS} GROUP BY 1, 2"""),
        "pay_currency": _with(DETAIL, f"""
            SELECT currency, count(*) AS transactions, round(CAST(sum(amount) FILTER (WHERE {RANGE}) AS DOUBLE), 2) AS total_value,
              round(CAST(sum(amount) FILTER (WHERE {RANGE}) AS DOUBLE) / count(amount) FILTER (WHERE {RANGE}), 2) AS avg_amount
            FROM detail WHERE currency IS NOT NULL GROUP BY 1 ORDER BY transactions DESC, currency LIMIT 12"""),
        "pay_buckets": _with(DETAIL, f"""
            SELECT {_report_bucket('amount')} AS bucket, count(*) AS count, {_money('amount', 'avg_amount', 'avg')}
            FROM detail WHERE {RANGE} GROUP BY 1"""),
        "pay_corridors": _with(DETAIL, """
            SELECT debtor_pfx AS debtor, creditor_pfx AS creditor, CASE WHEN debtor_pfx = creditor_pfx THEN 'domestic' ELSE 'cross-border' END AS flow,
              count(*) AS count FROM detail WHERE debtor_pfx IS NOT NULL AND creditor_pfx IS NOT NULL GROUP BY ALL
            ORDER BY count DESC, debtor, creditor LIMIT 10"""),
        "pay_charge_bearer": _with(DETAIL, _codes("SELECT * FROM detail", "charge_bearer", "charge_bearer", "(absent)", True)),
        "status_group": _codes(STATUS_SRC, "grp_status", "group_status"),
        "status_tx": _codes(STATUS_SRC, "tx_status", "tx_status"),
        "status_reason": _codes(STATUS_SRC, "reason_code", "reason_code", k=10),
        "reversal_reason": _codes(REVERSAL_SRC, "reversal_reason", "reason", share=True),
        "reversal_currency": f"""
            SELECT currency, count(*) AS count, round(CAST(sum(orig_amount) FILTER (WHERE orig_amount BETWEEN 0 AND 10000000) AS DOUBLE), 2) AS total
            FROM ({REVERSAL_SRC}) WHERE currency IS NOT NULL GROUP BY 1""",
        "reversal_buckets": f"""
            SELECT {_report_bucket('orig_amount')} AS bucket, count(*) AS count FROM ({REVERSAL_SRC}) WHERE orig_amount BETWEEN 0 AND 10000000 GROUP BY 1""",
        "mandate_tracking": _codes(MANDATE_SRC, "tracking_ind", "tracking", "(absent)", True),
        "mandate_country": _codes(MANDATE_SRC, "creditor_pfx", "creditor_country", k=10),
        "mandate_acceptance": f"""
            SELECT accepted, count, CASE WHEN accepted IN ('true', 'false')
                THEN round(100.0 * count / CAST(sum(count) FILTER (WHERE accepted IN ('true', 'false')) OVER () AS DOUBLE), 0) END AS share_pct
            FROM (SELECT coalesce(accepted, '(absent)') AS accepted, count(*) AS count FROM ({ACCEPT_SRC}) GROUP BY 1)""",
        "mandate_rejection": _codes(ACCEPT_SRC, "rejection_reason", "rejection_reason"),
        "mandate_copy": "SELECT count(DISTINCT 'MND' || o_custkey) AS unique_mandate_ids FROM orders",
        "share_of_max": f"""
            SELECT group_status, count, round(100.0 * count / CAST(max(count) OVER () AS DOUBLE), 1) AS bar_pct
            FROM ({_codes(STATUS_SRC, 'grp_status', 'group_status')})""",
    }
    for message_set, column in (("010", "amendment_reason"), ("011", "cancellation_reason"), ("018", "suspension_reason")):
        out[f"reason_codes_{message_set}"] = _codes(_reason_src(column), column, "reason_code", share=True)
    return out


def _sec(expression: str, digits: int) -> str:
    return f"round(CAST({expression} AS DOUBLE) / 1000.0, {digits})"


def recon() -> dict[str, str]:
    breakdown = f"""
        SELECT s.message_set, count(*) AS total_sent, count(p.message_id) AS processed,
          count(*) FILTER (WHERE p.validation_status = 'pass') AS pass_count, count(*) FILTER (WHERE p.validation_status = 'fail') AS fail_count,
          count(*) - count(p.message_id) AS pending,
          coalesce(round(100.0 * CAST(count(*) FILTER (WHERE p.validation_status = 'pass') AS DOUBLE) / nullif(count(p.message_id), 0), 1), 0.0) AS pass_rate
        FROM sent s LEFT JOIN processed p USING (message_id) GROUP BY 1"""
    outcomes = f"SELECT {STRICT} AS test_category, validation_status, count(*) AS count FROM processed GROUP BY 1, 2"
    return {
        "schema_breakdown": _with(STATE, breakdown),
        "error_patterns": _with(STATE, f"""
            SELECT {_classes('error_detail', CATEGORIES, 'Other validation error')} AS error_category, count(*) AS occurrences,
              count(DISTINCT message_set) AS schemas_affected {SET_ERRORS} GROUP BY 1"""),
        "category_outcomes": _with(STATE, outcomes),
        "category_share": _with(STATE, f"""
            SELECT *, round(100.0 * count / CAST(sum(count) OVER (PARTITION BY test_category) AS DOUBLE), 1) AS pct FROM ({outcomes})"""),
        "unexpected_outcomes": _with(STATE, f"""
            SELECT *, (test_category IN ('gen-pass', 'gen-edge') AND validation_status = 'fail') OR (test_category = 'gen-fail' AND validation_status = 'pass') AS unexpected
            FROM ({outcomes})"""),
        "latency_by_schema": _with(STATE, f"""
            SELECT message_set, count(*) AS msg_count, {_sec('min(latency_ms)', 2)} AS min_sec,
              round(CAST(sum(latency_ms) AS DOUBLE) / count(*) / 1000.0, 2) AS avg_sec,
              {_sec('percentile_cont(0.95) WITHIN GROUP (ORDER BY latency_ms)', 2)} AS p95_sec, {_sec('max(latency_ms)', 2)} AS max_sec,
              CAST(epoch_ms(max(processed_at)) - epoch_ms(min(processed_at)) AS DOUBLE) AS receiver_span_ms
            FROM pairs GROUP BY 1"""),
        "latency_scatter": _with(STATE, f"""
            SELECT message_set, file_name, row_number() OVER (ORDER BY sent_at, message_id) AS seq_num, {_sec('latency_ms', 3)} AS latency_sec FROM pairs"""),
        "pipeline_timeline": _with(STATE, f"""
            SELECT {_sec('epoch_ms(max(sent_at)) - epoch_ms(min(sent_at))', 3)} AS sender_sec,
              {_sec('epoch_ms(min(processed_at)) - epoch_ms(max(sent_at))', 3)} AS wait_sec,
              {_sec('epoch_ms(max(processed_at)) - epoch_ms(min(processed_at))', 3)} AS receiver_sec, count(*) AS total_messages,
              round(count(*) * 1000.0 / nullif(CAST(epoch_ms(max(processed_at)) - epoch_ms(min(processed_at)) AS DOUBLE), 0), 0) AS throughput_per_sec FROM pairs"""),
        "tampered_by_set": _with(STATE, "SELECT domain || '.' || message_set AS schema_label, count(*) AS tampered_count FROM tampered GROUP BY 1"),
        "rule_violation_summary": _with(STATE, """
            SELECT rule_id, severity, count(*) AS total_violations, count(DISTINCT message_set) AS schemas_affected,
              count(DISTINCT message_id) AS messages_affected, min(field_path) AS sample_field, min(message) AS sample_message
            FROM violations GROUP BY 1, 2"""),
        "violation_severity_totals": _with(STATE, """
            SELECT count(*) FILTER (WHERE severity = 'ERROR') AS errors, count(*) FILTER (WHERE severity = 'WARNING') AS warnings FROM violations"""),
        "recon_summary": _with(STATE, """
            SELECT count(*) AS total_sent, count(*) FILTER (WHERE p.validation_status = 'pass') AS passed, count(*) FILTER (WHERE p.validation_status = 'fail') AS failed,
              count(*) FILTER (WHERE p.message_id IS NULL) AS not_processed, (SELECT count(*) FROM duplicates) AS duplicates, (SELECT count(*) FROM tampered) AS tampered,
              (SELECT count(*) FROM violations WHERE severity = 'ERROR') AS br_errors, (SELECT count(*) FROM violations WHERE severity = 'WARNING') AS br_warnings,
              count(*) FILTER (WHERE p.message_id IS NULL) = 0 AS fully_reconciled
            FROM sent s LEFT JOIN processed p USING (message_id)"""),
        "message_detail": _with(STATE, """
            SELECT s.message_id, s.file_name, s.domain || '.' || s.message_set AS schema_label, coalesce(p.validation_status, 'not_processed') AS status,
              strftime(p.processed_at, '%Y-%m-%d %H:%M:%S') AS processed_second, substr(p.error_detail, 1, 200) AS error
            FROM sent s LEFT JOIN processed p USING (message_id)"""),
        "report_cube": _with(STATE, f"""
            SELECT 'schema' AS set_id, s.message_set AS key, NULL AS status, count(*) AS sent, count(p.message_id) AS done, count(p.message_id) AS n,
              count(*) FILTER (WHERE p.validation_status = 'pass') AS passed, count(*) FILTER (WHERE p.validation_status = 'fail') AS failed, NULL::BIGINT AS sets,
              min(epoch_ms(s.sent_at)) FILTER (WHERE p.message_id IS NOT NULL) AS first_sent, max(epoch_ms(p.processed_at)) AS last_done
            FROM sent s LEFT JOIN processed p USING (message_id) GROUP BY 2
            UNION ALL
            SELECT 'all', NULL, NULL, count(s.message_id), count(*) FILTER (WHERE s.message_id = p.message_id), count(p.message_id),
              count(*) FILTER (WHERE s.message_id = p.message_id AND p.validation_status = 'pass'), count(*) FILTER (WHERE s.message_id = p.message_id AND p.validation_status = 'fail'),
              NULL, min(epoch_ms(s.sent_at)) FILTER (WHERE s.message_id = p.message_id), max(epoch_ms(p.processed_at)) FILTER (WHERE s.message_id = p.message_id)
            FROM sent s FULL JOIN processed p ON s.message_id = p.message_id
            UNION ALL
            SELECT 'error', {_classes('p.error_detail', CATEGORIES, 'Other validation error')}, NULL, count(s.message_id), count(s.message_id), count(*),
              0, count(s.message_id), count(DISTINCT p.message_set), min(epoch_ms(s.sent_at)), max(epoch_ms(p.processed_at)) FILTER (WHERE s.message_id IS NOT NULL)
            FROM processed p LEFT JOIN sent s ON s.message_id = p.message_id WHERE p.validation_status = 'fail' AND p.error_detail IS NOT NULL GROUP BY 2
            UNION ALL
            SELECT 'category', p.test_category, p.validation_status, count(s.message_id), count(s.message_id), count(*),
              count(s.message_id) FILTER (WHERE p.validation_status = 'pass'), count(s.message_id) FILTER (WHERE p.validation_status = 'fail'), NULL,
              min(epoch_ms(s.sent_at)), max(epoch_ms(p.processed_at)) FILTER (WHERE s.message_id IS NOT NULL)
            FROM (SELECT *, {STRICT} AS test_category FROM processed) p LEFT JOIN sent s ON s.message_id = p.message_id GROUP BY 2, 3
            UNION ALL SELECT 'tampered', domain || '.' || message_set, NULL, NULL, NULL, count(*), NULL, NULL, NULL, NULL, NULL FROM tampered GROUP BY 2
            UNION ALL SELECT 'severity', severity, NULL, NULL, NULL, count(*), NULL, NULL, NULL, NULL, NULL FROM violations GROUP BY 2
            UNION ALL SELECT 'duplicate', 'all', NULL, NULL, NULL, count(*), NULL, NULL, NULL, NULL, NULL FROM duplicates HAVING count(*) > 0"""),
        "duplicate_log": _with(STATE, """
            SELECT file_name, domain || '.' || message_set AS schema_label, substr(message_id, 1, 16) AS short_id,
              strftime(detected_at, '%Y-%m-%d %H:%M:%S') AS detected_second FROM duplicates"""),
        "tampered_log": _with(STATE, """
            SELECT file_name, domain || '.' || message_set AS schema_label, substr(message_id, 1, 16) AS short_id,
              strftime(detected_at, '%Y-%m-%d %H:%M:%S') AS detected_second, 'iso20022.tampered' AS tampered_topic FROM tampered"""),
        "pass_band": _with(STATE, f"""
            SELECT message_set, pass_rate, CASE WHEN pass_rate >= 80 THEN 'good' WHEN pass_rate >= 50 THEN 'fair' ELSE 'poor' END AS band FROM ({breakdown})"""),
        "recon_status": _with(STATE, """
            SELECT s.message_id, s.message_set, s.file_name, coalesce(p.validation_status, 'not_processed') AS status
            FROM sent s LEFT JOIN processed p USING (message_id)"""),
        "unprocessed": _with(STATE, "SELECT message_id, file_name FROM sent WHERE message_id NOT IN (SELECT message_id FROM processed)"),
        "dedup_antijoin": _with(STATE, "SELECT event_id, message_id FROM del WHERE message_id NOT IN (SELECT message_id FROM processed)"),
        "route": _with(STATE, "SELECT event_id, message_id, route FROM flow"),
        "integrity_split": _with(STATE, """
            SELECT event_id, CASE WHEN unsigned THEN 'missing signature' WHEN unsound THEN 'signature mismatch' ELSE 'ok' END AS integrity FROM del"""),
        "manifest_split": f"""
            SELECT event_id, CASE WHEN value < {_BAD[0]} THEN 'missing signature'
              WHEN CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 7 = 3 AND (event_id % 2 = 1 OR props || '!' NOT IN (SELECT props FROM events))
              THEN 'differs from manifest' ELSE 'ok' END AS integrity FROM events""",
        "adhoc_status_counts": _with(STATE, "SELECT validation_status, count(*) AS count FROM processed GROUP BY 1"),
        "adhoc_failed": _with(STATE, "SELECT file_name, message_set, error_detail FROM processed WHERE validation_status = 'fail'"),
        "adhoc_duplicates": _with(STATE, "SELECT file_name, strftime(detected_at, '%Y-%m-%d %H:%M:%S.%g') AS detected_at FROM duplicates"),
        "adhoc_tampered": _with(STATE, "SELECT file_name, message_set, strftime(detected_at, '%Y-%m-%d %H:%M:%S.%g') AS detected_at FROM tampered"),
    }


NAME = f"""{_case('o_orderpriority', {'1-URGENT': 'gen-pass-', '2-HIGH': 'gen-fail-', '3-MEDIUM': 'gen-edge-', '4-NOT SPECIFIED': 'gen-passage-'}, "'manual-'")} || o_orderkey || '.xml'"""
CATEGORY = _case('o_orderpriority', {'1-URGENT': 'gen-pass', '2-HIGH': 'gen-fail', '3-MEDIUM': 'gen-edge', '4-NOT SPECIFIED': 'gen-pass'}, "'hand-crafted'")
_TX_COLUMNS = """file_name, category, msg_id, nb_txs_declared, CAST(ctrl_sum AS DOUBLE) AS ctrl_sum, initiating_party, pmt_inf_id, pmt_method,
  req_exec_date, debtor_name, debtor_country, debtor_iban_prefix, debtor_bic, debtor_bic_country, end_to_end_id, instr_id, has_uetr,
  CAST(amount AS DOUBLE) AS amount, currency, charge_bearer, creditor_name, creditor_country, creditor_iban_prefix, creditor_bic,
  creditor_bic_country, purpose_code, has_remittance_info"""


def _iban_bad(column: str) -> str:
    """MOD 97 of an account number whose national part is all digits."""
    number = (
        f"CAST(substr({column}, 5) AS HUGEINT) * 1000000 + (ascii({column}) - 55) * 10000 "
        f"+ (ascii(substr({column}, 2, 1)) - 55) * 100 + CAST(substr({column}, 3, 2) AS INT)"
    )
    return f"(({number}) % 97 <> 1)"


def shredding() -> dict[str, str]:
    order_reason = "SELECT {name} AS file_name, {category} AS category, {code} AS {column} FROM orders"

    def reasons(column: str) -> str:
        return order_reason.format(name=NAME, category=CATEGORY, code=_pick(PRIORITY, demo.PRIORITY_CODES[column]), column=column)

    mandate = "CASE WHEN o_orderstatus <> 'P' THEN 'MND' || o_custkey END"
    return {
        "shred_001": _with(TX, f"SELECT {_TX_COLUMNS} FROM tx"),
        "shred_payment": _with(DETAIL, "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM detail"),
        "shred_direct_debit": _with(LINES, """
            SELECT file_name, category, CAST(amount AS DOUBLE) AS amount, CASE WHEN filled THEN currency END AS currency,
              substr(creditor_iban, 1, 2) AS debtor_pfx, CASE WHEN filled THEN substr(debtor_iban, 1, 2) END AS creditor_pfx FROM lines"""),
        "shred_status": f"""
            SELECT {NAME} AS file_name, {CATEGORY} AS category, CASE o_orderstatus WHEN 'F' THEN 'RJCT' WHEN 'O' THEN 'ACCP' WHEN 'P' THEN 'PEND' END AS grp_status,
              NULL AS tx_status, NULL AS reason_code FROM orders
            UNION ALL SELECT {NAME}, {CATEGORY}, NULL, CASE l_returnflag WHEN 'A' THEN 'ACSP' WHEN 'R' THEN 'RJCT' WHEN 'N' THEN 'WAIT' END,
              CASE WHEN l_returnflag = 'R' THEN {_pick('l_linenumber', demo.STATUS_CODES)} END FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
        "shred_reversal": f"""
            SELECT {NAME} AS file_name, {CATEGORY} AS category,
              CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS INT) AS DECIMAL(18,2)) AS DOUBLE) AS orig_amount,
              CASE l_returnflag WHEN 'A' THEN 'EUR' WHEN 'R' THEN 'USD' END AS currency, {_pick('l_linenumber', demo.REVERSAL_CODES)} AS reversal_reason
            FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
        "shred_mandate_init": f"""
            SELECT 'gen-pass-' || c_custkey || '.xml' AS file_name, 'gen-pass' AS category, {_case('c_mktsegment', demo.TRACKING)} AS tracking_ind,
              {_country('c_nationkey')} AS creditor_pfx, CAST(NULL AS VARCHAR) AS debtor_pfx FROM customer""",
        "shred_amend": reasons("amendment_reason"),
        "shred_cancel": reasons("cancellation_reason"),
        "shred_suspend": reasons("suspension_reason"),
        "shred_accept": f"""
            SELECT {NAME} AS file_name, {CATEGORY} AS category, CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' END AS accepted,
              CASE WHEN o_orderstatus = 'O' THEN {_pick(PRIORITY, demo.PRIORITY_CODES['rejection_reason'])} END AS rejection_reason FROM orders""",
        "shred_copy": f"SELECT {NAME} AS file_name, {CATEGORY} AS category, {mandate} AS orig_mandate_id FROM orders",
        "file_base": _with(HDR, "SELECT file_name, '001' AS message_set, category, msg_id FROM hdr"),
    }


def sections() -> dict[str, str]:
    """Counts per code over the shredded rows of a set; reasons and countries are cut at ten where the report does."""
    rows = shredding()

    def counts(query: str, dataset: str, column: str, absent: str | None = None, k: int | None = None) -> str:
        key, where = (column, f"WHERE {column} IS NOT NULL") if absent is None else (f"coalesce({column}, {_q(absent)})", "")
        cut = f" QUALIFY row_number() OVER (ORDER BY count(*) DESC, {key}) <= {k}" if k else ""
        return f"SELECT {_q(dataset)} AS dataset, {key} AS key, count(*) AS count FROM ({rows[query]}) {where} GROUP BY {key}{cut}"

    parts = {
        "002": [("shred_status", "group_status", "grp_status"), ("shred_status", "tx_status", "tx_status"), ("shred_status", "reason", "reason_code", None, 10)],
        "007": [("shred_reversal", "reason", "reversal_reason"), ("shred_reversal", "currency", "currency")],
        "009": [("shred_mandate_init", "tracking", "tracking_ind", "(absent)"), ("shred_mandate_init", "country", "creditor_pfx", None, 10)],
        "010": [("shred_amend", "reason", "amendment_reason")],
        "011": [("shred_cancel", "reason", "cancellation_reason")],
        "012": [("shred_accept", "acceptance", "accepted", "(absent)"), ("shred_accept", "rejection", "rejection_reason")],
        "018": [("shred_suspend", "reason", "suspension_reason")],
    }
    found = {f"section_{s}": " UNION ALL ".join(f"SELECT * FROM ({counts(*p)})" for p in own) for s, own in parts.items()}
    found["section_017"] = f"SELECT 'copies' AS dataset, 'all' AS key, count(DISTINCT orig_mandate_id) AS count FROM ({rows['shred_copy']})"
    return found


RULE_COUNTS = LINES + f""",
pmt AS (
  SELECT file_name, pmt_inf_id, any_value(pmt_method) AS pmt_method, count(*) AS n, sum(amount) FILTER (WHERE NOT equivalent) AS total,
    count(*) FILTER (WHERE NOT equivalent) AS priced, any_value(debtor_iban) AS debtor_iban, any_value(debtor_bic) AS debtor_bic,
    any_value(order_date) AS order_date
  FROM lines WHERE filled GROUP BY 1, 2
),
msg AS (
  SELECT file_name, any_value(nb_txs_declared) AS declared, any_value(ctrl_sum) AS ctrl_sum, count(end_to_end_id) AS n,
    sum(amount) FILTER (WHERE NOT equivalent) AS total FROM lines GROUP BY 1
),
hits AS (
  SELECT file_name, 'BR-001' AS rule_id, 1 AS v FROM msg WHERE declared <> n
  UNION ALL SELECT file_name, 'BR-002', 1 FROM msg WHERE abs(ctrl_sum - total) > 0.01
  UNION ALL SELECT file_name, 'BR-003', 1 FROM pmt WHERE pmt_method = 'CHK' AND priced > 0 AND abs(50000.00 - total) > 0.01
  UNION ALL SELECT file_name, 'BR-004', 1 FROM pmt WHERE pmt_method = 'CHK' AND n <> 2
  UNION ALL SELECT file_name, 'BR-005', count(*) - 1 FROM lines WHERE filled GROUP BY file_name, end_to_end_id HAVING count(*) > 1
  UNION ALL SELECT file_name, 'BR-006', 1 FROM lines WHERE uetr_bad
  UNION ALL SELECT file_name, 'BR-008', 1 FROM lines WHERE filled AND {_iban_bad('creditor_iban')}
  UNION ALL SELECT file_name, 'BR-008', 1 FROM pmt WHERE {_iban_bad('debtor_iban')}
  UNION ALL SELECT file_name, 'BR-009', 1 FROM pmt WHERE NOT regexp_full_match(debtor_bic, '[A-Z]{{6}}[A-Z0-9]{{2}}([A-Z0-9]{{3}})?')
  UNION ALL SELECT file_name, 'BR-010', 1 FROM lines WHERE filled AND NOT equivalent AND currency = 'XXQ'
  UNION ALL SELECT file_name, 'BR-011', 1 FROM pmt WHERE order_date < DATE '{demo.AS_OF}'
),
counts AS (SELECT file_name, rule_id, CAST(sum(v) AS BIGINT) AS violations FROM hits GROUP BY 1, 2),
decided AS (
  SELECT m.file_name, coalesce(sum(violations) FILTER (WHERE rule_id <> 'BR-011'), 0) AS br_errors,
    coalesce(sum(violations) FILTER (WHERE rule_id = 'BR-011'), 0) AS br_warnings
  FROM msg m LEFT JOIN counts USING (file_name) GROUP BY 1
)"""


def rules() -> dict[str, str]:
    blank = "FROM orders WHERE o_orderstatus = 'P'"

    def code_hits(message_set: str, rule: str, column: str, bad: str) -> str:
        return (
            f"SELECT '{message_set}' AS message_set, {NAME} AS file_name, '{rule}' AS rule_id, {_q(bad)} AS actual FROM orders "
            f"WHERE {_pick(PRIORITY, demo.PRIORITY_CODES[column])} = {_q(bad)}"
        )

    return {
        "rules_credit": _with(RULE_COUNTS, "SELECT file_name, rule_id, violations FROM counts"),
        "rules_credit_flat": _with(RULE_COUNTS, "SELECT file_name, rule_id, violations FROM counts"),
        "rules_credit_summary": _with(RULE_COUNTS, """
            SELECT rule_id, CASE rule_id WHEN 'BR-011' THEN 'WARNING' ELSE 'ERROR' END AS severity, CAST(sum(violations) AS BIGINT) AS violations,
              count(*) AS messages FROM counts GROUP BY 1"""),
        "rules_direct_debit": _with(LINES, f"""
            SELECT file_name, rule_id, CAST(sum(v) AS BIGINT) AS violations FROM (
              SELECT file_name, 'BR-040' AS rule_id, 1 AS v FROM (SELECT file_name, any_value(nb_txs_declared) AS d, count(end_to_end_id) AS n FROM lines GROUP BY 1) WHERE d <> n
              UNION ALL SELECT file_name, 'BR-041', 1 FROM (SELECT file_name, any_value(ctrl_sum) AS c, sum(amount) AS total FROM lines GROUP BY 1) WHERE abs(c - total) > 0.01
              UNION ALL SELECT file_name, 'BR-043', 1 FROM lines WHERE filled AND {_iban_bad('creditor_iban')}
              UNION ALL SELECT file_name, 'BR-043', count(DISTINCT pmt_inf_id) FROM lines WHERE filled AND {_iban_bad('debtor_iban')} GROUP BY 1
              UNION ALL SELECT file_name, 'BR-044', count(DISTINCT pmt_inf_id) FROM lines WHERE filled AND NOT regexp_full_match(debtor_bic, '[A-Z]{{6}}[A-Z0-9]{{2}}([A-Z0-9]{{3}})?') GROUP BY 1
              UNION ALL SELECT file_name, 'BR-010', 1 FROM lines WHERE filled AND currency = 'XXQ'
              UNION ALL SELECT file_name, 'BR-046', count(DISTINCT pmt_inf_id) FROM lines WHERE filled AND order_date < DATE '{demo.AS_OF}' GROUP BY 1
            ) GROUP BY 1, 2"""),
        "rules_status": f"""
            SELECT {NAME} AS file_name, 'BR-020' AS rule_id, 'PEND' AS actual, 'GrpSts ''PEND'' is not a recognised ISO 20022 group status code' AS message
            FROM orders WHERE o_orderstatus = 'P'
            UNION ALL SELECT {NAME}, 'BR-021', 'WAIT', 'TxSts ''WAIT'' is not a recognised ISO 20022 transaction status code'
            FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'N'
            UNION ALL SELECT {NAME}, 'BR-022', 'XX99', 'Status reason code ''XX99'' is not in the common ISO 20022 reason code set'
            FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R' AND l_linenumber = 7
            UNION ALL SELECT {NAME}, 'BR-023', NULL, 'Original message reference OrgnlMsgId is missing or empty' FROM orders WHERE o_orderpriority = '5-LOW'""",
        "rules_reversal": f"""
            SELECT {NAME} AS file_name, 'BR-030' AS rule_id, CAST(NULL AS VARCHAR) AS actual FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_linenumber = 7
            UNION ALL SELECT {NAME}, 'BR-031', 'ZZ99' FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_linenumber = 6""",
        "rules_mandates": f"""
            SELECT '009' AS message_set, 'gen-pass-' || c_custkey || '.xml' AS file_name, 'BR-050' AS rule_id, CAST(NULL AS VARCHAR) AS actual FROM customer WHERE c_acctbal < 0
            UNION ALL SELECT '009', 'gen-pass-' || c_custkey || '.xml', 'BR-052', iban FROM (
              SELECT c_custkey, {_iban('c_nationkey', 'c_custkey', 'c_acctbal')} AS iban FROM customer) WHERE {_iban_bad('iban')}
            UNION ALL {code_hits('010', 'BR-060', 'amendment_reason', 'ZZ01')}
            UNION ALL SELECT '010', {NAME}, 'BR-061', NULL {blank}
            UNION ALL {code_hits('011', 'BR-070', 'cancellation_reason', 'ZZ02')}
            UNION ALL SELECT '011', {NAME}, 'BR-071', NULL {blank}
            UNION ALL SELECT '012', {NAME}, 'BR-081', NULL FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '4-NOT SPECIFIED'
            UNION ALL SELECT '017', {NAME}, 'BR-090', NULL {blank}
            UNION ALL {code_hits('018', 'BR-100', 'suspension_reason', 'ZZ03')}
            UNION ALL SELECT '018', {NAME}, 'BR-101', NULL {blank}""",
        "validation_summary": _with(RULE_COUNTS, f"""
            SELECT count(*) AS total, count(*) FILTER (WHERE br_errors = 0) AS passed, count(*) FILTER (WHERE br_errors > 0) AS failed,
              {_pct('count(*) FILTER (WHERE br_errors = 0)', 'count(*)', 'pass_pct', 0)},
              count(*) FILTER (WHERE br_errors = 0 AND br_warnings > 0) AS passed_with_warnings,
              CAST(sum(br_errors) AS BIGINT) AS br_errors, CAST(sum(br_warnings) AS BIGINT) AS br_warnings FROM decided"""),
        "validation_status": _with(RULE_COUNTS, """
            SELECT file_name, CASE WHEN br_errors > 0 THEN 'FAIL' WHEN br_warnings > 0 THEN 'WARN' ELSE 'PASS' END AS badge FROM decided"""),
    }


def _suggestions(column: str) -> str:
    import re

    whens = []
    for pattern, template in ADVICE:
        parts = []
        for part in re.split(r"(\{\d\})", template):
            if re.fullmatch(r"\{\d\}", part):
                parts.append(f"regexp_extract({column}, {_q(pattern)}, {int(part[1]) + 1})")
            elif part:
                parts.append(_q(part))
        whens.append(f"WHEN regexp_matches({column}, {_q(pattern)}) THEN {' || '.join(parts)}")
    return f"CASE {' '.join(whens)} ELSE {_q(ADVICE_FALLBACK)} END"


CASES = HDR + """,
cases AS (
  SELECT file_name AS source_file, message_set AS schema, order_ts, o_orderkey,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'pass' WHEN '4-NOT SPECIFIED' THEN 'pass' WHEN '2-HIGH' THEN 'fail' ELSE 'edge' END AS requested_category,
    o_orderstatus <> 'F' AS valid FROM hdr
),
outcome AS (
  SELECT *, CASE WHEN valid AND requested_category = 'edge' THEN 'edge' WHEN valid THEN 'pass' ELSE 'fail' END AS actual_category FROM cases
)"""


def expressions() -> dict[str, str]:
    return {
        "file_category": _with(HDR, f"SELECT file_name, category, {STRICT} AS strict_category FROM hdr"),
        "iban_country": f"SELECT c_custkey, {_country('c_nationkey')} AS country FROM customer",
        "bic_country": _with(HDR, "SELECT file_name, substr(debtor_bic, 5, 2) AS country FROM hdr"),
        "iban_valid": f"""
            SELECT c_custkey, iban, NOT {_iban_bad('iban')} AS valid FROM (
              SELECT c_custkey, {_iban('c_nationkey', 'c_custkey', 'c_acctbal')} AS iban FROM customer)""",
        "bic_valid": _with(HDR, "SELECT file_name, debtor_bic NOT LIKE 'B1NK%' AS valid FROM hdr WHERE debtor_bic IS NOT NULL"),
        "uetr_valid": _with(LINES, "SELECT file_name, end_to_end_id, instr_id, NOT uetr_bad AS valid FROM lines WHERE uetr_given"),
        "content_id": "SELECT event_id, sha256('pain.' || event_type || ':' || props) AS message_id FROM events",
        "topic_name": _with(STATE, "SELECT event_id, 'iso20022.' || domain || '.' || message_set AS topic FROM del"),
        "schema_label": _with(STATE, "SELECT event_id, domain || '.' || message_set AS label FROM del"),
        "set_label": _with(STATE, f"SELECT event_id, {_case('message_set', SET_LABELS)} AS label, 'Payments Initiation' AS domain_label FROM del"),
        "strip_ns": _with(STATE, "SELECT event_id, regexp_replace(error_detail, '\\{[^}]+\\}', '', 'g') AS message FROM del WHERE error_detail IS NOT NULL"),
        "suggest_fix": _with(STATE, f"SELECT event_id, {_suggestions('error_detail')} AS suggestion FROM del WHERE error_detail IS NOT NULL"),
        "error_summary": _with(STATE, """
            SELECT event_id, substr(error_detail || '; ' || error_detail || '; ' || message_id, 1, 500) AS rule_text,
              substr(error_detail || '; ' || error_detail || '; ' || message_id || '; ' || error_detail || '; ' || error_detail || '; ' || error_detail, 1, 500) AS schema_text
            FROM del WHERE error_detail IS NOT NULL"""),
        "relabel_outcome": _with(CASES, "SELECT source_file, actual_category, requested_category <> actual_category AS mismatch FROM outcome"),
        "sequence_names": _with(CASES, """
            SELECT source_file, 'gen-' || actual_category || '-' || CASE WHEN seq < 1000 THEN lpad(CAST(seq AS VARCHAR), 3, '0') ELSE CAST(seq AS VARCHAR) END || '-06302026.xml' AS file_name
            FROM (SELECT *, row_number() OVER (PARTITION BY actual_category ORDER BY order_ts, o_orderkey) AS seq FROM outcome)"""),
        "label_audit": _with(CASES, """
            SELECT schema, count(*) FILTER (WHERE actual_category = 'pass') AS pass_cases, count(*) FILTER (WHERE actual_category = 'fail') AS fail_cases,
              count(*) FILTER (WHERE actual_category = 'edge') AS edge_cases, count(*) AS total,
              count(*) FILTER (WHERE requested_category <> actual_category) AS recategorised FROM outcome GROUP BY 1"""),
        "spread_sample": _with(HDR, """
            SELECT message_set, file_name, turn FROM (
              SELECT message_set, file_name, row_number() OVER (PARTITION BY message_set ORDER BY file_name) AS turn FROM hdr)
            ORDER BY turn, message_set LIMIT 12"""),
        "facet_check": f"""
            WITH v AS (
              SELECT 'c' || c_custkey AS message_id, 'Document/Dbtr/Nm' AS path, c_name AS value FROM customer
              UNION ALL SELECT 'c' || c_custkey, 'Document/Amt/@Ccy', {_case('c_mktsegment', {'AUTOMOBILE': 'EUR', 'BUILDING': 'USD', 'FURNITURE': 'GBP', 'MACHINERY': 'XXQ'})} FROM customer
              UNION ALL SELECT 'o' || o_orderkey, 'Document/ChrgBr', o_orderstatus FROM orders
              UNION ALL SELECT 'c' || c_custkey, 'Document/Amt', CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) FROM customer
            )
            SELECT message_id, path, 'maxLength' AS facet FROM v WHERE path = 'Document/Dbtr/Nm' AND length(value) > 17
            UNION ALL SELECT message_id, path, 'pattern' FROM v WHERE path = 'Document/Dbtr/Nm' AND NOT regexp_full_match(value, 'Customer#[0-8]+')
            UNION ALL SELECT message_id, path, 'required' FROM v WHERE path = 'Document/Amt/@Ccy' AND value IS NULL
            UNION ALL SELECT message_id, path, 'enumeration' FROM v WHERE path = 'Document/ChrgBr' AND value NOT IN ('F', 'O')
            UNION ALL SELECT message_id, path, 'minInclusive' FROM v WHERE path = 'Document/Amt' AND CAST(value AS DECIMAL(18,2)) < 0
            UNION ALL SELECT message_id, path, 'fractionDigits' FROM v WHERE path = 'Document/Amt' AND CAST(CAST(value AS DECIMAL(18,2)) * 100 AS BIGINT) % 10 <> 0
            UNION ALL SELECT message_id, path, 'totalDigits' FROM v WHERE path = 'Document/Amt' AND length(rtrim(rtrim(ltrim(replace(value, '-', ''), '0'), '0'), '.')) - CASE WHEN contains(rtrim(value, '0'), '.') AND NOT rtrim(value, '0') LIKE '%.' THEN 1 ELSE 0 END > 5""",
    }


MIXED = """
mixed AS (
  SELECT c_custkey AS k, CAST(c_acctbal AS DECIMAL(18,2)) AS amount, c_mktsegment, c_nationkey, 'gen-pass-' || c_custkey || '.xml' AS file_name,
    ['001', '002', '007', '008', '009', '010', '011', '012', '013', '014', '017', '018', '999'][CAST(c_custkey % 13 AS INT) + 1] AS message_set,
    c_custkey % 17 = 0 AS cut_short
  FROM customer
)"""


def _stream(chosen: str = "true") -> str:
    return f"""
            WITH raw AS (
              SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
                CASE event_type WHEN 'signup' THEN '018' WHEN 'error' THEN '010' ELSE '017' END AS message_set
              FROM events WHERE value >= {demo.LOST_BELOW}
            ),
            named AS (
              SELECT *, CASE message_set WHEN '018' THEN 'MndtSspnsnReq' ELSE 'MndtCpyReq' END AS root,
                CASE message_set WHEN '018' THEN 'UndrlygSspnsnDtls' ELSE 'UndrlygCpyReqDtls' END AS block FROM raw
            ),
            del AS (
              SELECT event_id, sha256('pain.' || message_set || ':<Document><' || root || '><' || block || '><OrgnlMndt><OrgnlMndtId>' ||
                  CASE WHEN k < 10 THEN ' ' ELSE user_id || '-' || k END || '</OrgnlMndtId></OrgnlMndt>' ||
                  CASE WHEN k BETWEEN 10 AND 14 THEN '<Extra/>' ELSE '' END ||
                  '</' || block || '></' || root || '><!-- ' || event_type || ' ' || props || ' --></Document>') AS message_id,
                value >= {_BAD[0]} AND value < {_NONE[1]} AS unsound, k, message_set FROM named
            ),
            flow AS (
              SELECT *, CASE WHEN count(*) FILTER (WHERE NOT unsound) OVER (
                  PARTITION BY message_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 0 THEN 'duplicate'
                WHEN unsound THEN 'tampered' WHEN k < 15 OR message_set = '010' THEN 'fail' ELSE 'pass' END AS outcome FROM del
            )
            SELECT message_id, outcome, count(*) AS deliveries FROM flow WHERE {chosen} GROUP BY 1, 2
            UNION ALL SELECT message_id, CASE message_set WHEN '018' THEN 'BR-101' ELSE 'BR-090' END, count(*) FROM flow
            WHERE outcome = 'fail' AND k < 10 AND message_set != '010' AND {chosen} GROUP BY 1, 2"""


def jobs() -> dict[str, str]:
    return {
        "xsd_flag": _with(LINES, """
            SELECT file_name, count(*) FILTER (WHERE filled) > 0 AND count(*) FILTER (WHERE filled AND NOT equivalent AND currency IS NULL) = 0 AS valid
            FROM lines GROUP BY 1"""),
        "corpus_outcomes": f"""
            WITH {MIXED},
            hits AS (
              SELECT *, list_filter([
                CASE WHEN message_set IN ('001', '013') AND k % 5 = 0 THEN 'BR-012' END,
                CASE WHEN message_set IN ('001', '013') AND amount <= 0 THEN 'BR-007' END,
                CASE WHEN message_set = '013' AND k % 3 = 0 AND amount <= 0 THEN 'BR-007' END,
                CASE WHEN message_set = '013' AND k % 3 = 0 THEN 'BR-001' END,
                CASE WHEN message_set = '013' AND k % 3 = 0 AND abs(amount) > 0.01 THEN 'BR-002' END,
                CASE WHEN message_set = '013' AND k % 3 = 0 THEN 'BR-005' END,
                CASE WHEN message_set IN ('002', '014') AND k % 4 = 0 THEN 'BR-020' END,
                CASE WHEN message_set IN ('002', '014') AND k % 3 = 0 THEN 'BR-021' END,
                CASE WHEN message_set = '007' AND amount <= 0 THEN 'BR-032' END,
                CASE WHEN message_set = '008' AND k % 2 = 1 THEN 'BR-042' END,
                CASE WHEN message_set = '009' AND c_mktsegment = 'AUTOMOBILE' THEN 'BR-051' END,
                CASE WHEN message_set = '009' AND c_nationkey % 2 = 1 THEN 'BR-053' END,
                CASE WHEN message_set = '010' AND k % 2 = 1 THEN 'BR-061' END,
                CASE WHEN message_set = '011' AND k % 2 = 1 THEN 'BR-071' END,
                CASE WHEN message_set = '012' AND k % 3 = 0 THEN 'BR-080' END,
                CASE WHEN message_set = '017' AND k % 2 = 1 THEN 'BR-090' END,
                CASE WHEN message_set = '018' AND k % 2 = 1 THEN 'BR-101' END
              ], lambda r: r IS NOT NULL AND NOT cut_short) AS rules, CAST(cut_short OR message_set = '999' AS INT) AS structural FROM mixed
            )
            SELECT file_name, message_set, CASE WHEN structural = 0 AND len(rules) = 0 THEN 'pass' ELSE 'fail' END AS validation_status,
              structural, CAST(len(rules) AS INT) AS br_errors, array_to_string(list_sort(list_distinct(rules)), ',') AS rules FROM hits""",
        "store_payment_013": f"""
            WITH {MIXED}
            SELECT file_name, 'gen-pass' AS category, amount, 'EUR' AS currency, false AS has_uetr FROM mixed
            JOIN (VALUES (1), (2)) t(n) ON n = 1 OR k % 3 = 0 WHERE message_set = '013' AND NOT cut_short""",
        "store_status_014": f"""
            WITH {MIXED}
            SELECT file_name, 'gen-pass' AS category, CASE WHEN n = 1 THEN CASE WHEN k % 4 = 0 THEN 'XXXX' ELSE 'ACCP' END END AS grp_status,
              CASE WHEN n = 2 THEN CASE WHEN k % 3 = 0 THEN 'YYYY' ELSE 'ACSP' END END AS tx_status, CAST(NULL AS VARCHAR) AS reason_code
            FROM mixed, (VALUES (1), (2)) t(n) WHERE message_set = '014' AND NOT cut_short""",
        "stream_state": _stream(),
        "stream_commits": _stream(),
        "stream_of_set": _stream("message_set = '018'"),
    }


def all_sql() -> dict[str, str]:
    return {**jobs(), **credit(), **dashboard(), **recon(), **shredding(), **sections(), **rules(), **expressions()}
