"""What the flat rules move on large tables, with the same totals and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from girolens import catalog, demo
from girolens.operators import rules_flat


def _plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_flat_rules_move_payment_texts_once(spark, folder):
    """No exchange by payment for the stated totals, and no reference among the keys that carry the payment texts."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # joins as on large tables
    try:
        flat = demo.flat_rules_input(demo.order_lines(spark, folder))
        moved = [line for line in _plan(flat).splitlines() if "Exchange hashpartitioning" in line]
        whole = _plan(rules_flat.credit_rule_counts(flat, F.lit(demo.AS_OF).cast("date")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert moved and not [line for line in moved if "pmt_inf_id" in line]
    keys = [line for line in whole.splitlines() if "Exchange hashpartitioning" in line and "end_to_end_id" in line]
    assert keys and all("debtor_iban" not in line.split("ENSURE")[0] for line in keys)


def test_flat_totals_of_odd_payments(spark):
    """Missing payment ids, references and amounts, and rows that come twice: totals as a join with grouped rows gives them."""
    odd = [(1, "P1", "a", "TRF", False, "1.50"), (1, "P1", "a", "TRF", False, "1.50"), (1, "P1", "b", "TRF", True, "2.00"), (1, "P1", None, "TRF", False, "4.00"),
           (2, None, "c", "TRF", False, "3.00"), (3, None, None, None, None, None), (4, "P4", None, "CHK", False, "5.00"), (5, "P5", "e", "CHK", None, None)]
    lines = spark.createDataFrame(odd, "o_orderkey long, pmt_inf_id string, end_to_end_id string, pmt_method string, equivalent boolean, amount string")
    none = {c: F.lit(None).cast("string") for c in ("file_name", "msg_id", "debtor_iban", "debtor_bic", "uetr", "currency", "creditor_iban", "creditor_bic")}
    lines = lines.withColumns({**none, "amount": F.col("amount").cast("decimal(18,2)"), "nb_txs_declared": F.lit(1), "ctrl_sum": F.lit(None).cast("decimal(18,2)"),
                               "order_date": F.lit(None).cast("date")})
    got = sorted((str(r.pmt_inf_id), str(r.end_to_end_id), r.pmt_declared, r.pmt_ctrl_sum and float(r.pmt_ctrl_sum))
                 for r in demo.flat_rules_input(lines).collect())
    assert got == [("None", "None", None, None), ("None", "c", None, None), ("P1", "None", 3, 3.0), ("P1", "a", 3, 3.0), ("P1", "a", 3, 3.0), ("P1", "b", 3, 3.0),
                   ("P4", "None", None, None), ("P5", "e", 2, 50000.0)]


def test_rule_counts_agree_on_both_forms(spark, folder):
    queries = catalog.all_queries()
    arrays, flat = ({tuple(r) for r in queries[q](spark, folder).collect()} for q in ("rules_credit", "rules_credit_flat"))
    assert arrays == flat and arrays
