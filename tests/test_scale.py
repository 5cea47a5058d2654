"""Operators that replace one-task windows, on skewed input, against plain Python."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from girolens import catalog
from girolens.operators import joins, labels, ranking, routing, rules, shred
from girolens.sources import corpus
from tests import samples as s


def test_row_number_is_global_and_gapless(spark):
    frame = spark.range(0, 5000, numPartitions=7).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") * 7919 % 5000).alias("t"), "id")
    got = ranking.row_number(frame, ["t", "id"], "n").collect()
    expected = {r.id: i + 1 for i, r in enumerate(sorted(got, key=lambda r: (r.t, r.id)))}
    assert all(expected[r.id] == r.n for r in got) and len(got) == 5000


def test_quantile_with_hot_key_and_hot_value(spark):
    random.seed(3)
    rows = [("hot", random.choice([7, 7, 7, random.randint(0, 900)])) for _ in range(3000)]
    rows += [("small", v) for v in (1, 2, 10)] + [("one", 5)] + [("none", None)]
    frame = spark.createDataFrame(rows, "k string, v int").repartition(5)
    got = {r.k: r.p for r in ranking.quantile(frame, "k", "v", 0.95, "p").collect()}

    def exact(values):
        values = sorted(values)
        rank = 0.95 * (len(values) - 1)
        low = int(rank)
        high = min(low + 1, len(values) - 1)
        return values[low] + (values[high] - values[low]) * (rank - low)

    for key in ("hot", "small", "one"):
        assert abs(got[key] - exact([v for k, v in rows if k == key])) < 1e-9, key
    assert "none" not in got


def test_number_within_hot_key(spark):
    frame = spark.range(0, 3000, numPartitions=6).select(
        F.when(F.col("id") < 2500, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5)).alias("k"),
        (F.col("id") * 31 % 3001).alias("t"))
    got = labels.number_within(frame, ["k"], ["t"], "n").collect()
    assert len(got) == 3000
    by_key = {}
    for r in got:
        by_key.setdefault(r.k, []).append((r.t, r.n))
    for pairs in by_key.values():
        assert [n for _, n in sorted(pairs)] == list(range(1, len(pairs) + 1))


def test_shares_and_top(spark):
    frame = spark.createDataFrame([("a", 6), ("b", 3), ("c", 3), ("d", 0)], "k string, n bigint")
    assert [r.pct for r in ranking.share_of_total(frame, "n").orderBy("k").collect()] == [50.0, 25.0, 25.0, 0.0]
    assert [r.bar for r in ranking.share_of_max(frame, "n", "bar").orderBy("k").collect()] == [100.0, 50.0, 50.0, 0.0]
    assert [r.k for r in ranking.top(frame, "n", ["k"], 2).collect()] == ["a", "b"]


def test_hot_lookup_keeps_every_row(spark):
    rows = spark.range(0, 4000).select(
        F.when(F.col("id") < 3000, "hot").when(F.col("id") < 3010, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), "id")
    lookup = rows.groupBy("k").agg(F.count("*").alias("w"), F.min("id").alias("first")).where("k != 'k3999'")
    got = joins.hot_lookup(rows, lookup, "k", "w").collect()
    assert len(got) == 4000 and sorted(r.id for r in got) == list(range(4000))
    assert {r.first for r in got if r.k == "hot"} == {0}
    assert all(r.first is None for r in got if r.k in (None, "k3999"))


def test_route_order(spark):
    rows = [  # id, position, sound
        ("a", 1, False), ("a", 2, True), ("a", 3, True), ("a", 4, False), ("b", 5, True), ("c", 6, False), ("old", 7, True), ("old", 8, False)]
    frame = spark.createDataFrame(rows, "message_id string, position int, sound boolean")
    seen = spark.createDataFrame([("old",), ("old",)], "message_id string")
    got = {r.position: r.route for r in routing.route(frame, seen, ["position"], F.col("sound")).collect()}
    assert got == {
        1: "tampered", 2: "fresh", 3: "duplicate", 4: "duplicate", 5: "fresh", 6: "tampered", 7: "duplicate", 8: "duplicate"}


def test_array_form_and_flat_form_agree(spark, folder):
    queries = catalog.all_queries()
    arrays, flat = ({tuple(r) for r in queries[q](spark, folder).select("file_name", "rule_id", "violations").collect()}
                    for q in ("rules_credit", "rules_credit_flat"))
    assert arrays == flat and len(arrays) > 1000


def test_one_message_of_any_size(spark):
    """40,000 transactions in one message above 10 MB: all are shredded, and rules count as in small messages."""
    many = 40_000
    txs = "".join(s.credit_tx(f"R{i}" if i > 2 else "", ccy="QQQ" if i == 7 else "EUR") for i in range(many))
    xml = s.credit(s.payment(txs)) + " " * (11 << 20)
    frame = spark.createDataFrame([("pain", "001", "big.xml", "manual", xml)], "domain string, message_set string, file_name string, category string, xml string")
    parsed = corpus.well_formed(corpus.parse(frame, "001"))
    assert shred.shred_001(parsed).count() == many
    found = rules.violations(rules.with_violations(parsed, "001", F.lit("2026-01-01").cast("date")), "file_name")
    counts = {r.rule_id: r["count"] for r in found.groupBy("rule_id").count().collect()}
    assert counts["BR-005"] == 2 and counts["BR-010"] == 1


def test_round_robin_sample(spark):
    frame = spark.createDataFrame([("x", f"x{i}") for i in range(5)] + [("y", "y0")] + [("z", f"z{i}") for i in range(2)], "s string, f string")
    got = labels.spread_sample(frame, ["s"], "f", 6).orderBy("turn", "s").collect()
    assert [r.f for r in got] == ["x0", "y0", "z0", "x1", "z1", "x2"]


def test_no_python_udf_and_no_cross_join(spark, folder):
    for name in ("rules_credit", "shred_001", "route", "recon_summary", "latency_by_schema", "flow_matrix"):
        plan = catalog.all_queries()[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        for bad in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct"):
            assert bad not in plan, (name, bad)


def test_top_per_key_is_cut_before_the_shuffle(spark, folder):
    for name in ("spread_sample", "set_error_element"):
        plan = catalog.all_queries()[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in plan and "Partial" in plan, name


def test_filters_and_columns_reach_the_scan(spark, folder):
    plan = catalog.all_queries()["purpose_code"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "lineitem.parquet" in line)
    assert "l_shipdate" not in scan and "l_discount" not in scan
