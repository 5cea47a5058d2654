"""Reports from one pass, and quantiles from counts."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from girolens import demo
from girolens.operators.ranking import counted_quantile
from girolens.plans import recon


def rows(frame):
    return sorted(map(str, frame.select(*sorted(frame.columns)).collect()))


@pytest.mark.parametrize("extra", [False, True])
def test_datasets_equal_the_single_queries(spark, folder, extra):
    tables = demo.state(spark, folder)
    if extra:  # processed without having been sent, no error text, an unknown status
        tables["processed_messages"] = tables["processed_messages"].unionByName(spark.sql(
            "SELECT * FROM VALUES ('x1', 'pain', '777', 'gen-fail-1.xml', 'fail', TIMESTAMP '2030-01-01', NULL), "
            "('x2', 'pain', NULL, 'gen-pass-1.xml', 'fail', NULL, 'strange') AS t(message_id, domain, message_set, file_name, validation_status, processed_at, error_detail)"
        ), allowMissingColumns=True)
    tables = {k: v.persist() for k, v in tables.items()}
    sent, done, bad = tables["sent_messages"], tables["processed_messages"], tables["tampered_messages"]
    got = recon.run_all(tables)
    want = {
        "summary": recon.recon_summary(sent, done, tables["duplicate_events"], bad, tables["rule_violations"]),
        "schema_breakdown": recon.schema_breakdown(sent, done), "error_patterns": recon.error_bars(done),
        "category_outcomes": recon.category_share(done), "tampered_by_set": recon.tampered_bars(bad),
        "pipeline_timeline": recon.pipeline_timeline(sent, done),
    }
    assert list(got) and set(want) < set(got)
    for name, frame in want.items():
        assert rows(got[name]) == rows(frame), name
    for frame in tables.values():
        frame.unpersist()


def test_empty_tables(spark, folder):
    tables = {k: v.limit(0) for k, v in demo.state(spark, folder).items()}
    got = recon.run_all(tables)
    assert got["summary"].first().total_sent == 0 and got["summary"].first().fully_reconciled
    assert all(got[n].count() == 0 for n in ("schema_breakdown", "error_patterns", "category_outcomes", "tampered_by_set"))


def test_one_scan_of_each_table(spark, tmp_path, folder):
    tables = {}
    for name, frame in demo.state(spark, folder).items():
        frame.write.parquet(f"{tmp_path}/{name}")
        tables[name] = spark.read.parquet(f"{tmp_path}/{name}")
    cube = recon.report_cube(*(tables[n] for n in ("sent_messages", "processed_messages", "duplicate_events", "tampered_messages", "rule_violations")))
    plan = cube._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == len(tables) == 5


@pytest.mark.parametrize("seed", range(4))
def test_quantile_of_counts(spark, seed):
    rnd = np.random.default_rng(seed)
    kinds = {
        "small": rnd.integers(-5, 5, 41), "wide": rnd.integers(-(1 << 40), 1 << 50, 500), "one": np.array([7]), "same": np.full(90, 1000),
        "long": (rnd.pareto(1.0, 3000) * 1000).astype(np.int64), "hot": rnd.integers(0, 86_400_000, 4000), "edge": np.array([255, 256, 257, 511, 512, 513, -256, 0]),
    }
    data = [(k, int(v)) for k, values in kinds.items() for v in values] + [("small", None), ("nulls", None)]
    frame = spark.createDataFrame(data, "key string, v long")
    counted = frame.groupBy("key", "v").agg(F.count(F.lit(1)).alias("n"))
    for q in (0.0, 0.5, 0.95, 1.0):
        found = counted_quantile(counted, "key", "v", "n", q, "p")
        got = {r.key: r.p for r in found.collect()}
        assert set(got) == set(kinds)
        for k, values in kinds.items():
            assert got[k] == pytest.approx(np.quantile(values, q), rel=1e-12, abs=1e-9), (k, q)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "ExistingRDD" not in plan.replace("Scan ExistingRDD[key", "")
