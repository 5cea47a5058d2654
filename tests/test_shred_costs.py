"""Columns of credit transfers: compiled by the JIT, and texts that need no trimming are left alone."""

from __future__ import annotations

from pyspark.sql import functions as F

from girolens.functions.text import text
from girolens.operators import shred
from girolens.sources import corpus
from tests import samples as s

#: bytes of bytecode from which on the JIT leaves a method to the interpreter
HUGE = 8000


def test_no_method_of_the_columns_is_too_long_to_be_compiled(spark):
    """The method that made all 27 columns had 21,703 bytes and ran interpreted."""
    rows = shred.shred_001(corpus.well_formed(corpus.parse(s.frame(spark, "001", s.credit(s.payment(s.credit_tx("E1")))), "001", reads=shred.READS["shred_001"])))
    stages = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(rows._jdf.queryExecution().executedPlan())
    sizes = [stages.apply(n)._3().maxMethodCodeSize() for n in range(stages.size())]
    assert sizes and max(sizes) < HUGE and rows.first().end_to_end_id == "E1"


def test_text_equals_the_trimmed_one(spark):
    blanks = ["", " ", "\t", "\r\n", "\n \t"]
    values = [None, *(a + core + b for a in blanks for b in blanks for core in ("", "x", "x y", "é", " x ", "\x0bx", " ", "日本"))]
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r.t for r in frame.select(text(F.col("v")).alias("t")).collect()]
    assert got == [(v.strip(" \t\r\n") or None) if v is not None else None for v in values]


def test_text_without_blanks_is_not_taken_apart(spark):
    frame = spark.createDataFrame([("x",)], "v string")
    assert "ascii(" in frame.select(text(F.col("v")))._jdf.queryExecution().analyzed().toString()
