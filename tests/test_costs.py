"""Steps that grew too costly on large tables: how often they evaluate, with the same results."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from girolens.functions import ids
from girolens.operators import rules
from girolens.operators.once import bound
from girolens.sources import corpus


@pytest.mark.parametrize("tail", ["", "\n", " \t\r\n", "<!-- x -->", "<!-- " + "x" * 300 + " -->\n", "<?p q?>", "<Document/>", "x", "<a/>", "<!-- "])
@pytest.mark.parametrize("end", ["</Document>", "</n:Document >", "<Document a='b'/>", "</Other>"])
def test_end_of_message_equals_the_whole_pattern(spark, end, tail):
    frame = spark.createDataFrame([("<a>" + "y" * 200 + end + tail,), (None,)], "xml string")
    rows = frame.select(corpus.ended(F.col("xml")).alias("got"), F.col("xml").rlike(corpus._END).alias("whole")).collect()
    assert all(r.got == r.whole for r in rows)


def test_whole_message_is_not_searched_for_its_end(spark):
    """A plain end settles it; the pattern alone used to walk through every message."""
    plan = corpus.ended(F.col("xml"))._jc.toString()
    assert "endsWith" in plan or "endswith" in plan.lower()


@pytest.mark.parametrize("xml", [
    '<A><B Ccy="EUR">1</B><n:C  x="1" Ccy = \'XXQ\'>2</n:C></A>', '<A Ccy=""/>', '<A><!-- <B Ccy="QQQ"/> --><B Ccy="usd"/></A>',
    '<A><B Ccy="QQQ"/><B Ccy="QQQ"/></A>', '<A xCcy="QQQ" y="Ccy=\'ZZZ\'"/>', "<A>no</A>", "<A>Ccy='QQQ'</A>",
    '<A><![CDATA[<B Ccy="QQQ">]]></A>', '<A z="1"\nCcy="ZZZ"/>', '<a.b-c Ccy="Ccy=" d="QQQ"/>',
])
def test_currencies_equal_the_search_of_all_tags(spark, xml):
    hidden = re.sub(r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>", "", xml)
    pattern = r"<(?:[\w.-]+:)?([\w.-]+)\s(?:[^<>]*?\s)?Ccy\s*=\s*[\"']([^\"']*)[\"']"
    expected = [c for _, c in re.findall(pattern, hidden) if c and c.upper() not in rules.model.CURRENCIES]
    frame = spark.createDataFrame([(xml,)], "xml string")
    found = frame.select(rules._currencies(F.col("xml")).alias("v")).first().v
    assert [v.actual for v in found] == expected


def test_parts_of_an_account_number_are_evaluated_once(spark):
    numbers = ["DE89370400440532013000", "de89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "DE00", "", None, "XX99ABCZ"]
    frame = spark.createDataFrame([(n,) for n in numbers], "n string")
    lambdas = ids.iban_is_valid(F.col("n"), bound).alias("v")
    rows = frame.select(ids.iban_is_valid(F.col("n")).alias("plain"), lambdas).collect()
    assert [r.plain for r in rows] == [r.v for r in rows] == [True, True, True, False, False, False, False]
    assert frame.select(lambdas)._jdf.queryExecution().analyzed().toString().count("upper(") == 1
