"""Large messages read in splits give the rows of whole messages."""

from __future__ import annotations

import pytest

from girolens.operators import shred
from girolens.sources import corpus, large
from tests import samples as s


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for n, value in zip(names, ("7000", "1"), strict=True):
        spark.conf.set(n, value)
    yield
    for n, value in zip(names, before, strict=True):
        spark.conf.set(n, value)


def written(tmp_path, files):
    for name, xml in files.items():
        place = tmp_path / "data/pain/001" / name
        place.parent.mkdir(parents=True, exist_ok=True)
        place.write_text(xml)
    return str(tmp_path / "data")


@pytest.mark.parametrize("prefix", ["", "p"])
def test_rows_equal_those_of_whole_messages(spark, tmp_path, small_splits, prefix):
    payments = [s.payment(*[s.credit_tx(f"é{p}-{k}", amount=f"{p}.{k:02}") for k in range(1 + 7 * (p % 9))], date=f"2030-01-{p % 28 + 1:02}") for p in range(40)]
    files = {
        "gen-pass-big.xml": s.credit(*payments, prefix=prefix), "gen-fail-other.xml": s.credit(*payments[20:30], prefix=prefix),
        "none.xml": s.credit(prefix=prefix), "empty-payment.xml": s.credit("<PmtInf><PmtInfId>P9</PmtInfId></PmtInf>", *payments[:2]) if not prefix else s.credit(payments[0], prefix=prefix),
    }
    folder = written(tmp_path, files)
    whole = corpus.well_formed(corpus.parse(corpus.read_corpus(spark, folder, "001"), "001"))
    parts = large.read_large(spark, f"{folder}/pain/001", prefix=prefix and prefix + ":")
    assert large._pieces(spark, f"{folder}/pain/001", "CdtTrfTxInf", prefix and prefix + ":").rdd.getNumPartitions() > 20
    for shredder in (shred.shred_001, shred.shred_payment):
        want, got = (sorted(map(str, shredder(frame).collect())) for frame in (whole, corpus.well_formed(parts)))
        assert got == want and len(got) > 1000


def test_malformed_messages(spark, tmp_path, small_splits):
    payments = [s.payment(*[s.credit_tx(f"{p}-{k}") for k in range(20)]) for p in range(5)]
    good = s.credit(*payments)
    at = good.index("<EndToEndId>3-7")
    folder = written(tmp_path, {
        "good.xml": good, "cut.xml": good[:-12], "inside.xml": good[:at] + "<Open>" + good[at:], "after.xml": good + "x", "nothing.xml": "<Document>",
        "comment.xml": good[:at] + "<!-- </CdtTrfTxInf> -->" + good[at:],
    })
    got = {(r.file_name, r.parsed) for r in large.read_large(spark, f"{folder}/pain/001").select("file_name", "parsed").collect()}
    assert ("good.xml", True) in got and {parsed for name, parsed in got if name != "good.xml"} == {False}
