"""Secret scans against a plain scan, and the ledger over several scans."""

from __future__ import annotations

import hashlib
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from girolens.llm import secrets

KEY = "AKIA" + "Q7" * 8
WORDS = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def plain(text: str | None) -> list[tuple[int, int, str]]:
    text, out = text or "", []
    for m in re.finditer(WORDS, text, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end(), "assign"))
    for rank, kind, pattern, least in ((1, "access", "AKIA[A-Z0-9]+", 20), (2, "hex", "[0-9a-f]+", 24)):
        out += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return [(a, b, kind) for a, _, b, kind in sorted(out)]


TEXTS = [
    f"é password = 'abc' PassWord:\"ünsafe1 token=token=abcdefg {KEY}{KEY} x{KEY[:19]} X{KEY}",
    "secret:" + "a0" * 12 + " API_KEY = '" + "f" * 23 + "' apikey=..-/+= paſſword=abcdefgh toKen: abcdefgh",
    "password=abcde password: secret=abcdefg\ntoken =\nabcdefgh", "0123456789abcdef01234567" * 3 + "G" + "a" * 23, "", None, " ", "plain words only",
]


@pytest.fixture
def history(spark):
    """Paths with several versions; a text that most versions have; nulls, repeated rows and clashing columns."""
    rows = [(p, v, TEXTS[(p * v) % len(TEXTS)]) for p in range(12) for v in range(3)] + [(3, 1, TEXTS[3])] * 2 + [(None, None, TEXTS[0])]
    rows += [(100 + k, 0, TEXTS[1]) for k in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, version int, text string").repartition(6)
    for name in ("kind", "spans", "salt", "hot", "row", "deal", "n", "secrets", "blob", "seen"):
        frame = frame.withColumn(name, F.lit(name))
    return frame


def test_equals_a_plain_scan(spark, history, tmp_path):
    ledger = str(tmp_path / "ledger")
    texts = {r.text or "" for r in history.select("text").collect()}
    assert secrets.scan(history, ledger) == 3 * len(texts)
    assert secrets.scan(history, ledger) == 0  # nothing is scanned twice
    found = secrets.findings(history, ledger)
    assert sorted(found.columns) == sorted(c for c in history.columns if c != "text")
    got = sorted((str((r.doc_id, r.version, [tuple(s) for s in r.secrets])) for r in found.collect()))
    assert got == sorted(str((r.doc_id, r.version, plain(r.text))) for r in history.collect())
    for r in secrets.told(found).where("doc_id = 100").collect():
        spans = plain(TEXTS[1])
        shown = ",".join(f"{k}:{a}:{b}" for a, b, k in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[2] == k for s in spans) for k in ("assign", "access", "hex"))
        assert (r.spans, r.base_sha256) == (shown, hashlib.sha256(shown.encode()).hexdigest())


def test_only_unseen_pairs_are_scanned(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    first = spark.createDataFrame([(1, TEXTS[0]), (2, TEXTS[1])], "doc_id long, text string")
    both = spark.createDataFrame([(1, TEXTS[1]), (2, TEXTS[1]), (3, TEXTS[2]), (4, None)], "doc_id long, text string")
    one = secrets.RULES[1]
    assert secrets.scan(first, ledger, (one,)) == 2
    assert secrets.scan(first, ledger) == 4  # the two rules that are new
    assert secrets.scan(both, ledger) == 6  # two new texts, three rules
    short = (replace(one, least=8, pattern="AKIA[A-Z0-9]{4}", version=2),)
    assert secrets.scan(both, ledger, secrets.RULES[:1] + short) == 3  # the changed rule, on three texts
    got = {r.doc_id: [tuple(s) for s in r.secrets] for r in secrets.findings(first, ledger, short).collect()}
    assert got == {1: [], 2: []}  # the first text was not looked at with that rule
    rows = {r.doc_id: [tuple(s) for s in r.secrets] for r in secrets.findings(both, ledger).collect()}
    assert rows == {1: plain(TEXTS[1]), 2: plain(TEXTS[1]), 3: plain(TEXTS[2]), 4: []}


def test_empty_table_and_long_text(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert secrets.scan(empty, str(tmp_path / "a")) == 0 and secrets.findings(empty, str(tmp_path / "a")).count() == 0
    long = ("é word " * 100_000) + f"token={KEY} " + "ab12" * 50_000
    frame = spark.createDataFrame([(1, long), (1, long)], "doc_id long, text string")
    assert secrets.scan(frame, str(tmp_path / "b")) == 3
    assert [[tuple(s) for s in r.secrets] for r in secrets.findings(frame, str(tmp_path / "b")).collect()] == [plain(long)] * 2
