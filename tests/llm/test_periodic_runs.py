"""Periodic runs against all stretches of all periods."""

from __future__ import annotations

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from girolens.llm import periodic_runs
from girolens.llm.common import table


def all_runs(words, least=6, periods=4):
    found = {}
    for q in range(1, len(words) // periods + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, periods * q):
                found.setdefault((i, j + q), q)  # the smallest period comes first
            i = j + 1
    return sorted((start, end - start, q) for (start, end), q in found.items())


def digests(doc, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc).encode())
    if doc is not None and h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = all_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(st.text("ab", min_size=1, max_size=9), st.integers(1, 9)), max_size=6), max_size=4), st.integers(1, 40))
def test_equals_all_stretches(parts, step):
    texts = [list("".join(t * n for t, n in text)) for text in parts]
    assert periodic_runs.runs_of(texts, step) == [all_runs(t) for t in texts]
    assert periodic_runs.runs_of(texts, step, 2, 2) == [all_runs(t, 2, 2) for t in texts]


@pytest.mark.parametrize("step", [1, 7, 1000, 1 << 20])
def test_long_periods_and_words_of_special_kinds(step):
    rnd = np.random.default_rng(3)
    word = [str(x) for x in rnd.integers(0, 50, 301)]
    fibonacci, thue = ["a", "b"], "a"
    while len(fibonacci) < 2000:
        fibonacci = fibonacci + fibonacci[: -(-len(fibonacci) * 5 // 8)]
    while len(thue) < 2048:
        thue += thue.translate(str.maketrans("ab", "ba"))
    texts = [word * 5, word[:40] * 3 + word[:17], word + ["x"] * 700 + word, fibonacci[:900], list(thue), ["a"] * 1500, ["a", "b"] * 300 + ["c"], []]
    if step == 1:
        texts = [t[:400] for t in texts]
    assert periodic_runs.runs_of(texts, step) == [all_runs(t) for t in texts]


def test_hashes_decide_nothing(monkeypatch):
    monkeypatch.setattr(periodic_runs, "mix", lambda h: h & np.uint64(3))
    rnd = np.random.default_rng(4)
    texts = [[str(x) for x in rnd.integers(0, 3, 300)] * 2 + list("abcab") * 9, list("abcd" * 20)]
    assert periodic_runs.runs_of(texts) == [all_runs(t) for t in texts]


def test_query(spark, docs, folder):
    frame = docs.withColumnRenamed("lang", "runs").withColumnRenamed("n_chars", "collapsed")
    rows = [tuple(r) for r in frame.select("doc_id", "text").collect()] + [(d, "ja nein " * d) for d in range(20, 60)] + [(77, "la " * 60_000)]
    frame = frame.select("doc_id", "text", "runs", "key").unionByName(
        spark.createDataFrame(rows[docs.count():], "doc_id long, text string"), allowMissingColumns=True)
    found = periodic_runs.find(periodic_runs.planted(frame))
    got = sorted(map(tuple, periodic_runs.strongest(found).collect()), key=str)
    assert [r for r in got if r[0] != 77] == sorted((digests(d, t) for d, t in rows if d != 77), key=str)
    assert [r[1:6] for r in got if r[0] == 77] == [(1, 0, 60_000, 1, 60_000_000)]  # too long for the plain way
    assert periodic_runs.find(frame).columns == ["doc_id", "key", "runs", "collapsed"]
    assert periodic_runs.strongest(periodic_runs.find(periodic_runs.planted(frame.limit(0)))).count() == 0
    given = [tuple(r) for r in table(spark, folder, "documents").select("doc_id", "text").collect() if len(r.text) < 5000]
    want = sorted((digests(d, t) for d, t in given), key=str)
    have = periodic_runs.strongest(periodic_runs.find(periodic_runs.planted(table(spark, folder, "documents"))))
    ids = {d for d, _ in given}
    assert sorted((tuple(r) for r in have.collect() if r.doc_id in ids), key=str) == want
    assert any(r[1] for r in want)
