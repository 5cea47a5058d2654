"""The Merkle manifest against a plain one, and its edge cases."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from girolens.llm import merkle

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row: tuple) -> str:
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes: list[str], fan: int) -> tuple[str, list[list]]:
    steps: list[list] = [[] for _ in nodes]
    place = list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(place):
            run = nodes[i // fan * fan : i // fan * fan + fan]
            steps[k].append((run[: i % fan], run[i % fan + 1 :]))
        place = [i // fan for i in place]
        nodes = [h(*nodes[i : i + fan]) for i in range(0, len(nodes), fan)]
    return nodes[0], steps


def plain(rows: list[tuple], fan: int = 16) -> list[tuple]:
    """rows: doc_id, source, lang, n_chars, text."""
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    held = []
    for source in sorted(groups, key=lambda s: (s is not None, (s or "").encode())):
        own = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        held.append((own, *tree([leaf(r) for r in own], fan)))
    root, over = tree([sub for _, sub, _ in held], fan) if held else ("", [])
    out = []
    for (own, sub, steps), top in zip(held, over, strict=True):
        for row, low in zip(own, steps, strict=True):
            proof = low + top
            tampers = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None
            node = leaf((*row[:4], row[4].translate(LOW))) if tampers else leaf(row)
            for left, right in proof:
                node = h(*left, node, *right)
            out.append((row[0], leaf(row), sub, root, h(*(d for a, b in proof for d in a + b)), node, node == root))
    return out


def got(frame) -> list[tuple]:
    return sorted(map(tuple, frame.collect()), key=str)


def test_equals_a_plain_tree(docs):
    frame = docs.withColumn("source", F.when(F.col("lang") != "fr", F.concat("lang", F.lit("É"))).otherwise(F.lit("")))
    frame = frame.withColumn("source", F.when(F.col("doc_id") != 12, F.col("source")))
    for name in ("tree", "idx", "n", "node", "at", "steps", "left", "sibling", "leaf", "root"):
        frame = frame.withColumn(name, F.lit(name))
    rows = [tuple(r) for r in frame.select(*merkle.FIELDS).collect()]
    rows = [(r[0], r[1], r[2], r[3], r[4]) for r in rows]
    assert got(merkle.verified(frame)) == sorted(plain(rows), key=str)


@pytest.mark.parametrize("sizes", [[1], [16], [17], [1, 1], [300, 2, 16, 1], [1] * 40])
def test_sizes_of_trees(spark, sizes):
    rows = [(i * 7 + g, f"s{g}" if g else None, "en", i, f"Text {i % 5}") for g, n in enumerate(sizes) for i in range(n)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string").repartition(5)
    assert got(merkle.verified(frame)) == sorted(plain(rows), key=str)
    # another fan-out, and groups that are too many to be broadcast
    few, merkle.FEW_GROUPS = merkle.FEW_GROUPS, 0
    try:
        held = merkle.manifest(frame, fan=2).select(F.lower(F.hex("leaf")), F.lower(F.hex("root")),
                                                    merkle.proof_digest(F.col("steps")), merkle.folded(F.col("leaf"), F.col("steps")) == F.col("root"))
        assert got(held) == sorted(((r[1], r[3], r[4], True) for r in plain(rows, 2)), key=str)
    finally:
        merkle.FEW_GROUPS = few


def test_empty_table_and_long_text(spark):
    shape = "doc_id long, source string, lang string, n_chars int, text string"
    assert merkle.verified(spark.createDataFrame([], shape)).count() == 0
    rows = [(5, "a", None, None, "É " * 500_000), (5, "a", None, None, "É " * 500_000), (6, "a", "", 0, "")]
    assert got(merkle.verified(spark.createDataFrame(rows, shape))) == sorted(plain(rows), key=str)
