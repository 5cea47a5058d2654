"""Chat repair, fingerprints and boosted trees against plain versions that share no code with them."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import Row

from girolens.llm import chat, fingerprints, quality

M = (1 << 64) - 1


def repairs(roles, texts):
    """The rendered forms of all legal repairs with at most two inserted turns in front of a turn, and their least cost."""
    after = {None: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    found = {}

    def shown(turns):
        return "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns)

    def go(k, turns, cost):
        last = turns[-1][0] if turns else None
        if k == len(roles):
            done = [*turns, ("user", "")] if last == "system" else turns
            cost += 3 * (last == "system")
            found[shown(done)] = min(cost, found.get(shown(done), cost))
            return
        if turns:
            change = 0 if roles[k] == last else 2 if roles[k] in ("system", "user", "assistant") else 1
            go(k + 1, [*turns[:-1], (last, turns[-1][1] + "\n" + texts[k])], cost + 1 + change)
        for role in ("system", "user", "assistant"):
            change = 0 if roles[k] == role else 2 if roles[k] in ("system", "user", "assistant") else 1
            fronts = [[]]
            for _ in range(2):
                fronts += [[*f, r] for f in fronts for r in after[f[-1] if f else last] if [*f, r] not in fronts]
            for front in fronts:
                if len(front) <= 2 and role in after[front[-1] if front else last]:
                    go(k + 1, [*turns, *((r, "") for r in front), (role, texts[k])], cost + change + 3 * len(front))

    go(0, [], 0)
    return found


def test_rendered_repairs_are_legal_and_cheapest(spark):
    rnd = random.Random(4)
    chats = {c: [rnd.choice(["system", "user", "assistant", "tool"]) for _ in range(rnd.randint(1, 4))] for c in range(60)}
    turns = [Row(conv_id=c, turn=k, role=r, text=f"text {k}") for c, roles in chats.items() for k, r in enumerate(roles)]
    got = {}
    for row in sorted(chat.repair(spark.createDataFrame(turns)).collect(), key=lambda r: r.position):
        got[row.conv_id] = got.get(row.conv_id, "") + row.rendered
    for c, roles in chats.items():
        every = repairs(roles, [f"text {k}" for k in range(len(roles))])
        assert got[c] in every, (roles, got[c])
        assert every[got[c]] == min(every.values()), (roles, got[c])


def mixed(h):
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ h >> 33) * factor & M
    return h ^ h >> 33


def slow_print(text):
    """256 bins of 4 bits, one shingle and one bin after the other."""
    if not text:
        return ""
    codes = [0x110000] * 7 + [ord(c) for c in text] + [0x110000] * 7
    bins = {}
    for k in range(len(codes) - 7):
        h = 0
        for c in codes[k : k + 8]:
            h = (h * 0x9E3779B97F4A7C15 + c + 1) & M
        h = mixed(h)
        bins[h >> 56] = min(bins.get(h >> 56, M), h & (1 << 56) - 1)
    digits = []
    for b in range(256):
        source, attempt = b, 0
        while source not in bins:
            attempt += 1
            source = mixed(b + attempt * 256) % 256
        digits.append(f"{mixed(bins[source]) % 16:x}")
    return "".join(digits[k + 1] + digits[k] for k in range(0, 256, 2))


def slow_likeness(a, b):
    if not a or not b:
        return float(a == b)
    agree = sum(x == y for x, y in zip(a, b, strict=True)) / 256
    return min(1.0, max(0.0, (agree - 1 / 16) / (1 - 1 / 16)))


def test_fingerprints_and_likeness_equal_a_slow_version(spark, docs):
    few = docs.where("doc_id IS NOT NULL AND doc_id NOT IN (2, 9)")
    texts = sorted((r.doc_id, r.text or "") for r in few.collect())
    got = {r.doc_id: r for r in fingerprints.compare(few).collect()}
    assert len(got) == len(texts) > 8
    for k, (doc, text) in enumerate(texts):
        after = texts[(k + 1) % len(texts)][1]
        cut = len(text) // 4
        own, edited, follower = slow_print(text), slow_print(text[: len(text) - cut] + after[:cut]), slow_print(after)
        assert (got[doc].fingerprint, got[doc].edited_fingerprint) == (own, edited), doc
        assert got[doc].near_edited == pytest.approx(slow_likeness(own, edited)), doc
        assert got[doc].near_next == pytest.approx(slow_likeness(own, follower)), doc


def walked(trees, row):
    total = trees.start
    for node in trees.roots:
        while trees.feature[node] >= 0:
            node = trees.left[node] + int(row[trees.feature[node]] > trees.threshold[node])
        total += trees.value[node]
    return 1 / (1 + math.exp(-total))


def test_trees_are_walked_node_by_node():
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(400, 6)).round(1)  # ties in every column
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] + x[:, 4] > 0.5)).astype(float)
    trees = quality.grow(x, y, trees=20)
    assert len(trees.roots) == 20 and trees.feature.max() >= 0
    assert np.allclose(trees.scores(x), [walked(trees, r) for r in x])
    assert ((trees.scores(x) >= 0.5) == y).mean() > 0.9


def test_first_split_is_the_best_of_all():
    """One tree of depth one against all splits of all columns, by the gain in second order."""
    rnd = np.random.default_rng(6)
    for _ in range(10):
        x = rnd.integers(0, 12, (80, 4)).astype(float)
        y = (x[:, rnd.integers(0, 4)] + rnd.normal(size=80) > 6).astype(float)
        trees = quality.grow(x, y, trees=1, depth=1)
        share = (y.sum() + 0.5) / (len(y) + 1)

        def weight(part, share=share):
            return sum(v - share for v in part), len(part) * share * (1 - share)

        best = (0.0, None)
        for f in range(4):
            for cut in sorted(set(x[:, f])):
                sides = [y[x[:, f] <= cut], y[x[:, f] > cut]]
                if min(map(len, sides)) >= 5:
                    gain = sum(g * g / (h + 1) for g, h in map(weight, sides))
                    best = max(best, (round(gain, 9), [0.15 * g / (h + 1) for g, h in map(weight, sides)]), key=lambda b: b[0])
        kids = trees.left[trees.roots[0]]
        assert trees.feature[trees.roots[0]] >= 0 and np.allclose(sorted(trees.value[[kids, kids + 1]]), sorted(best[1]))
