"""Operators over documents against brute force on a small table."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from girolens.llm import bpe, decontaminate, fingerprints, near_dedup, quality, suffix_dedup, token_blocks
from tests.llm.conftest import LONG


def rows(frame, *columns):
    return [tuple(r) for r in frame.select(*columns).collect()]


def sorted_docs(docs):
    return sorted(rows(docs, "doc_id", "text"), key=lambda r: (r[0] is not None, r[0] or 0))


def test_bpe_equals_the_library_and_round_trips(docs):
    coder = bpe.codec("byte_bpe_50k.tiktoken")
    small = bpe.Codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, leaf=8)
    got = sorted(map(str, rows(bpe.encode(docs), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")))
    want = []
    for doc, text in sorted_docs(docs):
        ids = coder._coder.encode_ordinary(text or "")
        if len(text or "") < 20_000:
            assert small.encode(text or "") == ids
        shown = " ".join(map(str, ids))
        want.append((doc, len(ids), hashlib.sha256(shown.encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(map(str, want))
    assert bpe.encode(docs.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["ab" * 3000, " \n" * 3000, "=" * 5001, "12" * 3000, "x" + " " * 5000, "'s'll ''re" * 500, "é\x1c中́'t"])
def test_bpe_long_runs(text):
    small = bpe.Codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, leaf=16)
    ids = small._coder.encode_ordinary(text)
    assert small.encode(text) == ids and small.decode(ids) == text.encode()


def jaccard_components(pairs, n, percent):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for doc, text in pairs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(low))
        sets[doc] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set()
    home = {d: d for d in sets}

    def find(d):
        while home[d] != d:
            d = home[d]
        return d

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                home[y] = x
    return sets, {d: find(d) for d in sets}


@pytest.mark.parametrize(("n", "percent"), [(3, 85), (5, 80)])
def test_near_dedup_equals_all_pairs(docs, n, percent):
    sets, home = jaccard_components([r for r in sorted_docs(docs) if r[0] is not None], n, percent)
    got = rows(near_dedup.link(docs, n, percent), "doc_id", "n_shingles", "component_id", "kept")
    assert len(got) == docs.count()
    for doc, size, component, kept in got:
        if doc is None:
            assert component is None and kept
        else:
            assert (size, component, kept) == (len(sets[doc]), home[doc], home[doc] == doc)
    assert home[8] == 7 and home[2] == 1 and home[6] == 6
    assert near_dedup.link(docs.limit(0), n, percent).count() == 0
    left = near_dedup.keep(docs, n, percent)
    assert left.columns == docs.columns
    assert sorted(str(r[0]) for r in rows(left, "doc_id")) == sorted([*(str(d) for d in home if home[d] == d), "None"])


@pytest.mark.parametrize("block", [near_dedup.BLOCK, 24])
def test_near_dedup_in_a_large_group_of_near_copies(spark, monkeypatch, block):
    """Texts of one group whose links form no star; the components are those of all pairs, also if its frequent shingles
    are dealt to many pairs of blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rare, large = near_dedup._rare, []
    monkeypatch.setattr(near_dedup, "_rare", lambda members, *rest: large.append(members.count()) or rare(members, *rest))
    rnd = np.random.default_rng(5)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for k in range(300):
        words = list(base)
        for at in rnd.integers(0, 60, rnd.integers(0, 5)):
            words[at] = f"v{rnd.integers(0, 4)}" if k % 2 else f"u{k}x{at}"
        texts.append((k, " ".join(words)))
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    _, home = jaccard_components(texts, 3, 85)
    got = dict(rows(near_dedup.link(frame, 3, 85), "doc_id", "component_id"))
    assert got == home and 1 < len(set(home.values())) < 300
    assert large[0] > 0


def test_hamming_keys_meet_within_the_budget():
    rnd = np.random.default_rng(1)
    limit = near_dedup.budget(85)
    ways = near_dedup.patterns(limit)
    for _ in range(300):
        a = rnd.integers(0, 1 << 16, near_dedup.SYMBOLS)
        b = a.copy()
        b[rnd.choice(near_dedup.SYMBOLS, limit, replace=False)] += 1
        assert any((a[w] == b[w]).all() for w in ways)


def removed(pairs, window=50):
    seen, out = {}, {}
    for doc, text in sorted((p for p in pairs if p[0] is not None), key=lambda p: p[0]):
        data = (text or "").encode()
        for i in range(len(data) - window + 1):
            seen.setdefault(data[i : i + window], doc)
    for doc, text in pairs:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - window + 1):
            if doc is not None and seen[data[i : i + window]] < doc:
                gone[i : i + window] = True
        edges = np.diff(np.concatenate([[0], gone.astype(int)]))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out[doc] = (len(data), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest(), kept)
    return out


def test_suffix_dedup_equals_brute_force(docs):
    want = removed(sorted_docs(docs))
    got = rows(suffix_dedup.removals(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert len(got) == docs.count() and all(r[1:] == want[r[0]][:4] for r in got)
    assert want[2][1] == want[2][0] and want[11][1] >= len(LONG) and want[9][1] == 0
    texts = suffix_dedup.removals(docs, texts=True)
    assert texts.columns == docs.columns
    assert all(text == want[doc][4].decode("utf-8", "ignore") and n == len(text) for doc, text, n in rows(texts, "doc_id", "text", "n_chars"))
    assert suffix_dedup.removals(docs.limit(0)).count() == 0


def test_anchors_of_many_strings_are_dealt_by_windows(spark, monkeypatch):
    """A phrase in ever different surroundings is not held by one task, and nothing is lost."""
    rnd = np.random.default_rng(9)

    def letters(n):
        return rnd.integers(97, 123, n).astype(np.uint8).tobytes().decode()

    phrases = [letters(n) for n in (20, 24, 35, 49, 60, 80)]
    pairs = [(k, "".join(letters(int(rnd.integers(0, 60))) + p for p in phrases) + letters(40) + "-" * int(rnd.integers(40, 70))) for k in range(400)]
    calls = []
    real = suffix_dedup._marks
    monkeypatch.setattr(suffix_dedup, "HOT_STRINGS", 50)
    monkeypatch.setattr(suffix_dedup, "_marks", lambda *a: calls.append(a) or real(*a))
    frame = spark.createDataFrame(pairs, "doc_id long, text string").repartition(8)
    got = rows(suffix_dedup.removals(frame), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    want = removed(pairs)
    assert len(got) == 400 and all(r[1:] == want[r[0]][:4] for r in got)
    strings = suffix_dedup._dealt(*calls[0]).where("octet_length(data) >= 50").groupBy("anchor").count()
    assert len(calls[0][2]) and (strings.agg(F.max("count")).first()[0] or 0) <= 50


@pytest.mark.parametrize("letters", [1, 2, 4, 200])
def test_induced_order_and_queues_on_disk(letters, monkeypatch):
    rnd = np.random.default_rng(letters)
    text = np.append(rnd.integers(1, letters + 1, 3000), 0).astype(np.uint8)
    data = text.tobytes()
    for queued in (suffix_dedup.QUEUED, 256):
        monkeypatch.setattr(suffix_dedup, "QUEUED", queued)
        order = suffix_dedup.suffix_order(text)
        keys = [data[i : i + 50] for i in order]
        assert sorted(order.tolist()) == list(range(3001)) and keys == sorted(keys)


@pytest.mark.parametrize("text", [b"\0", b"a\0", b"aa\0\0", b"ab\0ba" + b"-" * 70 + b"\0\0", b"\0\0\0\0", b"b\0a\0\0b\0\0", b"cab" + b" " * 60 + b"=" * 60 + b"\0\0"])
def test_order_of_texts_that_end_with_several_zeros(text):
    order = suffix_dedup.suffix_order(np.frombuffer(text, np.uint8)).tolist()
    keys = [text[i : i + 50].ljust(50, b"\0") for i in order]
    assert sorted(order) == list(range(len(text))) and keys == sorted(keys)


def test_windows_of_a_long_run_at_the_end_are_found():
    strings = [b"-" * 70 + b"a", b"b" + b"-" * 70]
    whole, marked = suffix_dedup._decided(np.array([5, 5]), np.array([1, 2]), strings)
    assert not whole.any() and marked.keys() == {1} and marked[1].tolist() == [False] + [True] * 21


def test_decontamination_finds_edited_passages_and_leaves_clean_text(spark, docs):
    items = [(1, "The quick brown fox jumps over the lazy dog while thirteen wizards vexingly quiz the daft jocks."), (2, None),
             (3, "short"), (None, "nobody"), (4, " ".join(f"term{i * 37 % 101}" for i in range(80)))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    edited = items[0][1].replace("brown", "browm").replace("wizards ", "wizard ").upper()
    dirty = [(20, "Before. " + edited + " After."), (21, "x " * 300_000 + items[0][1]), (22, items[4][1][100:400]),
             (23, "The quick brown fox jumps over another hedge, and thirteen cats sleep.")]
    frame = docs.unionByName(spark.createDataFrame(dirty, "doc_id long, text string"), allowMissingColumns=True)
    found = {d: r for d, r in rows(decontaminate.find(frame, benchmark), "doc_id", "regions")}
    assert {d for d, r in found.items() if r} == {20, 21, 22}
    assert {x.item_id for x in found[20]} == {1} and found[20][0].edits == 2
    start, end = found[21][0].start, found[21][0].end
    assert dirty[1][1][start:end] == items[0][1]
    left = decontaminate.clean(frame, benchmark)
    assert left.columns == frame.columns and left.count() == frame.count() - 3
    passes = rows(decontaminate.find(frame, benchmark, chars=100), "doc_id", "regions")
    assert sorted(map(str, passes)) == sorted(map(str, rows(decontaminate.find(frame, benchmark), "doc_id", "regions")))
    assert decontaminate.clean(frame, benchmark.limit(0)).count() == frame.count()


def test_quality_learns_statistics_and_scores_everything(spark, docs):
    good = [(100 + i, f"The report on item {i} was written with care. It has {i} parts and each of them is short.", 1) for i in range(200)]
    bad = [(400 + i, f"BUY!! NOW!! {i}!! CHEAP!! " * (3 + i % 5), 0) for i in range(200)]
    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame([r[:2] for r in good + bad], "doc_id long, text string"))
    labels = spark.createDataFrame([(r[0], r[2], 0) for r in good + bad] + [(None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    trees = quality.fit(frame, labels)
    got = rows(quality.score(frame, trees), "doc_id", "held_out", "score", "predicted")
    assert len(got) == frame.count() and all(0 <= s <= 1 and p == int(s >= 0.3) for _, _, s, p in got)
    assert all(h == (d is not None and zlib.crc32(str(d).encode()) % 5 == 0) for d, h, _, _ in got)
    truth = {r[0]: r[2] for r in good + bad}
    held = [(d, p) for d, h, _, p in got if h and d in truth]
    assert len(held) > 40 and sum(truth[d] == p for d, p in held) >= 0.95 * len(held)
    nothing = quality.fit(frame, labels.limit(0))
    assert {s for _, _, s, _ in rows(quality.score(frame, nothing), "doc_id", "held_out", "score", "predicted")} == {0.5}
    assert quality.score(frame.limit(0), trees).count() == quality.keep(docs.limit(0), trees).count() == 0
    assert {s for _, _, s, _ in rows(quality.score(frame, quality.fit(frame.limit(0), labels)), "doc_id", "held_out", "score", "predicted")} == {0.5}
    twice = rows(quality.score(docs.where("doc_id = 2"), trees), "score")
    assert len(twice) == 2 and twice[0] == twice[1]
    assert quality.keep(docs, nothing).columns == docs.columns and quality.keep(docs, nothing).count() == docs.count()


def test_fingerprints(docs):
    got = rows(fingerprints.compare(docs), "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    texts = [(d, t or "") for d, t in sorted_docs(docs)]
    want = sorted((str(d), len(t)) for d, t in texts)
    assert sorted((str(r[0]), r[1]) for r in got) == want
    by_id = {r[0]: r for r in got}
    for k, (doc, text) in enumerate(texts):
        if doc in (2, 1):
            continue  # a repeated id: either row may come first
        after = texts[(k + 1) % len(texts)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        assert by_id[doc][2] == hashlib.sha256(edited.encode()).hexdigest(), doc
    assert by_id[1][3] == by_id[2][3] and by_id[1][6] == 1.0 and by_id[4][3] == "" and len(by_id[7][3]) == 256
    assert by_id[3][5] > 0.6 and all(0 <= r[5] <= 1 and 0 <= r[6] <= 1 for r in got)
    assert fingerprints.compare(docs.limit(0)).count() == 0
    assert rows(fingerprints.compare(docs.where("doc_id = 7")), "near_next") == [(1.0,)]


def test_bias_corrected_likeness_is_close_to_jaccard():
    rnd = np.random.default_rng(3)
    off = []
    for _ in range(60):
        a = rnd.integers(97, 123, 2000).astype(np.uint32)
        b = a.copy()
        at = rnd.integers(0, 1500)
        b[at : at + 400] = rnd.integers(97, 123, 400)
        grams = [{x[i : i + 8].tobytes() for i in range(len(x) - 7)} for x in (a, b)]
        true = len(grams[0] & grams[1]) / len(grams[0] | grams[1])
        off.append(fingerprints.likeness(fingerprints.fingerprint(a), fingerprints.fingerprint(b)) - true)
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.06


def test_token_blocks_round_trip(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    longer = " ".join(f"word{i % 977}" for i in range(600_000))  # more ids than a segment holds
    docs = docs.unionByName(spark.createDataFrame([(99, longer)], "doc_id long, text string"), allowMissingColumns=True)
    token_blocks.write(docs, str(tmp_path / "ids"))
    got = sorted(rows(token_blocks.read(spark, str(tmp_path / "ids"), ids=True), "start", "doc_id", "n_tokens", "ids", "ids_crc32"))
    start = 0
    for (doc, text), row in zip(sorted_docs(docs), got, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert row == (start, doc, len(ids), ids, zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(ids) > 1 << 20
    assert token_blocks.round_trip(docs.limit(0)).count() == 0


def nearest(piece, text):
    """Fewest edits between the piece and any part of the text."""
    row = np.zeros(len(text) + 1, int)
    steps = np.arange(len(text) + 1)
    for i, ch in enumerate(piece):
        new = np.minimum(row[1:] + 1, row[:-1] + (text != ch))
        new = np.concatenate([[i + 1], new])
        row = np.minimum.accumulate(new - steps) + steps
    return row.min()


def test_decontamination_equals_edit_distances_over_all_places(spark):
    rnd = np.random.default_rng(11)
    letters = np.array(list("abcdefgh "))
    items = ["".join(rnd.choice(letters, n)) for n in (24, 40, 95, 96, 143, 144, 260)]
    texts = []
    for k in range(90):
        item = items[k % len(items)].strip()
        part = list(item[: 96 if len(item) > 143 else len(item)]) if k % 3 else list(item[50:146])
        for _ in range(int(rnd.integers(0, len(part) // 6 + 1))):
            at, way = rnd.integers(0, len(part)), rnd.integers(0, 3)
            part[at : at + (way != 1)] = [] if way == 0 else [rnd.choice(letters)]
        texts.append("".join(rnd.choice(letters, 120)) + "".join(part) + "".join(rnd.choice(letters, 90)))
    ix = decontaminate.index(list(enumerate(items)))
    got = [bool(r) for r in decontaminate.regions(ix, texts)]
    want = []
    for text in texts:
        c, _ = decontaminate.normal(text)
        want.append(any(nearest(ix.chars[p, : ix.size[p]], c) <= ix.edits[p] for p in range(len(ix.size))))
    assert got == want and 20 < sum(want) < 85


def test_short_items_match_as_they_are(spark, docs):
    benchmark = spark.createDataFrame([(1, "Two  words"), (2, "an"), (3, " "), (4, "中文"), (5, "é là"), (6, "Fin."), (6, "word7 is")], "item_id long, text string")
    frame = docs.unionByName(spark.createDataFrame([(50, "An end, two\nWORDS!"), (51, "twowords two words1"), (52, "中文 an-x")], "doc_id long, text string"), allowMissingColumns=True)
    found = {d: {(x.item_id, x.start, x.end) for x in r} for d, r in rows(decontaminate.find(frame, benchmark), "doc_id", "regions")}
    assert found[50] == {(2, 0, 2), (1, 8, 17)} and found[51] == set() and found[52] == {(4, 0, 2), (2, 3, 5)}
    assert found[7] == {(1, 0, 9)} and found[8] == {(1, 0, 9)} and found[12] == set() and found[4] == found[5] == set()
    assert {i for i, _, _ in found[1]} == {6} and {i for i, _, _ in found[11]} == {6}
    assert decontaminate.find(docs.limit(0), benchmark).count() == 0


def test_added_tokens_are_encoded_as_the_library_does():
    from tokenizers import Tokenizer

    file = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, coder = Tokenizer.from_file(file), token_blocks.WordCoder(file)
    texts = ["a <|endoftext|> b", "a<|endoftext|>b", "<|STARTOFTEXT|> x", "<|startoftext|>\n\n two <|endoftext|><|endoftext|>", "< |endoftext|>", "<|", "<|endof text|>",
             " <|endoftext|> ", "plain words", "", "é <|EndOfText|>İ", "word. " * 300 + "<|endoftext|>" + " word" * 300]
    counts, ids = coder.encode(texts, 2)
    want = [[*tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert counts == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert want[0] == [320, 49407, 321, 2]


def test_packing():
    rnd = np.random.default_rng(0)
    cases = [rnd.zipf(1.3, n) % 50_000 for n in (1, 2, 100, 4096)] + [np.array([0]), np.array([2**32 - 1, 0]), np.full(4096, 7)]
    for ids in cases:
        ids = ids.astype(np.uint32)
        assert (token_blocks.unpack(token_blocks.pack(ids)) == ids).all()
    ids = rnd.integers(0, 50_000, 20_000).astype(np.uint32)
    counts = [0, 5000, 1, 14_999]
    data = token_blocks.segment(counts, ids)
    parts = list(token_blocks.documents(data))
    assert [len(p) for p in parts] == counts and (np.concatenate(parts) == ids).all()
    assert (next(token_blocks.documents(data, 2, 3)) == ids[5000:5001]).all()


def test_components(spark):
    from girolens.llm.common import components

    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (300, 200), (250, 300)]
    got = dict(rows(components(spark.createDataFrame(chain, "u long, v long")), "node", "component"))
    want = {i: 0 for i in range(1, 41)} | {101: 100, 300: 200, 250: 200}
    assert {k: v for k, v in got.items() if k != v} == want
    assert components(spark.createDataFrame([], "u long, v long")).where(F.lit(True)).count() == 0
