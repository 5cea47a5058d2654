"""Helpers that took too many CPU seconds: the same results from less."""

from __future__ import annotations

import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from girolens.llm import suffix_dedup, token_blocks


def test_bits_of_a_block_are_bytes():
    """Four bytes for each bit, twice over, made a block of 4,096 ids half a megabyte."""
    ids = (np.arange(4096, dtype="<u4") * np.uint32(7919)) % np.uint32(49_000)
    tracemalloc.start()
    try:
        token_blocks.unpack(token_blocks.pack(ids))
        assert tracemalloc.get_traced_memory()[1] < 300_000
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("high", [0, 1, 3, 255, 256, 40_000, (1 << 16) - 1, 1 << 16, (1 << 20) + 3, (1 << 32) - 1])
def test_blocks_hold_the_bits_of_the_plain_layout(high):
    """Bits are taken apart in bytes now, not in a number of four bytes for each bit; the files stay as they were."""
    rng = np.random.default_rng(high % 1000)
    ids = rng.integers(0, high, 5000, np.uint64, endpoint=True).astype("<u4") if high else np.full(5000, 7, "<u4")
    ids[::31] = rng.integers(0, 1 << 32, len(ids[::31]), np.uint64).astype("<u4") if high > 300 else ids[0]
    for n in (1, 7, 4096, 5000):
        part = ids[:n]
        data = token_blocks.pack(part)
        low, bits = int(part.min()), int(np.frombuffer(data, "<u2", 1, 8)[0])
        v = (part - np.uint32(low)).astype(np.uint32)
        plain = np.packbits(((v[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)).astype(np.uint8), bitorder="little")
        assert data[12 : 12 + len(plain)] == plain.tobytes() and np.array_equal(token_blocks.unpack(data), part)


class Counted:
    """A tokenizer that counts the words it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.words = tokenizer, Counter()

    def encode_batch_fast(self, texts, add_special_tokens):
        self.words.update(w for t in texts for w in t.split(" "))
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=add_special_tokens)


def test_each_different_word_of_many_texts_is_looked_up_once():
    """Every word of every text was looked up, and the forms with a capital went to the library too."""

    class Known(dict):
        gets = 0

        def get(self, *args):
            self.gets += 1
            return super().get(*args)

    coder = token_blocks.WordCoder(public_tokenizers.path("word_bpe_49k.json"))
    coder._known = known = Known()
    coder._plain = counted = Counted(coder._plain)
    texts = ["The end of the road, The road of the end.\nthe  end " * 5] * 64
    counts, ids = coder.encode(texts, 2)
    assert known.gets <= 20 and set(counted.words) == {"the", "end", "of", "road"} and set(counted.words.values()) == {1}
    want = [*coder._tokenizer.encode(texts[0], add_special_tokens=False).ids, 2]
    assert counts == [len(want)] * 64 and ids.tolist() == want * 64


def test_words_in_use_stay_known(monkeypatch):
    """All words were forgotten at the limit, those of every text too."""
    monkeypatch.setattr(token_blocks, "_WORDS", 1000)
    coder = token_blocks.WordCoder(public_tokenizers.path("word_bpe_49k.json"))
    coder._plain = counted = Counted(coder._plain)
    letters = "abcdefghij"
    fresh = iter("zq" + a + b + c + d for a in letters for b in letters for c in letters for d in letters)
    for _ in range(20):
        text = " ".join(["often", "used", "words", *(next(fresh) for _ in range(300))])
        _, ids = coder.encode([text], 2)
        assert ids.tolist() == [*coder._tokenizer.encode(text, add_special_tokens=False).ids, 2]
        assert len(coder._known) + len(coder._before) <= 2 * 1000
    assert [counted.words[w] for w in ("often", "used", "words")] == [1, 1, 1]
    coder.encode([" ".join(next(fresh) for _ in range(3000))], 2)
    coder.encode(["often"], 2)
    assert len(coder._known) + len(coder._before) <= 1000  # what one large call added does not stay


def test_marks_are_cut_off_where_the_library_does():
    """Also behind letters that turn into two in lower case, signs that join the marks, and next to added tokens."""
    coder = token_blocks.WordCoder(public_tokenizers.path("word_bpe_49k.json"))
    ends = [chr(k) for k in [*range(1, 0x400), 0x1E9E, 0x2019, 0x2126, 0x4E2D, 0xFF0C, 0x1F600]]
    texts = [f"{c}{m} a{c}{m} {m}{c} {c}'s{m} 1{c}{m}\n{c}x{m}" for c in ends for m in (".", "'", "!'", "|")]
    texts += ["", "\n", " .", ".", "a.", ". a", "J\u030c, J\u030c", "b<|endoftext|>. c", "<| a.", "x."]
    column = pa.array(["before.", None, *texts, None, ".after"]).slice(1, len(texts) + 2)
    for given in (column, column.cast(pa.large_string())):
        counts, ids = coder.encode(given, 2)
        want = [[*coder._tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in column.to_pylist()]
        assert counts == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    counts, ids = coder.encode([], 2)
    assert counts == [] and len(ids) == 0


def test_files_hold_texts_of_several_blocks_of_bytes(spark, tmp_path, monkeypatch):
    """Words of as many texts as fit some bytes are numbered at a time; the rows are those of single texts."""
    texts = {k: None if k % 17 == 0 else f"Word{k}, word " * (k % 40) for k in range(300)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    found = []
    for size in (1, 500, 4 << 20):
        monkeypatch.setattr(token_blocks, "_TEXT_BYTES", size)
        token_blocks.write(frame, str(tmp_path / str(size)))
        rows = token_blocks.read(spark, str(tmp_path / str(size)), ids=True).orderBy("doc_id").collect()
        found.append([(r.doc_id, r.start, r.n_tokens, r.ids, r.ids_crc32) for r in rows])
    tokenizer, start = token_blocks.coder("word_bpe_49k.json")._tokenizer, 0
    for k, row in enumerate(found[0]):
        ids = [*tokenizer.encode(texts[k] or "", add_special_tokens=False).ids, 2]
        assert row == (k, start, len(ids), ids, zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert found[0] == found[1] == found[2] and len(found[0]) == 300


def test_anchors_equal_those_of_each_window(monkeypatch):
    """Runs of windows with one anchor, also across parts, empty, short and just long enough texts."""
    rng = np.random.default_rng(5)
    texts = [rng.integers(97, 100, n, np.uint8).tobytes() for n in (0, 49, 50, 0, 51, 0, 0, 700, 3, 90, 400, 0)] + [b"a" * 120, b"", b"ab" * 60]
    text, at = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    found = []
    for size in (1 << 17, 100):
        monkeypatch.setattr(suffix_dedup, "_ANCHOR_BYTES", size)
        row, first, last, h, sides = suffix_dedup._runs(text, at)
        found.append({(r, p): (int(x), int(s)) for r, a, b, x, s in zip(row, first, last, h, sides, strict=True) for p in range(a, b + 1)})
        assert len(found[-1]) == int((last - first + 1).sum())
    wanted = {(r, int(at[r]) + k) for r, t in enumerate(texts) for k in range(len(t) - suffix_dedup.WINDOW + 1)}
    assert found[0].keys() == wanted == found[1].keys()
    windows = {}
    for (r, p), (x, _) in found[0].items():
        assert windows.setdefault(text[p : p + suffix_dedup.WINDOW].tobytes(), x) == x == found[1][r, p][0]
    parts, blocks = [], suffix_dedup.blocks
    monkeypatch.setattr(suffix_dedup, "_ANCHOR_BYTES", 1 << 17)
    monkeypatch.setattr(suffix_dedup, "blocks", lambda at, *size: parts.extend(blocks(at, *size)) or iter(parts))
    long = np.tile(text, 400)
    suffix_dedup._runs(long, np.arange(0, len(long) + 1, len(text)))
    assert len(parts) > 1  # a megabyte at once left the cache
