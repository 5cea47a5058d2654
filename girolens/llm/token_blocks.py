"""Token ids in files of patched frame-of-reference blocks.

A file is a Parquet part whose rows are segments in id order: the ids of the documents and one binary value each. The
binary value holds, little-endian: `PFR1`, number of documents, of ids and of blocks; the tokens of each document
(u32); the byte at which each block starts (u32, one more for the end); the blocks. A block holds its smallest id and
its number of ids (u32), a width and the number of exceptions (u16), the differences to the smallest id packed at the
width, and the positions (u16) and high bits (u32) of the exceptions. The width is the number of bits that a given
share of the differences fits in. Parquet gives what a folder of plain files can't: Spark commits a part whole or not
at all, so a repeated or lost task leaves no torn file.
"""

from __future__ import annotations

import functools
import json
import os
import string
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from girolens.llm.common import blocks, mapped, shared_folder, spans, width

BLOCK = 4096
#: Share of a block that the width has to hold.
PERCENTILE = 0.95
_SEGMENT_DOCS, _SEGMENT_IDS = 256, 1 << 20
#: Words whose ids a Python worker remembers, the last ones in use; one call may add its own words to that.
_WORDS = 600_000
#: Words that go to the library at a time.
_AT_ONCE = 1024
#: Bytes of text whose words are numbered at a time.
_TEXT_BYTES = 4 << 20


def _cell(bits: int) -> np.dtype:
    """The number that holds a difference while its bits are taken apart."""
    return np.dtype("<u2" if bits <= 16 else "<u4")


def pack(ids: np.ndarray) -> bytes:
    """One block."""
    low = int(ids.min())
    v = (ids - np.uint32(low)).astype(np.uint32)
    bits = int(np.partition(v, k := min(len(v) - 1, int(len(v) * PERCENTILE)))[k]).bit_length()
    odd = np.flatnonzero(v >> np.uint32(bits)) if bits < 32 else np.zeros(0, np.int64)
    cell = _cell(bits)
    cells = np.unpackbits(v.astype(cell).view(np.uint8), bitorder="little").reshape(len(v), 8 * cell.itemsize)
    packed = np.packbits(cells[:, :bits], bitorder="little")
    head = np.array([low, len(v)], "<u4").tobytes() + np.array([bits, len(odd)], "<u2").tobytes()
    return head + packed.tobytes() + odd.astype("<u2").tobytes() + (v[odd] >> np.uint32(min(bits, 31))).astype("<u4").tobytes()


def unpack(data: bytes) -> np.ndarray:
    low, n = np.frombuffer(data, "<u4", 2)
    bits, odd = (int(x) for x in np.frombuffer(data, "<u2", 2, 8))
    size = (int(n) * bits + 7) // 8
    cell = _cell(bits)
    cells = np.zeros((int(n), 8 * cell.itemsize), np.uint8)
    cells[:, :bits] = np.unpackbits(np.frombuffer(data, np.uint8, size, 12), count=int(n) * bits, bitorder="little").reshape(int(n), bits)
    v = np.packbits(cells, bitorder="little").view(cell).astype(np.uint32)
    at = np.frombuffer(data, "<u2", odd, 12 + size)
    v[at] |= np.frombuffer(data, "<u4", odd, 12 + size + 2 * odd) << np.uint32(min(bits, 31))
    return v + low


def segment(counts: list[int], ids: np.ndarray) -> bytes:
    blocks = [pack(ids[i : i + BLOCK]) for i in range(0, len(ids), BLOCK)]
    starts = np.cumsum([0, *map(len, blocks)]).astype("<u4")
    head = b"PFR1" + np.array([len(counts), len(ids), len(blocks)], "<u4").tobytes()
    return b"".join([head, np.array(counts, "<u4").tobytes(), starts.tobytes(), *blocks])


def documents(data: bytes, first: int = 0, last: int | None = None) -> Iterator[np.ndarray]:
    """The ids of documents `first` to `last` (exclusive) of a segment; only their blocks are unpacked."""
    assert data[:4] == b"PFR1"
    n, _, many = (int(x) for x in np.frombuffer(data, "<u4", 3, 4))
    ends = np.concatenate([[0], np.cumsum(np.frombuffer(data, "<u4", n, 16), dtype=np.int64)])
    starts = np.frombuffer(data, "<u4", many + 1, 16 + 4 * n).astype(np.int64)
    last = n if last is None else min(last, n)
    if first >= last:
        return
    body = 16 + 4 * n + 4 * (many + 1)
    a, b = int(ends[first]) // BLOCK, -(-int(ends[last]) // BLOCK)
    ids = np.concatenate([np.zeros(0, np.uint32), *(unpack(data[body + starts[k] : body + starts[k + 1]]) for k in range(a, b))])
    for k in range(first, last):
        yield ids[ends[k] - a * BLOCK : ends[k + 1] - a * BLOCK]


def _letters(word: str) -> bool:
    """Whether the split keeps the word whole and lower-casing it is plain: Latin letters only."""
    return word.isalpha() and (word.isascii() or max(word) < "\u0250" and "\u0130" not in word)


_GAP = np.isin(np.arange(256), [0x20, 0x0A])
_MARK = np.isin(np.arange(256), np.frombuffer(string.punctuation.encode(), np.uint8))
_ALNUM = np.isin(np.arange(256), np.frombuffer((string.ascii_letters + string.digits).encode(), np.uint8))
#: Latin letters of two bytes, by both.
_LATIN = np.zeros(1 << 16, bool)
_LATIN[[int.from_bytes(chr(k).encode()) for k in range(0x80, 0x250) if _letters(chr(k))]] = True


def _pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words between spaces and line feeds, marks at the end of one apart, and each text's first one (n + 1 of them).

    The marks are cut off behind ASCII letters and digits and behind Latin letters of two bytes, which the split pattern
    never takes together with them; other words keep theirs, as those that end with a dotted capital I, whose dot does.
    """
    data, at = spans(texts)
    data, at = data[at[0] : at[-1]], at - at[0]
    n = len(data)
    if not n:
        return pa.array([], pa.large_string()), np.zeros(len(at), np.int64)
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    inside = ~_GAP[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    mark = np.concatenate([[False], _MARK[data], [False]])
    turns = np.flatnonzero(mark[1:] != mark[:-1])
    begin, end = turns[::2], turns[1::2]
    begin, end = begin[begin > 0], end[begin > 0]
    edge[:-1] |= ~inside
    prior, lead = data[begin - 1], data[np.maximum(begin - 2, 0)]
    first[begin[edge[end] & (_ALNUM[prior] | _LATIN[lead.astype(np.int64) << 8 | prior])]] = True
    first_kept = np.flatnonzero(first[inside])
    kept = data[inside]
    offsets = np.append(first_kept, len(kept))
    words = pa.LargeStringArray.from_buffers(len(first_kept), pa.py_buffer(offsets), pa.py_buffer(kept))
    return words, np.searchsorted(np.flatnonzero(first), at)


class WordCoder:
    """Ids of texts for tokenizers that drop white space: words are encoded on their own, each new one once.

    Neither the normalizer nor the split pattern of such a file looks across a space or a line feed. Marks behind letters
    are a part of their own. Words of Latin letters are encoded many at a time, in lower case and split at spaces: that is
    all that the normalizer and the pattern do to them, and each ends with the only token that carries the end-of-word
    sign. Words of many texts are numbered first, so that each different one is looked up once.
    """

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(file)
        with open(file, encoding="utf-8") as text:
            plain = json.load(text)
        # a text that may hold an added token, which reaches over spaces, is encoded as a whole
        self._signs = tuple({t["content"][:2] for t in plain["added_tokens"]})
        plain["normalizer"] = None
        byte_level = [p for p in plain["pre_tokenizer"]["pretokenizers"] if p["type"] == "ByteLevel"]
        plain["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, *byte_level]}
        self._plain = Tokenizer.from_str(json.dumps(plain))
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._last = np.zeros(max(vocabulary.values()) + 1, bool)
        self._last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._known: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> None:
        known = self._known
        whole = [w for w in new if _letters(w)]
        lower = " ".join(whole).lower().split(" ") if whole else []
        missing = [w for w in dict.fromkeys(lower) if w not in known]
        for i in range(0, len(missing), _AT_ONCE):
            part = missing[i : i + _AT_ONCE]
            ids = np.array(self._plain.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self._last[ids]) + 1
            if len(ends) == len(part):
                data, start = ids.tobytes(), 0
                for w, end in zip(part, (4 * ends).tolist(), strict=True):
                    known[w] = data[start:end]
                    start = end
        for w, low in zip(whole, lower, strict=True):
            if w != low and low in known:
                known[w] = known[low]
        rest = [w for w in new if w not in known]
        for i in range(0, len(rest), _AT_ONCE):
            part = rest[i : i + _AT_ONCE]
            for w, e in zip(part, self._tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                known[w] = np.array(e.ids, "<u4").tobytes()

    def _look_up(self, words: list[str]) -> list[bytes]:
        """The ids of different words. Of the words remembered, those not met for the longest time are forgotten."""
        if len(self._known) > _WORDS // 2:
            self._known, self._before = {}, self._known if len(self._known) <= _WORDS else {}
        known, before = self._known, self._before
        found = list(map(known.get, words))
        open_ = [k for k, x in enumerate(found) if x is None]
        new = []
        for k in open_:
            w = words[k]
            if (x := before.get(w)) is None:
                new.append(w)
            else:
                known[w] = x
        self._learn(new)
        for k in open_:
            found[k] = known[words[k]]
        return found

    def encode(self, texts: list[str] | pa.Array, end: int) -> tuple[list[int], np.ndarray]:
        """Number of ids of each text with the end id, and all ids."""
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts
        signed = np.zeros(len(texts), bool)
        for sign in self._signs:
            signed |= pc.match_substring(texts, sign).fill_null(False).to_numpy(zero_copy_only=False)
        whole = np.flatnonzero(signed)
        words, first = _pieces(pc.if_else(pa.array(signed), pa.scalar("", texts.type), texts) if len(whole) else texts)
        words = words.dictionary_encode()
        found = self._look_up(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        many = len(found)
        found.append(np.array([end], "<u4").tobytes())
        found += [np.array(self._tokenizer.encode(texts[int(k)].as_py(), add_special_tokens=False).ids, "<u4").tobytes() for k in whole]
        # the numbers in `found` of what the texts hold, the end id behind the words of each
        codes = np.insert(words.indices.to_numpy().astype(np.int64), first[1:], many)
        first = first + np.arange(len(first))
        codes = np.insert(codes, first[whole], many + 1 + np.arange(len(whole)))
        first[1:] += np.bincount(whole, minlength=len(texts)).cumsum()
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids = np.frombuffer(b"".join(found), "<u4")
        length = size[codes]
        ends = np.concatenate([[0], np.cumsum(length)])
        at = np.repeat((np.cumsum(size) - size)[codes] - ends[:-1], length) + np.arange(ends[-1])
        return np.diff(ends[first]).tolist(), ids[at]


@functools.lru_cache(4)
def coder(name: str) -> WordCoder:
    """The coder of a public tokenizer file, once per Python worker."""
    import public_tokenizers

    return WordCoder(public_tokenizers.path(name))


def write(docs: DataFrame, folder: str, tokenizer: str = "word_bpe_49k.json", end: int = 2) -> None:
    """Writes the ids of all texts, `end` after each, in ascending doc_id order to `folder`.

    The order is by range partitions: `part` numbers them, `segment` the rows within one. Null ids come first; rows of
    equal id stand in a fixed order; null texts count as empty and have the end id only. One shuffle moves the texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, words = TaskContext.get().partitionId(), 0, coder(tokenizer)
        ids: list[int | None] = []
        counts: list[int] = []
        found: list[np.ndarray] = []

        def done() -> pa.RecordBatch:
            cells = [pa.array([part], pa.int32()), pa.array([k], pa.int64()), pa.array([sum(counts)], pa.int64()),
                     pa.array([ids], pa.list_(pa.int64())), pa.array([segment(counts, np.concatenate(found))], pa.binary())]
            return pa.RecordBatch.from_arrays(cells, names=["part", "segment", "n_ids", "doc_ids", "data"])

        for batch in batches:
            for first, last in blocks(spans(batch.column(1))[1], _TEXT_BYTES):
                n, x = words.encode(batch.column(1).slice(first, last - first), end)
                ends = np.concatenate([[0], np.cumsum(n)])
                for low in range(0, last - first, 64):
                    high = min(low + 64, last - first)
                    ids += batch.column(0).slice(first + low, high - low).to_pylist()
                    counts += n[low:high]
                    found.append(x[ends[low] : ends[high]])
                    if len(ids) >= _SEGMENT_DOCS or sum(map(len, found)) >= _SEGMENT_IDS:
                        yield done()
                        ids, counts, found, k = [], [], [], k + 1
        if ids:
            yield done()

    tie = F.xxhash64("text")
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    rows = rows.repartitionByRange(width(docs), "doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    mapped(rows, run, "part int, segment long, n_ids long, doc_ids array<long>, data binary").write.option(
        "compression", "none").parquet(folder)


def read(spark: SparkSession, folder: str, ids: bool = False) -> DataFrame:
    """One row per document from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    `ids` adds the ids themselves. The offsets of the parts are one row each, which is why they may be broadcast.
    """
    files = spark.read.parquet(folder)
    sizes = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    inner = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    places = files.select("part", "segment", F.coalesce(F.sum("n_ids").over(inner), F.lit(0)).alias("segment_start"))
    more = "ids array<long>, " if ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                found = list(documents(batch.column(3)[row].as_py()))
                n = np.array([len(x) for x in found], np.int64)
                crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in found]
                many = len(found)
                cells = [pa.array([batch.column(0)[row].as_py()] * many, pa.int32()), pa.array([batch.column(1)[row].as_py()] * many, pa.int64()),
                         pa.array(batch.column(2)[row].as_py(), pa.int64()), pa.array(np.cumsum(n) - n), pa.array(n)]
                cells += [pa.array([x.astype(np.int64) for x in found], pa.list_(pa.int64()))] if ids else []
                names = ["part", "segment", "doc_id", "within", "n_tokens", *(["ids"] if ids else []), "ids_crc32"]
                yield pa.RecordBatch.from_arrays([*cells, pa.array(crc, pa.int64())], names=names)

    rows = mapped(files.select("part", "segment", "doc_ids", "data"), run,
        f"part int, segment long, doc_id long, within long, n_tokens long, {more}ids_crc32 long")
    rows = rows.join(places, ["part", "segment"]).join(F.broadcast(offsets), "part")
    start = F.col("part_start") + F.col("segment_start") + F.col("within")
    return rows.select("doc_id", start.alias("start"), "n_tokens", *(["ids"] if ids else []), "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end: int = 2) -> DataFrame:
    """Writes the files to the shared folder and reads them back."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write(docs, folder, tokenizer, end)
    return read(spark, folder)
