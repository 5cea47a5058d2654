"""Exact substring dedup: removes what is covered by strings of 50 bytes that an earlier document also has.

Windows of 50 bytes are found equal by suffix order. No suffix array of the whole corpus is built; it is reduced first:

1. Copies of a whole text collapse to the one with the smallest id; the others are removed as a whole.
2. Every window has an anchor, its smallest q-gram by hash. Equal windows have equal anchors, so only windows whose
   anchor occurs in two different texts go on. The 15 bytes on one side of the anchor belong to the window too, so a
   byte of hash for each side has to agree as well. Anchors are dealt to shards by hash. Each block of documents sends
   one entry per anchor and sides at most, so a passage that a third of all documents hold costs a shard one entry per
   block.
3. What is left is compared first within each block of documents and then, by anchor, over all blocks: only the
   earliest copy of a window in its block goes on. Windows around one anchor form a string; equal strings are decided
   at once, and anchors with one string only need no more. The windows of the others are ordered by induced sorting.
   An anchor that very many windows have in all (a short phrase in ever different surroundings) would fill the memory of
   one task. Its windows are dealt one by one, by digests of 128 bits as for whole texts, and compared as they pass.

Induced sorting orders the S* suffixes (to the depth of a window, which is all that counts here), then induces the
other suffixes through one queue per byte, which hold suffixes in order and go to disk when they grow large. Equal
windows are neighbours then, and the smallest id of each group is the earliest document.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from girolens.llm.common import blocks, cut, lean, mapped, mix, width

WINDOW = 50
GRAM = 20
_WIDE = WINDOW - GRAM + 1  # q-grams of a window
_SIDE = (WINDOW - GRAM) // 2  # bytes that a window has on one side of its anchor at least
#: Bytes of a block of documents.
BLOCK_BYTES = 8 << 20
#: Bytes of windows that are ordered at once within a block of documents.
LOCAL_BYTES = 2 << 20
#: Strings of one anchor, counted before any comparison, beyond which its windows are dealt one by one.
HOT_STRINGS = 1 << 14
#: Bytes of text for a shard of anchors at most; there are at least eight shards for each partition.
SHARD_BYTES = 16 << 20
#: Positions that the queues of one order keep in memory before they go to disk.
QUEUED = 32 << 20
_BASE = 0x9E3779B97F4A7C15
_HASH_BYTES = 4
#: Bytes of text whose anchors are looked for at once: few, so that the hashes of a part stay in the cache of a core.
_ANCHOR_BYTES = 1 << 17


class _Queue:
    """Positions, first in first out, in memory and beyond a number of them in a file without a name."""

    def __init__(self) -> None:
        self._parts: list[np.ndarray] = []
        self._size, self._file, self._filed = 0, None, 0

    def put(self, positions: np.ndarray, most: int) -> None:
        self._parts.append(positions)
        self._size += len(positions)
        if self._size > most:
            self._file = self._file or tempfile.TemporaryFile()
            self._file.seek(0, 2)
            for part in self._parts:
                part.astype(np.int64).tofile(self._file)
            self._filed, self._parts, self._size = self._filed + self._size, [], 0

    def take(self) -> np.ndarray:
        """All positions so far; the queue is empty afterwards."""
        parts = self._parts
        if self._file is not None:
            self._file.seek(0)
            parts = [np.fromfile(self._file, np.int64, self._filed), *parts]
            self._file.close()
        self._parts, self._size, self._file, self._filed = [], 0, None, 0
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _deal(queues: list[_Queue], text: np.ndarray, positions: np.ndarray) -> None:
    """Puts positions into the queues of their bytes, in order."""
    if len(positions):
        byte = text[positions]
        order = np.argsort(byte, kind="stable")
        positions, ends = positions[order], np.cumsum(np.bincount(byte, minlength=256))
        for b in np.unique(byte):
            queues[b].put(positions[(ends[b - 1] if b else 0) : ends[b]], QUEUED // 256)


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number that sorts like them; zeros follow the end."""
    w = np.zeros(len(text) + WINDOW, np.uint64)
    w[: len(text)] = text
    size = 1
    while size < 8:
        w[: -size] = (w[: -size] << np.uint64(8 * size)) | w[size:]
        size *= 2
    return w


def suffix_order(text: np.ndarray) -> np.ndarray:
    """All positions of `text` (bytes, the last one 0, as others may be) by the suffixes there, exact to WINDOW bytes."""
    n = len(text)
    step = np.diff(text.astype(np.int16))
    apart = np.flatnonzero(step)
    following = np.searchsorted(apart, np.arange(n - 1))
    small = np.ones(n, bool)  # S type: smaller than the suffix behind it; the last one is
    small[:-1] = np.where(following < len(apart), step[apart[np.minimum(following, len(apart) - 1)]] > 0, False) if len(apart) else False
    stars = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    stars = stars[stars < n - 1]  # the end comes before all others, also before those that start with its byte
    w = _words(text)
    keys = [w[stars + 8 * k] for k in range(-(-WINDOW // 8))]
    stars = stars[np.lexsort(keys[::-1])]
    seeds = [_Queue() for _ in range(256)]
    _deal(seeds, text, stars)
    queues = [_Queue() for _ in range(256)]
    larges: list[np.ndarray] = []
    if n > 1:
        _deal(queues, text, np.array([n - 2]))  # the last but one is L type
    for b in range(256):  # L types, upwards
        waves = []
        while len(wave := queues[b].take()):
            waves.append(wave)
            before = wave[wave > 0] - 1
            _deal(queues, text, before[~small[before]])
        larges.append(np.concatenate(waves) if waves else np.zeros(0, np.int64))
        seed = seeds[b].take()
        before = seed[seed > 0] - 1
        _deal(queues, text, before[~small[before]])
    out = []
    for b in range(255, -1, -1):  # S types, downwards
        waves = []
        while len(wave := queues[b].take()):
            waves.append(wave)
            before = wave[wave > 0] - 1
            _deal(queues, text, before[small[before]])
        large = larges[b]
        before = large[large > 0][::-1] - 1
        _deal(queues, text, before[small[before]])
        out += [np.concatenate(waves)[::-1] if waves else np.zeros(0, np.int64), large]
        larges[b] = np.zeros(0, np.int64)
    return np.concatenate([[n - 1], *out[::-1]])


def repeats(text: np.ndarray, allowed: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which positions start a window that also starts at an allowed position of a smaller owner."""
    order = suffix_order(np.append(text, np.uint8(0)))
    order = order[order < len(text)]
    order = order[allowed[order]]
    found = np.zeros(len(text), bool)
    if len(order) > 1:
        w = _words(text)
        differs = np.zeros(len(order) - 1, bool)
        for k in (*range(0, WINDOW - 8, 8), WINDOW - 8):
            differs |= w[order[1:] + k] != w[order[:-1] + k]
        first = np.concatenate([[0], np.flatnonzero(differs) + 1])
        owners = owner[order]
        least = np.repeat(np.minimum.reduceat(owners, first), np.diff(np.append(first, len(order))))
        found[order[owners > least]] = True
    return found


def _anchors(text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of window starts with one anchor: row, first start, last start (in `text`), hash of the anchor, and its
    sides: a byte of hash (never 0) for the bytes before it in the high byte, for those behind it in the low byte, or 0
    where the text has too few of them."""
    n = len(text)
    empty = np.zeros(0, np.int64)
    nothing = empty, empty, empty, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    if n < WINDOW:
        return nothing
    powers: dict[int, np.ndarray] = {1: text.astype(np.uint64) + np.uint64(1)}
    size = 1
    while size < 16:
        h = powers[size]
        powers[2 * size] = h[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + h[size:]
        size *= 2
    m = n - GRAM + 1
    h = mix(powers[16][:m] * np.uint64(pow(_BASE, 4, 1 << 64)) + powers[4][16 : 16 + m])
    low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(m, dtype=np.uint64)
    size = 1
    while size * 2 <= _WIDE:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    rest = _WIDE - size
    low = np.minimum(low[: len(low) - rest], low[rest:])
    # a window starts where its document holds all of it; the last WINDOW - 1 bytes of a document part it from the next
    count = np.diff(at)
    whole = np.maximum(count - WINDOW + 1, 0)
    valid = np.repeat(np.tile([True, False], len(count)), np.stack([whole, count - whole], axis=1).ravel())[: len(low)]
    joined = valid[1:] & valid[:-1] & (low[1:] == low[:-1])  # windows that go on with the anchor before them
    start = np.flatnonzero(valid & ~np.concatenate([[False], joined]))
    if not len(start):
        return nothing
    end = np.flatnonzero(valid & ~np.concatenate([joined, [False]]))
    row, a = np.searchsorted(at, start, "right") - 1, (low[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    eight = powers[8]

    def side(begin: np.ndarray, there: np.ndarray) -> np.ndarray:
        i = np.clip(begin, 0, n - _SIDE)
        x = mix(eight[i] * np.uint64(_BASE) + eight[i + _SIDE - 8])
        return np.where(there, x % np.uint64(255) + np.uint64(1), np.uint64(0))

    before = side(a - _SIDE, a - _SIDE >= at[row])
    behind = side(a + GRAM, a + GRAM + _SIDE <= at[row + 1])
    return row, start, end, h[a], (before << np.uint64(8)) | behind


def _elsewhere(h: np.ndarray, sides: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which anchors another owner has too, with the same bytes on one side at least."""
    out = np.zeros(len(h), bool)
    for side in (sides >> np.uint64(8), sides & np.uint64(255)):
        there = np.flatnonzero(side)
        key = mix(h[there] * np.uint64(_BASE) + side[there])
        order = np.argsort(key, kind="stable")
        if len(order):
            first = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
            o = owner[there][order]
            differs = np.minimum.reduceat(o, first) != np.maximum.reduceat(o, first)
            out[there[order]] |= np.repeat(differs, np.diff(np.append(first, len(order))))
    return out


def _runs(text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """As `_anchors`, in parts that stay small."""
    parts = []
    for i, j in blocks(at, _ANCHOR_BYTES):
        row, first, last, h, sides = _anchors(text[at[i] : at[j]], at[i : j + 1] - at[i])
        parts.append((row + i, first + at[i], last + at[i], h, sides))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else _anchors(text[:0], at[:1])


def _unpacked(sizes: list[int], packed: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    codec = pa.Codec("zstd")
    texts = [codec.decompress(p, s, asbytes=True) if s and p is not None else b"" for s, p in zip(sizes, packed, strict=True)]
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


def _bounds(*columns: np.ndarray) -> list[tuple[int, int]]:
    """[i, j) of each run of rows that are equal in all columns."""
    n = len(columns[0])
    if not n:
        return []
    new = np.zeros(n, bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(new)
    return list(zip(first.tolist(), [*first[1:].tolist(), n], strict=True))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (doc_id, a, size, ...) cut into blocks of documents that fit in memory and 16-bit row numbers."""
    for batch in batches:
        at = np.concatenate([[0], np.cumsum(batch.column(2).to_numpy())])
        for i, j in blocks(at, BLOCK_BYTES):
            for low in range(i, j, 8192):
                yield batch.slice(low, min(8192, j - low))


def _digest(text: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(text, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _texts(docs: DataFrame, rest: list[str]) -> DataFrame:
    """(doc_id, rest, size, a, b, packed): compressed texts with their digests."""
    shape = StructType([f for f in docs.schema.fields if f.name in rest])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(2).to_pylist()]
            digests = [_digest(t) for t in texts]
            cells = [pa.array([len(t) for t in texts], pa.int64()), pa.array([d[0] for d in digests], pa.int64()),
                     pa.array([d[1] for d in digests], pa.int64()), pa.array([codec.compress(t, asbytes=True) for t in texts], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cells], names=["doc_id", "rest", "size", "a", "b", "packed"])

    return mapped(rows, lean(run), StructType([StructField("rest", shape, False) if f.name == "rest" else f for f in
                                         StructType.fromDDL("doc_id long, rest int, size long, a long, b long, packed binary").fields]))


def _firsts(docs: DataFrame) -> DataFrame:
    """(doc_id, a): texts of at least a window that a smaller id also has, so that the later ones need no look."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [_digest((t or "").encode()) for t in batch.column(1).to_pylist()]
            cells = [pa.array([d[k] for d in digests], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cells], names=["doc_id", "a", "b"])

    told = docs.where(F.octet_length("text") >= WINDOW).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    told = cut(mapped(told, lean(run), "doc_id long, a long, b long"))
    least = told.groupBy("a", "b").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    return told.join(least, ["a", "b"]).where("doc_id > least").groupBy("doc_id").agg(F.collect_set("a").alias("copies"))


def _shared_anchors(texts: DataFrame, shards: int, most: int) -> DataFrame:
    """(doc_id, a, hashes): anchors of a text that other texts have too.

    Rows without a doc_id hold the keys of anchors of more than `most` strings.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        for batch in _parts(batches):
            ids, digests = (batch.column(c).to_numpy() for c in (0, 1))
            text, at = _unpacked(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            row, _, _, h, sides = _runs(text, at)
            known = _elsewhere(h, sides, row)
            # a text's anchors that other texts of this block have ride along as they are
            r, x = row[known], _short(h[known], sides[known], shards)
            out = [(int(ids[r[e]]) % shards, int(ids[r[e]]), int(digests[r[e]]), np.unique(x[e:f]).tobytes()) for e, f in _bounds(r)]
            _, first, strings = np.unique(_full(h, sides), return_index=True, return_counts=True)
            shard = (h[first] % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            first, shard, strings = first[order], shard[order], np.minimum(strings[order], 0xFFFF)
            r, x, s, many = row[first], h[first] // np.uint64(shards), sides[first], known[first]
            for e, f in _bounds(shard):
                used, place = np.unique(r[e:f], return_inverse=True)
                bits = x[e:f].view(np.uint8).reshape(-1, 8)[:, :_HASH_BYTES]
                data = b"".join([np.array([len(used), f - e], "<u4").tobytes(), np.diff(ids[used], prepend=0).astype("<i8").tobytes(),
                                 digests[used].astype("<i8").tobytes(), place.astype("<u2").tobytes(), s[e:f].astype("<u2").tobytes(), strings[e:f].astype("<u2").tobytes(),
                                 np.packbits(many[e:f]).tobytes(), bits.tobytes()])
                out.append((int(shard[e]), len(data), None, codec.compress(data, asbytes=True)))
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
            for low in range(0, len(out), 2000):
                cells = [pa.array([o[c] for o in out[low : low + 2000]], kind) for c, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(cells, names=["shard", "x", "y", "data"])

    def settle(shard: int, held: list[tuple[int, bytes]]) -> list[tuple[int | None, int | None, bytes]]:
        codec = pa.Codec("zstd")
        ids, digests, sides, strings, many, hashes = [], [], [], [], [], []
        for size, data in held:
            data = codec.decompress(data, size, asbytes=True)
            n, m = (int(v) for v in np.frombuffer(data, "<u4", 2))
            own = np.cumsum(np.frombuffer(data, "<i8", n, 8))
            dig = np.frombuffer(data, "<i8", n, 8 + 8 * n)
            at = 8 + 16 * n
            place = np.frombuffer(data, "<u2", m, at).astype(np.int64)
            sides.append(np.frombuffer(data, "<u2", m, at + 2 * m).astype(np.uint64))
            strings.append(np.frombuffer(data, "<u2", m, at + 4 * m))
            many.append(np.unpackbits(np.frombuffer(data, np.uint8, (m + 7) // 8, at + 6 * m), count=m).astype(bool))
            h = np.zeros((m, 8), np.uint8)
            h[:, :_HASH_BYTES] = np.frombuffer(data, np.uint8, m * _HASH_BYTES, at + 6 * m + (m + 7) // 8).reshape(m, -1)
            hashes.append(h.view(np.uint64).ravel())
            ids.append(own[place])
            digests.append(dig[place])
        ids, digests, sides, strings, many, hashes = (np.concatenate(v) for v in (ids, digests, sides, strings, many, hashes))
        order = np.argsort(hashes, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(hashes[order]) != 0]))
        hot = hashes[order[first]][np.add.reduceat(strings[order].astype(np.int64), first) > most]
        wanted = _elsewhere(hashes, sides, ids) & ~many
        # a truncated hash comes back as all that is known of it; the text's own anchors are compared the same way
        ids, digests, hashes = ids[wanted], digests[wanted], _told(hashes[wanted], sides[wanted], np.uint64(shard))
        order = np.lexsort((digests, ids))
        ids, digests, hashes = ids[order], digests[order], hashes[order]
        told = [(int(ids[e]), int(digests[e]), hashes[e:f].tobytes()) for e, f in _bounds(ids, digests)]
        return told + ([(None, None, _key(hot, np.uint64(shard)).tobytes())] if len(hot) else [])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(out: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
            cells = [pa.array([o[c] for o in out], kind) for c, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))]
            return pa.RecordBatch.from_arrays(cells, names=["doc_id", "a", "hashes"])

        now, held = -1, []
        for batch in batches:
            out = []
            for shard, x, y, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if y is not None:
                    out.append((x, y, data))
                    continue
                if shard != now and held:
                    out += settle(now, held)
                    held = []
                now = shard
                held.append((x, data))
            yield rows(out)
        if held:
            yield rows(settle(now, held))

    dealt = mapped(texts.select("doc_id", "a", "size", "packed"), lean(deal, None), "shard int, x long, y long, data binary")
    dealt = dealt.repartition(width(texts), "shard").sortWithinPartitions("shard")
    return mapped(dealt, lean(gather, None), "doc_id long, a long, hashes binary")


def _full(h: np.ndarray, sides: np.ndarray) -> np.ndarray:
    return mix(h * np.uint64(_BASE) + sides)


def _chosen(h: np.ndarray, sides: np.ndarray, shards: int, told: list[bytes]) -> np.ndarray:
    """Which anchors of a text are among those told for it; one more by chance does no harm."""
    return np.isin(_short(h, sides, shards), np.frombuffer(b"".join(told), np.uint32))


def _short(h: np.ndarray, sides: np.ndarray, shards: int) -> np.ndarray:
    """What a text is told of an anchor: four bytes that a shard can make from what it got."""
    kept = (h // np.uint64(shards)) & np.uint64((1 << (8 * _HASH_BYTES)) - 1)
    return _told(kept, sides, h % np.uint64(shards))


def _key(kept: np.ndarray, shard: np.ndarray | np.uint64) -> np.ndarray:
    """An anchor as its shard knows it; two of one key by chance do no harm."""
    return mix(kept * np.uint64(_BASE) + shard)


def _told(kept: np.ndarray, sides: np.ndarray, shard: np.ndarray | np.uint64) -> np.ndarray:
    return (_full((kept << np.uint64(16)) | sides, shard) >> np.uint64(32)).astype(np.uint32)


def _ranges(ids: np.ndarray, digests: np.ndarray, first: np.ndarray, last: np.ndarray) -> list[tuple[int, int, bytes]]:
    """(doc_id, a, ranges) of each text: its ranges of window starts, merged where they meet, as pairs of 64-bit numbers."""
    if not len(ids):
        return []
    order = np.lexsort((first, digests, ids))
    ids, digests, first, last = ids[order], digests[order], first[order], last[order]
    bounds = _bounds(ids, digests)
    apart = np.int64(max(int(last.max()) + 2, 1))
    shift = np.repeat(np.arange(len(bounds)), [f - e for e, f in bounds]) * apart  # so that texts do not meet
    until = np.maximum.accumulate(last + shift)
    new = np.concatenate([[True], first[1:] + shift[1:] > until[:-1] + 1])
    start = np.flatnonzero(new)
    pairs = np.stack([first[start], (until - shift)[np.append(start[1:], len(ids)) - 1]], axis=1).astype("<i8")
    edge = np.searchsorted(start, [e for e, _ in bounds] + [len(ids)])
    return [(int(ids[e]), int(digests[e]), pairs[edge[k] : edge[k + 1]].tobytes()) for k, (e, _) in enumerate(bounds)]


def _true_runs(found: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], found.astype(np.int8), [0]])))
    return list(zip(edges[0::2].tolist(), edges[1::2].tolist(), strict=True))


def _decided(anchor: np.ndarray, owner: np.ndarray, strings: list[bytes]) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Which strings of windows an earlier owner has as a whole; of the others, which of their windows one has.

    Windows are only equal if their anchors are, so an anchor with one string is done once equal strings are.
    """
    known: dict[bytes, int] = {}
    kind = np.array([known.setdefault(s, len(known)) for s in strings], np.int64)
    least = np.full(len(known), np.iinfo(np.int64).max)
    np.minimum.at(least, kind, owner)
    whole = owner > least[kind]
    first = np.flatnonzero(~whole & (owner == least[kind]))
    _, pick = np.unique(kind[first], return_index=True)
    kept = first[pick]  # an earliest copy of each string
    _, group, many = np.unique(anchor[kept], return_inverse=True, return_counts=True)
    kept = kept[many[group] > 1]
    marked: dict[int, np.ndarray] = {}
    if len(kept):
        size = np.array([len(strings[k]) + 1 for k in kept])
        joined = np.frombuffer(b"".join(strings[k] + b"\0" for k in kept), np.uint8)
        place = np.cumsum(size) - size
        spot = np.arange(len(joined)) - np.repeat(place, size)
        allowed = spot < np.repeat(size - WINDOW, size)
        found = repeats(joined, allowed, np.repeat(owner[kept], size))
        windows = {int(kind[k]): found[p : p + n - WINDOW] for k, p, n in zip(kept, place, size, strict=True)}
        windows = {k: f for k, f in windows.items() if f.any()}
        marked = {int(k): windows[int(kind[k])] for k in np.flatnonzero(~whole) if int(kind[k]) in windows}
    return whole, marked


def _dealt(candidates: DataFrame, shards: int, hot: np.ndarray) -> DataFrame:
    """(anchor, doc_id, a, first, last, data, ranges): what is left to compare.

    Data is a string of windows, or for an anchor with a key in `hot` the digest of one window, with a part of it as anchor.
    Rows without data hold the packed ranges of window starts of a text that an earlier document has.
    """

    def local(ids: np.ndarray, digests: np.ndarray, text: np.ndarray, at: np.ndarray, runs: tuple[np.ndarray, ...]) -> Iterator[tuple]:
        row, first, last, h = runs
        data = text.tobytes()
        strings = [data[a : b + WINDOW] for a, b in zip(first.tolist(), last.tolist(), strict=True)]
        owner = ids[row]
        whole, marked = _decided(h, owner, strings)
        gone = [(row[whole], first[whole], last[whole])]
        for k, found in marked.items():
            i, j = np.array(_true_runs(found)).T
            gone.append((np.full(len(i), row[k]), first[k] + i, first[k] + j - 1))
        r, a, b = (np.concatenate(x) for x in zip(*gone, strict=True))
        for doc, digest, ranges in _ranges(ids[r], digests[r], a - at[r], b - at[r]):
            yield None, doc, digest, None, None, None, ranges
        alone = np.isin(_key((h // np.uint64(shards)) & np.uint64((1 << (8 * _HASH_BYTES)) - 1), h % np.uint64(shards)), hot)
        for k in np.flatnonzero(~whole).tolist():
            r, a, many = int(row[k]), int(first[k]), int(last[k] - first[k]) + 1
            origin, found = int(at[r]), marked.get(k)
            low, high = 0, many - 1
            if found is not None:
                left = np.flatnonzero(~found)
                if not len(left):
                    continue
                low, high = int(left[0]), int(left[-1])
            if alone[k]:
                for i in range(many) if found is None else left.tolist():
                    digest = hashlib.blake2b(data[a + i : a + i + WINDOW], digest_size=16).digest()
                    start = a - origin + i
                    yield int.from_bytes(digest[:8], "little", signed=True), int(ids[r]), int(digests[r]), start, start, digest, None
                continue
            # the earliest copies go on to all others of their anchor
            yield (int(h[k].astype(np.int64)), int(ids[r]), int(digests[r]), a - origin + low, a - origin + high, data[a + low : a + high + WINDOW], None)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            ids, digests = (batch.column(c).to_numpy() for c in (0, 1))
            text, at = _unpacked(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            row, first, last, h, sides = _runs(text, at)
            bounds = np.searchsorted(row, np.arange(len(ids) + 1))
            keep = np.zeros(len(row), bool)
            for k, told in enumerate(batch.column(4).to_pylist()):
                own = slice(bounds[k], bounds[k + 1])
                keep[own] = _chosen(h[own], sides[own], shards, [t["hashes"] for t in told if t["a"] == digests[k]])
            row, first, last, h = row[keep], first[keep], last[keep], h[keep]
            total = np.concatenate([[0], np.cumsum(last - first + WINDOW)])
            i = 0
            while i < len(row):
                j = max(int(np.searchsorted(total, total[i] + LOCAL_BYTES, "right")) - 1, i + 1)
                out = []
                for found in local(ids, digests, text, at, (row[i:j], first[i:j], last[i:j], h[i:j])):
                    out.append(found)
                    if len(out) >= 20_000:
                        yield _rows(out)
                        out = []
                yield _rows(out)
                i = j

    rows = candidates.select("doc_id", "a", "size", "packed", "told")
    return mapped(rows, lean(deal, None), "anchor long, doc_id long, a long, first long, last long, data binary, ranges binary")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)],
                                      names=["anchor", "doc_id", "a", "first", "last", "data", "ranges"])


def _marks(candidates: DataFrame, shards: int, hot: np.ndarray) -> DataFrame:
    """(doc_id, a, ranges): packed ranges of window starts that an earlier document has."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle(held: list[tuple]) -> list[tuple[int, int, bytes]]:
            owner = np.array([r[1] for r in held])
            whole, marked = _decided(np.array([r[0] for r in held]), owner, [r[5] for r in held])
            found = [(int(k), held[k][3], held[k][4]) for k in np.flatnonzero(whole)]
            found += [(k, held[k][3] + i, held[k][3] + j - 1) for k in marked for i, j in _true_runs(marked[k])]
            if not found:
                return []
            k, first, last = np.array(found).T
            return _ranges(owner[k], np.array([r[2] for r in held])[k], first, last)

        held: list[tuple] = []
        size = 0
        now, least = None, {}  # smallest ids of the windows of one anchor; rows come by id
        for batch in batches:
            out, single = [], []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[5] is None:
                    out.append((row[1], row[2], row[6]))
                    continue
                if len(row[5]) < WINDOW:
                    if row[0] != now:
                        now, least = row[0], {}
                    if least.setdefault(row[5], row[1]) < row[1]:
                        single.append(row[1:5])
                    continue
                if size > LOCAL_BYTES and row[0] != held[-1][0]:
                    out += settle(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
            if single:
                out += _ranges(*np.array(single).T)
            yield _packed(out)
        if held:
            yield _packed(settle(held))

    dealt = _dealt(candidates, shards, hot)
    dealt = dealt.repartition(width(candidates), F.coalesce("anchor", "doc_id")).sortWithinPartitions("anchor", "doc_id")
    return mapped(dealt, lean(gather, None), "doc_id long, a long, ranges binary")


def _packed(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)], names=["doc_id", "a", "ranges"])


def spans(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal removed runs [start, end) for ranges (first, last) of window starts."""
    out: list[list[int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + WINDOW)
        else:
            out.append([first, last + WINDOW])
    return [(a, b) for a, b in out]


def removals(docs: DataFrame, texts: bool = False) -> DataFrame:
    """Removes each byte that is covered by a window which also starts in a document with a smaller id.

    By default one row per row of `docs`: doc_id, n_bytes, n_removed, n_spans, kept_sha256. With `texts`, the rows of
    `docs` with what is left as text (parts of characters are dropped) and n_chars, if there is one, set to its length.
    Null texts count as empty; texts shorter than a window lose nothing. Rows with a null doc_id neither lose nor take
    anything. Rows of equal doc_id take nothing from each other; repeated rows give repeated rows. Very long texts are
    judged whole; an empty table gives an empty one.
    """
    rest = [c for c in docs.columns if c != "text"] if texts else ["doc_id"]
    many = width(docs)
    known = docs.where(F.col("doc_id").isNotNull())
    base = _texts(known, rest).repartition(many, "doc_id")
    copies = _firsts(known).withColumnRenamed("doc_id", "c_id")
    copy = F.coalesce(F.array_contains("copies", F.col("a")), F.lit(False))
    base = base.join(copies, base["doc_id"] == copies["c_id"], "left").select("doc_id", "rest", "size", "a", copy.alias("copy"), "packed")
    base = cut(base.withColumn("packed", F.when(~F.col("copy"), F.col("packed"))))
    shards = max(8 * many, -(-(base.agg(F.sum("size")).first()[0] or 0) // SHARD_BYTES))
    told = _shared_anchors(base.where("packed IS NOT NULL"), shards, HOT_STRINGS).groupBy("doc_id").agg(F.collect_list(F.struct("a", "hashes")).alias("told"))
    told = cut(told)
    hot = told.where("doc_id IS NULL").select(F.explode("told.hashes")).collect()
    hot = np.frombuffer(b"".join(bytes(r[0]) for r in hot), np.uint64)
    candidates = base.where("packed IS NOT NULL").join(told.withColumnRenamed("doc_id", "t_id"), F.col("doc_id") == F.col("t_id"))
    marks = _marks(candidates, shards, hot)
    marks = cut(marks.groupBy(F.col("doc_id").alias("m_id")).agg(F.collect_list(F.struct("a", "ranges")).alias("marks")))
    told = base.join(marks, base["doc_id"] == marks["m_id"], "left").select("doc_id", "rest", "size", "a", "copy", "packed", "marks")
    nobody = _texts(docs.where(F.col("doc_id").isNull()), rest)
    told = told.unionByName(nobody.select("doc_id", "rest", "size", "a", F.lit(False).alias("copy"), "packed",
                                          F.lit(None).cast("array<struct<a:bigint,ranges:binary>>").alias("marks")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                out = []
                for size, a, copy, packed, marks in zip(*(part.column(c).to_pylist() for c in range(2, 7)), strict=True):
                    gone = [(0, size)] if copy else spans(np.frombuffer(b"".join(m["ranges"] for m in marks or () if m["a"] == a), "<i8").reshape(-1, 2).tolist())
                    data = codec.decompress(packed, size, asbytes=True) if size and packed is not None else b""
                    edges = [0, *(x for s in gone for x in s), size]
                    kept = b"".join(data[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2))
                    out.append((size, sum(b - a for a, b in gone), len(gone), hashlib.sha256(kept).hexdigest(),
                                kept.decode("utf-8", "ignore") if texts else None))
                cells = [pa.array([o[c] for o in out], kind) for c, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *cells],
                                                 names=["doc_id", "rest", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    shape = StructType([f for f in told.schema.fields if f.name in ("doc_id", "rest")]
                       + StructType.fromDDL("n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string").fields)
    result = mapped(told, lean(run), shape)
    if not texts:
        return result.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    kinds = dict(docs.dtypes)
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast(kinds.get("n_chars", "long"))}
    return result.select(*[new[c].alias(c) if c in new else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])
