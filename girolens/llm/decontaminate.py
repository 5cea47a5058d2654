"""Benchmark decontamination by the q-gram lemma.

Benchmark items are cut into overlapping pieces. A piece of m characters that occurs with k edits at most shares at
least m + 1 - q - k q of its q-grams with the text, on diagonals (text position minus piece position) that spread over
k at most. So shared q-grams are counted per piece in bands of 2 k diagonals that overlap by k; bands that reach the
bound are kept, and a banded alignment of the piece decides. Pieces, unlike whole items, also find part of an item,
and an item within the budget has a piece within it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from girolens.llm.common import mapped

Q = 8
PIECE = 96
STEP = 48
#: Edits for each character of a piece.
RATE = 0.1
#: Items of fewer characters have too few q-grams for edits; they match where they stand as they are, between words.
LEAST = 24
#: Characters of benchmark text that one pass holds in memory; more of it takes more passes.
PASS_CHARS = 1_000_000
_SEGMENT = 1 << 18
_OVERLAP = 512
_HITS = 2_000_000  # shared q-grams that are held at once
_BETWEEN = np.uint32(0x7FFFFFFF)
_BIAS = 1 << 30  # keeps starts positive where they share a number with costs
_BASE = 0x9E3779B97F4A7C15
_FOLD = np.arange(128, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[9:14] = 32


def normal(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points with A-Z lower-cased and ASCII white space runs as one space, and where each stood in the text."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.where(c < 128, _FOLD[np.minimum(c, 127)], c)
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 32) | (c[:-1] != 32)
    return c[keep], np.flatnonzero(keep)


def grams(c: np.ndarray) -> np.ndarray:
    """Hashes of the q-grams of code points."""
    h, size = c.astype(np.uint64) + np.uint64(1), 1
    while size < Q:
        h = h[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + h[size:]
        size *= 2
    return h ^ (h >> np.uint64(29))


@dataclass
class Index:
    """Pieces of benchmark items and the places of their q-grams, sorted by hash."""

    item: np.ndarray  # of each piece
    size: np.ndarray
    edits: np.ndarray
    least: np.ndarray
    chars: np.ndarray  # pieces x longest piece
    hashes: np.ndarray
    first: np.ndarray
    piece: np.ndarray
    at: np.ndarray
    seen: np.ndarray  # low hash bits that occur
    short: dict[str, list[int]]  # items under LEAST characters

    def exact(self, c: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, start, end) of short items that stand in a normal text between characters that are no letters or digits."""
        if not self.short:
            return
        if self._finder is None:
            import ahocorasick

            self._finder = ahocorasick.Automaton()
            for text in self.short:
                self._finder.add_word(text, text)
            self._finder.make_automaton()
        text = c.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        for last, found in self._finder.iter(text):
            a, b = last + 1 - len(found), last + 1
            if (a == 0 or not text[a - 1].isalnum()) and (b == len(text) or not text[b].isalnum()):
                for item in self.short[found]:
                    yield item, a, b

    _finder = None  # made where it is used


def index(items: list[tuple[int, str]]) -> Index | None:
    pieces, short = [], {}
    for item, text in items:
        c, _ = normal(text.strip())
        if len(c) < LEAST:
            if len(c):
                short.setdefault(c.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass"), []).append(item)
            continue
        starts = [0] if len(c) < PIECE + STEP else [*range(0, len(c) - PIECE, STEP), len(c) - PIECE]
        size = len(c) if len(c) < PIECE + STEP else PIECE
        pieces += [(item, c[s : s + size]) for s in starts]
    if not pieces and not short:
        return None
    if not pieces:
        none = np.zeros(0, np.int64)
        return Index(none, none, none, none, np.zeros((0, 0), np.uint32), none.astype(np.uint64), none, none, none, np.zeros(1 << 20, bool), short)
    size = np.array([len(c) for _, c in pieces])
    edits = np.minimum((size * RATE).astype(np.int64), (size - Q) // Q)
    chars = np.zeros((len(pieces), size.max()), np.uint32)
    for k, (_, c) in enumerate(pieces):
        chars[k, : len(c)] = c
    h = [grams(c) for _, c in pieces]
    piece = np.repeat(np.arange(len(pieces)), [len(x) for x in h])
    at = np.concatenate([np.arange(len(x)) for x in h])
    h = np.concatenate(h)
    order = np.argsort(h, kind="stable")
    hashes, first = np.unique(h[order], return_index=True)
    seen = np.zeros(1 << 20, bool)
    seen[hashes & np.uint64(0xFFFFF)] = True
    least = np.maximum(size + 1 - Q - edits * Q, 1)
    return Index(np.array([i for i, _ in pieces]), size, edits, least, chars, hashes, np.append(first, len(h)), piece[order], at[order], seen, short)


def _align(ix: Index, text: np.ndarray, piece: np.ndarray, low: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fewest edits of each piece against `text` on the diagonals low to low + wide - 1, with start and end there."""
    n, cells = len(piece), np.arange(wide)
    cost = np.zeros((n, wide), np.int64)
    begin = low[:, None] + cells + _BIAS
    best, best_end = np.full(n, 1 << 20), np.zeros(n, np.int64)
    best_begin = np.zeros(n, np.int64)
    for i in range(int(ix.size[piece].max())):
        at = low[:, None] + cells + i
        inside = (at >= 0) & (at < len(text))
        same = inside & (text[np.clip(at, 0, len(text) - 1)] == ix.chars[piece, i][:, None])
        # the high digits of a cell are its cost, the low ones its start; the smallest wins
        across = (cost + ~same) * (1 << 40) + begin
        skip = np.full((n, wide), 1 << 60)
        skip[:, :-1] = (cost[:, 1:] + 1) * (1 << 40) + begin[:, 1:]
        new = np.minimum(across, skip) - cells * (1 << 40)
        new = np.minimum.accumulate(new, axis=1) + cells * (1 << 40)
        cost, begin = new >> 40, new & ((1 << 40) - 1)
        done = np.flatnonzero(ix.size[piece] == i + 1)
        if len(done):
            cell = cost[done].argmin(axis=1)
            best[done] = cost[done, cell]
            best_begin[done] = begin[done, cell] - _BIAS
            best_end[done] = low[done] + cell + i + 1
    return best, best_begin, best_end


def _regions(ix: Index, text: np.ndarray) -> set[tuple[int, int, int, int]]:
    """(item, start, end, edits) in `text` for pieces within their budget."""
    if len(text) < Q or not len(ix.hashes):
        return set()
    h = grams(text)
    at = np.flatnonzero(ix.seen[h & np.uint64(0xFFFFF)])
    slot = np.searchsorted(ix.hashes, h[at])
    hit = ix.hashes[np.minimum(slot, len(ix.hashes) - 1)] == h[at]
    at, slot = at[hit], slot[hit]
    many = ix.first[slot + 1] - ix.first[slot]
    if not len(at):
        return set()
    if many.sum() > _HITS and len(text) > 4 * _OVERLAP:  # monotonous text: halves that overlap by more than a piece
        half = len(text) // 2
        right = _regions(ix, text[half - _OVERLAP :])
        return _regions(ix, text[: half + _OVERLAP]) | {(i, a + half - _OVERLAP, b + half - _OVERLAP, e) for i, a, b, e in right}
    ends = np.cumsum(many)
    entry = np.arange(ends[-1]) - np.repeat(ends - many - ix.first[slot], many)
    piece = ix.piece[entry]
    diagonal = np.repeat(at, many) - ix.at[entry] + (1 << 20)
    half = np.maximum(ix.edits[piece], 1)
    found: set[tuple[int, int, int, int]] = set()
    for shift in (0, 1):
        band = (diagonal + shift * half) // (2 * half)
        key, count = np.unique(piece * (1 << 40) + band, return_counts=True)
        p = key >> 40
        ok = count >= ix.least[p]
        p, band = p[ok], key[ok] & ((1 << 40) - 1)
        if not len(p):
            continue
        k = np.maximum(ix.edits[p], 1)
        low = band * 2 * k - shift * k - (1 << 20) - k
        edits, begin, end = _align(ix, text, p, low, int(4 * k.max() + 1))
        good = edits <= ix.edits[p]
        found |= set(zip(ix.item[p[good]].tolist(), np.maximum(begin[good], 0).tolist(),
                         np.minimum(end[good], len(text)).tolist(), edits[good].tolist(), strict=True))
    return found


def regions(ix: Index, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
    """For each text, sorted (item, start, end, edits) with positions in the text; long texts go segment by segment."""
    out: list[set[tuple[int, int, int, int]]] = [set() for _ in texts]
    waiting: list[tuple[int, np.ndarray, np.ndarray]] = []

    def flush() -> None:
        if not waiting:
            return
        gap = np.full(_OVERLAP, _BETWEEN, np.uint32)
        joined = np.concatenate([x for _, c, _ in waiting for x in (c, gap)])
        start = np.cumsum([0, *[len(c) + _OVERLAP for _, c, _ in waiting]])
        for item, a, b, e in _regions(ix, joined):
            k = int(np.searchsorted(start, (a + b) // 2, "right")) - 1
            row, c, where = waiting[k]
            a, b = max(a - int(start[k]), 0), min(b - int(start[k]), len(c))
            if a < b:
                out[row].add((item, int(where[a]), int(where[b - 1]) + 1, e))
        waiting.clear()

    size = 0
    for row, text in enumerate(texts):
        c, where = normal(text)
        out[row] |= {(item, int(where[a]), int(where[b - 1]) + 1, 0) for item, a, b in ix.exact(c)}
        for s in range(0, max(len(c) - _OVERLAP, 1), _SEGMENT):
            part = slice(s, s + _SEGMENT + _OVERLAP)
            waiting.append((row, c[part], where[part]))
            size += len(c[part])
            if size >= _SEGMENT:
                flush()
                size = 0
    flush()
    return [sorted(x) for x in out]


def _indexes(benchmark: DataFrame, chars: int) -> Iterator[Index]:
    """An index for each pass: items are dealt to as many passes as keep one under about `chars` characters."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").dropna().distinct()
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    passes = -(-total // chars) or 1
    for k in range(passes):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), passes) == k) if passes > 1 else items
        ix = index([tuple(r) for r in mine.orderBy("item_id", "text").collect()])
        if ix is not None:
            yield ix


_REGIONS = "array<struct<item_id:bigint,start:bigint,end:bigint,edits:bigint>>"


def _found(docs: DataFrame, benchmark: DataFrame, chars: int) -> DataFrame:
    """(row, text, regions): the columns of `docs` in a struct, so that none of their names clashes."""
    fields = ("item_id", "start", "end", "edits")
    plain = pa.list_(pa.struct([(n, pa.int64()) for n in fields]))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    found = docs.select(row, F.coalesce("text", F.lit("")).alias("text"), F.lit(None).cast(_REGIONS).alias("regions"))
    for ix in _indexes(benchmark, chars):
        shared = docs.sparkSession.sparkContext.broadcast(ix)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for low in range(0, batch.num_rows, 512):
                    part = batch.slice(low, 512)
                    new = regions(shared.value, part.column(1).to_pylist())
                    rows = [sorted({*(tuple(x.values()) for x in b or ()), *f}) for b, f in zip(part.column(2).to_pylist(), new, strict=True)]
                    cells = pa.array([[dict(zip(fields, x, strict=True)) for x in r] for r in rows], plain)
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), cells], names=["row", "text", "regions"])

        found = mapped(found, run, found.schema)
    return found.withColumn("regions", F.coalesce("regions", F.array().cast(_REGIONS)))


def find(docs: DataFrame, benchmark: DataFrame, chars: int = PASS_CHARS) -> DataFrame:
    """One row per row of `docs`: its columns, and `regions`: array of (item_id, start, end, edits), empty if clean.

    Positions are code points of the whole text. Null and empty texts have no regions; benchmark rows with a null id
    or text, and blank items, match nothing; items under LEAST characters match without edits, between characters that
    are no letters or digits. An empty benchmark leaves every document clean, empty `docs` give no rows. Equal regions of
    several pieces are told once. Repeated rows give repeated rows. A column `regions` of `docs` is replaced. A benchmark of more than `chars` characters is
    taken in several passes over the documents.
    """
    columns = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != "regions"]
    return _found(docs, benchmark, chars).select(*columns, "regions")


def clean(docs: DataFrame, benchmark: DataFrame, chars: int = PASS_CHARS) -> DataFrame:
    """The rows of `docs` without a region, with all their columns."""
    return _found(docs, benchmark, chars).where(F.size("regions") == 0).select("row.*")
