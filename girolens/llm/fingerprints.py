"""Document fingerprints: one-permutation MinHash with optimal densification and packed low-order bits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from girolens.llm.common import mapped, mix, width

#: Characters of a shingle; texts are padded by one less on both sides, so short ones have shingles too.
SHINGLE = 8
BINS = 256
BITS = 4
_BASE = 0x9E3779B97F4A7C15
_NONE = np.iinfo(np.uint64).max
_PAD = np.full(SHINGLE - 1, 0x110000, np.uint32)


def _shingles(chars: np.ndarray) -> np.ndarray:
    h, size = np.concatenate([_PAD, chars, _PAD]).astype(np.uint64) + np.uint64(1), 1
    while size < SHINGLE:
        h = h[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + h[size:]
        size *= 2
    return mix(h)


def fingerprint(chars: np.ndarray) -> np.ndarray | None:
    """Low-order bits of the bins for the code points of a text; None for an empty one.

    Every shingle is hashed once; the high bits choose its bin. An empty bin takes the value of the first filled bin
    in its own sequence of universal hashes, so empty bins of two texts agree as often as their sets do.
    """
    if not len(chars):
        return None
    h = _shingles(chars)
    low = np.full(BINS, _NONE, np.uint64)
    shift = np.uint64(64 - BINS.bit_length() + 1)
    np.minimum.at(low, (h >> shift).astype(np.int64), h & ((np.uint64(1) << shift) - np.uint64(1)))
    empty, full, attempt = np.flatnonzero(low == _NONE), low != _NONE, 0
    out = low.copy()
    while len(empty):
        attempt += 1
        source = (mix(empty.astype(np.uint64) + np.uint64(attempt * BINS)) % np.uint64(BINS)).astype(np.int64)
        hit = full[source]
        out[empty[hit]] = low[source[hit]]
        empty = empty[~hit]
    return (mix(out) & np.uint64((1 << BITS) - 1)).astype(np.uint8)


def shown(print_: np.ndarray | None) -> str:
    """The packed bits as lowercase hexadecimal digits; an empty text has none."""
    if print_ is None:
        return ""
    bits = (print_[:, None] >> np.arange(BITS, dtype=np.uint8)) & 1
    return np.packbits(bits, bitorder="little").tobytes().hex()


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    """Estimated Jaccard similarity, without the share of bins that agree by chance; empty texts only equal each other."""
    if a is None or b is None:
        return float(a is b)
    chance = 2.0**-BITS
    return min(1.0, max(0.0, (float((a == b).mean()) - chance) / (1 - chance)))


def _dealt(docs: DataFrame, many: int) -> tuple[DataFrame, int]:
    """Rows (part, tail, doc_id, size, packed): ranges of ids, and after each range the first row of the next one.

    Bounds and the first id of each range are read to the driver, one number each per range. Null ids come first.
    """
    at = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    ids = docs.select(at.alias("at"))
    cuts = ids.approxQuantile("at", [k / many for k in range(1, many)], min(0.001, 0.25 / many)) if many > 1 else []
    bounds = np.unique(np.array(cuts, float)).astype(np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = np.searchsorted(bounds, batch.column(0).to_numpy(), "right")
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), batch.column(0)], names=["part", "at"])

    heads = mapped(ids, place, "part int, at long").groupBy("part").agg(F.min("at")).orderBy("part").collect()
    parts, first = [r[0] for r in heads], [r[1] for r in heads]
    before = {first[k]: parts[k - 1] for k in range(len(parts))}  # the first of all also follows the last of all

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        for batch in batches:
            key, ids, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            part = np.searchsorted(bounds, key, "right").tolist()
            rows = []
            for k, text in enumerate(texts):
                data = (text or "").encode()
                row = (int(key[k]), ids[k], len(data), codec.compress(data, asbytes=True))
                rows.append((part[k], False, *row))
                if int(key[k]) in before:
                    rows.append((before[int(key[k])], True, *row))
            kinds = (pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            cells = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(cells, names=["part", "tail", "at", "doc_id", "size", "packed"])

    rows = mapped(docs.select(at.alias("at"), F.col("doc_id").cast("long"), "text"),
        run, "part int, tail boolean, at long, doc_id long, size long, packed binary")
    return rows, len(parts)


def compare(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: fingerprints of each text and its edited text, and how like they are.

    The edited text has its last floor(n_chars / 4) code points replaced by the first as many (or all) of the next
    document, by ascending doc_id; the first document follows the last. Null ids come first, rows of equal id follow
    each other in a fixed order, null texts count as empty. A lone document follows itself. Very long texts are taken
    whole, an empty table gives an empty one. Texts move once, compressed.
    """

    def chars(size: int, packed: bytes, codec: pa.Codec) -> np.ndarray:
        text = codec.decompress(packed, size, asbytes=True).decode() if size else ""
        return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        codec = pa.Codec("zstd")
        held = None  # part, doc_id, code points, fingerprint of the row before
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                out = []
                for row in zip(*(c.to_pylist() for c in batch.slice(low, 256).columns), strict=True):
                    part, tail, _, doc_id, size, packed = row
                    if held is not None and held[0] != part:
                        held = None
                    if tail and held is None:
                        continue  # a further row of the same id behind the one that was needed
                    own = chars(size, packed, codec)
                    print_ = fingerprint(own)
                    if held is not None:
                        _, key, text, before = held
                        cut = len(text) // 4
                        edited = np.concatenate([text[: len(text) - cut], own[:cut]])
                        other = fingerprint(edited)
                        data = edited.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
                        out.append((key, len(text), hashlib.sha256(data).hexdigest(), shown(before), shown(other),
                                    likeness(before, other), likeness(before, print_)))
                    held = None if tail else (part, doc_id, own, print_)
                cells = [pa.array([r[c] for r in out], kind) for c, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(cells, names=names)

    many = 4 * width(docs)
    rows, _ = _dealt(docs, many)
    rows = rows.repartition(width(docs), "part").sortWithinPartitions("part", "tail", "at", "size", "packed")
    return mapped(rows, run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                "edited_fingerprint string, near_edited double, near_next double")
