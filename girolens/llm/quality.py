"""Quality classifier: histogram gradient-boosted trees over statistics of the text.

The trees are grown on a sample of labelled rows whose size is bounded by `rows`, so they and the sample have a fixed
size at any scale. They are flattened into arrays, and all documents of a batch walk down a tree together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from girolens.llm.common import blocks, lean, mapped, spans, words

#: Labelled rows that a model is fitted on: those with the smallest hash of their id.
SAMPLE_ROWS = 20_000
BINS = 64

_CLASSES = [  # bytes that are counted; shares of them are features
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " ", "\t\r\v\f", "\n", ".", ",;:", "!", "?",
    "|", "#$%&*+=<>^~@\\_/", "\"'`", "()[]{}", "-",
]
_CLASS = np.full(256, len(_CLASSES), np.uint8)
for _k, _members in enumerate(_CLASSES):
    _CLASS[list(_members.encode())] = _k
_CLASS[:32][_CLASS[:32] == len(_CLASSES)] = len(_CLASSES) + 1
_CLASS[128:] = len(_CLASSES) + 2
_KINDS = len(_CLASSES) + 3
FEATURES = _KINDS + 13


def statistics(column: pa.Array) -> np.ndarray:
    """One row of FEATURES numbers per text, from the whole text; all zeros for empty ones."""
    data, at = spans(column)
    out = np.zeros((len(at) - 1, FEATURES))
    for i, j in blocks(at):
        low, high = int(at[i]), int(at[j])
        size = np.diff(at[i : j + 1])
        row = np.repeat(np.arange(j - i), size)
        part = data[low:high]
        counts = np.bincount(row * _KINDS + _CLASS[part], minlength=(j - i) * _KINDS).reshape(j - i, _KINDS)
        chars = size - np.bincount(row, weights=(part & 0xC0) == 0x80, minlength=j - i)
        rows = out[i:j]
        some = np.maximum(size, 1)
        rows[:, :_KINDS] = counts / some[:, None]
        hashes, first = words(data, at[i : j + 1])
        lines = np.concatenate([[low], np.flatnonzero(part == 10) + 1 + low])
        for k in np.flatnonzero(size):
            own = hashes[first[k] : first[k + 1]]
            n = len(own)
            _, often = np.unique(own, return_counts=True)
            a, b = np.searchsorted(lines, [at[i + k], at[i + k + 1]])
            starts = np.concatenate([[at[i + k]], lines[a:b][lines[a:b] > at[i + k]]])
            length = np.diff(np.concatenate([starts, [at[i + k + 1]]]))
            text = data[at[i + k] : at[i + k + 1]]
            shown = {}
            for s, e in zip(starts.tolist(), (starts + length).tolist(), strict=True):
                line = data[s:e].tobytes().strip()
                shown[line] = shown.get(line, 0) + 1
            rows[k, _KINDS:] = (
                np.log1p(chars[k]), np.log1p(n), chars[k] / max(n, 1), len(often) / max(n, 1), often.max(initial=0) / max(n, 1),
                (often == 1).sum() / max(n, 1), np.sort(often)[-10:].sum() / max(n, 1), len(shown) / len(starts),
                np.log1p(length.mean()), np.log1p(length.max()), length.std() / max(length.mean(), 1),
                np.bincount(text, minlength=256).max() / len(text), len(np.unique(text)) / 256,
            )
    return out


@dataclass
class Trees:
    """Nodes of all trees in arrays. A leaf has feature -1; `left` holds the first of two neighbouring children."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                feature = self.feature[node]
                right = x[rows, np.maximum(feature, 0)] > self.threshold[node]
                node = np.where(feature < 0, node, self.left[node] + right)
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, least: float = 5.0,
         ridge: float = 1.0) -> Trees:
    """Boosted trees for a 0/1 target. Without rows, or with one class only, a constant near the share of ones."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(share / (1 - share)))
    feature, threshold, left, value, roots = [], [], [], [], []
    if len(y) and 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], axis=1)
        shift = np.arange(x.shape[1]) * BINS
        total = np.full(len(y), start)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-total))
            g, h = y - p, np.maximum(p * (1 - p), 1e-9)
            roots.append(len(feature))
            level = [(len(feature), np.arange(len(y)))]
            feature.append(-1), threshold.append(0.0), left.append(0), value.append(0.0)
            for d in range(depth + 1):
                below = []
                for node, rows in level:
                    gs, hs = g[rows].sum(), h[rows].sum()
                    value[node] = rate * gs / (hs + ridge)
                    total[rows] += value[node]
                    if d == depth or len(rows) < 2 * least:
                        continue
                    cells = (binned[rows] + shift).ravel()
                    sums = [np.bincount(cells, weights=np.repeat(w[rows], x.shape[1]), minlength=BINS * x.shape[1])
                            .reshape(-1, BINS).cumsum(axis=1)[:, :-1] for w in (g, h, np.ones(len(y)))]
                    gl, hl, nl = sums
                    gain = gl**2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs**2 / (hs + ridge)
                    gain[(nl < least) | (len(rows) - nl < least)] = -1
                    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
                    if gain[f, b] <= 1e-6 or b >= len(edges[f]):
                        continue
                    total[rows] -= value[node]
                    right = binned[rows, f] > b
                    feature[node], threshold[node], left[node] = int(f), float(edges[f][b]), len(feature)
                    for side in (rows[~right], rows[right]):
                        below.append((len(feature), side))
                        feature.append(-1), threshold.append(0.0), left.append(0), value.append(0.0)
                level = below
    kinds = ((feature, np.int64), (threshold, float), (left, np.int64), (value, float), (roots, np.int64))
    return Trees(*(np.array(v, k) for v, k in kinds), depth, start)


def held_out(key: Column, folds: int = 5) -> Column:
    """Whether the CRC-32 of the id as text leaves no remainder; null ids are not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Trees:
    """Trees from the labelled rows that are not held out; `rows` bounds how many of them are read to the driver.

    `labels` has doc_id and quality. Rows with nulls are left out; an id with both labels counts as 1.
    """
    told = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    told = told.groupBy("doc_id").agg(F.max("quality").alias("_quality"))
    told = told.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(told), "doc_id").select("text", "_quality")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(batch.column(0))
            cells = [pa.array(list(x), pa.list_(pa.float64())), batch.column(1).cast(pa.int32())]
            yield pa.RecordBatch.from_arrays(cells, names=["x", "y"])

    found = mapped(texts, run, "x array<double>, y int").orderBy("y", "x").toArrow()
    x = np.array(found.column("x").to_pylist(), float).reshape(-1, FEATURES)
    return grow(x, (found.column("y").to_numpy() > 0).astype(float))


def score(docs: DataFrame, trees: Trees, at: float = 0.3) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score (null and empty texts too), predicted (1 from `at` on).

    Equal texts have equal scores, so repeated rows and ties are decided alike. Very long texts are read whole, and an
    empty table gives an empty one. Only doc_id and text are read, whatever other columns are called.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = trees.scores(statistics(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    scored = mapped(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= at).cast("int").alias("predicted"))


def keep(docs: DataFrame, trees: Trees, at: float = 0.3) -> DataFrame:
    """The rows of `docs` that are not rejected, with all their columns."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at_text = batch.schema.get_field_index("text")
            yield batch.filter(pa.array(trees.scores(statistics(batch.column(at_text))) >= at))

    return mapped(docs, lean(run), schema)
