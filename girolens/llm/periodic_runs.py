"""Periodic runs of words, found online by dyadic square catching.

A run is a stretch of consecutive words in which words q apart are identical, q its smallest period, that no neighbouring
word extends. Words become numbers, and the texts of a batch are appended to one stream with a separator of its own after
each text, so that no run crosses texts. The stream is read once, in steps of any size:

* For every power of two b, each completed block of b words (its place a multiple of b) gets a catcher for the periods
  2b - 1 to 4b - 2. A square of such a period has a whole block in its first half, so that block comes back one period
  later. Each period belongs to one b.
* Appended words advance the comparisons: a catcher compares its block with the suffixes that have come since, by hashes
  of b words that are built by doubling, until the words of its last period are in; then it is settled.
* Blocks in a row that come back at the same distance are squares that merge into one stretch, also over several steps.
  A stretch that ends is compared word by word, with fewer than b words on each side, so hashes decide nothing.
* A stretch inside of a run whose period divides its own is that run, and is not followed again.

Of a step, a level compares 2b distances for each block of b words: twice the words of the step, whatever they are, so a
text of one repeated word costs no more than prose. Nothing is shuffled; a lost task is run again.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from girolens.llm.common import blocks, mapped, mix, spans

#: A run has this many words and this many periods at least.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Words that are appended to the stream in one step.
STEP = 1 << 17
#: Bytes of text whose words are in one stream; a longer text is a stream of its own.
STREAM_BYTES = 1 << 20
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_TIMES = np.uint64(0x9E3779B97F4A7C15)
_NOTHING = -(1 << 62)  # from here on numbers that no word and no separator has


class _Level:
    """The catchers of the blocks of b words."""

    def __init__(self, b: int) -> None:
        self.b = b
        self.periods = np.arange(2 * b - 1, 4 * b - 1)
        self.settled = 0  # words whose catchers are settled
        self.hashes = np.zeros(0, np.uint64)  # of the b words from each place on
        self.since = np.full(2 * b, -1)  # per period the first word of a stretch that still grows

    def settle(self, have: int) -> list[tuple[int, int, int]]:
        """Stretches (period, first, end) of blocks in a row that come back, which have ended among the `have` words."""
        b, begin = self.b, self.settled
        rows = (have - begin - (4 * b - 2)) // b
        if rows <= 0:
            return []
        seen = np.lib.stride_tricks.sliding_window_view(self.hashes, 4 * b - 1)[: rows * b : b]
        back = (seen[:, 2 * b - 1 :] == seen[:, :1]).T  # period, block
        self.settled += rows * b
        self.hashes = self.hashes[rows * b :].copy()
        going = self.since >= 0
        if not going.any() and not back.any():
            return []
        edge = np.diff(np.concatenate([going[:, None], back], axis=1).astype(np.int8), axis=1)
        period, block = np.nonzero(edge == 1)
        period = np.concatenate([np.flatnonzero(going), period])
        first = np.concatenate([self.since[going], begin + block * b])
        order = np.argsort(period, kind="stable")  # the one that was growing comes before new ones
        period, first = period[order], first[order]
        grows = np.append(period[1:] != period[:-1], True)[: len(period)] & back[period, -1]
        self.since[:] = -1
        self.since[period[grows]] = first[grows]
        period, first = period[~grows], first[~grows]
        end = begin + np.nonzero(edge == -1)[1] * b  # one for each of them, in the same order
        return list(zip(self.periods[period].tolist(), first.tolist(), end.tolist(), strict=True))


class Catcher:
    """Runs of a stream of words, given as numbers from 0 and separators below 0.

    `longest` is the length of the longest run that can occur (the longest text), which bounds the periods.
    """

    def __init__(self, longest: int, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> None:
        self._least, self._most = least, max(2, periods)
        self._words, self._owner = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._levels: list[_Level] = []
        while (2 << len(self._levels)) - 1 <= longest // self._most:
            self._levels.append(_Level(1 << len(self._levels)))
        self._runs: list[tuple[int, int, int]] = []  # start, end, period

    def append(self, words: np.ndarray) -> None:
        """The next words; catchers whose last words are among them are settled."""
        self._words = np.concatenate([self._words, words])
        self._owner = np.concatenate([self._owner, np.full(len(words), -1)])  # the run that a word is in
        fresh, low = mix(words.astype(np.uint64) * _TIMES), None
        for level in self._levels:
            if low is not None:  # hashes of twice as many words, from those of the level below
                place = level.settled + len(level.hashes) - low.settled
                pairs = low.hashes[place:]
                half = low.b
                fresh = mix(pairs[:-half] * _TIMES + pairs[half:]) if len(pairs) > half else pairs[:0]
            level.hashes = np.concatenate([level.hashes, fresh])
            low = level
        for level in self._levels:
            for period, first, end in level.settle(len(self._words)):
                self._merge(period, first, end, level.b)

    def finish(self) -> list[tuple[int, int, int]]:
        """All runs (start, end, period) by start, then period; the stream ends here."""
        if self._levels:
            self.append(_NOTHING + np.arange(6 * self._levels[-1].b))
        return sorted(self._runs, key=lambda r: (r[0], r[2]))

    def _needed(self, period: int) -> int:
        return max(self._least, self._most * period)

    def _merge(self, period: int, first: int, end: int, b: int) -> None:
        """Notes the runs among the words around first to end, whose blocks come back one period later."""
        if end - first < (self._needed(period) - period - b + 1) // b * b:
            return  # a run has more whole blocks than that
        held = self._owner[first]
        if held >= 0:
            start, stop, smaller = self._runs[held]
            if period % smaller == 0 and end + period <= stop:
                return
        words = self._words
        low, high = max(0, first - b), min(len(words) - period, end + b)
        apart = low + np.flatnonzero(words[low:high] != words[low + period : high + period])
        edges = [low - 1, *apart.tolist(), high]
        for before, after in zip(edges, edges[1:], strict=False):
            start, stop = before + 1, after + period
            if stop - start >= self._needed(period) and self._smallest(start, stop, period):
                self._owner[start:stop] = len(self._runs)
                self._runs.append((start, stop, period))

    def _smallest(self, start: int, stop: int, period: int) -> bool:
        """Whether no divisor is a period too; with two whole periods a smaller period is a divisor."""
        words = self._words[start:stop]
        return not any(period % d == 0 and np.array_equal(words[d:], words[:-d]) for d in range(1, period // 2 + 1))


def runs_of(texts: list[list[str]], step: int = STEP, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[list[tuple[int, int, int]]]:
    """For each list of words its runs (start, length, period), by start, then period."""
    number: dict[str, int] = {}
    sizes = np.array([len(words) + 1 for words in texts], np.int64)
    ends = np.cumsum(sizes)
    ids = np.fromiter((number.setdefault(w, len(number)) for words in texts for w in (*words, "")), np.int64, int(sizes.sum()))
    ids[ends - 1] = -1 - np.arange(len(texts))  # separators differ from each other
    catcher = Catcher(int(sizes.max(initial=1)) - 1, least, periods)
    for low in range(0, len(ids), step):
        catcher.append(ids[low : low + step])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    found = catcher.finish()
    rows = np.searchsorted(ends, [start for start, _, _ in found], "right").tolist()
    for row, (start, end, period) in zip(rows, found, strict=True):
        out[row].append((start - int(ends[row] - sizes[row]), end - start, period))
    return out


def kept(n: int, runs: Iterable[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: those that no run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) == 0


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` without their text, with its `runs`, and with `collapsed`, the text without repeats.

    `runs` is an array of (start, length, period) in words `[^\\x20\\x09-\\x0D]+`, numbered from 0, by start, then period.
    A run has 6 words and 4 periods at least. `collapsed` holds the words that are in no run after its first period,
    joined by one blank. Null, empty and blank texts have no runs and an empty `collapsed`. Runs that overlap or share an
    end are all told. Repeated rows give repeated rows, an empty table no rows; other columns named like the new ones are
    replaced. A very long text is appended in steps like any other; a task needs memory in proportion to its words.
    """
    own = [c for c in docs.columns if c not in (text, "runs", "collapsed")]
    rows = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in own]).alias("row"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            _, offsets = spans(batch.column(1))
            for i, j in blocks(offsets, STREAM_BYTES):
                part = batch.slice(i, j - i)
                texts = [_WORD.findall(t or "") for t in part.column(1).to_pylist()]
                found = runs_of(texts)
                left = [" ".join(words[k] for k in np.flatnonzero(kept(len(words), runs))) if runs else " ".join(words)
                        for words, runs in zip(texts, found, strict=True)]
                named = [[{"start": s, "length": n, "period": p} for s, n, p in runs] for runs in found]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(named, shape), pa.array(left, pa.string())],
                                                 names=["row", "runs", "collapsed"])

    told = StructType([rows.schema["row"], *StructType.fromDDL(
        "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string").fields])
    return mapped(rows, run, told).select(*[F.col(f"row.`{c}`").alias(c) for c in own], "runs", "collapsed")


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text of `documents`; every tenth text by the CRC-32 of its id goes on in a period from some word on.

    With h that number, g its tenth and n words, word i from a = g % n on becomes word a + (i - a) % p, p being
    1 + (n - a) // (3 + g % 8). Words are joined by one blank then. Other texts, and rows without an id, stay as they are.
    """

    def repeated(doc: int | None, text: str | None) -> str | None:
        h = zlib.crc32(str(doc).encode())
        words = _WORD.findall(text or "") if doc is not None and h % 10 == 0 else []
        if not words:
            return text
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return " ".join(words[:a] + [words[a + k % p] for k in range(n - a)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts = map(repeated, part.column(0).to_pylist(), part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(texts), pa.string())], names=["doc_id", "text"])

    return mapped(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, text string")


def strongest(found: DataFrame) -> DataFrame:
    """Digest columns of `find`: n_runs, the run of most periods (ties: first start, then period) and its exponent in
    thousandths, runs_sha256 of all runs as lines, collapsed_sha256. Without a run the four columns of the run are null."""
    first = F.get(F.array_sort("runs", lambda a, b: F.when(a["length"] * b["period"] > b["length"] * a["period"], -1).when(
        a["length"] * b["period"] < b["length"] * a["period"], 1).when(a["start"] < b["start"], -1).when(
        a["start"] > b["start"], 1).otherwise((a["period"] - b["period"]).cast("int"))), F.lit(0))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    told = found.withColumn("n_runs", F.size("runs").cast("long")).withColumn("best", first)
    return told.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                       F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                       F.sha2(F.concat(lines, F.when(F.col("n_runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
                       F.sha2("collapsed", 256).alias("collapsed_sha256"))
