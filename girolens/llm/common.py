"""Helpers that the operators of this package share: tables, checkpoints, text buffers, word hashes, components."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of text that the vectorised helpers look at in one go; a longer document is a block of its own.
BLOCK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, which the driver and all executors share.

    A local session without that setting falls back to a temporary folder; a cluster has to set it.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir")
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the modules of this package to the executors, once per application; they need not have them installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="llm-modules-")) / f"{package.name}-{context.applicationId}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in [package / "__init__.py", *sorted((package / "llm").glob("*.py"))]:
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """mapInArrow, after the executors got what `run` imports."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], rows: int | None = 512,
         size: int = BLOCK_BYTES) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run` on slices of `rows` rows and, but for longer rows, `size` bytes at most (None: whole batches); the worker
    gives back its memory after a task.

    Workers are used again by later stages. What malloc and Arrow keep of a stage would add to what the next one needs.
    """

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if rows is None:
                yield batch
                continue
            step = max(1, min(rows, batch.num_rows * size // max(batch.nbytes, 1)))
            for low in range(0, batch.num_rows, step):
                yield batch.slice(low, step)

    def leaner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(slices(batches))
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(AttributeError, OSError):  # only glibc has it
                ctypes.CDLL(None).malloc_trim(0)

    return leaner


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage of `df` with a checkpoint in the shared folder; the shuffle files that led to it go at once.

    Spark would keep them until the driver's collector finds the frames, which may be long after.
    """
    spark = df.sparkSession
    shared_folder(spark)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a frame keeps the setting that it was made under
    finally:
        spark.conf.set(_CLEANUP, before)


def width(df: DataFrame) -> int:
    """Partitions for a shuffle that is dealt by hand."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the n + 1 offsets of its rows; null counts as empty."""
    column = column.fill_null("" if not pa.types.is_binary(column.type) else b"").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) whose bytes stay under `size`, or single longer rows."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = j


_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 of an odd base modulo 2**64, and of its inverse; kept for the next call."""
    for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
        have = _powers[k]
        while len(have) < n:
            have = np.concatenate([have, have * np.uint64(pow(base, len(have), 1 << 64))])
        _powers[k] = have
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input reaches every bit of the result."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(1, 257, dtype=np.uint64)
_LOWER[ord("A") : ord("Z") + 1] += np.uint64(32)


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased, and each row's first word (n + 1 of them)."""
    base, n = int(at[0]), int(at[-1] - at[0])
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    data, at = data[base : base + n], at - base
    inside = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[at] = True  # a word never crosses rows
    before = np.concatenate([[False], inside])
    after = np.concatenate([inside, [False]])
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    up, down = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_LOWER[data] * up[:n], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, at)


def shingles(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of n words, and each row's first one; a row of fewer words has one run of all its words."""
    count = np.diff(first)
    runs = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for k in range(n):
        runs += hashes[k : k + len(runs)] * np.uint64(pow(0xD1342543DE82EF95, k + 1, 1 << 64))
    runs = mix(runs)
    many = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    start = np.concatenate([[0], np.cumsum(many)])
    out = np.empty(start[-1], np.uint64)
    full = np.flatnonzero(count >= n)
    source = np.repeat(first[full] - start[full], many[full]) + _ranges(start[full], many[full])
    out[_ranges(start[full], many[full])] = runs[source]
    for row in np.flatnonzero((count > 0) & (count < n)):
        value = int(count[row])
        for h in hashes[first[row] : first[row + 1]]:
            value = (value * _BASE + int(h)) & _MASK
        out[start[row]] = mix(np.array([value], np.uint64))[0]
    return out, start


def _ranges(start: np.ndarray, many: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... many[i] of them, for each i."""
    if not len(start):
        return np.zeros(0, np.int64)
    ends = np.cumsum(many)
    return np.arange(ends[-1]) - np.repeat(ends - many - start, many)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of `edges` (u, v: long): rows (node, component) with component the smallest node.

    Alternates large-star and small-star until the edges stay as they are. Each node sends its edges to the smallest
    neighbour, so every step is a partial aggregate and a join; no list of neighbours is built. Nodes without an
    edge are not returned.
    """
    pairs = cut(edges.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v"))
        pairs = cut(small.distinct())
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == tuple(now):
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = tuple(now)
