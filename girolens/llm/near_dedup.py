"""MinHash near-duplicates by a multi-index Hamming join on b-bit signatures.

Every text becomes the set of its word shingles and a signature of 64 symbols of 16 bits, one per hash function. A pair
of similarity s differs in about 64 (1 - s) symbols; pairs that reach the threshold differ in at most `budget` symbols
but for a chance of about one in a million. Signatures are split into chunks such that one chunk of a pair within the
budget has one wrong symbol at most (pigeonhole). For every chunk, each way to leave one symbol out gives a key, so all
pairs within the budget share a key. Texts with equal sets collapse into one class before that.

Pairs are not listed within a key. Every class meets the smallest classes of its keys and some that a hash chooses; the
nearest one by signature is compared on full sets, and confirmed links give components. Keys whose members are all in
one component are done. In the others, members meet chosen members of other components once more.
Then all pairs from different components are left: small keys list them; in large ones, only pairs that share one of
their rarest shingles can reach the threshold. What is within the budget is confirmed on full sets. So no link between
different texts that would change a component is missed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from girolens.llm.common import blocks, components, cut, lean, mapped, mix, shingles, spans, words

SYMBOLS = 64
#: Keys of more members find their remaining pairs by rare shingles; those of fewer list them.
SMALL = 16
#: Members that are compared with one another in one block of `_rare`.
BLOCK = 1024
#: Symbols of one byte of the signatures there.
LONG = 256
#: Turns in which members meet chosen members of other components, and the share of keys that one turn looks at.
TURNS, KEYS_A_TURN = 2, 4
_SIGMAS = 4.7
_rng = np.random.default_rng(20240917)
_A = _rng.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64)
_LONG_A = _rng.integers(0, 1 << 63, LONG, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LONG_B = _rng.integers(0, 1 << 63, LONG, dtype=np.uint64)


def budget(percent: int) -> int:
    """Symbols in which the signatures of a pair that reaches the threshold may differ."""
    p = 1 - percent / 100
    return min(SYMBOLS - 3, math.ceil(SYMBOLS * p + _SIGMAS * math.sqrt(SYMBOLS * p * (1 - p))))


def patterns(limit: int) -> list[np.ndarray]:
    """Symbol positions of each key: the chunks with one symbol left out."""
    chunks = np.array_split(np.arange(SYMBOLS), limit // 2 + 1)
    return [np.delete(c, i) for c in chunks for i in range(len(c))]


def _long_budget(percent: int) -> int:
    p = 1 - percent / 100
    return math.ceil(LONG * p + _SIGMAS * math.sqrt(LONG * p * (1 - p)))


def _lowest(found: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(found), 4096):
        part = found[i : i + 4096]
        low = np.minimum(low, (part[None, :] * a[:, None] + b[:, None]).min(axis=1))
    return mix(low)


def signature(found: np.ndarray) -> np.ndarray:
    """The signature of a set of shingle hashes."""
    return _lowest(found, _A, _B).astype(np.uint16)


def long_signature(found: np.ndarray) -> np.ndarray:
    return _lowest(found, _LONG_A, _LONG_B).astype(np.uint8)


def _sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of each text."""
    data, at = spans(column)
    for i, j in blocks(at):
        found, start = shingles(*words(data, at[i : j + 1]), n)
        for a, b in zip(start[:-1], start[1:], strict=True):
            yield np.unique(found[a:b])


def _identity(found: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        a, b = mix(found).sum(dtype=np.uint64), mix(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def _prints(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, two halves of a digest of the set, signature (null for empty sets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(len(s), *_identity(s), signature(s).tobytes() if len(s) else None) for s in _sets(batch.column(1), n)]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            cells = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cells], names=["doc_id", "n_shingles", "set_a", "set_b", "signature"])

    return mapped(docs.select(F.col("doc_id").cast("long"), "text"),
        lean(run), "doc_id long, n_shingles long, set_a long, set_b long, signature binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, SYMBOLS)


def _keys(classes: DataFrame, limit: int) -> DataFrame:
    """(key, id) for every class and every chunk with one symbol left out."""
    ways = patterns(limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols, ids = _matrix(batch.column(1)).astype(np.uint64), batch.column(0).to_numpy()
            for w, way in enumerate(ways):
                key = np.full(len(ids), w + 1, np.uint64)
                for k in way:
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + symbols[:, k])
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(ids)], names=["key", "id"])

    return mapped(classes.select("id", "signature"), lean(run, None), "key long, id long")


def _within(pairs: DataFrame, classes: DataFrame, limit: int) -> DataFrame:
    """The pairs (u, v) whose signatures differ in `limit` symbols at most, with the number of them."""
    signed = classes.select(F.col("id").alias("u"), F.col("signature").alias("su"))
    other = classes.select(F.col("id").alias("v"), F.col("signature").alias("sv"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                apart = (_matrix(batch.column(2)) != _matrix(batch.column(3))).sum(axis=1)
                cells = [batch.column(0), batch.column(1), pa.array(apart, pa.int32())]
                yield pa.RecordBatch.from_arrays(cells, names=["u", "v", "apart"]).filter(pa.array(apart <= limit))

    return mapped(pairs.join(signed, "u").join(other, "v").select("u", "v", "su", "sv"), lean(run, None), "u long, v long, apart int")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    left = sets.select(F.col("id").alias("u"), F.col("found").alias("fu"))
    right = sets.select(F.col("id").alias("v"), F.col("found").alias("fv"))
    both = pairs.join(left, "u").join(right, "v")
    shared = F.size(F.array_intersect("fu", "fv"))
    both = both.select("u", "v", shared.alias("shared"), (F.size("fu") + F.size("fv")).alias("total"))
    return both.where(100 * F.col("shared") >= percent * (F.col("total") - F.col("shared"))).select("u", "v")


def _crossing(members: DataFrame) -> DataFrame:
    """Pairs of one key from different components; keys have SMALL members at most."""
    left = members.select("key", F.col("id").alias("u"), F.col("component").alias("cu"))
    right = members.select("key", F.col("id").alias("v"), F.col("component").alias("cv"))
    return left.join(right, "key").where("u > v AND cu != cv").select("u", "v").distinct()


def _rare(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs from different components that share one of their rarest shingles, if a long signature allows them.

    Sets of n and m shingles that reach the threshold share at least a = ceil(p (n + m) / (100 + p)) of them. Put both
    in one order (by frequency, then by hash): the first shingle that they share has at least a - 1 behind it in both.
    So only first parts of the sets are dealt out by shingle. In a group of near copies what all of them share is
    frequent and stands last. A pair is looked at where its first shared shingle is, by signatures of LONG symbols,
    and only what these allow becomes a row. Frequent shingles are dealt to pairs of blocks of BLOCK members.
    """
    homes = members.select("id", "component").distinct()
    tokens = sets.join(homes.select("id"), "id").select("id", F.size("found").alias("n"), F.explode("found").alias("token"))
    often = tokens.groupBy("token").agg(F.count("*").alias("often"))
    ranked = tokens.join(often, "token").groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("often", "token"))).alias("all"))
    most = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    first = ranked.select("id", "n", F.slice("all", F.lit(1), most.cast("int")).alias("first"))
    first = first.join(homes, "id").join(sets.select("id", "long"), "id")
    dealt = first.select("id", "n", "component", "long", F.col("first.token").alias("first"), F.explode("first").alias("t")).where("t.often > 1")
    many = F.ceil(F.col("t.often") / BLOCK).cast("int")
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("id"), many).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), many - 1)))
    group = ["token", "low", "high"]
    dealt = dealt.select(F.col("t.token").alias("token"), F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                         "own", "id", "n", "component", "long", "first")
    dealt = dealt.repartition(*group).sortWithinPartitions(*group, "id")
    allowed = _long_budget(percent)

    def pairs(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        token = rows.column("token")[0].as_py()
        ids, n, home, own = (rows.column(c).to_numpy() for c in ("id", "n", "component", "own"))
        low, high = rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
        long = np.frombuffer(b"".join(rows.column("long").to_pylist()), np.uint8).reshape(-1, LONG)
        firsts = [x.tolist() for x in rows.column("first").to_numpy(zero_copy_only=False)]
        at = np.array([f.index(token) for f in firsts])
        us, vs = [], []
        for i in range(len(ids) - 1):
            j = np.arange(i + 1, len(ids))
            need = -(-percent * (n[i] + n[j]) // (100 + percent))
            j = j[(home[j] != home[i]) & ((low == high) | (own[j] != own[i])) & (np.minimum(n[i] - at[i], n[j] - at[j]) >= need)]
            j = j[(long[j] != long[i]).sum(axis=1) <= allowed]
            before = set(firsts[i][: at[i]])
            for k in j.tolist():
                if before.isdisjoint(firsts[k][: at[k]]):
                    us.append(max(ids[i], ids[k]))
                    vs.append(min(ids[i], ids[k]))
        return np.array(us, np.int64), np.array(vs, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the rows of a group, two blocks at most, may go on in the next batch
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in group), strict=True))
            edges = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                part = batch.slice(a, b - a)
                if held and keys[a] != tuple(held[0].column(c)[0].as_py() for c in group):
                    yield _pair_rows(*pairs(_one(held)))
                    held = []
                if b - a:
                    held.append(part)
        if held:
            yield _pair_rows(*pairs(_one(held)))

    return mapped(dealt, lean(run, None), "u long, v long").distinct()


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _pair_rows(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _sampled(members: DataFrame, turn: int) -> DataFrame:
    """Pairs (u, v) of different components: a member of every KEYS_A_TURN-th key with the one that a hash chooses there."""
    some = members.where(F.pmod(F.xxhash64("key"), F.lit(KEYS_A_TURN)) == turn % KEYS_A_TURN)
    chosen = some.groupBy("key").agg(F.min(F.struct(F.xxhash64("id", "key", F.lit(turn)).alias("h"), "id", "component")).alias("c"))
    met = some.join(chosen, "key").where(F.col("component") != F.col("c.component"))
    return met.select(F.col("id").alias("u"), F.col("c.id").alias("v")).distinct()


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id and the compressed text, for a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            packed = [codec.compress(t, asbytes=True) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(packed, pa.binary())],
                                             names=["doc_id", "size", "packed"])

    return mapped(docs.select(F.col("doc_id").cast("long"), "text"), lean(run), "doc_id long, size long, packed binary")


def _full_sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(id, found, long) for the classes in `wanted` (id, set_a, set_b), from their whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                part = batch.slice(low, 64)
                texts = [codec.decompress(p, s, asbytes=True).decode() if s else "" for p, s in
                         zip(part.column(2).to_pylist(), part.column(1).to_pylist(), strict=True)]
                found = list(_sets(pa.array(texts, pa.large_string()), n))
                keep = [i for i, s in enumerate(found) if _identity(s) == (part.column(3)[i].as_py(), part.column(4)[i].as_py())]
                cells = [pa.array([found[i].view(np.int64) for i in keep], pa.list_(pa.int64())),
                         pa.array([long_signature(found[i]).tobytes() for i in keep], pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(keep, pa.int64())), *cells], names=["id", "found", "long"])

    rows = _packed(docs).join(wanted.hint("SHUFFLE_HASH"), F.col("doc_id") == F.col("id"))
    return mapped(rows.select("id", "size", "packed", "set_a", "set_b"), lean(run), "id long, found array<long>, long binary").dropDuplicates(["id"])


def link(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept.

    Words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased; a set holds the distinct shingles of `n` words, or the whole
    sequence where there are fewer. Two documents are linked if 100 * intersection >= percent * union. `component_id`
    is the smallest doc_id that can be reached, `kept` says whether it is the document's own. Null texts count as
    empty; empty sets are linked with nothing. Rows with a null doc_id stay outside: their component is null, and
    they are kept. Repeated rows give repeated rows. An id that occurs with different texts is one node. Very long texts
    are taken whole; an empty table gives an empty one.
    """
    limit = budget(percent)
    prints = cut(_prints(docs, n))
    known = prints.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = known.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("id"), F.first("signature").alias("signature"))
    classes = cut(classes)
    keys = _keys(classes, limit)
    shared = cut(keys.groupBy("key").agg(F.min("id").alias("leader"), F.max("id").alias("top"), F.count("*").alias("size"))
                 .where(F.col("leader") < F.col("top")).drop("top"))
    members = cut(keys.join(shared, "key").select("key", "id", "leader", "size"))
    wanted = members.select("id").distinct().join(classes.select("id", "set_a", "set_b"), "id")
    sets = cut(_full_sets(docs, wanted, n))

    edges = None
    for turn in range(TURNS + 1):
        if edges is None:
            rest = members.withColumn("component", F.col("id"))
        else:
            found = components(edges)
            told = members.join(found, members["id"] == found["node"], "left").select(
                "key", "id", "size", F.coalesce("component", "id").alias("component"))
            mixed = told.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b").select("key")
            rest = cut(told.join(mixed, "key"))
        if turn < TURNS:
            pairs = _sampled(rest, turn)
            if edges is None:
                stars = members.where("id > leader").select(F.col("id").alias("u"), F.col("leader").alias("v"))
                pairs = pairs.unionByName(stars).distinct()
            pairs = _within(pairs, classes, limit).groupBy("u").agg(F.min(F.struct("apart", "v")).alias("best"))
            pairs = pairs.select("u", F.col("best.v").alias("v"))
        else:
            pairs = _crossing(rest.where(F.col("size") <= SMALL)).unionByName(_rare(rest.where(F.col("size") > SMALL), sets, percent))
            pairs = _within(pairs.distinct(), classes, limit).select("u", "v")
        new = _confirmed(pairs, sets, percent)
        edges = cut(new if edges is None else edges.unionByName(new))
    found = components(edges)

    homes = classes.select("set_a", "set_b", "id").join(found, F.col("id") == F.col("node"), "left").select(
        F.col("set_a").alias("a"), F.col("set_b").alias("b"), F.coalesce("component", "id").alias("component"))
    told = prints.join(homes, (prints["set_a"] == homes["a"]) & (prints["set_b"] == homes["b"])
                       & (prints["n_shingles"] > 0) & prints["doc_id"].isNotNull(), "left")
    component = F.coalesce("component", "doc_id")
    return told.select("doc_id", "n_shingles", component.alias("component_id"),
                       F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs`, one for each component, with all their columns.

    Of rows with equal doc_id the smallest stays (by text, then the other columns). Rows with a null doc_id all stay.
    """
    told = link(docs, n, percent).where("kept AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("k_id")).agg(F.count("*").alias("k_n"))
    told = cut(told)
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found = rows.join(told.hint("SHUFFLE_HASH"), F.col("id") == F.col("k_id"))
    several = found.where("k_n > 1").groupBy("k_id").agg(F.min(F.struct("row.text", "row")).alias("least")).select("least.row")
    return found.where("k_n = 1").select("row").unionByName(several).unionByName(rows.where("id IS NULL").select("row")).select("row.*")
