"""Merkle manifest of a table: a tree of fixed fan-out for each group, and one tree over the roots of the groups.

Each level is one equijoin of the nodes with themselves. A node is known by its tree and its place; its siblings are the
places of the same run of `fan` places, reached by adding 1 to `fan` - 1 to the own slot modulo `fan` (for a fan-out of
two that is the exclusive or with one). So every node is sent to the computed places of its siblings and met there, and
has its whole run then: what stands left and right of it, which is also its step of the inclusion proof. The rows of slot
zero emit the parents, the nodes of the next level. A node is sent `fan` - 1 times whatever the size of its group, so a
hot group has the same load a row as any other.

Only DataFrame operations: nothing here runs Python on the executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from girolens.llm.common import cut
from girolens.operators.joins import hot_lookup
from girolens.operators.ranking import row_number

FAN = 16
#: The columns of `documents` that make a leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Groups that are looked up from a broadcast; each row there holds digests only.
FEW_GROUPS = 10_000
_DIGEST = 32
_STEPS = "array<struct<left: binary, right: binary>>"


def _digest(value: Column) -> Column:
    return F.unhex(F.sha2(value, 256))


def _shown(value: Column) -> Column:
    return F.lower(F.hex(value))


def leaf(fields: list[Column]) -> Column:
    """Digest of the fields one after the other: `-` for null, else the number of UTF-8 bytes, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    return _digest(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def parent(left: Column, node: Column, right: Column) -> Column:
    """Digest of a run, given by what stands left and right of one node of it."""
    return _digest(_shown(F.concat(left, node, right)))


def folded(node: Column, steps: Column) -> Column:
    """The root that a leaf and the steps of its proof lead to."""
    return F.aggregate(steps, node, lambda at, step: parent(step["left"], at, step["right"]))


def proof_digest(steps: Column) -> Column:
    """Lowercase hex digest of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: _shown(F.concat(s["left"], s["right"]))), ""), 256)


def _met(nodes: DataFrame, fan: int) -> DataFrame:
    """`nodes` (tree, idx, n, node, ...) with `left` and `right`, the digests of the siblings on either side."""
    slot = F.col("idx") % fan
    sent = nodes.select("tree", "n", slot.alias("from"), (F.col("idx") - slot).alias("run"), F.col("node").alias("sibling"),
                        F.explode(F.sequence(F.lit(1), F.lit(fan - 1))).alias("step"))
    sent = sent.withColumn("idx", F.col("run") + (F.col("from") + F.col("step")) % fan).where(F.col("idx") < F.col("n"))
    own = nodes.columns
    met = nodes.join(sent.select("tree", "idx", "from", "sibling"), ["tree", "idx"], "left")
    siblings = F.sort_array(F.collect_list(F.when(F.col("sibling").isNotNull(), F.struct("from", "sibling"))))
    met = met.groupBy(*own).agg(siblings.alias("siblings"))

    def joined(side: Column) -> Column:
        return F.aggregate(F.filter("siblings", lambda s: side_of(s, side)), F.lit(b""), lambda out, s: F.concat(out, s["sibling"]))

    def side_of(s: Column, right: Column) -> Column:
        return (s["from"] > slot) == right

    return met.select(*own, joined(F.lit(False)).alias("left"), joined(F.lit(True)).alias("right"))


def _trees(nodes: DataFrame, fan: int) -> tuple[DataFrame, DataFrame]:
    """Steps of every node, and (tree, top) of every tree; `nodes` has tree, idx from 0, n of the tree, and node."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    own, levels, tops = nodes.columns, [], []
    while True:
        tops.append(nodes.where("n = 1").select("tree", F.col("node").alias("top")))
        if most <= 1:
            break
        levels.append(cut(_met(nodes.where("n > 1"), fan)))
        up = levels[-1].where(F.col("idx") % fan == 0)
        nodes = up.select("tree", F.floor(F.col("idx") / fan).cast("long").alias("idx"), F.ceil(F.col("n") / fan).cast("long").alias("n"),
                          parent(F.col("left"), F.col("node"), F.col("right")).alias("node"))
        most = -(-most // fan)
    above = None
    for level in reversed(levels):
        step = F.array(F.struct("left", "right")).cast(_STEPS)
        if above is None:
            told = level.withColumn("steps", step)
        else:
            run = F.floor(F.col("idx") / fan).cast("long")
            told = level.withColumn("run", run).join(above, ["tree", "run"], "left").withColumn(
                "steps", F.concat(step, F.coalesce("above", F.array().cast(_STEPS))))
        told = told.drop("left", "right", "run", "above")
        above = told.select("tree", F.col("idx").alias("run"), F.col("steps").alias("above"))
    return (told.select(*own, "steps") if levels else None), reduce(DataFrame.unionByName, tops)


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "source", fields: tuple[str, ...] = FIELDS, fan: int = FAN,
             also: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of `docs`: key, leaf, subroot, root, and `steps`, the proof from the leaf through subroot to root.

    Digests are binary. A step holds the digests left and right of the node in its run, one after the other. `also` names
    further columns, expressions over `docs`, that are kept with each row. Within a group leaves ascend by the key (null
    first), equal keys by digest, so repeated rows are neighbours and the tree does not depend on the order of `docs`.
    Groups ascend bytewise, the null group first. Null fields are part of the leaf as `-`; an empty text is `0:`. A group
    of one row has its leaf as subroot and no steps of its own. An empty table gives no rows. Other columns are not read.
    Texts of any length are hashed as they are scanned; only digests are shuffled.
    """
    source = _digest(F.coalesce(F.concat(F.lit(":"), F.col(group).cast("string")), F.lit("-")))
    extra = [e.alias(f"also_{k}") for k, e in enumerate((also or {}).values())]
    rows = cut(docs.select(F.col(key).alias("key"), F.col(group).cast("string").alias("group"), source.alias("g"),
                           leaf([F.col(f) for f in fields]).alias("node"), *extra))
    ranked = row_number(rows, ["group", "key", "node"], "at")
    groups = ranked.groupBy("g").agg(F.min("group").alias("group"), F.min("at").alias("first"), F.count("*").alias("n"))
    groups = cut(row_number(groups, ["group"], "tree").drop("group"))
    n_groups = groups.count()
    few = n_groups <= FEW_GROUPS
    carried = ["key", *(f"also_{k}" for k in range(len(extra)))]
    placed = _looked_up(ranked, groups.withColumn("weight", F.col("n")), "g", few)
    placed = cut(placed.select("tree", (F.col("at") - F.col("first")).alias("idx"), "n", "node", *carried))

    steps, tops = _trees(placed, fan)
    alone = placed.where("n = 1").withColumn("steps", F.array().cast(_STEPS))
    told = alone if steps is None else steps.unionByName(alone)
    over = tops.select(F.lit(0).cast("long").alias("tree"), (F.col("tree") - 1).alias("idx"), F.lit(n_groups).cast("long").alias("n"),
                       F.col("top").alias("node"))
    up, top = _trees(cut(over), fan)
    over = over.withColumn("steps", F.array().cast(_STEPS)) if up is None else up
    root = top.select("top").scalar()
    over = over.select((F.col("idx") + 1).alias("tree"), F.col("node").alias("subroot"), F.col("steps").alias("over"))
    over = over.join(groups.select("tree", F.col("n").alias("weight")), "tree")
    told = _looked_up(told, over, "tree", few)
    return told.select(F.col("key").alias(key), F.col("node").alias("leaf"), "subroot", root.alias("root"),
                       F.concat("steps", "over").alias("steps"),
                       *[F.col(f"also_{k}").alias(name) for k, name in enumerate(also or {})])


def _looked_up(rows: DataFrame, groups: DataFrame, on: str, few: bool) -> DataFrame:
    """A row of `groups` for each of `rows`: from a broadcast if there are few, else hot groups apart from all others."""
    return rows.join(F.broadcast(groups.drop("weight")), on) if few else hot_lookup(cut(rows), groups, on, "weight")


def verified(docs: DataFrame, folds: int = 5) -> DataFrame:
    """The manifest of `documents` with proofs checked against texts of which every `folds`-th is tampered with.

    A tampered text (the CRC-32 of the id leaves no remainder; a null id is never one) has A-Z lower-cased. doc_id, leaf,
    subroot, root and proof_sha256 are those of the untampered table; folded_root comes from the row's own leaf, tampered
    where it is, and the siblings of the manifest; verified tells whether it is the root.
    """
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampers = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0
    other = F.when(tampers, leaf([lower if f == "text" else F.col(f) for f in FIELDS]))
    held = manifest(docs, also={"tampered": other})
    again = folded(F.coalesce("tampered", "leaf"), F.col("steps"))
    return held.select("doc_id", *[_shown(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
                       proof_digest(F.col("steps")).alias("proof_sha256"), _shown(again).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
