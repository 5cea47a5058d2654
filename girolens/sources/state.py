"""Pipeline state tables: Parquet folders that become visible by commits."""

from __future__ import annotations

from collections.abc import Collection, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from girolens import model
from girolens.sources import id_index
from girolens.sources.commits import FAN, Commit, compact, folder, new_name, put, read, snapshot

BATCH = "batch_id"
#: Partition column of the folders: the message set where it is a known one, else OTHER, so their number is bounded.
SET, OTHER = "set_folder", "other"


def path_of(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def _columns(table: str) -> list[str]:
    return [field.split()[0] for field in model.STATE_DDL[table].split(", ")]


def _known(message_set: Column) -> Column:
    return F.when(message_set.isin(model.MESSAGE_SETS), message_set).otherwise(OTHER)


def _stored(spark: SparkSession, root: str, table: str, commits: Iterable[Commit]) -> DataFrame:
    return read(spark, root, table, f"{model.STATE_DDL[table]}, {BATCH} BIGINT, {SET} STRING", commits)


def read_table(
    spark: SparkSession, root: str, table: str, commits: list[Commit] | None = None, sets: Collection[str] | None = None
) -> DataFrame:
    """The committed rows of one state table, with the batch that wrote them.

    ``sets`` names message sets; only the folders that can hold them are read.  Tables that belong together are read
    from one ``snapshot``, as ``load_all`` does; a later one may hold more.
    """
    rows = _stored(spark, root, table, snapshot(spark, root) if commits is None else commits)
    if sets is not None:
        places = sorted({s if s in model.MESSAGE_SETS else OTHER for s in sets})
        rows = rows.where(F.col(SET).isin(places) & F.col("message_set").isin(list(sets)))
    return rows.drop(SET)


def write_table(rows: DataFrame, root: str, table: str, name: str, batch_id: int, gather: bool = False) -> None:
    """Write rows of one table into the folder of a commit, which nobody reads before the commit is put into place.

    ``gather`` brings the rows of a set together first, for small batches that would make a file per task and set.
    """
    placed = rows.select(*_columns(table), F.lit(batch_id).cast("bigint").alias(BATCH), _known(F.col("message_set")).alias(SET))
    if gather:
        placed = placed.hint("rebalance", F.col(SET))  # adaptive execution splits a set that holds most of the rows
    placed.write.mode("overwrite").partitionBy(SET).parquet(folder(root, table, name))


def append(rows: DataFrame, root: str, table: str) -> None:
    """One commit of one table, for batch writers such as the sent log."""
    name = new_name(table)
    write_table(rows, root, table, name, -1)
    tables, notes = (table,), {}
    if table == "sent_messages":  # the index is what deliveries are held against
        ids = rows.select("message_id", F.lit(-1).cast("bigint").alias(BATCH))
        notes = {id_index.SENT: id_index.write(ids, root, name, table=id_index.SENT)}
        tables = (table, id_index.SENT)
    put(rows.sparkSession, root, Commit(name, table, tables, notes=notes))
    compact_tables(rows.sparkSession, root, table)


def compact_tables(spark: SparkSession, root: str, kind: str, fan: int = FAN) -> int:
    """Merge small commits of the state tables and the index of ids; the number of merges.

    The files of a merged commit follow the bytes of its parts: reading packs small files into splits, and each split
    becomes one file for every set that it holds.
    """
    def merge(members: list[Commit], name: str) -> tuple[tuple[str, ...], dict]:
        tables = sorted({t for c in members for t in c.tables})
        notes = {}
        for table in tables:
            if table in (id_index.TABLE, id_index.SENT):
                ids = spark.read.schema(id_index.DDL).parquet(
                    *[f"{folder(root, table, c.name)}/prefix={p}" for c in members if table in c.tables for p in c.notes[table]["prefixes"]]
                ) if any(c.notes.get(table, {}).get("prefixes") for c in members) else spark.createDataFrame([], id_index.DDL)
                notes[table] = id_index.write(ids, root, name, ids.count(), table)
            else:
                _stored(spark, root, table, members).write.mode("overwrite").partitionBy(SET).parquet(folder(root, table, name))
        return tuple(tables), notes

    return compact(spark, root, kind, merge, fan)


def register(tables: dict[str, DataFrame], prefix: str = "") -> None:
    """Temp views, so that the same tables can be queried in SQL."""
    for name, frame in tables.items():
        frame.createOrReplaceTempView(prefix + name)


def load_all(spark: SparkSession, root: str, sets: Collection[str] | None = None) -> dict[str, DataFrame]:
    """All state tables of one snapshot, of some message sets or of all."""
    commits = snapshot(spark, root)
    return {name: read_table(spark, root, name, commits, sets) for name in model.STATE_DDL}


def save_bucketed(table: DataFrame, name: str, buckets: int) -> None:
    """Catalog table bucketed and sorted by message id.

    Sent and processed tables saved with the same number of buckets are joined
    on the id without a shuffle, as often as they are reconciled.
    """
    (
        table.write.mode("overwrite").bucketBy(buckets, "message_id").sortBy("message_id")
        .saveAsTable(name)
    )
