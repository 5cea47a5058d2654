"""Ids that were processed, and ids that were sent, in hash-prefix folders, so that a batch reads only the prefixes that it holds.

Every commit has its ids in ``prefix=`` folders.  A merged commit has more of them, about one for ``PART_IDS`` ids, so a
folder stays small however long the history is.  A batch asks for the folders of its own prefixes by name; nothing else
is listed or read.  With m ids in a batch and commits of k levels, it reads m·k·fan folders of a bounded size at most.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from girolens.sources.commits import Commit, folder

TABLE, SENT = "processed_ids", "sent_ids"
DDL = "message_id STRING, batch_id BIGINT"
#: bits of the widest prefix, and ids in one folder of a merged commit
BITS, PART_IDS = 16, 500_000


def prefix(message_id: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(message_id), 64 - bits).cast("int") if bits else F.lit(0)


def write(ids: DataFrame, root: str, name: str, most: int | None = None, table: str = TABLE) -> dict:
    """Write ids (message_id, batch_id); the notes for the manifest.

    ``most`` is the number of ids and sets the number of prefixes; without it there is one.
    """
    bits = min(BITS, max(0, ((most or 0) // PART_IDS).bit_length()))
    place = folder(root, table, name)
    placed = ids.select("message_id", "batch_id", prefix(F.col("message_id"), bits).alias("prefix"))
    if bits:
        placed = placed.repartition("prefix")
    placed.write.mode("overwrite").partitionBy("prefix").parquet(place)
    spark = ids.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    names = [s.getPath().getName() for s in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]
    held = sorted(int(n.removeprefix("prefix=")) for n in names if n.startswith("prefix="))
    return {"bits": bits, "prefixes": held}


def prefixes_of(batch: DataFrame) -> set[int]:
    """The widest prefixes of the ids of a batch, 2**BITS numbers at most."""
    rows = batch.where(F.col("message_id").isNotNull()).select(prefix(F.col("message_id"), BITS).alias("p")).distinct()
    return {row[0] for row in rows.collect()}


def paths(root: str, commits: Iterable[Commit], wanted: set[int], table: str = TABLE) -> list[str]:
    """The folders that can hold ids with one of the wanted prefixes."""
    found = []
    for commit in commits:
        if table not in commit.tables:
            continue
        bits = commit.notes[table]["bits"]
        own = {p >> (BITS - bits) for p in wanted}
        found += [f"{folder(root, table, commit.name)}/prefix={p}" for p in commit.notes[table]["prefixes"] if p in own]
    return found


def lookup(spark: SparkSession, root: str, commits: Iterable[Commit], wanted: set[int], table: str = TABLE) -> DataFrame:
    """Ids of earlier batches that can be those of a batch with the wanted prefixes."""
    places = paths(root, commits, wanted, table)
    return spark.read.schema(DDL).parquet(*places) if places else spark.createDataFrame([], DDL)
