"""Secret scans over histories with a ledger of content-addressed texts.

1. Every version at every path is addressed by the SHA-256 of its text, so copies and unchanged versions are one blob.
2. A ledger, a Parquet folder, holds what was scanned: one row for each pair of a blob and a version of a rule, with the
   spans found, also where there are none. Only pairs that it does not hold are scanned: new texts by all rules, known
   texts by rules that are new or changed. Copies of a blob drop out within their partition before texts are shuffled,
   the others meet by address in one task, which scans one of them.
3. Findings are joined back to all versions and paths by the address.

A blob with more than one in a thousand of all rows is hot; there are fewer than a thousand such, so the list of their
addresses is broadcast. Their rows are dealt by path over all partitions, and their findings repeated for each.

The ledger grows by one folder of Parquet per scan, which Spark commits as a whole; a scan that failed leaves nothing
that is read. Two scans at once may scan a pair twice; findings are made distinct when they are read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from girolens.llm.common import mapped, width

#: One row in so many makes a blob hot.
HOT_SHARE = 1000
_LEDGER = "blob binary, kind string, version int, spans array<struct<start:bigint,stop:bigint>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


@dataclass(frozen=True)
class Rule:
    """A pattern (ASCII rules for letter case) of which matches count whose `group` has `least` characters at least.

    Matches are leftmost and do not overlap; one that is too short is dropped, and what it covers is not looked at again.
    A change of any part needs another `version`, else texts that the ledger holds are not scanned again.
    """

    kind: str
    pattern: str
    least: int
    group: int = 0
    ignore_case: bool = False
    version: int = 1

    def spans(self, text: str) -> list[tuple[int, int]]:
        found = re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0)).finditer(text)
        return [m.span() for m in found if m.end(self.group) - m.start(self.group) >= self.least]


#: The kinds of secrets, in the order in which spans of one start are listed.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}", 24),
)


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The pairs that were scanned so far, with their spans; no rows before the first scan."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).parquet(f"{folder}/scan=*")


def addressed(versions: DataFrame, text: str = "text") -> DataFrame:
    """`versions` with `blob`, the SHA-256 of the text; a null text is the empty one."""
    return versions.withColumn("blob", F.unhex(F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256)))


def scan(versions: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> int:
    """Scans what the ledger in `folder` does not hold and adds it; the number of pairs of blob and rule scanned.

    `versions` has one row per version of a path; only its text is read. Null and empty texts are one blob without
    findings. Texts are scanned whole, whatever their length. An empty table adds nothing.
    """
    spark = versions.sparkSession
    many = width(versions)
    texts = versions.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    texts = addressed(texts)
    wanted = spark.createDataFrame([(r.kind, r.version) for r in rules], "kind string, version int")
    known = ledger(spark, folder).join(F.broadcast(wanted), ["kind", "version"], "left_semi")
    known = known.groupBy("blob").agg(F.collect_set(F.struct("kind", "version")).alias("seen"))  # as many as rules
    place = f"{folder}/scan={uuid.uuid4().hex}"

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        for batch in batches:
            fresh = []
            for k, blob in enumerate(batch.column(0).to_pylist()):
                if blob not in met:
                    met.add(blob)
                    fresh.append(k)
            yield batch if len(fresh) == batch.num_rows else batch.take(pa.array(fresh, pa.int64()))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                out: list[tuple] = []
                part = batch.slice(low, 256)
                for blob, body, seen in zip(*(part.column(c).to_pylist() for c in range(3)), strict=True):
                    if blob in met:
                        continue
                    met.add(blob)
                    done = {(s["kind"], s["version"]) for s in seen or ()}
                    out += [(blob, r.kind, r.version, [{"start": a, "stop": b} for a, b in r.spans(body)])
                            for r in rules if (r.kind, r.version) not in done]
                kinds = (pa.binary(), pa.string(), pa.int32(), _SPANS)
                yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], k) for c, k in enumerate(kinds)],
                                                 names=["blob", "kind", "version", "spans"])

    fresh = mapped(texts.select("blob", "text"), once, "blob binary, text string").repartition(many, "blob")
    held = fresh.join(known.hint("shuffle_hash"), "blob", "left").where(F.coalesce(F.size("seen"), F.lit(0)) < len(rules))
    mapped(held.select("blob", "text", "seen"), look, _LEDGER).write.parquet(place)
    return spark.read.schema(_LEDGER).parquet(place).count()


def findings(versions: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES, path: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `versions` without their text, with `blob` and `secrets`, from the ledger in `folder`.

    `secrets` is an array of (start, stop, kind) in code points, by start, then by the order of the rules; it is empty where
    nothing was found, also for null and empty texts. `path` only deals the rows of hot texts. Repeated rows and rows of
    equal paths are all kept; other columns named like the new ones are replaced.
    """
    spark = versions.sparkSession
    many = width(versions)
    own = [c for c in versions.columns if c not in (text, "blob", "secrets")]
    rows = addressed(versions.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in own]).alias("row"),
                                     F.xxhash64(F.col(f"`{path}`")).alias("deal"), F.col(f"`{text}`").alias("text")))
    rows = rows.drop("text")
    order = spark.createDataFrame([(r.kind, r.version, k) for k, r in enumerate(rules)], "kind string, version int, rank int")
    told = ledger(spark, folder).where(F.size("spans") > 0).join(F.broadcast(order), ["kind", "version"])
    told = told.dropDuplicates(["blob", "kind", "version"]).groupBy("blob").agg(F.collect_list(F.struct("rank", "kind", "spans")).alias("found"))
    each = F.flatten(F.transform("found", lambda f: F.transform(f["spans"], lambda s: F.struct(
        s["start"].alias("start"), f["rank"].alias("rank"), s["stop"].alias("stop"), f["kind"].alias("kind")))))
    each = F.transform(F.array_sort(each), lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind")))
    told = told.select("blob", each.alias("secrets"))

    copies = rows.groupBy("blob").agg(F.count("*").alias("n"))
    hot = copies.where(F.col("n") * HOT_SHARE > copies.agg(F.sum("n")).scalar()).select("blob", F.lit(True).alias("hot"))
    hot = F.broadcast(hot)  # fewer than HOT_SHARE rows of 32 bytes
    rows = rows.join(hot, "blob", "left").withColumn("salt", F.when(F.col("hot"), F.pmod("deal", F.lit(many))).otherwise(0).cast("int"))
    told = told.join(hot, "blob", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.when(F.col("hot"), many - 1).otherwise(0))))
    joined = rows.drop("hot").join(told.drop("hot"), ["blob", "salt"], "left")
    none = F.array().cast("array<struct<start:bigint,stop:bigint,kind:string>>")
    return joined.select(*[F.col(f"row.`{c}`").alias(c) for c in own], "blob", F.coalesce("secrets", none).alias("secrets"))


def told(found: DataFrame) -> DataFrame:
    """Digest columns of `findings`: doc_id, number of spans of each kind, base_sha256 of all spans, and the spans."""
    spans = F.array_join(F.transform("secrets", lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    def many(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [many(r.kind) for r in RULES]
    return found.select("doc_id", *counts, F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))
