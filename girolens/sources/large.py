"""Very large credit-transfer messages, read by many tasks.

``corpus.read_corpus`` keeps a message in one row, which ends at 2 GB and makes one task parse it.  Here a file is split
by the reader of text files, whose records end with the closing tag of a transaction, so tasks start anywhere in it.
Each transaction becomes a small document of its own with the header of its message and the head of its payment, which
the ordinary parser and shredders take.  The head of the payment is carried on within a split by a window, and from one
split to the next by a table with one row per split.

Files are UTF-8.  Closing tags in comments or CDATA sections cut a transaction in two; it does not parse then, and the
message counts as malformed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from girolens import model
from girolens.functions.text import file_category
from girolens.operators.once import once
from girolens.operators.ranking import broadcast_small, ensure_checkpoint_dir
from girolens.sources.corpus import ended, parse_document

_OPEN = r"(?:\s[^<>]*)?>"


def _pieces(spark: SparkSession, path: str, block: str, prefix: str) -> DataFrame:
    """Records of the files under ``path`` in their order: ``file, split, row, piece``; all but the last hold a transaction."""
    lines = spark.read.option("lineSep", f"</{prefix}{block}>").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"), F.col("value").alias("piece"),
    )


def _heads(pieces: DataFrame, block: str, prefix: str) -> DataFrame:
    """``pieces`` with ``tx``, and the head of the payment that each of them is in."""
    start = rf"<{prefix}PmtInf{_OPEN}"
    tx = F.regexp_extract("piece", rf"(?s)<{prefix}{block}{_OPEN}.*\z", 0)
    # of the payments that open in a piece the last one, up to its transaction
    head = F.regexp_extract("piece", rf"(?s).*{start}(.*?)<{prefix}{block}{_OPEN}", 1)
    opened = F.col("piece").rlike(start)
    cut = pieces.select("file", "split", "row", "piece", F.nullif(tx, F.lit("")).alias("tx"), F.when(opened, head).alias("own"))
    within = Window.partitionBy("file", "split").orderBy("row")
    filled = cut.withColumn("head", F.last("own", ignorenulls=True).over(within))
    last = cut.where("own IS NOT NULL").groupBy("file", "split").agg(F.max_by("own", "row").alias("own"))
    splits = cut.select("file", "split").distinct().join(last, ["file", "split"], "left")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carried = splits.select("file", "split", F.last("own", ignorenulls=True).over(before).alias("carried"))
    return filled.join(broadcast_small(carried), ["file", "split"]).withColumn("head", F.coalesce("head", "carried"))


def read_large(
    spark: SparkSession, path: str, message_set: str = "001", block: str = "CdtTrfTxInf", prefix: str = ""
) -> DataFrame:
    """``body`` and ``parsed`` as ``corpus.parse`` returns them, with one row per transaction of each file under ``path``.

    ``prefix`` is the namespace prefix of the files with its colon.  A file without transactions has one row without a
    payment.  ``parsed`` is false for all rows of a file of which any part is malformed or whose end is missing.
    Shredders of credit transfers give the rows that they give for whole messages; rules over whole messages do not
    apply.  The parsed rows are kept in ``spark.checkpoint.dir``.
    """
    root, child = "Document", model.LAYOUTS[message_set][0]
    pieces = _pieces(spark, path, block, prefix)
    ensure_checkpoint_dir(pieces)
    found = _heads(pieces, block, prefix)
    header = rf"(?s)<{prefix}GrpHdr{_OPEN}.*?</{prefix}GrpHdr\s*>"
    headers = pieces.where(F.col("split") == 0).select("file", F.nullif(F.regexp_extract("piece", header, 0), F.lit("")).alias("header"))
    headers = headers.where("header IS NOT NULL").groupBy("file").agg(F.first("header").alias("header"))
    found = found.join(broadcast_small(headers), "file", "left")

    def tag(name: str, close: bool = False) -> str:
        return f"<{'/' * close}{prefix}{name}>"

    payment = F.concat(F.lit(tag("PmtInf")), F.col("head"), F.col("tx"), F.lit(tag(block, True) + tag("PmtInf", True)))
    text = F.concat(
        F.lit(tag(root) + tag(child)), F.coalesce("header", F.lit("")), F.coalesce(payment, F.lit("")),
        F.lit(tag(child, True) + tag(root, True)))
    alone = F.col("tx").isNull() & (F.col("split") == 0) & F.col("piece").rlike(rf"<(?:{prefix})?{root}\b")
    parsed = once(found.withColumn("alone", alone), "_doc", parse_document(F.when(F.col("tx").isNotNull() | alone, text), message_set))
    sound = F.when(F.col("tx").isNotNull(), F.col("head").isNotNull() & F.col(f"_doc.{model.CORRUPT}").isNull()).otherwise(
        ended(F.col("piece")) & (~F.col("alone") | F.col(f"_doc.{model.CORRUPT}").isNull()))
    parts = F.split("file", "/")
    rows = parsed.select(
        "file", F.element_at(parts, -3).alias("domain"), F.element_at(parts, -2).alias("message_set"),
        F.element_at(parts, -1).alias("file_name"), F.col(f"_doc.{child}").alias("body"), F.coalesce(sound, F.lit(False)).alias("sound"),
        F.col("tx").isNull().alias("tail"), "alone",
    ).checkpoint(eager=True)
    # sound files have one last piece, and all their pieces are sound
    files = rows.groupBy("file").agg((F.min("sound") & (F.sum(F.col("tail").cast("int")) == 1)).alias("parsed"))
    told = rows.where("NOT tail OR alone").join(broadcast_small(files), "file")
    return told.select(
        "domain", "message_set", "file_name", file_category(F.col("file_name")).alias("category"), "body", "parsed",
    )
