"""Reading XML corpora: one message per file, ``<root>/<domain>/<set>/<file>.xml``."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from girolens import model
from girolens.functions import ids
from girolens.functions.text import file_category
from girolens.operators.once import once

#: the end of the root element, then nothing that counts
_END = r"(?s)(?:</(?:[\w.-]+:)?Document\s*>|<(?:[\w.-]+:)?Document\b[^<>]*/>)(?:\s|<!--(?:(?!-->).)*+-->|<\?(?:(?!\?>).)*+\?>)*+\z"
_FILE_DDL = "path STRING, length BIGINT, content BINARY"
_XML_OPTIONS = {
    "ignoreNamespace": "true",
    "ignoreSurroundingSpaces": "false",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": model.CORRUPT,
}


def read_corpus(
    spark: SparkSession, root: str, message_set: str | None = None, max_bytes: int | None = None
) -> DataFrame:
    """Messages under ``root`` with the keys taken from their path.

    Only files exactly three levels deep count, and only the folders of
    ``message_set`` are listed if one is named; ``root`` may be a glob.  Files of
    any size are read.  With ``max_bytes`` larger files stay in the result,
    flagged ``oversize`` and without content, and their bytes are not read.
    """
    depth = _depth(spark, root)

    def files(columns: list[str]) -> DataFrame:
        reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.xml")
        try:
            found = reader.load(f"{root.rstrip('/')}/*/{message_set or '*'}")
            return found.where(F.size(F.split("path", "/")) == depth).select(*columns)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], _FILE_DDL).select(*columns)

    keys = _keys()
    size = F.col("length").alias("bytes")
    whole = files(["path", "length", "content"])
    if max_bytes is None:
        return with_identity(whole.select(*keys, F.lit(False).alias("oversize"), size, "content"))
    small = whole.where(F.col("length") <= max_bytes).select(*keys, F.lit(False).alias("oversize"), size, "content")
    large = files(["path", "length"]).where(F.col("length") > max_bytes).select(
        *keys, F.lit(True).alias("oversize"), size, F.lit(None).cast("binary").alias("content")
    )
    return with_identity(small.unionByName(large))


def follow_corpus(spark: SparkSession, root: str, files_per_batch: int | None = None) -> DataFrame:
    """The messages of ``read_corpus`` as a stream: its checkpoint remembers the files, so each one is read once."""
    reader = spark.readStream.format("binaryFile").schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
    reader = reader.option("pathGlobFilter", "*.xml")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    found = reader.load(f"{root.rstrip('/')}/*/*").where(F.size(F.split("path", "/")) == _depth(spark, root))
    return with_identity(found.select(*_keys(), F.lit(False).alias("oversize"), F.col("length").alias("bytes"), "content"))


def _depth(spark: SparkSession, root: str) -> int:
    """Parts of the paths of messages under ``root``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    whole_path = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    return len(whole_path.rstrip("/").split("/")) + 3


def _keys() -> list[Column]:
    parts = F.split("path", "/")
    return [F.element_at(parts, -3).alias("domain"), F.element_at(parts, -2).alias("message_set"),
            F.element_at(parts, -1).alias("file_name")]


def with_identity(messages: DataFrame) -> DataFrame:
    """Content-derived id, category and decoded text of ``(domain, message_set, content)``."""
    return messages.select(
        "*",
        ids.content_id(F.col("domain"), F.col("message_set"), F.col("content")).alias("message_id"),
        file_category(F.col("file_name")).alias("category"),
        F.make_valid_utf8(F.col("content").cast("string")).alias("xml"),
    )


def parse_document(xml: Column, message_set: str, reads: tuple[str, ...] | None = None) -> Column:
    """Document tree of one message set, with the corrupt-record column; of the elements in ``reads`` if they are named."""
    return F.from_xml(xml, model.document_ddl(message_set, reads), _XML_OPTIONS)


#: characters at the end of a message that are looked at before the whole of it
_TAIL = 64


def ended(xml: Column) -> Column:
    """Whether nothing but blanks, comments and instructions follows the root element.

    The pattern looks ahead only, so what fits in the last characters fits in the whole; the whole text is searched
    where the end alone does not say yes.
    """
    return xml.endswith("</Document>") | F.substring(xml, -_TAIL, _TAIL).rlike(_END) | xml.rlike(_END)


def parse(messages: DataFrame, message_set: str, xml: str = "xml", reads: tuple[str, ...] | None = None) -> DataFrame:
    """Messages of one set with ``body`` (element below Document) and ``parsed``.

    ``parsed`` is false for malformed documents, so rejects can be listed.  The
    parser stops at the end of the root element, so what follows it is looked at
    here: only blanks, comments and instructions may.

    ``reads`` names the elements of the body that are used (see ``shred.READS``).  The time of the parser is that of the
    values it builds, with the square of the fields of a block; elements outside of the layout are read, and refused if
    they are malformed, but not built.
    """
    document = once(messages, "_doc", parse_document(F.col(xml), message_set, reads))
    return document.select(
        *messages.columns,
        F.col(f"_doc.{model.LAYOUTS[message_set][0]}").alias("body"),
        (F.col(xml).isNotNull() & F.col(f"_doc.{model.CORRUPT}").isNull() & ended(F.col(xml))).alias("parsed"),
    )


def well_formed(parsed: DataFrame) -> DataFrame:
    return parsed.where("parsed")


def rejects(parsed: DataFrame) -> DataFrame:
    return parsed.where("NOT parsed")
