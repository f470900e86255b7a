"""Reading match documents."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.schema import DOCUMENT_SCHEMA

#: Holds the text of a document that does not parse, else NULL.
CORRUPT = "malformed_text"
_WITH_CORRUPT = f"{DOCUMENT_SCHEMA}, {CORRUPT} string"


def _file_stem(path: Column) -> Column:
    # File paths arrive percent-encoded, but with a literal "+" left alone.
    stem = F.regexp_extract(path, r"([^/]+)\.json$", 1)
    return F.url_decode(F.replace(stem, F.lit("+"), F.lit("%2B")))


def list_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(path, modified, length) of the document files below ``folder``; none is opened."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", True)
        .load(folder)
    )
    return files.select("path", F.col("modificationTime").alias("modified"), "length")


def read_match_documents(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Whole-file JSON documents; the file's stem is the match id.

    Such a file cannot be split, so it is one unit of work. Where there are
    more files than a driver can list, pack them as JSON lines instead and use
    ``read_document_lines``.
    """
    docs = (
        spark.read.schema(_WITH_CORRUPT)
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", "*.json")
        .json(paths if isinstance(paths, str) else list(paths))
    )
    stem = _file_stem(F.col("_metadata.file_path")).alias("match_id")
    return docs.select(stem, "meta", "info", "innings", CORRUPT)


def stream_match_documents(
    spark: SparkSession, folder: str, files_at_once: int, archive_to: str | None = None
) -> DataFrame:
    """``read_match_documents`` as a stream of the files that arrive in ``folder`` or below it.

    No file is too old to be read. ``archive_to`` is where files go once their batch is done.
    """
    options = {
        "multiLine": True,
        "columnNameOfCorruptRecord": CORRUPT,
        "pathGlobFilter": "*.json",
        "recursiveFileLookup": True,
        "maxFilesPerTrigger": files_at_once,
        "maxFileAge": "36500d",
    }
    if archive_to:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive_to}
    docs = spark.readStream.schema(_WITH_CORRUPT).options(**options).json(folder)
    stem = _file_stem(F.col("_metadata.file_path")).alias("match_id")
    return docs.select(stem, "meta", "info", "innings", CORRUPT)


def read_document_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """JSON lines, one document per line with its id in ``match_id``."""
    return (
        spark.read.schema(f"match_id string, {_WITH_CORRUPT}")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(paths if isinstance(paths, str) else list(paths))
    )


def parse_documents(texts: DataFrame, text_column: str = "document") -> DataFrame:
    """Documents held as JSON text beside their ``match_id``."""
    doc = F.from_json(text_column, _WITH_CORRUPT, {"columnNameOfCorruptRecord": CORRUPT})
    return texts.select("match_id", doc.alias("doc")).select("match_id", "doc.*")
