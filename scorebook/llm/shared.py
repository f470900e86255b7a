"""Helpers of several operators: shared folders, cut lineage, row identity, Arrow mapping."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import cache, cached_property

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.sources.workspace import require_shared, shared_folder

#: The white space of the contracts, `[\x20\x09-\x0D]`.
WHITE_SPACE = " \t\n\x0b\x0c\r"
#: The same as a Java character class, and its complement.
SPACE_CLASS = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="scorebook-llm-")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that driver and executors share (``shared_folder``).

    Where the session names none, a local one gets a folder of this machine; a
    cluster gets no folder that lies on one machine's disk.
    """
    shared = require_shared(spark, shared_folder(spark) or _own_folder())
    return f"{shared}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage starts at those files."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(*columns: str) -> Column:
    """64 bits naming a row by content. Equal rows share a key and get equal results."""
    return F.xxhash64(*columns)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        found.append(name)
    return found


def map_arrow(
    df: DataFrame, function: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``function`` applied to each Arrow batch; memory is bounded by the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)

    return df.mapInArrow(run, schema)


def blocks(texts: list[str | None], characters: int, rows: int) -> Iterator[slice]:
    """Runs of neighbouring texts with at most so many characters, or a single text, and rows."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        long = len(text or "")
        if i > start and (size + long > characters or i - start >= rows):
            yield slice(start, i)
            start, size = i, 0
        size += long
    if start < len(texts):
        yield slice(start, len(texts))


class Shipped:
    """A broadcast value that brings its classes along: workers need no copy of this package.

    Plain broadcasts name a class by its module, which a worker would have to import.
    """

    def __init__(self, spark: SparkSession, value: object):
        self.held = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def __getstate__(self) -> dict:
        return {"held": self.held}

    @cached_property
    def value(self):
        return cloudpickle.loads(self.held.value)


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null: word starts are counted without building them."""
    starts = F.regexp_count(text, F.lit(WORD))
    return F.coalesce(starts, F.lit(0)).cast("long")
