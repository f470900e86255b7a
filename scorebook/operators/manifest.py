"""Which documents have been processed, and in which revision."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorebook.schema import columns


def document_manifest(docs: DataFrame, ingested_at: Column) -> DataFrame:
    """The manifest rows of a set of documents."""
    return docs.select(
        "match_id",
        "meta.revision",
        "meta.created",
        "meta.data_version",
        ingested_at.alias("ingested_at"),
    )


def due_documents(documents: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows of ``documents`` that are new or have a greater revision than the manifest's.

    Hand in a narrow projection (match id and revision): both sides go by match.
    """
    known = manifest.select(
        "match_id", F.col("revision").alias("known_revision"), F.lit(True).alias("known")
    )
    unseen = F.col("known").isNull()
    return (
        documents.join(known, "match_id", "left")
        .where(unseen | (F.col("revision") > F.col("known_revision")))
        .select(*documents.columns)
    )


def upsert_manifest(manifest: DataFrame, processed: DataFrame) -> DataFrame:
    """The manifest after processing: known matches get a new revision and time only.

    Of several documents for one match the greatest revision counts.
    """
    latest = processed.groupBy("match_id").agg(
        F.max_by(F.struct(*columns("manifest")), F.coalesce("revision", F.lit(-1))).alias("new")
    )
    old = manifest.select("match_id", F.struct(*columns("manifest")).alias("old"))
    kept, found = F.col("old").isNotNull(), F.col("new").isNotNull()

    def pick(prefer: Column, one: str, other: str, name: str) -> Column:
        value = F.when(prefer, F.col(f"{one}.{name}")).otherwise(F.col(f"{other}.{name}"))
        return value.alias(name)

    return old.join(latest, "match_id", "full").select(
        "match_id",
        pick(found, "new", "old", "revision"),
        pick(kept, "old", "new", "created"),
        pick(kept, "old", "new", "data_version"),
        pick(found, "new", "old", "ingested_at"),
    )


def archive_manifest(manifest: DataFrame, archived_at: Column) -> DataFrame:
    """History rows for the whole manifest."""
    return manifest.select(*columns("manifest"), archived_at.alias("archived_at"))
