"""Documents as they arrive: a file stream that stops when nothing is left.

The stream's checkpoint is the arrival log. A call lists the folder, opens what
the log does not have, and runs a build for every batch; what was handed to a
build that is lost comes again, and documents that are known already are left
out there. Nothing is joined to a table of all files ever seen.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from scorebook.plans.incremental import FILES_AT_ONCE, BuildResult, build
from scorebook.sources.documents import stream_match_documents
from scorebook.sources.workspace import require_shared


def build_arrivals(
    spark: SparkSession,
    folder: str,
    root: str,
    ingested_at: datetime | None = None,
    files_at_once: int = FILES_AT_ONCE,
    archive_to: str | None = None,
) -> list[BuildResult]:
    """Bring the tables under ``root`` up to date with files new to ``folder``; one result a batch.

    A file counts once, by its path: a revised document arrives under a new
    path, such as another subfolder, with the match id as its stem. Finished
    files go to ``archive_to`` if given, which keeps the listing short.
    """
    results: list[BuildResult] = []

    def run(documents: DataFrame, _: int) -> None:
        result = build(documents.sparkSession, documents, root, ingested_at)
        if result:
            results.append(result)

    documents = stream_match_documents(spark, folder, files_at_once, archive_to)
    query = (
        documents.writeStream.foreachBatch(run)
        .option("checkpointLocation", f"{require_shared(spark, root)}/arrivals")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return results
