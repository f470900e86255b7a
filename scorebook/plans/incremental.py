"""The incremental run: new and revised documents to all tables.

A run costs what its batch costs. Documents are staged once; bronze, facts,
registry, matches and scorecards are built for the batch's matches alone, and
the partitions these lie in are written anew with what else they hold (see
``scorebook.sources.store``). Player names and season totals are kept as sums
that the batch's matches are added to and their earlier rows taken from. All of
it becomes visible with one pointer, so a run that is lost is simply repeated,
and of two runs at once the second one fails.

Documents that cannot be used are kept out of the tables and listed, with the
reason, in ``quarantine``; the others go on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import partial
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook import operators as ops
from scorebook.operators import season_state as state
from scorebook.operators.registry import display_names
from scorebook.operators.season import season_rows
from scorebook.schema import DOCUMENT_SCHEMA
from scorebook.sources.documents import CORRUPT, list_documents, read_match_documents
from scorebook.sources.jobs import run_together
from scorebook.sources.store import Partition, Store

MALFORMED, REPEATED, UNRECONCILED = "malformed", "repeated in the batch", "unreconciled"
#: Paths handed to one read; the driver never holds more of them.
FILES_AT_ONCE = 10_000


@dataclass(frozen=True)
class BuildResult:
    """What one run did; ``quarantined`` counts documents by reason."""

    seasons: frozenset[str | None]
    rows: dict[str, int]
    null_batters: int
    quarantined: dict[str, int] = field(default_factory=dict)


def build_folder(
    spark: SparkSession, folder: str, root: str, ingested_at: datetime | None = None
) -> BuildResult | None:
    """Bring the tables under ``root`` up to date with the documents in ``folder``.

    Files are listed without being opened. Those whose path, time and length
    are known from an earlier run are left alone; the others are parsed, once.
    """
    store = Store(spark, root)
    known = store.read("files")
    listed = f"{store.root}/staging/{store.run}-listed"
    due = _stage(
        list_documents(spark, folder).join(known, ["path", "modified", "length"], "left_anti"),
        f"{listed}/files",
    )
    target = f"{listed}/parsed"
    mode = "overwrite"
    for paths in _chunks(due.select("path").toLocalIterator(), FILES_AT_ONCE):
        read_match_documents(spark, paths).write.mode(mode).parquet(target)
        mode = "append"
    schema = f"match_id string, {DOCUMENT_SCHEMA}, {CORRUPT} string"
    try:
        if mode == "overwrite":
            return None
        return build(spark, spark.read.schema(schema).parquet(target), root, ingested_at, due)
    finally:
        store.remove(listed)


def _chunks(rows: Iterator, size: int) -> Iterator[list[str]]:
    while chunk := [row.path for row in islice(rows, size)]:
        yield chunk


def build(
    spark: SparkSession,
    documents: DataFrame,
    root: str,
    ingested_at: datetime | None = None,
    files: DataFrame | None = None,
    slices: int = 4,
) -> BuildResult | None:
    """Bring the tables under ``root`` up to date; None if no document is due.

    ``documents`` are read once. Hand in what has arrived since the last run:
    what is known in the same or a greater revision is left out here, but only
    after it has been read. ``files`` (path, modified, length) are recorded as
    seen. ``slices`` is settled by the first run. Raises ``ConcurrentRunError``
    if another run has changed the tables in the meantime.
    """
    store = Store(spark, root, slices)
    now = F.lit(ingested_at or datetime.now(timezone.utc))
    batch, quarantined = _due(store, documents)
    result = None if batch.isEmpty() else _Run(store, batch, now).all()
    if result:
        quarantined = quarantined | result.quarantined
    if files is not None:
        store.write("files", files)
    if quarantined:
        listed = spark.read.schema("match_id string, reason string").parquet(store.staging("quarantine/*"))
        store.write("quarantine", listed.withColumn("ingested_at", now))
    staged = store.staging("")
    if result or quarantined or files is not None:
        store.commit()
    store.remove(staged)
    if result is None and not quarantined:
        return None
    result = result or BuildResult(frozenset(), {}, 0)
    return BuildResult(result.seasons, result.rows, result.null_batters, quarantined)


def archive(spark: SparkSession, root: str, archived_at: datetime | None = None):
    """Move the manifest to its history, so that every document is due again; one commit."""
    store = Store(spark, root)
    at = F.lit(archived_at or datetime.now(timezone.utc))
    store.write("manifest_history", ops.archive_manifest(store.read("manifest"), at))
    store.clear("manifest")
    store.clear("files")
    store.commit()


def _stage(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _quarantine(store: Store, rows: DataFrame, reason: str) -> dict[str, int]:
    listed = _stage(
        rows.select("match_id", F.lit(reason).alias("reason")),
        store.staging(f"quarantine/{reason.replace(' ', '-')}"),
    )
    found = listed.count()
    return {reason: found} if found else {}


def _due(store: Store, documents: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """The due documents, each match once, and what is wrong with others.

    Documents are staged in one pass. Which of them are due, and the best of
    several for one match, is settled on their ids and revisions alone, against
    the slices of the manifest that they fall into. The number given to each row
    tells documents of one match apart.
    """
    corrupt = F.col(CORRUPT) if CORRUPT in documents.columns else F.lit(None).cast("string")
    staged = _stage(
        documents.select(
            "match_id",
            "meta",
            "info",
            "innings",
            F.nullif(F.col("info.season"), F.lit("")).alias("season"),
            corrupt.isNotNull().alias("malformed"),
            F.monotonically_increasing_id().alias("document"),
        ),
        store.staging("documents"),
    )
    arrived = staged.select("match_id", "document", "malformed", "meta.revision")
    manifest = store.read("manifest", only=store.partitions("manifest", arrived)).select(
        "match_id", F.col("revision").alias("known_revision"), F.lit(True).alias("known")
    )
    newer = F.col("known").isNull() | (F.col("revision") > F.col("known_revision"))
    due = arrived.join(manifest, "match_id", "left").where(F.col("malformed") | newer)
    due = _stage(due.select("match_id", "document", "malformed", "revision"), store.staging("due"))
    quarantined = _quarantine(store, due.where("malformed"), MALFORMED)
    sound = due.where(~F.col("malformed"))
    order = F.struct(F.coalesce("revision", F.lit(-1)), "document")
    best = _stage(
        sound.groupBy("match_id").agg(F.max_by("document", order).alias("document")), store.staging("best")
    )
    quarantined |= _quarantine(store, sound.join(best, "document", "left_anti"), REPEATED)
    if best.count() < staged.count():
        staged = _stage(staged.join(best.select("document"), "document", "left_semi"), store.staging("chosen"))
    return staged.drop("malformed", "document"), quarantined


#: Tables built from the batch's documents alone.
STAR = ("bronze", "fact_delivery", "match_player_registry", "dim_match")
CARDS = ("batting_scorecard", "bowling_scorecard")


class _Run:
    """One run over the due documents, step by step; all writes go to the store's pending state."""

    def __init__(self, store: Store, batch: DataFrame, now: Column):
        self.store, self.batch, self.now = store, batch, now
        self.rows: dict[str, int] = {}

    def all(self) -> BuildResult:
        store = self.store
        self.star()
        audit = ops.content_audit(self.fresh["bronze"], self.fresh["fact_delivery"])
        audit = audit.withColumn("reconciled", F.col("reconciled") & F.col("content_equal"))
        audit = _stage(audit, store.staging("audit"))
        bad = audit.where(~F.col("reconciled"))
        quarantined = _quarantine(store, bad, UNRECONCILED)
        if quarantined:
            bad = bad.select("match_id")
            self.batch = self.batch.join(bad, "match_id", "left_anti")
            self.fresh = {t: df.join(bad, "match_id", "left_anti") for t, df in self.fresh.items()}
            if self.batch.isEmpty():
                return BuildResult(frozenset(), {}, 0, quarantined)
        null_batters = audit.where("reconciled").agg(F.coalesce(F.sum("null_batters"), F.lit(0)))
        self.place()
        run_together(
            lambda: self.write([(t, self.fresh[t], self.ids, self.touched) for t in STAR]),
            self.names,
            self.manifest,
        )
        self.rename()
        self.cards()
        self.seasons()
        return BuildResult(
            frozenset(season for season, _ in self.touched_cards),
            self.rows,
            null_batters.first()[0],
            quarantined,
        )

    def write(self, jobs: list[tuple[str, DataFrame, DataFrame, set[Partition]]]) -> None:
        """Partitions of independent tables side by side: new rows, and the others' that are kept."""

        def kept(table: str, gone: DataFrame, only: set[Partition]) -> DataFrame:
            old = self.store.read(table, only=only, with_season=True)
            return old.join(gone.select("match_id"), "match_id", "left_anti")

        saved = run_together(
            *(
                partial(self.store.save, table, rows, kept=kept(table, gone, only), only=only)
                for table, rows, gone, only in jobs
            )
        )
        for (table, *_), found in zip(jobs, saved, strict=True):
            self.rows[table] = self.store.note(table, *found)

    def star(self) -> None:
        """The batch's own rows, staged: audited first, then written and summed."""
        batch, now = self.batch, self.now
        tables = {
            "bronze": ops.flatten_deliveries(batch, now),
            "fact_delivery": ops.fact_from_documents(batch, now, ("season",)),
            "match_player_registry": ops.match_player_registry(batch, ("season",), distinct=False),
            "dim_match": ops.dim_match_from_documents(batch),
        }
        staged = run_together(*(partial(_stage, df, self.store.staging(f"fresh/{t}")) for t, df in tables.items()))
        self.fresh = dict(zip(tables, staged, strict=True))

    def place(self) -> None:
        """Where the batch's matches lie and have lain, which also holds after an archive."""
        store = self.store
        self.ids = _stage(self.batch.select("match_id", "season"), store.staging("ids"))
        slices = store.partitions("placement", self.ids)
        placement = store.read("placement", only=slices)
        before = placement.join(self.ids.select("match_id"), "match_id", "left_semi")
        self.before = _stage(before, store.staging("before"))
        self.old_parts = store.partitions("bronze", self.before)
        self.touched = self.old_parts | store.partitions("bronze", self.ids)
        kept = placement.join(self.ids.select("match_id"), "match_id", "left_anti")
        store.write("placement", self.ids, kept=kept, only=slices)

    def gone(self, table: str, matches: DataFrame, only: set[Partition]) -> DataFrame:
        """Earlier rows of matches that are written anew."""
        old = self.store.read(table, only=only, with_season=True)
        return old.join(matches.select("match_id"), "match_id", "left_semi")

    def sums(self, table: str, changes: list[DataFrame], only: set[Partition]) -> None:
        self.store.write(table, state.summed(table, self.store.read(table, only=only, with_season=True), *changes), only=only)

    def names(self) -> None:
        """Names of the players of the batch's matches, by the names these bring and no longer bring."""
        store = self.store
        fresh, gone = self.fresh["match_player_registry"], self.gone("match_player_registry", self.before, self.old_parts)
        changes = state.summed("player_names", state.name_changes(fresh, 1), state.name_changes(gone, -1))
        changes = _stage(changes, store.staging("names"))
        touched = store.partitions("player_names", changes)
        self.sums("player_names", [changes], touched)
        players = store.read("player_names", only=touched, pending=True)
        self.rows["dim_player"] = store.write("dim_player", ops.dim_player(players), only=touched)
        new = display_names(store.read("dim_player", only=touched, pending=True))
        old = display_names(store.read("dim_player", only=touched)).withColumnRenamed("display_name", "old")
        renamed = new.join(old, "player_id").where(~F.col("display_name").eqNullSafe(F.col("old")))
        self.renamed_players = _stage(renamed.select("player_id"), store.staging("renamed-players"))

    def rename(self) -> None:
        """The other matches that show a name which is no longer the player's."""
        store = self.store
        self.renamed = store.read("placement").limit(0).select("match_id", "season")
        self.renamed_parts: set[Partition] = set()
        if not self.renamed_players.isEmpty():  # the one case that looks through all squads
            registry = store.read("match_player_registry", with_season=True, pending=True)
            self.renamed = _stage(
                registry.join(self.renamed_players, "player_id", "left_semi")
                .join(self.ids.select("match_id"), "match_id", "left_anti")
                .select("match_id", "season")
                .distinct(),
                store.staging("renamed"),
            )
            self.renamed_parts = store.partitions("bronze", self.renamed)

    def cards(self) -> None:
        """Scorecards of the batch's matches and of renamed players', innings summaries of the batch's."""
        store = self.store
        renamed_parts = self.renamed_parts
        self.touched_cards = self.touched | renamed_parts
        facts = self.fresh["fact_delivery"]
        squads = self.fresh["match_player_registry"]
        if renamed_parts:
            facts, squads = (
                df.unionByName(
                    store.read(t, only=renamed_parts, with_season=True).join(
                        self.renamed.select("match_id"), "match_id", "left_semi"
                    )
                )
                for t, df in (("fact_delivery", facts), ("match_player_registry", squads))
            )
        players = store.read("dim_player", only=store.partitions("dim_player", squads), pending=True)
        season_of = self.ids.unionByName(self.renamed)
        matches = self.fresh["dim_match"]
        cards = {
            "batting_scorecard": ops.batting_scorecard(facts, players),
            "bowling_scorecard": ops.bowling_scorecard(facts, players),
            "team_match_summary": ops.team_match_summary(self.fresh["fact_delivery"], matches),
        }
        staged = run_together(
            *(
                partial(_stage, card.join(season_of, "match_id"), store.staging(f"fresh/{t}"))
                for t, card in cards.items()
            )
        )
        self.fresh |= dict(zip(cards, staged, strict=True))
        self.write(
            [
                *((t, self.fresh[t], season_of, self.touched_cards) for t in CARDS),
                ("team_match_summary", self.fresh["team_match_summary"], self.ids, self.touched),
            ]
        )

    def seasons(self) -> None:
        """Season sums by what the batch adds and takes, then the rows made of them."""
        store = self.store
        rewritten = self.before.unionByName(self.renamed)
        old = {t: self.gone(t, rewritten, self.touched_cards) for t in CARDS}
        squads = self.gone("match_player_registry", self.before, self.old_parts)
        signed = {
            "season_players": (state.player_changes, self.fresh["match_player_registry"], squads),
            "season_batting": (state.batting_changes, *(x["batting_scorecard"] for x in (self.fresh, old))),
            "season_bowling": (state.bowling_changes, *(x["bowling_scorecard"] for x in (self.fresh, old))),
        }

        def change(table: str) -> set[Partition]:
            changes, come, gone = signed[table]
            found = state.summed(table, changes(come, 1), changes(gone, -1))
            found = _stage(found, store.staging(f"changes/{table}"))
            parts = store.partitions(table, found)
            if parts:
                self.sums(table, [found], parts)
            return parts

        touched = set().union(*run_together(*(partial(change, t) for t in signed)))

        def now(table: str) -> DataFrame:
            return store.read(table, only=touched, with_season=True, pending=True)

        stats = season_rows(
            state.matches_played(now("season_players")),
            state.batting_totals(now("season_batting")),
            state.bowling_totals(now("season_bowling")),
        )
        self.rows["player_season_stats"] = store.write("player_season_stats", stats, only=touched) if touched else 0

    def manifest(self) -> None:
        store = self.store
        slices = store.partitions("manifest", self.ids)
        old = store.read("manifest", only=slices)
        mine = old.join(self.ids.select("match_id"), "match_id", "left_semi")
        rows = ops.upsert_manifest(mine, ops.document_manifest(self.batch, self.now))
        kept = old.join(self.ids.select("match_id"), "match_id", "left_anti")
        self.rows["manifest"] = store.write("manifest", rows, kept=kept, only=slices)
