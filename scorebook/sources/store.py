"""Tables under one root folder, replaced partition by partition.

Rows lie in ordinary partition folders, by season and by slice of the match or
player they belong to, under the run that wrote them. A run writes the
partitions it touches anew, as a whole. One small file, the pointer, names for
every partition the run it is read from. Pointers are numbered; a run publishes
all it has written by creating the next one, which fails if another run has
done so in the meantime. Readers take the newest complete pointer.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Iterable
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scorebook.schema import TABLES, columns, ddl
from scorebook.sources.tables import no_rows, sorted_files, writer
from scorebook.sources.workspace import file_system, require_shared

#: What a table's rows are sliced by, for those that do not lie by season too.
SLICED_ONLY = {
    "manifest": "match_id",
    "placement": "match_id",
    "dim_player": "player_id",
    "player_names": "player_id",
}
#: Tables by season and slice of the player; all others go by match.
BY_PLAYER = {"season_players", "season_batting", "season_bowling", "player_season_stats"}
#: Tables that only grow: each run adds a partition of its own.
APPENDED = {"manifest_history", "files", "quarantine"}

#: Season (None for no name) and slice, or the slice alone.
Partition = tuple


class ConcurrentRunError(RuntimeError):
    """Another run has published its state since this one began."""


@dataclass
class State:
    """``folders``: by table and partition folder, the run to read it from."""

    number: int = 0
    follows: int = 0
    slices: int = 4
    folders: dict[str, dict[str, str]] = field(default_factory=dict)

    def copy(self) -> State:
        folders = {table: dict(found) for table, found in self.folders.items()}
        return State(self.number, self.follows, self.slices, folders)


def partition_columns(table: str) -> tuple[str, ...]:
    if table in APPENDED:
        return ("batch",)
    return ("slice",) if table in SLICED_ONLY else ("season", "slice")


def _values(folder: str) -> Partition:
    """``season=2007%2F08/slice=3`` to ("2007/08", 3)."""
    found = dict(part.split("=", 1) for part in folder.split("/"))
    season = found.get("season")
    at = int(found.get("slice", 0))
    if season is None:
        return (at,)
    return (None if season == "__HIVE_DEFAULT_PARTITION__" else unquote(season), at)


class Store:
    """The tables of one root. ``begin`` starts a run, ``commit`` makes it the current state.

    ``slices`` is settled by the first run: into how many parts each season's
    matches, and all players, are dealt. A run rewrites the parts it touches.
    """

    def __init__(self, spark: SparkSession, root: str, slices: int = 4):
        self.spark, self.root = spark, require_shared(spark, root)
        self.current = self._newest() or State(slices=slices)
        self.begin()

    # Pointers.

    def _pointers(self) -> list[int]:
        return sorted(int(name) for name in self._names(f"{self.root}/pointers") if name.isdigit())

    def _load(self, number: int) -> State | None:
        """None for a pointer that is not complete, or gone."""
        system, path = file_system(self.spark, f"{self.root}/pointers/{number:012d}")
        try:
            stream = system.open(path)
        except Py4JJavaError:
            return None
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return State(**json.loads(text)) if text.endswith("\n") else None

    def _newest(self) -> State | None:
        return next((s for n in reversed(self._pointers()) if (s := self._load(n))), None)

    def begin(self) -> None:
        """Starts a run from the state this store has read."""
        self.run = f"{self.current.number + 1}-{uuid.uuid4().hex[:8]}"
        self.pending = self.current.copy()

    def commit(self) -> None:
        """Publishes the run, unless another one has published since it began.

        The pointer's file is created only if it is not there yet. A run that
        died while writing one leaves it incomplete; the next number is taken
        then, and either run finds the other if both turn out complete.
        """
        newest = self._newest()
        if (newest.number if newest else 0) != self.current.number:
            raise ConcurrentRunError(f"{self.root} was changed by another run")
        number = max([self.current.number, *self._pointers()]) + 1
        self.pending.number, self.pending.follows = number, self.current.number
        text = json.dumps(vars(self.pending)) + "\n"
        system, path = file_system(self.spark, f"{self.root}/pointers/{number:012d}")
        try:
            out = system.create(path, False)
        except Py4JJavaError as taken:
            raise ConcurrentRunError(f"{self.root} is being changed by another run") from taken
        out.write(bytearray(text.encode()))
        out.close()
        later = [s for n in self._pointers() if n > number and (s := self._load(n))]
        if any(s.follows < number for s in later):
            raise ConcurrentRunError(f"{self.root} was changed by another run")
        before = self._load(self.current.follows) if self.current.follows else None
        self._sweep(before)
        self.current = self.pending
        self.begin()

    def _sweep(self, before: State | None) -> None:
        """Removes what no reader of the last state needs: folders that only the one before it named,
        and those of lost runs that began from an earlier one."""
        states = (self.current, self.pending)
        if before is not None:
            for table, found in before.folders.items():
                for folder, run in found.items():
                    if all(s.folders.get(table, {}).get(folder) != run for s in states):
                        self.remove(f"{self.root}/{table}/run={run}/{folder}")
            self.remove(f"{self.root}/pointers/{before.number:012d}")
        for table in (*TABLES, "staging"):
            used = {run for s in states for run in s.folders.get(table, {}).values()}
            for name in self._names(f"{self.root}/{table}"):
                run = name.removeprefix("run=")
                number = run.partition("-")[0]
                if number.isdigit() and int(number) < self.pending.number and run not in used:
                    self.remove(f"{self.root}/{table}/{name}")

    def _names(self, folder: str) -> list[str]:
        system, path = file_system(self.spark, folder)
        return [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []

    # Partitions.

    def slice_of(self, column: str) -> Column:
        return F.pmod(F.xxhash64(F.col(column)), F.lit(self.current.slices)).cast("int")

    def _sliced(self, table: str, rows: DataFrame) -> DataFrame:
        by = SLICED_ONLY.get(table, "player_id" if table in BY_PLAYER else "match_id")
        rows = rows.withColumn("slice", self.slice_of(by))
        if "season" in partition_columns(table):
            # An empty name ends up in the same partition as no name.
            rows = rows.withColumn("season", F.nullif("season", F.lit("")))
        return rows

    def partitions(self, table: str, *rows: DataFrame) -> set[Partition]:
        """The partitions that rows belong to: as many as there are folders at most."""
        names = partition_columns(table)
        found = [self._sliced(table, r).select(*names) for r in rows]
        union = found[0]
        for other in found[1:]:
            union = union.union(other)
        return {tuple(row) for row in union.distinct().collect()}

    def staging(self, name: str) -> str:
        return f"{self.root}/staging/{self.run}/{name}"

    def read(
        self,
        table: str,
        seasons: Collection[str | None] | None = None,
        with_season: bool = False,
        pending: bool = False,
        only: Iterable[Partition] | None = None,
    ) -> DataFrame:
        """A table as of the pointer read, or as it will be after the ``pending`` run.

        ``seasons`` and ``only`` (partitions) choose among its folders.
        """
        names = partition_columns(table)
        folders = (self.pending if pending else self.current).folders.get(table, {})
        if seasons is not None:
            folders = {f: r for f, r in folders.items() if _values(f)[0] in seasons}
        if only is not None:
            wanted = set(only)
            folders = {f: r for f, r in folders.items() if _values(f) in wanted}
        chosen = [*columns(table), *(["season"] if with_season and "season" in names else [])]
        chosen = list(dict.fromkeys(chosen))
        if not folders:
            return no_rows(self.spark, {"season": "string", **TABLES[table]}).select(*chosen)
        kinds = {"season": "string", "slice": "int", "batch": "string"}
        extra = [f"{name} {kinds[name]}" for name in names if name not in TABLES[table]]
        base = f"{self.root}/{table}"
        df = self.spark.read.option("basePath", base).schema(ddl(table, *extra, "run string"))
        return df.parquet(*(f"{base}/run={run}/{folder}" for folder, run in folders.items())).select(*chosen)

    # Writing.

    def write(self, table: str, rows: DataFrame, **how) -> int:
        return self.note(table, *self.save(table, rows, **how))

    def save(
        self, table: str, rows: DataFrame, kept: DataFrame | None = None, only: Iterable[Partition] | None = None
    ) -> tuple[int, list[str], set[Partition] | None]:
        """The files of ``write``: ``rows`` and what is ``kept`` become the whole content of the
        partitions ``only`` (None: of the table); returns the number of ``rows``.

        A partition that holds most rows is written by as many tasks as it needs.
        """
        names, seen = partition_columns(table), Observation()
        target = f"{self.root}/{table}/run={self.run}"
        if table in APPENDED:
            laid_out = rows.select(*columns(table), F.lit(self.run).alias("batch"), F.lit(True).alias("fresh"))
        else:
            parts = [(rows, True), *([(kept, False)] if kept is not None else [])]
            wanted = list(dict.fromkeys([*columns(table), *names]))
            found = [
                self._sliced(table, df).select(*wanted, F.lit(fresh).alias("fresh")) for df, fresh in parts
            ]
            union = found[0] if len(found) == 1 else found[0].unionByName(found[1])
            laid_out = union.hint("rebalance", *names)
        counted = laid_out.observe(seen, F.count_if("fresh").alias("rows")).drop("fresh")
        writer(sorted_files(counted, table, names), table).partitionBy(*names).parquet(target)
        written = list(self._folders(target, len(names)))
        return seen.get["rows"], written, None if only is None else set(only)

    def _folders(self, target: str, depth: int) -> Iterable[str]:
        for name in self._names(target):
            if "=" in name:
                if depth == 1:
                    yield name
                else:
                    yield from (f"{name}/{rest}" for rest in self._folders(f"{target}/{name}", depth - 1))

    def note(self, table: str, count: int, written: list[str], only: set[Partition] | None) -> int:
        """Adds what ``save`` has written to the pending state."""
        folders = self.pending.folders.get(table, {})
        if table not in APPENDED:
            folders = {f: r for f, r in folders.items() if only is not None and _values(f) not in only}
        self.pending.folders[table] = {**folders, **dict.fromkeys(written, self.run)}
        return count

    def clear(self, table: str) -> None:
        self.pending.folders[table] = {}

    def remove(self, folder: str) -> None:
        system, path = file_system(self.spark, folder)
        system.delete(path, True)
