"""Removal of repeated byte strings by external induced sorting of suffixes.

A byte goes if a string of ``length`` bytes that covers it starts anywhere
else. Induced sorting orders a sample of the suffixes first and derives the
rest from it, so here suffixes are sorted level by level:

1. The *sample* suffixes start at content-defined anchors: the least hash of
   ``core`` bytes within a string of ``length`` bytes. Equal strings have the
   same anchor, so each string belongs to one anchor, and the strings of an
   anchor are a run of neighbours. Suffix tuples (name of the core at the
   anchor, name of the whole context of the run) are sorted; neighbours in that
   order say how much they have in common: nothing, the core, or everything.
2. Where the whole context is common, all strings of the run repeat. Where not
   even the core is, none does. What lies between is induced: runs of ``STEP``
   strings around the same place of the same anchor become the suffixes of the
   next level, and of those that are still open, single strings.

Every level is one external sort: the tuples are dealt by range, so that a
frequent string is spread over tasks, and each task's sort spills sorted runs
to disk and merges them through a priority queue. Names are 64-bit hashes; the
order only has to bring equal ones together. Texts are read in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorebook.llm.shared import map_arrow, row_key, stored
from scorebook.llm.word_hashes import VALUES, mixed, prefix_sums, range_hashes

#: Strings of one open run that go to the next level together.
STEP = 16
#: Strings handled at once; anchors are compared by hash first, by place in these bits last.
PIECE = 1 << 19
PLACE_BITS = np.uint64((1 << 22) - 1)
#: A tuple's place: first string, number of strings less one, bytes from there to the anchor.
SPAN_BITS = 12


@dataclass(frozen=True)
class Lengths:
    length: int = 400
    core: int = 100

    def __post_init__(self):
        if not 0 < self.core <= self.length < 1 << SPAN_BITS:
            raise ValueError(f"0 < core <= length < {1 << SPAN_BITS} is needed")


def _packed(first: np.ndarray, more: np.ndarray, ahead: np.ndarray) -> np.ndarray:
    return (first << 2 * SPAN_BITS) | (more << SPAN_BITS) | ahead


def _unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = (1 << SPAN_BITS) - 1
    return place >> 2 * SPAN_BITS, (place >> SPAN_BITS) & low, place & low


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, from the least so far within blocks of that width."""
    blocks = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, x.dtype)
    blocks[: len(x)] = x
    blocks = blocks.reshape(-1, width)
    onward = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: len(x) - width + 1], onward[width - 1 : len(x)])


def _named(sums, first, more, ahead, lengths: Lengths) -> np.ndarray:
    """Name of the context of a run and of the run's shape in it."""
    context = range_hashes(sums, first, first + more + lengths.length)
    return mixed(context + ((more << SPAN_BITS) | ahead).astype(np.uint64) * VALUES[0])


def _anchored(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lengths: Lengths):
    """The runs of the strings of several texts laid end to end: (first string, strings less
    one, bytes to the anchor, name of the core, name of the context)."""
    length, core = lengths.length, lengths.core
    sums = prefix_sums(VALUES[data])
    cores = range_hashes(sums, np.arange(len(data) - core + 1), np.arange(core, len(data) + 1))
    placed = (cores & ~PLACE_BITS) | np.arange(len(cores), dtype=np.uint64)
    anchor = (_sliding_least(placed, length - core + 1) & PLACE_BITS).astype(np.int64)
    long = ends - starts >= length
    inside = np.zeros(len(data) + 1, np.int32)
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - length + 1, -1)
    inside = np.cumsum(inside)[: len(anchor)] > 0
    opens = np.r_[True, (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])]
    opens[starts[long]] = True
    first = np.flatnonzero(opens)
    more = np.r_[first[1:], len(anchor)] - 1 - first
    first, more = first[inside[first]], more[inside[first]]
    ahead = anchor[first] - first
    return first, more, ahead, cores[anchor[first]], _named(sums, first, more, ahead, lengths)


_TUPLE = ["core", "whole", "row", "place"]
_TUPLES = "core long, whole long, row long, place long"


def _tuples(core, whole, row, place) -> pa.RecordBatch:
    columns = [pa.array(x.astype(np.uint64).view(np.int64)) for x in (core, whole)]
    columns += [pa.array(row), pa.array(place)]
    return pa.RecordBatch.from_arrays(columns, names=_TUPLE)


def sample_suffixes(rows: DataFrame, lengths: Lengths) -> DataFrame:
    """The tuples of all anchors of ``rows`` (row, text). Texts are laid end to end; longer
    ones are cut into pieces that overlap by less than a string."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys = batch.column(0).to_numpy()
        held: list[tuple[int, int, bytes]] = []  # number, offset, piece
        size = 0
        for number, text in enumerate(batch.column(1)):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            for offset in range(0, max(0, len(raw) - lengths.length + 1), PIECE):
                piece = raw[offset : offset + PIECE + lengths.length - 1]
                held.append((number, offset, piece))
                size += len(piece)
                if size >= PIECE:
                    yield flush(keys, held)
                    held, size = [], 0
        if held:
            yield flush(keys, held)

    def flush(keys: np.ndarray, held: list) -> pa.RecordBatch:
        number, offset, pieces = zip(*held, strict=True)
        ends = np.cumsum([len(p) for p in pieces])
        starts = np.r_[0, ends[:-1]]
        data = np.frombuffer(b"".join(pieces), np.uint8)
        first, more, ahead, core, whole = _anchored(data, starts, ends, lengths)
        of = np.searchsorted(starts, first, "right") - 1
        place = first - starts[of] + np.array(offset)[of]
        return _tuples(core, whole, keys[np.array(number)[of]], _packed(place, more, ahead))

    return map_arrow(rows, run, _TUPLES)


def sorted_neighbours(tuples: DataFrame) -> DataFrame:
    """(row, place, same, one) of the tuples that share their core with another.

    ``same``: another tuple shares the whole context. ``one`` marks a tuple of
    each such class (more, where a class crosses tasks or batches) if its core
    also has open tuples, which must meet it on the next level. What two tasks
    share at their border is settled by their first and last tuples, the only
    ones the driver sees.
    """
    spark = tuples.sparkSession
    ordered = tuples.repartitionByRange(*_TUPLE).sortWithinPartitions(*_TUPLE)
    schema = f"{_TUPLES}, shared boolean, same boolean, one boolean, edge int, task int"
    marked = stored(ordered.mapInArrow(_marked, schema), "suffixes")
    edges = marked.where(F.col("edge") > 0).select("task", "edge", "core", "whole")
    cores, wholes = [], []
    last = None
    for row in sorted(edges.collect(), key=lambda r: (r["task"], r["edge"] == 2)):
        if last and last["task"] != row["task"]:
            if last["core"] == row["core"]:
                cores.append(row["core"])
                if last["whole"] == row["whole"]:
                    wholes.append(row["whole"])
        last = row
    at_edge = F.col("edge") > 0
    across = spark.createDataFrame([(c,) for c in {*cores}], "core long")
    whole = spark.createDataFrame([(w,) for w in {*wholes}], "whole long")
    across = F.broadcast(across.withColumn("c", F.lit(True)))  # one row per task at most
    whole = F.broadcast(whole.withColumn("w", F.lit(True)))
    same = F.col("same") | (at_edge & F.coalesce("w", F.lit(False)))
    shared = F.col("shared") | (at_edge & F.coalesce("c", F.lit(False)))
    return (
        marked.join(across, "core", "left")
        .join(whole, "whole", "left")
        .where(shared)
        .select("row", "place", same.alias("same"), (F.col("one") | at_edge).alias("one"))
    )


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares each tuple with its neighbours; a batch's last one waits for the next batch."""
    task = TaskContext.get().partitionId()
    held: pa.Table | None = None
    before: tuple[int, int] | None = None  # core and whole of the tuple before the held one
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held else table
        if table.num_rows > 1:
            yield from _compared(table, before, task, last=False)
            before = tuple(table.column(c)[-2].as_py() for c in ("core", "whole"))
        held = table.slice(table.num_rows - 1)
    if held:
        yield from _compared(held, before, task, last=True)


def _compared(table: pa.Table, before, task: int, last: bool) -> Iterator[pa.RecordBatch]:
    core, whole = (table.column(c).to_numpy() for c in ("core", "whole"))
    n = len(core)
    core_up, same_up = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    core_up[1:n] = core[1:] == core[:-1]
    same_up[1:n] = core_up[1:n] & (whole[1:] == whole[:-1])
    if before is not None:
        core_up[0] = core[0] == before[0]
        same_up[0] = core_up[0] and whole[0] == before[1]
    shared, same = core_up[:-1] | core_up[1:], same_up[:-1] | same_up[1:]
    # Whether a core has open tuples; one that may go on beyond this batch counts as having some.
    group = np.cumsum(~core_up[:-1])
    opened = np.bincount(group, ~same, minlength=group[-1] + 1) > 0
    opened[[group[0], group[-1]]] = True
    one = same & ~same_up[:-1] & opened[group]
    edge = np.zeros(n, np.int32)
    if before is None:
        edge[0] = 1
    if last:
        edge[-1] = 3 if n == 1 and before is None else 2  # 3: the only one
    stop = n if last else n - 1
    keep = np.flatnonzero((shared | (edge > 0))[:stop])
    if not len(keep):
        return
    columns = [table.column(c).combine_chunks().take(pa.array(keep)) for c in _TUPLE]
    columns += [pa.array(x[keep]) for x in (shared, same, one, edge)]
    columns.append(pa.array(np.full(len(keep), task, np.int32)))
    names = [*_TUPLE, "shared", "same", "one", "edge", "task"]
    yield pa.RecordBatch.from_arrays(columns, names=names)


def _open(found: DataFrame) -> DataFrame:
    """What goes to the next level: the open tuples, and one of each class they may meet."""
    return found.where(~F.col("same") | F.col("one")).select("row", "place")


def _contexts(rows: DataFrame, places: DataFrame, lengths: Lengths) -> DataFrame:
    """(row, place, context): the bytes of each open run, cut from its text."""
    listed = places.groupBy("row").agg(F.collect_list("place").alias("places"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out: tuple[list, list, list] = ([], [], [])
        for key, text, places in zip(*batch.columns, strict=True):
            raw = text.as_buffer().to_pybytes()
            for place in places.as_py():
                first, more, _ = _unpacked(place)
                out[0].append(key.as_py())
                out[1].append(place)
                out[2].append(raw[first : first + more + lengths.length])
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0]), pa.array(out[1]), pa.array(out[2], pa.binary())],
            names=["row", "place", "context"],
        )

    joined = rows.join(listed, "row").select("row", "text", "places")
    return map_arrow(joined, run, "row long, place long, context binary")


def _induced(contexts: DataFrame, lengths: Lengths, step: int) -> DataFrame:
    """Tuples of runs of up to ``step`` strings, from (row, place, context[, parts]).

    Runs are cut at distances to the anchor that are multiples of ``step``, so
    equal strings lie at the same place of their runs. ``parts`` (places) are
    those to cut; without it the whole context is.
    """

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        per = max(1, (PIECE << 1) // (2 * lengths.length))
        for start in range(0, batch.num_rows, per):
            yield cut(batch.slice(start, per))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, place = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        pieces = [c.as_buffer().to_pybytes() for c in batch.column(2)]
        ends = np.cumsum([len(p) for p in pieces])
        starts = np.r_[0, ends[:-1]]
        sums = prefix_sums(VALUES[np.frombuffer(b"".join(pieces), np.uint8)])
        of = np.arange(len(row))
        part = place
        if batch.num_columns > 3:
            lists = batch.column(3)
            of = np.repeat(of, np.diff(lists.offsets.to_numpy()))
            part = lists.flatten().to_numpy()
        origin, _, _ = _unpacked(place[of])
        first, more, ahead = _unpacked(part)
        low, high = (ahead - more) // step, ahead // step  # distances to the anchor, in steps
        count = high - low + 1
        which = np.repeat(np.arange(len(of)), count)
        nth = high[which] - (np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count))
        far = np.minimum(ahead[which], nth * step + step - 1)
        near = np.maximum((ahead - more)[which], nth * step)
        begin = first[which] + ahead[which] - far  # in the text
        more = far - near
        at = begin - origin[which] + starts[of][which]  # in the pieces
        # Common to all strings that a run at this place can have, whatever its ends.
        lead = nth * step + step - 1 - far
        middle = at + (far - nth * step)
        core = range_hashes(sums, middle, at - lead + lengths.length)
        core = mixed(core + nth.astype(np.uint64) * VALUES[1])
        whole = _named(sums, at, more, far, lengths)
        return _tuples(core, whole, row[of][which], _packed(begin, more, far))

    return map_arrow(contexts, run, _TUPLES)


def _spans(found: DataFrame, lengths: Lengths) -> DataFrame:
    low = F.lit((1 << SPAN_BITS) - 1)
    first = F.shiftright("place", 2 * SPAN_BITS)
    more = F.shiftright("place", SPAN_BITS).bitwiseAND(low)
    return found.where("same").select(
        "row", F.struct(first.alias("from"), (first + more + lengths.length).alias("to")).alias("span")
    )


def repeated_spans(rows: DataFrame, lengths: Lengths = Lengths()) -> DataFrame:
    """(row, span<from, to>) that cover, with overlaps, every repeated string of ``rows`` (row, text)."""
    sample = stored(sorted_neighbours(sample_suffixes(rows, lengths)), "repeats-sample")
    contexts = stored(_contexts(rows, _open(sample), lengths), "contexts")
    runs = stored(sorted_neighbours(_induced(contexts, lengths, STEP)), "repeats-runs")
    parts = _open(runs).groupBy("row").agg(F.collect_set("place").alias("all"))
    first = F.shiftright("place", 2 * SPAN_BITS)
    size = F.shiftright("place", SPAN_BITS).bitwiseAND(F.lit((1 << SPAN_BITS) - 1))

    def within(p):
        begin = F.shiftright(p, 2 * SPAN_BITS)
        return (begin >= first) & (begin <= first + size)

    cut = (
        contexts.join(parts, "row")
        .withColumn("parts", F.filter("all", within))
        .where(F.size("parts") > 0)
        .select("row", "place", "context", "parts")
    )
    strings = stored(sorted_neighbours(_induced(cut, lengths, 1)), "repeats-strings")
    spans = [_spans(found, lengths) for found in (sample, runs, strings)]
    return spans[0].unionByName(spans[1]).unionByName(spans[2])


def remove_repeats(
    documents: DataFrame, length: int = 400, core: int = 100, id_column: str = "doc_id"
) -> DataFrame:
    """(id, n_bytes, n_removed, spans, kept): what is left of each text, one row per row.

    ``spans`` are the maximal removed runs (from, to) in bytes, ``kept`` the
    remaining bytes; they need not be valid UTF-8. Null texts count as empty;
    texts shorter than ``length`` stay. Repeated rows are copies of each other
    and lose everything that is long enough. Other columns are ignored.
    """
    lengths = Lengths(length, core)
    rows = documents.select(
        F.col(id_column).alias("id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
        row_key(id_column, "text").alias("row"),
    )
    spans = repeated_spans(rows.select("row", "text").where(F.length("text") >= length), lengths)
    listed = spans.groupBy("row").agg(F.collect_list("span").alias("spans"))
    kind = documents.schema[id_column].dataType.simpleString()
    span = "struct<`from`: long, `to`: long>"

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes, removed, merged, kept = [], [], [], []
        for text, found in zip(batch.column(1), batch.column(2), strict=True):
            raw = text.as_buffer().to_pybytes()
            whole, left, at = [], [], 0
            if found.is_valid:
                start = found.values.field("from").to_numpy()
                stop = found.values.field("to").to_numpy()
                order = np.argsort(start, kind="stable")
                start, reach = start[order], np.maximum.accumulate(stop[order])
                opens = np.flatnonzero(np.r_[True, start[1:] > reach[:-1]])
                closes = np.r_[opens[1:], len(start)] - 1
                whole = list(zip(start[opens].tolist(), reach[closes].tolist(), strict=True))
            for begin, end in whole:
                left.append(raw[at:begin])
                at = end
            left.append(raw[at:])
            sizes.append(len(raw))
            removed.append(sum(end - begin for begin, end in whole))
            merged.append([{"from": begin, "to": end} for begin, end in whole])
            kept.append(b"".join(left))
        kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(merged, kind),
                pa.array(kept, pa.binary()),
            ],
            names=["id", "n_bytes", "n_removed", "spans", "kept"],
        )

    joined = rows.join(listed, "row", "left").select("id", "text", "spans")
    schema = f"id {kind}, n_bytes long, n_removed long, spans array<{span}>, kept binary"
    return map_arrow(joined, run, schema).withColumnRenamed("id", id_column)
