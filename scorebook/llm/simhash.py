"""SimHash near-dedup with a binary trie self-join.

Fingerprints that differ in at most k bits agree in one of k + 1 blocks of
bits. For each block there is a trie of the fingerprints rotated so that this
block leads; below a node that spells a block's value, the trie is joined with
itself. Pairs of nodes descend together, one bit at a time, with the number of
bits in which their paths differ, and a pair over the budget is pruned. A node
is a range of the sorted fingerprints, so a level is a few array operations on
all node pairs of a task. Exact copies are one fingerprint from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from scorebook.llm.components import connected_components
from scorebook.llm.shared import fresh, map_arrow, row_key, stored

SEED = 42
#: Fingerprints of a block's value beyond which they are dealt to several tasks.
GROUP_ROWS = 20_000
#: Rows joined at once in a task, node pairs held at once, pairs compared outright.
BATCH_ROWS, FRONTIER, SMALL = 100_000, 1_000_000, 8


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64 bits: each set if it is set in over half of the shingles' hashes."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        return xxh64_intdigest(b" ".join(words), SEED)
    runs = zip(*(words[i:] for i in range(shingle)), strict=False)
    count = len(words) - shingle + 1
    hashes = np.fromiter(map(xxh64_intdigest, map(b" ".join, runs), repeat(SEED)), "<u8", count)
    ones = np.zeros(64, np.int64)
    for start in range(0, count, 1 << 16):
        octets = hashes[start : start + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(ones * 2 > count, bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, shingle: int = 3, id_column: str = "doc_id") -> DataFrame:
    """(id, row, fingerprint as a signed long), one row per row; null and empty texts give 0."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [fingerprint(text, shingle) for text in batch.column(2).to_pylist()]
        signed = np.array(found, np.uint64).view(np.int64)
        columns = [batch.column(0), batch.column(1), pa.array(signed)]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "row", "print"])

    rows = documents.select(
        F.col(id_column).cast("long").alias("id"), row_key(id_column, "text").alias("row"), "text"
    )
    return map_arrow(rows, run, "id long, row long, print long")


def links(prints: DataFrame, bits: int = 3) -> DataFrame:
    """Links (a, b) that connect exactly what all pairs within ``bits`` bits connect.

    ``prints`` (print) is distinct. A task gives a spanning forest of its pairs
    instead of all of them. A block's value with very many fingerprints is
    dealt to one task for each pair of its chunks.
    """
    width = 64 // (bits + 1)
    turned = [_rotated(F.col("print"), width * i) for i in range(bits + 1)]
    rows = prints.select(
        F.posexplode(F.array(*turned)).alias("block", "turned")
    ).withColumn("value", F.shiftrightunsigned("turned", 64 - width))
    sizes = rows.groupBy("block", "value").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.where(F.col("n") > GROUP_ROWS).select(
        "block", "value", F.ceil(F.col("n") / GROUP_ROWS).alias("chunks")
    )
    rows = rows.join(large, ["block", "value"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    chunk = F.pmod(F.xxhash64("turned"), F.col("chunks"))
    rows = (
        rows.withColumn("side", chunk)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .select(
            F.concat_ws(
                ":", "block", "value", F.least("side", "other"), F.greatest("side", "other")
            ).alias("task"),
            "block",
            F.col("side").cast("long").alias("side"),
            "turned",
        )
    )
    dealt = rows.repartition("task").sortWithinPartitions("task", "side", _unsigned(F.col("turned")))
    return dealt.mapInArrow(lambda batches: _joined(batches, width, bits), "a long, b long").distinct()


def _rotated(print_, by: int):
    if not by:
        return print_
    return F.shiftleft(print_, by).bitwiseOR(F.shiftrightunsigned(print_, 64 - by))


def _unsigned(column):
    """Orders signed longs as unsigned ones."""
    return column.bitwiseXOR(F.lit(-(1 << 63)))


def _joined(batches: Iterator[pa.RecordBatch], width: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Gathers whole tasks up to BATCH_ROWS rows, or one larger task, and joins them."""
    held: list[pa.Table] = []
    rows = 0

    def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
        a, b = _trie_join(table, width, bits)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        rows += batch.num_rows
        if rows >= BATCH_ROWS:
            table = pa.concat_tables(held).combine_chunks()
            tasks = table.column("task").to_numpy(zero_copy_only=False)
            whole = int(np.searchsorted(tasks, tasks[-1]))  # the last task may go on
            if whole:
                yield from flush(table.slice(0, whole))
            held, rows = [table.slice(whole)], table.num_rows - whole
    if rows:
        yield from flush(pa.concat_tables(held).combine_chunks())


def _trie_join(table: pa.Table, width: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    turned = table.column("turned").to_numpy().view(np.uint64)
    block = table.column("block").to_numpy()
    tasks = table.column("task").to_numpy(zero_copy_only=False)
    side = table.column("side").to_numpy()
    new_task = np.r_[True, tasks[1:] != tasks[:-1]]
    edge = np.flatnonzero(new_task | np.r_[True, side[1:] != side[:-1]])
    low, high = edge, np.r_[edge[1:], len(turned)]
    # A task of one side joins it with itself; a task of two sides joins the two.
    second = ~new_task[edge]
    alone = ~second & ~np.r_[second[1:], False]
    at = np.flatnonzero(second)
    a_low, a_high = np.r_[low[alone], low[at - 1]], np.r_[high[alone], high[at - 1]]
    b_low, b_high = np.r_[low[alone], low[at]], np.r_[high[alone], high[at]]
    roots = _components(turned, (a_low, a_high, b_low, b_high), width, bits)
    moved = np.flatnonzero(roots != np.arange(len(roots)))
    back = (block.astype(np.uint64) * np.uint64(width)) % np.uint64(64)
    prints = (turned >> back) | np.where(back > 0, turned << ((np.uint64(64) - back) % np.uint64(64)), 0)
    prints = prints.astype(np.uint64).view(np.int64)
    return prints[moved], prints[roots[moved]]


def _components(turned: np.ndarray, pairs: tuple, depth: int, bits: int) -> np.ndarray:
    """Least row linked to each row, by descending the node pairs ``pairs`` from ``depth``."""
    parent = np.arange(len(turned))
    ones: dict[int, np.ndarray] = {}
    stack = [(depth, *pairs, np.zeros(len(pairs[0]), np.int8))]
    while stack:
        depth, a_low, a_high, b_low, b_high, differ = stack.pop()
        if len(a_low) > FRONTIER:
            half = len(a_low) // 2
            parts = (a_low, a_high, b_low, b_high, differ)
            stack.append((depth, *(x[half:] for x in parts)))
            stack.append((depth, *(x[:half] for x in parts)))
            continue
        # What hangs together already needs no more comparing.
        run = np.cumsum(np.r_[0, parent[1:] != parent[:-1]])
        same = (
            (run[a_low] == run[a_high - 1])
            & (run[b_low] == run[b_high - 1])
            & (parent[a_low] == parent[b_low])
        )
        self_pair = a_low == b_low
        small = (a_high - a_low) * (b_high - b_low) <= SMALL
        done = small | (depth == 64)
        now = np.flatnonzero(done & ~same)
        _compare(turned, parent, a_low[now], a_high[now], b_low[now], b_high[now], bits)
        go = np.flatnonzero(~done & ~same)
        if not len(go):
            continue
        a_low, a_high, b_low, b_high = a_low[go], a_high[go], b_low[go], b_high[go]
        differ, self_pair = differ[go], self_pair[go]
        if depth not in ones:
            bit = (turned >> np.uint64(63 - depth)) & np.uint64(1)
            ones[depth] = np.r_[0, np.cumsum(bit.astype(np.int64))]
        counts = ones[depth]
        a_mid = a_high - (counts[a_high] - counts[a_low])
        b_mid = b_high - (counts[b_high] - counts[b_low])
        children = (
            (a_low, a_mid, b_low, b_mid, differ),
            (a_mid, a_high, b_mid, b_high, differ),
            (a_low, a_mid, b_mid, b_high, differ + 1),
            # the mirror image of the pair above, if a node is joined with itself
            tuple(x[~self_pair] for x in (a_mid, a_high, b_low, b_mid, differ + 1)),
        )
        joined = [np.concatenate(x) for x in zip(*children, strict=True)]
        alive = (joined[0] < joined[1]) & (joined[2] < joined[3]) & (joined[4] <= bits)
        stack.append((depth + 1, *(x[alive] for x in joined)))
    return parent


def _compare(turned, parent, a_low, a_high, b_low, b_high, bits) -> None:
    """Compares all rows of small node pairs, and those of equal paths, in slices."""
    sizes = (a_high - a_low) * (b_high - b_low)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = ends[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(ends, base + 4 * FRONTIER, "right")))
        of = np.repeat(np.arange(start, stop), sizes[start:stop])
        place = np.arange(len(of)) - np.repeat(ends[start:stop] - sizes[start:stop] - base, sizes[start:stop])
        width = (b_high - b_low)[of]
        i, j = a_low[of] + place // width, b_low[of] + place % width
        near = np.flatnonzero((i != j) & (np.bitwise_count(turned[i] ^ turned[j]) <= bits))
        _union(parent, i[near], j[near])
        start = stop


def _union(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the sets of i and j; afterwards every row points at the least of its set."""
    while len(i):
        a, b = parent[i], parent[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        if not len(i):
            break
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up


def simhash_groups(
    documents: DataFrame, shingle: int = 3, bits: int = 3, id_column: str = "doc_id"
) -> DataFrame:
    """(id, fingerprint in hexadecimal, component_id, group_size, row, first_row), one row per row.

    ``component_id`` is the smallest id that is linked, directly or over others,
    and ``first_row`` the key of a row with that id. Null and empty texts have
    fingerprint zero and form groups like any other; a null id is the smallest
    only if a group has no other. Repeated rows are copies of each other. Other
    columns are ignored.
    """
    rows = stored(fingerprints(documents, shingle, id_column), "fingerprints")
    first = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    classes = rows.groupBy("print").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n"))
    classes = stored(classes, "fingerprint-classes")
    roots = connected_components(links(classes.select("print"), bits))
    member = classes.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", "first", "n", F.coalesce("root", "print").alias("root")
    )
    member = stored(member, "fingerprint-roots")
    groups = member.groupBy("root").agg(F.min("first").alias("least"), F.sum("n").alias("group_size"))
    named = member.join(groups, "root").select(F.col("print").alias("of"), "least", "group_size")
    return rows.join(named, F.col("print") == F.col("of")).select(
        F.col("id").alias(id_column),
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        F.col("least.id").alias("component_id"),
        "group_size",
        "row",
        F.col("least.row").alias("first_row"),
    )


def one_of_each_group(
    documents: DataFrame, shingle: int = 3, bits: int = 3, id_column: str = "doc_id"
) -> DataFrame:
    """The row of smallest id of each group, with all columns; one of equal rows.

    Groups decide by row key, so texts move once, to meet the keys that stay.
    """
    key, nth = fresh(documents, "row", "nth")
    groups = simhash_groups(documents, shingle, bits, id_column)
    stay = groups.select(F.col("first_row").alias(key)).distinct()
    kept = documents.withColumn(key, row_key(id_column, "text")).join(stay, key, "left_semi")
    once = Window.partitionBy(key).orderBy(key)
    kept = kept.withColumn(nth, F.row_number().over(once)).where(F.col(nth) == 1)
    return kept.select(*documents.columns)
