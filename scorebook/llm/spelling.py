"""Spelling variants: words one edit apart, grouped under their common form.

Letters are hashed to a few symbols, which turns the vocabulary into fewer and
shorter-alphabet reduced words. Each reduced word gets its full one-edit
neighbourhood (a symbol deleted, replaced or inserted anywhere, and itself), as
64-bit hashes that prefix sums give in time linear in the word. Hashes meet the
reduced vocabulary in a join; the original words behind a hit are then compared
in full. An edit of a word is an edit, or nothing, in its reduced word, so no
near pair is lost; what reduction or hashing brings together by chance falls in
the comparison.

The number of symbols follows the vocabulary, so that a reduced word of the
least length stands for a few words at every size.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorebook.llm.line_dedup import LOWER, UPPER
from scorebook.llm.shared import map_arrow, stored

#: Letters of a word, A-Z already lower-cased: a-z and U+00C0 to U+00FF.
LETTERS = "".join(map(chr, [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]))
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
#: An odd factor, so that a hash can be shifted back by its inverse, and what letter symbols count as.
BASE = 0x9E3779B97F4A7C15
SYMBOL_SEED = 0xC2B2AE3D27D4EB4F
#: Neighbour hashes worked out at once in a task.
AT_ONCE = 1 << 20


def vocabulary(documents: DataFrame, least_length: int = 7, least_count: int = 2, damage: int = 31) -> DataFrame:
    """(word, n): the distinct runs of letters over all documents, with their occurrences.

    A-Z is lower-cased. An occurrence loses one code point where ``damage``
    divides its hash (of document id and run), which stands for typing errors;
    0 turns that off. A null id counts as empty, a null text has no runs.
    """
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    runs = documents.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"),
    ).where(F.length("run") >= least_length)
    if damage:
        h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
        at = (h % F.length("run")).cast("int")
        rest = F.col("run").substr(at + 2, F.length("run"))
        damaged = F.concat(F.col("run").substr(F.lit(1), at), rest)
        runs = runs.select(F.when(h % damage == 0, damaged).otherwise(F.col("run")).alias("word"))
        runs = runs.where(F.length("word") >= least_length)
    else:
        runs = runs.select(F.col("run").alias("word"))
    return runs.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def symbols_for(words: int, least_length: int) -> int:
    """As few symbols as give reduced words of ``least_length`` a place for every eight words."""
    few = 4
    while few < len(LETTERS) and 8 * few**least_length < words:
        few += 1
    return few


def alphabet(symbols: int) -> str:
    """The symbol of each of ``LETTERS``: in order of their hashes, dealt round."""
    order = sorted(LETTERS, key=lambda letter: (crc32(letter.encode()), letter))
    symbol = {letter: LETTERS[i % symbols] for i, letter in enumerate(order)}
    return "".join(symbol[letter] for letter in LETTERS)


def reduced(word: Column, symbols: int) -> Column:
    return F.translate(word, LETTERS, alphabet(symbols))


def _values(codes: np.ndarray) -> np.ndarray:
    """A 64-bit value of each symbol's code point, mixed so that equal sums are chance."""
    v = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(SYMBOL_SEED)
    v ^= v >> np.uint64(29)
    return v * np.uint64(BASE) | np.uint64(1)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _hashes(codes: np.ndarray) -> np.ndarray:
    """Hash of each row of symbols: a polynomial in ``BASE`` modulo 2^64."""
    return (_values(codes) * _powers(codes.shape[1] + 1)[:-1]).sum(1, dtype=np.uint64)


def neighbourhood(codes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """For rows of equal length: the hashes of all strings at most one edit away, repeats included.

    Columns: the row itself, its deletions, its replacements, its insertions.
    """
    rows, length = codes.shape
    power = _powers(length + 2)
    back = np.uint64(pow(BASE, -1, 1 << 64))
    own, new = _values(codes), _values(symbols)
    before = np.zeros((rows, length + 1), np.uint64)
    np.cumsum(own * power[:length], axis=1, out=before[:, 1:])
    total = before[:, -1:]
    deleted = before[:, :-1] + (total - before[:, 1:]) * back
    replaced = total[:, :, None] + (new - own[:, :, None]) * power[:length, None]
    inserted = before + (total - before) * np.uint64(BASE)
    inserted = inserted[:, :, None] + new * power[: length + 1, None]
    return np.hstack([total, deleted, replaced.reshape(rows, -1), inserted.reshape(rows, -1)])


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and code points of the words of each length."""
    words = batch.column(batch.schema.get_field_index("reduced")).to_pylist()
    length = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(length):
        at = np.flatnonzero(length == n)
        joined = "".join(words[i] for i in at)
        yield at, np.frombuffer(joined.encode("utf-32-le"), np.uint32).reshape(len(at), n)


def _keyed(rows: DataFrame) -> DataFrame:
    """(reduced, id, key): the hash of each reduced word."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        key = np.zeros(batch.num_rows, np.uint64)
        for at, codes in _by_length(batch):
            key[at] = _hashes(codes)
        columns = [*batch.columns, pa.array(key.view(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, names=["reduced", "id", "key"])

    return map_arrow(rows, run, "reduced string, id long, key long")


def _neighbours(rows: DataFrame, symbols: int) -> DataFrame:
    """(key, left_id): the neighbourhood of each reduced word, each hash once."""
    codes_of = np.array(sorted(map(ord, set(alphabet(symbols)))), np.uint32)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column(batch.schema.get_field_index("id")).to_numpy()
        for at, codes in _by_length(batch):
            step = max(1, AT_ONCE // ((2 * codes.shape[1] + 2) * symbols))
            for start in range(0, len(at), step):
                keys = np.sort(neighbourhood(codes[start : start + step], codes_of), axis=1)
                new = np.ones(keys.shape, bool)
                new[:, 1:] = keys[:, 1:] != keys[:, :-1]
                left = np.repeat(ids[at[start : start + step]], new.sum(1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[new].view(np.int64)), pa.array(left)], names=["key", "left_id"]
                )

    return map_arrow(rows, run, "key long, left_id long")


def near_words(words: DataFrame, least_length: int = 7) -> DataFrame:
    """(word, near, n, near_n): every ordered pair of ``words`` (word, n) one edit apart.

    ``words`` holds each word once and is stored; it is read several times.
    """
    symbols = symbols_for(words.count(), least_length)
    words = words.withColumn("reduced", reduced(F.col("word"), symbols))
    cells = words.select("reduced").distinct()
    # A word has some hundred neighbours, so few words are enough for a task.
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = cells.repartition(tasks, "reduced").withColumn("id", F.monotonically_increasing_id())
    cells = stored(_keyed(cells), "spelling-cells")
    words = stored(
        words.join(cells.select("reduced", "id"), "reduced").select("id", "word", "n"), "spelling-words"
    )
    # Every pair of reduced words is found from both sides; one is enough.
    pairs = (
        _neighbours(cells, symbols)
        .join(cells.select("key", F.col("id").alias("right_id")), "key")
        .where("left_id <= right_id")
        .select("left_id", "right_id")
    )
    left = words.select(F.col("id").alias("left_id"), "word", "n")
    right = words.select(F.col("id").alias("right_id"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    apart = F.abs(F.length("word") - F.length("near")) <= 1
    found = (
        pairs.join(left, "left_id")
        .join(right, "right_id")
        .where((F.col("left_id") < F.col("right_id")) | (F.col("word") < F.col("near")))
        .where(apart)
        .where(F.levenshtein("word", "near", 1) == 1)
        .select("word", "near", "n", "near_n")
    )
    found = stored(found, "spelling-pairs")
    return found.unionByName(
        found.select(
            F.col("near").alias("word"), F.col("word").alias("near"),
            F.col("near_n").alias("n"), F.col("n").alias("near_n"),
        )
    )


def _roots(steps: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last, twice as far in each round.

    A form is ten times as frequent as its word, so chains are short and end.
    """
    roots = stored(steps.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if roots.join(onward, "root", "left_semi").isEmpty():
            return roots
        joined = roots.join(onward, "root", "left")
        roots = stored(
            joined.select("word", F.coalesce("further", "root").alias("root")), "spelling-roots"
        )


def spelling_groups(
    documents: DataFrame,
    least_length: int = 7,
    least_count: int = 2,
    times: int = 10,
    damage: int = 0,
) -> DataFrame:
    """Every word of ``documents`` (doc_id, text) with its form and the root of its group.

    Returns word, form, root, n, n_near, form_n. The form is the most frequent
    word one edit away (ties: the first in code-point order), if it is at least
    ``times`` as frequent, else null; the root is where forms lead in the end.
    Repeated rows count as often as they occur. Null or empty texts and tables
    give no words; other columns are ignored.
    """
    words = stored(vocabulary(documents, least_length, least_count, damage), "spelling-vocabulary")
    first = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word")))
    best = (
        near_words(words, least_length)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n_near"), first.alias("first"))
        .select("word", "n_near", F.col("first.word").alias("near"), (-F.col("first.less")).alias("near_n"))
    )
    enough = F.col("near_n") >= times * F.col("n")
    grouped = words.join(best, "word", "left").select(
        "word",
        F.when(enough, F.col("near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("near_n")).alias("form_n"),
    )
    grouped = stored(grouped, "spelling-forms")
    roots = _roots(grouped.where("form IS NOT NULL"))
    return grouped.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
