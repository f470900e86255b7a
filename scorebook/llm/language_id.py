"""Language identification of words, spans and documents.

Each letter's script narrows the languages a word can be of. Its character
trigrams score those languages, and Viterbi with a penalty for each switch
labels the words, so that a text of several languages falls into spans. A
document's language is the one that holds most of its letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorebook.llm.quality_classifier import fold
from scorebook.llm.shared import Shipped, map_arrow

#: First and last code point of scripts, in Unicode order.
SCRIPTS = (
    ("latin", 0x41, 0x24F),
    ("greek", 0x370, 0x3FF),
    ("cyrillic", 0x400, 0x52F),
    ("armenian", 0x531, 0x58F),
    ("hebrew", 0x590, 0x5FF),
    ("arabic", 0x600, 0x77F),
    ("devanagari", 0x900, 0x97F),
    ("bengali", 0x980, 0x9FF),
    ("tamil", 0xB80, 0xBFF),
    ("thai", 0xE00, 0xE7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x1F00, 0x1FFF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
    ("han", 0x20000, 0x3134F),
)
BUCKETS = 1 << 15
#: Code points handled at once; longer runs of documents are split between documents.
SLICE = 1 << 20


#: What a process has worked out. A cached function could not be shipped to workers by value.
_MADE: dict[str, np.ndarray] = {}


def script_names() -> list[str]:
    return ["other", *dict.fromkeys(name for name, _, _ in SCRIPTS)]


def script_table() -> np.ndarray:
    """By code point: 0 for no letter, else 1 + the number of its script."""
    if "table" in _MADE:
        return _MADE["table"]
    letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    table = letters.astype(np.uint8)
    names = script_names()
    for name, first, last in SCRIPTS:
        table[first : last + 1][letters[first : last + 1]] = 1 + names.index(name)
    _MADE["table"] = table
    return table


@dataclass
class Words:
    """The words (runs of letters) of several texts laid end to end with gaps between."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray  # the number of the text
    offset: np.ndarray  # where that text starts
    script: np.ndarray
    bucket: np.ndarray  # of the trigram around each code point
    codes: np.ndarray


def split(texts: list[str]) -> Words:
    joined = " " + " ".join(texts) + " "
    lowered = joined.lower()
    if len(lowered) != len(joined):  # a few capitals become two letters
        lowered = "".join(c if len(c.lower()) != 1 else c.lower() for c in joined)
    codes = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), np.uint32)
    script = script_table()[codes]
    letter = script > 0
    change = np.flatnonzero(letter[1:] != letter[:-1]) + 1
    start, end = change[::2], change[1::2]
    lengths = np.array([len(t) for t in texts], np.int64)
    begins = 1 + np.r_[0, np.cumsum(lengths + 1)[:-1]]
    text = np.searchsorted(begins, start, "right") - 1
    plain = np.where(letter, codes, 32).astype(np.uint32)
    bucket = np.zeros(len(plain), np.uint32)
    bucket[1:-1] = (
        plain[:-2] * np.uint32(0x9E3779B1)
        + plain[1:-1] * np.uint32(0x85EBCA77)
        + plain[2:] * np.uint32(0xC2B2AE3D)
    )
    bucket ^= bucket >> np.uint32(15)
    bucket *= np.uint32(0x2C1B3C6D)
    bucket >>= np.uint32(32 - 15)
    return Words(start, end, text, begins[text], script[start], bucket, codes)


@dataclass
class LanguageModel:
    languages: list[str]
    scores: np.ndarray  # bucket x language: log probability, less the languages' mean
    scripts: np.ndarray  # script x language: whether the language uses the script
    penalty: float = 6.0

    def word_scores(self, words: Words) -> np.ndarray:
        sums = np.zeros((len(words.codes) + 1, len(self.languages)), np.float64)
        np.cumsum(self.scores[words.bucket], axis=0, out=sums[1:])
        found = sums[words.end] - sums[words.start]
        allowed = self.scripts[words.script]
        # A script that no language uses narrows nothing.
        allowed = allowed | ~allowed.any(1, keepdims=True)
        return np.where(allowed, found, found - 1e3)

    def label(self, words: Words, texts: int) -> np.ndarray:
        """The language number of each word: all texts go through Viterbi side by side."""
        scores = self.word_scores(words)
        n = np.bincount(words.text, minlength=texts)
        first = np.r_[0, np.cumsum(n)[:-1]]
        order = np.argsort(-n, kind="stable")
        active = np.searchsorted(-n[order], -np.arange(n.max(initial=0)), "left")
        best_before = np.zeros(len(scores), np.int16)
        switched = np.zeros(scores.shape, bool)
        value = np.zeros((texts, len(self.languages)))
        for step, count in enumerate(active):
            at = first[order[:count]] + step
            now = value[:count]
            if step:
                best = now.argmax(1)
                jump = now[np.arange(count), best][:, None] - self.penalty
                switched[at] = jump > now
                best_before[at] = best
                np.maximum(now, jump, out=now)
            now += scores[at]
        labels = np.zeros(len(scores), np.int16)
        state = value.argmax(1)  # of every text at its last word
        for step in range(len(active) - 1, -1, -1):
            count = active[step]
            at = first[order[:count]] + step
            here = state[:count]
            labels[at] = here
            turn = switched[at, here]
            state[:count] = np.where(turn, best_before[at], here)
        return labels


def train(
    documents: DataFrame,
    most_documents: int = 2_000,
    folds: int = 5,
    held_out: int = 0,
    id_column: str = "doc_id",
) -> LanguageModel:
    """Learns from about ``most_documents`` documents of each language outside the held-out
    fold (all, if there are fewer): those whose row hash falls below their language's share.

    Trigrams are counted where the texts lie; what is collected is at most a
    count for each language and bucket or script.
    """
    known = documents.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(id_column, folds) != held_out)
    ).select(F.col("lang").cast("string").alias("lang"), F.col(id_column).alias("id"), "text")
    # One row per language; as part of the filter they cost the texts no shuffle.
    sizes = known.groupBy("lang").count().collect()
    shares = [F.lit(x) for r in sizes for x in (r["lang"], most_documents / r["count"])]
    share = F.try_element_at(F.create_map(*shares), F.col("lang")) if shares else F.lit(0.0)
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    rows = known.where(draw < share).select("lang", "text")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        names = batch.column(0).to_pylist()
        by_language: dict[str, list[str]] = {}
        for name, text in zip(names, batch.column(1).to_pylist(), strict=True):
            by_language.setdefault(name, []).append(text)
        for name, texts in by_language.items():
            for some, _ in _slices(texts):
                words = split(some)
                inside = script_table()[words.codes] > 0
                grams = np.bincount(words.bucket[inside], minlength=BUCKETS)
                scripts = np.bincount(words.script, words.end - words.start, len(script_names()) + 1)
                counts = np.r_[grams, scripts.astype(np.int64)]
                used = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(used)), pa.array(used), pa.array(counts[used])],
                    names=["lang", "bucket", "n"],
                )

    counted = map_arrow(rows, run, "lang string, bucket long, n long")
    found = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique())
    table = np.zeros((BUCKETS + len(script_names()) + 1, len(languages)))
    number = {name: i for i, name in enumerate(languages)}
    table[found["bucket"].to_numpy(int), found["lang"].map(number).to_numpy(int)] = found["n"]
    grams, scripts = table[:BUCKETS] + 0.5, table[BUCKETS:]
    logs = np.log(grams / grams.sum(0, keepdims=True)) if languages else grams
    logs = logs - logs.mean(1, keepdims=True) if languages else logs
    used = scripts >= 0.005 * np.maximum(1, scripts.sum(0, keepdims=True))
    return LanguageModel(languages, logs.astype(np.float32), used)


def _slices(texts: list[str]) -> Iterator[tuple[list[str], int]]:
    """The texts in runs of about SLICE code points, with the number of each run's first."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > SLICE:
            yield texts[start:i], start
            start, held = i, 0
        held += len(text) + 1
    if start < len(texts):
        yield texts[start:], start


def identify(documents: DataFrame, model: LanguageModel, id_column: str = "doc_id") -> DataFrame:
    """(id, lang_pred, score, spans), one row per row; a map without any shuffle.

    ``spans`` are (from, to, lang) in code points, from the first to the last
    word of each run of one language. ``lang_pred`` holds most letters, the
    earlier name on a tie; ``score`` is its share of them. Texts that are null
    or have no letter are ``und`` with score 0 and no spans, as are all texts
    if nothing was learned. Repeated rows get equal results.
    """
    held = Shipped(documents.sparkSession, model)
    span = pa.struct([("from", pa.int32()), ("to", pa.int32()), ("lang", pa.string())])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        model = held.value
        names = np.array(model.languages, object)
        for texts, first in _slices([t or "" for t in batch.column(1).to_pylist()]):
            ids = batch.column(0).slice(first, len(texts))
            words = split(texts)
            if not len(words.start) or not len(names):
                none = [0.0] * len(texts)
                columns = [ids, pa.array(["und"] * len(texts)), pa.array(none)]
                columns.append(pa.array([[]] * len(texts), pa.list_(span)))
                yield pa.RecordBatch.from_arrays(columns, names=["id", "lang_pred", "score", "spans"])
                continue
            labels = model.label(words, len(texts))
            letters = np.zeros((len(texts), len(names)))
            np.add.at(letters, (words.text, labels), words.end - words.start)
            total = letters.sum(1)
            most = letters.argmax(1)
            share = letters[np.arange(len(texts)), most] / np.maximum(1, total)
            pred = np.where(total > 0, names[most], "und")
            opens = np.r_[True, (labels[1:] != labels[:-1]) | (words.text[1:] != words.text[:-1])]
            at = np.flatnonzero(opens)
            to = np.r_[at[1:], len(labels)] - 1
            spans = pa.StructArray.from_arrays(
                [
                    pa.array((words.start[at] - words.offset[at]).astype(np.int32)),
                    pa.array((words.end[to] - words.offset[to]).astype(np.int32)),
                    pa.array(names[labels[at]], pa.string()),
                ],
                fields=list(span),
            )
            ends = np.searchsorted(words.text[at], np.arange(len(texts) + 1))
            spans = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), spans)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(pred, pa.string()), pa.array(share), spans],
                names=["id", "lang_pred", "score", "spans"],
            )

    rows = documents.select(F.col(id_column).cast("long").alias("id"), F.col("text"))
    spans = "array<struct<`from`: int, `to`: int, lang: string>>"
    found = map_arrow(rows, run, f"id long, lang_pred string, score double, spans {spans}")
    return found.withColumnRenamed("id", id_column)
