"""Quality rules by distribution divergence, in DataFrame functions only.

A document's histograms of character classes and of common words are compared
with those of each language by Jensen-Shannon distance. References are counted
over the whole corpus: the class totals of a language's documents, and its most
frequent words, of any length. A document is judged by its nearest language, so
a missing or wrong language name does no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorebook.llm.shared import SPACE_CLASS, WHITE_SPACE, stored

#: The symbols of the contract.
SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "space", "upper", "digit", "symbol", "mark", "letter", "rest")
#: Class of what a pattern takes away, in this order; each pass sees what the last one left.
_PASSES = (
    ("lower", "[a-z]+"),
    ("space", f"{SPACE_CLASS}+"),
    ("upper", "[A-Z]+"),
    ("digit", "[0-9]+"),
    ("symbol", "[#*$%&|<>]+"),
    ("mark", "[.,;:!?'\"()-]+"),
    ("letter", "\\p{L}+"),
)


def _class_counts(df: DataFrame) -> DataFrame:
    """Adds one count of code points for each class of ``text``."""
    df = df.withColumns({"left0": F.col("text"), "size0": F.length("text")})
    for i, (name, pattern) in enumerate(_PASSES):
        df = df.withColumn(f"left{i + 1}", F.regexp_replace(f"left{i}", pattern, ""))
        df = df.withColumn(f"size{i + 1}", F.length(f"left{i + 1}"))
        df = df.withColumn(name, (F.col(f"size{i}") - F.col(f"size{i + 1}")).cast("long"))
        df = df.drop(f"left{i}", f"size{i}")
    last = len(_PASSES)
    return df.withColumn("rest", F.col(f"size{last}").cast("long")).drop(f"left{last}", f"size{last}")


def _repeated(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words covered by 3-word windows that occur again in ``words``."""
    windows = F.greatest(F.size("words") - 2, F.lit(0))
    zipped = F.arrays_zip(*(F.slice("words", i, windows).alias(f"w{i}") for i in (1, 2, 3)))
    hashes = F.transform(zipped, lambda x: F.xxhash64(x["w1"], x["w2"], x["w3"]))
    placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.withColumn("placed", F.sort_array(placed))
    size = F.size("placed")
    before = F.slice(F.concat(F.array(F.lit(None)), F.col("placed")), 1, size)
    after = F.slice("placed", 2, F.greatest(size - 1, F.lit(0)))
    beside = F.arrays_zip(F.col("placed").alias("x"), before.alias("a"), after.alias("b"))
    again = F.filter(
        beside, lambda z: z["x"]["h"].eqNullSafe(z["a"]["h"]) | z["x"]["h"].eqNullSafe(z["b"]["h"])
    )
    df = df.withColumn("again", F.transform(again, lambda z: z["x"]["i"])).drop("placed")
    covered = [F.transform("again", _plus(k)) for k in range(3)]
    count = F.size(F.array_distinct(F.concat(*covered))).cast("long")
    return df.withColumn("n_repeat_words", count).drop("again")


def _plus(k: int):
    return lambda i: i + k


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(WHITE_SPACE))
    none = F.array().cast("array<string>")
    return F.when(trimmed == "", none).otherwise(F.split(trimmed, f"{SPACE_CLASS}+", -1))


def frequent_words(documents: DataFrame, common: int) -> dict[str, dict[str, int]]:
    """The ``common`` most frequent words of each language with their counts, over all its documents.

    Words are counted where they lie before they move; what is collected is
    ``common`` words for each language.
    """
    words = documents.where("lang is not null").select(
        F.col("lang").alias("lang"), F.explode(_words(F.coalesce(F.col("text"), F.lit("")))).alias("word")
    )
    counts = words.groupBy("lang", F.lower("word").alias("word")).count()
    order = Window.partitionBy("lang").orderBy(F.desc("count"), "word")
    best = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= common)
    found: dict[str, dict[str, int]] = {}
    for row in best.collect():
        found.setdefault(row["lang"], {})[row["word"]] = row["count"]
    return found


def digest(documents: DataFrame, id_column: str, known: list[str]) -> DataFrame:
    """One narrow row per document: counts, class counts, and those of its words, in lower case,
    that are ``known``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(F.col(id_column).alias("id"), F.col("lang").alias("lang"), text.alias("text"))
    rows = _class_counts(rows)
    words = _words(F.col("text"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(WHITE_SPACE)) != "")
    rows = _repeated(rows.withColumns({"words": words, "lines": lines}))
    return rows.select(
        "id",
        "lang",
        F.size("words").cast("long").alias("n_words"),
        sum(F.col(c) for c in CLASSES if c != "space").alias("word_chars"),
        F.col("symbol").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        *CLASSES,
        F.filter(F.transform("words", lambda w: F.lower(w)), lambda w: w.isin(known or [""])).alias("folded"),
    )


def references(rows: DataFrame, frequent: dict[str, dict[str, int]]) -> list[dict]:
    """For each language its class shares and the shares of its ``frequent`` words.

    Aggregated over all documents with a language. The result has one entry per
    language and becomes part of the plan.
    """
    totals = rows.where("lang is not null").groupBy("lang").agg(
        *(F.sum(c).alias(c) for c in CLASSES), F.sum("n_words").alias("n_words")
    )
    found = []
    for row in totals.orderBy("lang").collect():
        letters = max(1, sum(row[c] for c in CLASSES))
        words = max(1, row["n_words"])
        found.append(
            {
                "lang": row["lang"],
                "classes": {c: row[c] / letters for c in CLASSES},
                "words": {w: n / words for w, n in sorted(frequent.get(row["lang"], {}).items())},
            }
        )
    return found


def _part(p: Column, q: Column) -> Column:
    """Twice what one bin of shares p and q adds to the Jensen-Shannon divergence, in bits."""

    def half(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    return half(p, q) + half(q, p)


def _class_distance(reference: dict) -> Column:
    total = F.greatest(sum(F.col(c) for c in CLASSES), F.lit(1))
    parts = sum(_part(F.col(c) / total, F.lit(reference["classes"][c])) for c in CLASSES)
    return F.sqrt(F.greatest(parts / 2, F.lit(0.0)))


def _word_distance(reference: dict) -> Column:
    """Over the language's common words and one bin for all others.

    Words that the document lacks add their whole share, so only those it has
    are visited: ``bag`` holds them as (word, count).
    """
    shares = reference["words"]
    if not shares:
        return F.lit(0.0)
    table = F.create_map(*(F.lit(x) for pair in shares.items() for x in pair))
    every = float(sum(shares.values()))
    seen = F.transform(
        "bag",
        lambda x: F.struct((x["n"] / x["of"]).alias("p"), F.try_element_at(table, x["word"]).alias("q")),
    )
    zero = F.struct(*(F.lit(0.0).alias(c) for c in ("parts", "p", "q")))
    summed = F.aggregate(
        F.filter(seen, lambda x: x["q"].isNotNull()),
        zero,
        lambda acc, x: F.struct(
            (acc["parts"] + _part(x["p"], x["q"])).alias("parts"),
            (acc["p"] + x["p"]).alias("p"),
            (acc["q"] + x["q"]).alias("q"),
        ),
        lambda acc: acc["parts"]
        + _part(F.greatest(1 - acc["p"], F.lit(0.0)), F.lit(max(0.0, 1 - every)))
        + F.greatest(every - acc["q"], F.lit(0.0)),
    )
    return F.sqrt(F.greatest(summed / 2, F.lit(0.0)))


def _bags(rows: DataFrame) -> DataFrame:
    """Adds ``bag``: (word, count, words of the document) for the words in ``folded``.

    The words are sorted; a count is the distance between two ends of equal runs.
    """
    listed = F.sort_array("folded")
    rows = rows.withColumn("sorted", listed).drop("folded")
    after = F.slice("sorted", 2, F.greatest(F.size("sorted") - 1, F.lit(0)))
    beside = F.arrays_zip(F.col("sorted").alias("x"), after.alias("y"))
    ends = F.filter(
        F.transform(beside, lambda z, i: F.struct(z["x"].alias("word"), z["y"].alias("y"), (i + 1).alias("end"))),
        lambda z: ~z["word"].eqNullSafe(z["y"]),
    )
    rows = rows.withColumn("ends", ends).drop("sorted")
    starts = F.concat(F.array(F.lit(0)), F.transform("ends", lambda z: z["end"]))
    total = F.greatest(F.col("n_words"), F.lit(1))
    paired = F.arrays_zip(
        F.col("ends").alias("e"),
        F.slice(starts, 1, F.size("ends")).alias("s"),
        F.array_repeat(total, F.size("ends")).alias("t"),
    )
    bag = F.transform(
        paired,
        lambda z: F.struct(
            z["e"]["word"].alias("word"), (z["e"]["end"] - z["s"]).alias("n"), z["t"].alias("of")
        ),
    )
    return rows.withColumn("bag", bag).drop("ends")


def quality_rules(
    documents: DataFrame,
    common: int = 48,
    most_class: float = 0.28,
    most_word: float = 0.4,
    least_words: int = 80,
    id_column: str = "doc_id",
) -> DataFrame:
    """Counts, distances and verdict, one row per row: (id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, class_distance, word_distance, kept).

    ``base_failed``: fewer than 50 words, or more than half of the words in
    repeated 3-word windows. Otherwise a document is kept if its nearest
    language is within ``most_class`` by character classes and, from
    ``least_words`` words on (shorter ones have too few common words to
    compare), within ``most_word`` by common words. A null text is empty and
    fails the base rule. Without any language name in the corpus there is no
    reference and only the base rule holds. Rows are independent: repeated rows
    get the same verdict. Other columns are ignored.
    """
    frequent = frequent_words(documents, common)
    words = sorted({word for found in frequent.values() for word in found})
    rows = stored(digest(documents, id_column, words), "quality-digest")
    known = references(rows, frequent)
    rows = _bags(rows)
    # A document has one language for both rules: the nearest by words and classes together.
    near = [
        F.struct(_class_distance(r).alias("class"), _word_distance(r).alias("word")) for r in known
    ] or [F.struct(F.lit(0.0).alias("class"), F.lit(0.0).alias("word"))]
    rows = rows.withColumn("near", F.array(*near))
    summed = F.transform(
        "near", lambda x: F.struct((x["class"] + x["word"]).alias("sum"), x["class"], x["word"])
    )
    rows = rows.withColumn("best", F.array_min(summed))
    n = F.col("n_words")
    failed = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    near_enough = (F.col("best.class") <= most_class) & (
        (n < least_words) | (F.col("best.word") <= most_word)
    )
    return rows.select(
        F.col("id").alias(id_column),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        F.col("best.class").alias("class_distance"),
        F.col("best.word").alias("word_distance"),
        (~failed & near_enough).alias("kept"),
    )
