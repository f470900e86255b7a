"""The numbered queries: each applies its operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.llm import language_id, quality_classifier, toxicity
from scorebook.llm.decontamination import contaminated
from scorebook.llm.line_dedup import LOWER, UPPER, drop_frequent_lines
from scorebook.llm.mixing import mix
from scorebook.llm.quality_rules import CLASSES, quality_rules
from scorebook.llm.secrets import secrets
from scorebook.llm.simhash import simhash_groups
from scorebook.llm.spelling import spelling_groups
from scorebook.llm.suffix_dedup import remove_repeats
from scorebook.llm.token_alignment import align_tokens
from scorebook.llm.token_counts import token_counts


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def default_vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_documents(spark, sf_dir), length=400).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(_documents(spark, sf_dir), least=0.5)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = quality_rules(_documents(spark, sf_dir), most_class=0.28, most_word=0.4)
    return rules.drop("class_distance", "word_distance")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(_documents(spark, sf_dir), weights=(5.0, 2.0, 1.0), most=3.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(_documents(spark, sf_dir), shingle=3, bits=3)
    return groups.select("doc_id", "fingerprint", "component_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_frequent_lines(_documents(spark, sf_dir), frequent=10, least=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.train(documents, labels, most_rows=20_000, folds=3, held_out=1)
    held_out = F.coalesce(quality_classifier.fold("doc_id", 3) == 1, F.lit(False))
    return quality_classifier.score(documents, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_documents(spark, sf_dir), default_vocabulary(), limit=512)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    model = language_id.train(documents, most_documents=2_000, folds=5, held_out=0)
    held_out = F.coalesce(quality_classifier.fold("doc_id", 5) == 0, F.lit(False))
    return language_id.identify(documents, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark item, with the item."""
    rows = _documents(spark, sf_dir).select(F.col("doc_id").alias("id"), "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contaminated(rows, benchmark).withColumnRenamed("id", "doc_id")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    network = toxicity.train(documents, labels, most_rows=4_000, folds=5, held_out=0)
    held_out = F.coalesce(quality_classifier.fold("doc_id", 5) == 0, F.lit(False))
    return toxicity.score(documents, network).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(
        _documents(spark, sf_dir), least_length=7, least_count=2, times=10, damage=31
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = default_vocabulary(), default_vocabulary("piece_bpe_32k.model")
    return align_tokens(_documents(spark, sf_dir), *files)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_secret_scan": op2_secret_scan,
    "op3_quality_rules": op3_quality_rules,
    "op4_mix_sources": op4_mix_sources,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_token_counts": op8_token_counts,
    "op9_language_id": op9_language_id,
    "op10_decontamination": op10_decontamination,
    "op11_toxicity": op11_toxicity,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_token_alignment": op13_token_alignment,
}

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

_MIX = f"""
WITH d AS (
  SELECT doc_id, source, CAST({_WORDS} AS BIGINT) AS size,
         CAST(('0x' || substr(md5(concat_ws('|', CAST(doc_id AS VARCHAR), text)), 1, 13)) AS BIGINT) AS u
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS documents,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM d GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][rank % 3 + 1] AS weight, 3.0::DOUBLE * source_size AS cap FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (
              ORDER BY cap / weight, source NULLS LAST
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
t AS (SELECT source, source_size, documents, least(cap, max(level) OVER () * weight) AS target FROM l),
r AS (
  SELECT *, CASE WHEN source_size > 0
            THEN least(floor(target / source_size + 1e-9), 3) ELSE 0 END AS whole FROM t),
q AS (SELECT *, greatest(target - whole * source_size, 0) AS rest FROM r),
f AS (
  SELECT d.doc_id, d.source, d.size, source_size, target, whole, rest,
         (CAST(u AS DOUBLE) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS v,
         2 + CAST(least(2, floor(d.size * documents / greatest(source_size, 1))) AS BIGINT) AS favour
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
p AS (
  SELECT *, CASE WHEN weighted > 0 THEN least(1.0::DOUBLE, rest * favour / weighted) ELSE 0 END AS p
  FROM (SELECT *, CAST(sum(favour * size) OVER (PARTITION BY source) AS DOUBLE) AS weighted FROM f)),
e AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY u
                            RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS through
  FROM (SELECT * EXCLUDE (v), least(4503599627370495, CAST(floor(
          (v * (1 - p)) / (v * (1 - p) + (1 - v) * p) * 4503599627370496::DOUBLE) AS BIGINT)) AS u FROM p)),
c AS (
  SELECT source, rest - coalesce(max(through) FILTER (through <= rest), 0) AS gap
  FROM e GROUP BY source, rest),
x AS (
  SELECT e.source, arg_min(u, (abs(size - gap), u)) AS extra
  FROM e JOIN c ON e.source IS NOT DISTINCT FROM c.source
  WHERE through > rest AND abs(size - gap) < gap GROUP BY e.source)
SELECT doc_id, size, source_size, target,
       size * CAST(whole + CASE WHEN through <= rest OR u IS NOT DISTINCT FROM extra
                                THEN 1 ELSE 0 END AS BIGINT) AS taken
FROM e LEFT JOIN x ON e.source IS NOT DISTINCT FROM x.source
"""

_LINES = f"""
WITH l AS (
  SELECT doc_id, lines, unnest(lines) AS line, generate_subscripts(lines, 1) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
k AS (
  SELECT doc_id, i, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   '{UPPER}', '{LOWER}') AS key FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY doc_id
"""



def _part(p: str, q: str) -> str:
    return (
        f"(CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END"
        f" + CASE WHEN {q} > 0 THEN {q} * log2(2 * {q} / ({p} + {q})) ELSE 0 END)"
    )


def _class_parts() -> str:
    terms = (_part(f"(d.{c} / greatest(d.n_chars, 1))", f"(r.{c} / r.n_chars)") for c in CLASSES)
    return " + ".join(terms)


_COUNTED = {
    "lower": "[a-z]",
    "space": r"[\x20\x09-\x0D]",
    "upper": "[A-Z]",
    "digit": "[0-9]",
    "symbol": "[#*$%&|<>]",
    "mark": "[.,;:!?''\"()-]",
}
_COUNTS = ", ".join(
    f"length(text) - length(regexp_replace(text, '{pattern}', '', 'g')) AS {name}"
    for name, pattern in _COUNTED.items()
)

_RULES = rf"""
WITH t AS (
  SELECT doc_id, lang, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
g AS (
  SELECT doc_id, i, w[i] || chr(0) || w[i + 1] || chr(0) || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t)),
v AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g), range(3) AS r(k)
  WHERE n > 1 GROUP BY doc_id),
c AS (
  SELECT doc_id, lang, len(w) AS n_words, length(text) AS n_chars,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, {_COUNTS},
         length(text) - length(regexp_replace(text, '\p{{L}}', '', 'g')) - lower - upper AS letter,
         n_chars - lower - space - upper - digit - symbol - mark - letter AS rest
  FROM t),
d AS (
  SELECT c.*, coalesce(n_repeat_words, 0) AS n_repeat_words FROM c LEFT JOIN v USING (doc_id)),
s AS (
  SELECT doc_id, lang, word, count(*) AS n
  FROM (SELECT doc_id, lang, lower(unnest(w)) AS word FROM t)
  GROUP BY ALL),
r AS (
  SELECT lang, greatest(sum(n_chars), 1) AS n_chars, greatest(sum(n_words), 1) AS n_words,
         {", ".join(f"sum({x}) AS {x}" for x in CLASSES)}
  FROM d WHERE lang IS NOT NULL GROUP BY lang),
b AS (
  SELECT b.lang, word, n / n_words AS q
  FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS rank
        FROM (SELECT lang, word, sum(n) AS n FROM s WHERE lang IS NOT NULL GROUP BY ALL)) b
  JOIN r ON r.lang = b.lang WHERE rank <= 48),
e AS (SELECT lang, sum(q) AS every FROM b GROUP BY lang),
m AS (
  SELECT d.doc_id, b.lang, sum({_part("(s.n / greatest(d.n_words, 1))", "b.q")}) AS parts,
         sum(s.n / greatest(d.n_words, 1)) AS p, sum(b.q) AS q
  FROM d JOIN s USING (doc_id) JOIN b ON b.word = s.word GROUP BY ALL),
n AS (
  SELECT d.doc_id, sqrt(greatest(({_class_parts()}) / 2, 0)) AS class,
         greatest(1 - coalesce(m.p, 0), 0) AS p0, greatest(1 - coalesce(e.every, 0), 0) AS q0,
         sqrt(greatest((coalesce(m.parts, 0) + {_part("p0", "q0")}
                        + greatest(coalesce(e.every, 0) - coalesce(m.q, 0), 0)) / 2, 0)) AS word
  FROM d CROSS JOIN r LEFT JOIN e ON e.lang = r.lang
  LEFT JOIN m ON m.doc_id = d.doc_id AND m.lang = r.lang),
x AS (SELECT doc_id, min({{'a': class + word, 'class': class, 'word': word}}) AS best FROM n GROUP BY doc_id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_chars - space AS BIGINT) AS word_chars,
       CAST(symbol AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT base_failed AND coalesce(best['class'], 0) <= 0.28
         AND (n_words < 80 OR coalesce(best['word'], 0) <= 0.4) AS kept
FROM d LEFT JOIN x USING (doc_id)
"""

SQL: dict[str, str] = {
    "op3_quality_rules": _RULES,
    "op4_mix_sources": _MIX,
    "op6_line_dedup": _LINES,
}
