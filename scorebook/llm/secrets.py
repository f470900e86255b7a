"""Secret scan: candidates by pattern, false positives removed by a random forest.

Candidates are private key blocks, provider formats, passwords of URLs, any
value given to a telling name, and long runs of key characters with a digit.

Labelled findings train the forest. Where a corpus brings none, provider
formats and assignments to tell-tale names give positive findings, and plain
numbers, paths, placeholders and words give negative ones; what neither rule
knows is left to the forest.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorebook.llm.shared import map_arrow, scratch, stored

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_\-])(?=[A-Za-z0-9+/_\-]*[0-9])[A-Za-z0-9+/_\-]{12,}={0,2}")
#: Names that announce a secret, words that stand for one, provider formats.
TELLING = ("password", "passwd", "pwd", "token", "secret", "key", "auth", "bearer", "credential")
PLACEHOLDERS = ("example", "changeme", "placeholder", "xxxx", "dummy", "sample", "test")
PROVIDER = re.compile(
    r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|glpat-[\w\-]{20,}|xox[abprs]-[\w\-]{10,}"
    r"|sk-[A-Za-z0-9\-_]{20,}|AIza[\w\-]{35}|sk_live_[A-Za-z0-9]{16,}"
)
PRIVATE_KEY = re.compile(
    r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
    r"(?:(?:[^-]|-(?!----))*+-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----)?"
)
KNOWN = re.compile(rf"(?<![A-Za-z0-9])(?:{PROVIDER.pattern})(?![A-Za-z0-9])")
URL_PASSWORD = re.compile(r"://[^\s:/?#@\"'<>]*:(?!\d+[?#])([^\s/\"'<>]+)@")
#: A name that holds a telling word, a sign, and a value: quoted with any content, or up to white
#: space, a quote or a tag. The first look ahead keeps most words from being searched.
NAMED = re.compile(
    r"(?<!\w)(?=\w++(?:\\*[\"'`\])]){0,2}\s*+[=:])"
    rf"(?=\w*?(?:{'|'.join(TELLING)}))\w++(?:\\*[\"'`\])]){{0,2}}\s*+"
    r"(?:===?|=>|:=|=|:(?!:|//))[^\S\n]*+(?:\n[^\S\n]++)?(?:(?:bearer|basic|token)[^\S\n]++)?"
    r"(?:\"((?:[^\"\\\n]|\\.)++)\"|'((?:[^'\\\n]|\\.)++)'|`([^`\n]++)`"
    r"|(?:\\*[\"'`])?((?:(?!</?[a-z])[^\s\"'`])++))",
    re.IGNORECASE,
)
ASSIGNED = re.compile(
    rf"(?:{'|'.join(TELLING)})\w*[\"']?\s*(?:=|:|=>)\s*[\"']?$", re.IGNORECASE
)
#: Not values but where to find them: variables, calls, templates, nothing.
REFERENCE = re.compile(
    r"\$\{[^}]*\}|\$[A-Z][A-Z0-9_]*|\$?\{\{.*\}\}|<[^<>]*>|%\w+%|[A-Za-z_][\w.]*(?:\(.*\)|\[.*\]|[(\[])"
    r"|(?i:none|null|nil|true|false|undefined)"
)
_PATH = re.compile(r"(?:https?:|www\.|[\w.]+@|[\w\-]+/[\w\-]+/|\\)\S*$", re.IGNORECASE)
_WORD = re.compile(r"[^\W\d_]{3,}")
NEIGHBOURS = 3

FEATURES = (
    "length",
    "digits",
    "uppers",
    "lowers",
    "others",
    "changes",
    "entropy",
    "surprise",
    "dictionary",
    "slashes",
    "in_path",
    "provider",
    "named",
    "assigned",
    "quoted",
    "placeholder",
    *(f"near_{word}" for word in TELLING),
)


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3


def _value(text: str, match: re.Match) -> tuple[int, int]:
    """The value's span; unquoted ones end before the next parameter of a URL and closing marks."""
    start, end = match.span(match.lastindex)
    if match.lastindex < 4:
        return start, end
    value = text[start:end]
    if re.search(r"[?&#][\w.\[\-]*$", text[max(0, match.start() - 60) : match.start()]):
        value = re.split("[&#]", value, maxsplit=1)[0]
    if text[end : end + 1] in ("'", '"', "`"):
        value = value.rstrip("\\")
    opener = {")": "(", "]": "[", "}": "{", ">": "<"}
    while value and (value[-1] in ".,;:" or opener.get(value[-1], value[-1]) not in value):
        value = value[:-1]
    return start, start + len(value)


def _named(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the values given to telling names, the inner ones where a value holds some."""
    at = 0
    while match := NAMED.search(text, at):
        start, at = _value(text, match)
        yield from [_value(text, m) for m in NAMED.finditer(text, start, at)] or [(start, at)]


def spans(text: str) -> dict[tuple[int, int], str]:
    """The form of each candidate span, in order; of overlapping ones the surer form stays."""
    taken = bytearray(len(text))
    found = {}

    def add(start: int, end: int, form: str) -> None:
        if start < end and not any(taken[start:end]):
            taken[start:end] = b"\x01" * (end - start)
            found[start, end] = form

    for match in PRIVATE_KEY.finditer(text):
        add(*match.span(), "private")
    for match in KNOWN.finditer(text):
        add(*match.span(), "provider")
    for match in URL_PASSWORD.finditer(text):
        add(*match.span(1), "named")
    for span in _named(text):
        add(*span, "named")
    for match in CANDIDATE.finditer(text):
        add(*match.span(), "run")
    return dict(sorted(found.items()))


def _plain(value: str) -> bool:
    """Words only, as prose or code has them after a colon."""
    value = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value)
    words = [w for w in re.split(r"[\s'’.,;:!?_\-]+", value) if w]
    return all(w.isalpha() and (w.isupper() or w[1:].islower() or len(w) == 1) for w in words)


class Document:
    """What the features of a text's candidates need of the text itself."""

    def __init__(self, text: str):
        self.text = text
        self.spans = spans(text)
        self.total = max(1, len(text) - 1)

    @cached_property
    def words(self) -> set[str]:
        cuts = [0, *(at for span in self.spans for at in span), len(self.text)]
        rest = " ".join(self.text[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))
        return {w.lower() for w in _WORD.findall(rest)}

    @cached_property
    def pairs(self) -> Counter:
        return Counter(zip(self.text, self.text[1:], strict=False))

    def coverage(self, value: str) -> float:
        """Share of the characters that words of the text cover, longest first."""
        lowered, at, covered = value.lower(), 0, 0
        while at < len(lowered):
            for size in range(min(12, len(lowered) - at), 2, -1):
                if lowered[at : at + size] in self.words:
                    covered += size
                    at += size
                    break
            else:
                at += 1
        return covered / len(value)

    def surprise(self, value: str) -> float:
        """Bits of its character transitions against those of the text."""
        bits = [math.log2(self.total / self.pairs[p]) for p in zip(value, value[1:], strict=False)]
        return sum(bits) / max(1, len(bits))

    def features(self, start: int, end: int) -> list[float]:
        value, text = self.text[start:end], self.text
        before, n = text[max(0, start - 80) : start], len(value)
        kinds = [_kind(c) for c in value]
        share = [kinds.count(k) / n for k in range(4)]
        counts = Counter(value).values()
        near = " ".join(before.lower().split()[-NEIGHBOURS:])
        lowered = value.lower()
        form = self.spans.get((start, end))
        provider = form in ("private", "provider")
        named = form == "named" or bool(ASSIGNED.search(text[max(0, start - 60) : start]))
        return [
            float(n),
            *share,
            sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / n,
            -sum(c / n * math.log2(c / n) for c in counts),
            self.surprise(value),
            self.coverage(value),
            value.count("/") / n,
            float(not provider and not named and bool(_PATH.search(before))),
            float(provider),
            float(named),
            float(bool(re.search(r"[=:]\s*[\"']?$", before))),
            float(before[-1:] in ("'", '"') and text[end : end + 1] in ("'", '"')),
            float(any(p in lowered for p in PLACEHOLDERS)),
            *(float(word in near) for word in TELLING),
        ]

    def rule(self, start: int, end: int, x: list[float]) -> int | None:
        """1 or 0 where a rule is sure, else None."""
        value = self.text[start:end]
        known = dict(zip(FEATURES, x, strict=True))
        if self.spans.get((start, end)) == "private":
            return 1
        if known["placeholder"] or known["dictionary"] > 0.8:
            return 0
        if known["named"] and REFERENCE.fullmatch(value):
            return 0
        if known["digits"] == 1 or len(set(value)) < 6:
            return None if known["named"] else 0
        if known["provider"] or known["named"] and not _plain(value):
            return 1
        return 0 if known["in_path"] else None


def candidates(documents: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(id, start, end, value, x, label) of every candidate of every whole text.

    ``start`` and ``end`` count code points. ``label`` is what the rules are
    sure of. Null and empty texts have none; repeated rows repeat theirs.
    """

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = []
        for i, text in enumerate(batch.column(1).to_pylist()):
            document = Document(text) if text else None
            for span in document.spans if document else ():
                x = document.features(*span)
                found.append((i, *span, text[slice(*span)], x, document.rule(*span, x)))
            if len(found) > 10_000:
                yield pack(batch, found)
                found = []
        if found:
            yield pack(batch, found)

    def pack(batch: pa.RecordBatch, found: list) -> pa.RecordBatch:
        row, start, end, value, x, label = zip(*found, strict=True)
        columns = [
            batch.column(0).take(pa.array(row)),
            pa.array(start, pa.int64()),
            pa.array(end, pa.int64()),
            pa.array(value),
            pa.array(x, pa.list_(pa.float64())),
            pa.array(label, pa.int32()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["id", "start", "end", "value", "x", "label"])

    rows = documents.select(F.col(id_column).cast("long").alias("id"), F.col("text"))
    schema = "id long, start long, end long, value string, x array<double>, label int"
    return map_arrow(rows, run, schema)


def _columns(found: DataFrame) -> DataFrame:
    named = {f"x_{name}": F.col("x")[i] for i, name in enumerate(FEATURES)}
    inputs = [f"x_{name}" for name in FEATURES]
    return VectorAssembler(inputCols=inputs, outputCol="vector").transform(found.withColumns(named))


def train(findings: DataFrame, most_rows: int = 20_000) -> RandomForestClassificationModel | None:
    """A forest from at most ``most_rows`` labelled findings (x, label, value), half of each
    label, the first by hash; equal findings count once. None unless both labels occur."""
    distinct = findings.where("label is not null").groupBy("x", "label").agg(F.min("value").alias("value"))
    parts = [
        distinct.where(F.col("label") == label)
        .orderBy(F.xxhash64("value"), "x")
        .limit(most_rows // 2)
        .collect()
        for label in (0, 1)
    ]
    if not all(parts):
        return None
    spark = findings.sparkSession
    rows = spark.createDataFrame([(r["x"], r["label"]) for p in parts for r in p], "x array<double>, label int")
    forest = RandomForestClassifier(
        featuresCol="vector", labelCol="label", numTrees=40, maxDepth=6, seed=7, minInstancesPerNode=2
    )
    # A fitted forest keeps its training summary and with it the session, which cannot be shipped
    # to tasks in every state; one that is read back has neither.
    path = scratch(spark, "secret-forest")
    forest.fit(_columns(rows.coalesce(1))).save(path)
    return RandomForestClassificationModel.load(path)


def scored(found: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """``found`` (id, start, end, value, x, label) with the forest's ``score``. Without a forest
    it is 1 for what the rules are sure of, and 0 for the rest."""
    if model is None:
        return found.withColumn("score", F.coalesce((F.col("label") == 1).cast("double"), F.lit(0.0)))
    return model.transform(_columns(found)).withColumn("score", vector_to_array("probability")[1])


def secrets(
    documents: DataFrame,
    findings: DataFrame | None = None,
    least: float = 0.5,
    id_column: str = "doc_id",
) -> DataFrame:
    """(id, start, end, value, score) of the candidates that the forest takes for secrets.

    ``findings`` (x, label, value) are labelled candidates; by default those of
    the corpus that the rules are sure of. Other columns are ignored.
    """
    found = stored(candidates(documents, id_column), "secret-candidates")
    model = train(found if findings is None else findings)
    kept = scored(found, model).where(F.col("score") >= least)
    return kept.select(F.col("id").alias(id_column), "start", "end", "value", "score")
