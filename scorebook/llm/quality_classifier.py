"""Quality classifier: a generalised additive model with pairwise interactions.

Boosting goes round the features; each step fits a shallow tree to one
feature's bins and adds it to that feature's lookup table. Then it goes round
the feature pairs whose residuals interact most, with trees of one cut on each
axis. A score is the sum of one table entry for each feature and pair, so the
model is a few arrays, and scoring is additions over bins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorebook.llm.shared import Shipped, map_arrow

FEATURES = (
    "log_words",
    "mean_word",
    "upper",
    "digit",
    "symbol",
    "bar",
    "exclamation",
    "mark",
    "other_bytes",
    "space",
    "line_ends",
    "distinct_words",
    "echoed_words",
    "distinct_lines",
    "marked_words",
    "longest_word",
)


def _octets(of: str) -> np.ndarray:
    chosen = np.zeros(256)
    chosen[list(of.encode())] = 1
    return chosen


_SHARES = np.stack(
    [
        _octets("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        _octets("0123456789"),
        _octets("#*$%&<>@^~=+_/\\{}[]"),
        _octets("|"),
        _octets("!"),
        _octets(".,;:?'\"()-"),
        (np.arange(256) >= 128).astype(float),
        _octets(" \t\r\x0b\x0c"),
        _octets("\n"),
    ],
    axis=1,
)
_ENDS = frozenset(b"#*$%&!|")


def features(text: str | None) -> list[float]:
    """The features of one whole text, in the order of ``FEATURES``; empty for null."""
    raw = (text or "").encode()
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = (counts @ _SHARES / max(1, len(raw))).tolist()
    words = raw.split()
    n = max(1, len(words))
    lines = [line for line in raw.split(b"\n") if line]
    echoed = sum(map(bytes.__eq__, words, words[1:]))
    marked = sum(1 for word in words if word[-1] in _ENDS)
    return [
        float(np.log1p(len(words))),
        sum(map(len, words)) / n,
        *shares,
        len(set(words)) / n,
        echoed / n,
        len(set(lines)) / max(1, len(lines)),
        marked / n,
        float(np.log1p(max(map(len, words), default=0))),
    ]


@dataclass
class AdditiveModel:
    """Lookup tables by feature and by feature pair; ``score`` gives probabilities."""

    rounds: int = 150
    pair_rounds: int = 60
    pairs: int = 6
    bins: int = 48
    pair_bins: int = 12
    rate: float = 0.15
    leaves: int = 3
    smooth: float = 4.0
    base: float = 0.0
    edges: list = field(default_factory=list)
    pair_edges: list = field(default_factory=list)
    tables: list = field(default_factory=list)
    pair_tables: dict = field(default_factory=dict)

    def fit(self, x: np.ndarray, y: np.ndarray) -> AdditiveModel:
        """Without rows of both classes every score is the share of ones (0.5 without rows)."""
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
        self.base = float(np.log(share / (1 - share)))
        if not len(y) or y.min() == y.max():
            return self
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        coarse = [np.unique(np.quantile(c, np.linspace(0, 1, self.pair_bins + 1)[1:-1])) for c in x.T]
        self.edges, self.pair_edges = cuts, coarse
        self.tables = [np.zeros(len(c) + 1) for c in cuts]
        fine = self._binned(x, cuts)
        total = np.full(len(y), self.base)
        for _ in range(self.rounds):
            for at, bins in enumerate(fine):
                step = self._step(*self._sums(bins, len(self.tables[at]), total, y))
                self.tables[at] += step
                total += step[bins]
        rough = self._binned(x, coarse)
        sizes = [len(c) + 1 for c in coarse]

        def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
            sums = self._sums(rough[i] * sizes[j] + rough[j], sizes[i] * sizes[j], total, y)
            return tuple(s.reshape(sizes[i], sizes[j]) for s in sums)

        gains = {p: self._cross(*grid(*p))[1] for p in combinations(range(x.shape[1]), 2)}
        chosen = sorted(gains, key=lambda p: (-gains[p], p))[: self.pairs]
        self.pair_tables = {p: np.zeros((sizes[p[0]], sizes[p[1]])) for p in chosen}
        for _ in range(self.pair_rounds):
            for i, j in chosen:
                step, _ = self._cross(*grid(i, j))
                self.pair_tables[i, j] += step
                total += step[rough[i], rough[j]]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if self.tables:
            for bins, table in zip(self._binned(x, self.edges), self.tables, strict=True):
                total += table[bins]
            rough = self._binned(x, self.pair_edges)
            for (i, j), table in self.pair_tables.items():
                total += table[rough[i], rough[j]]
        return 1 / (1 + np.exp(-np.clip(total, -50, 50)))

    @staticmethod
    def _binned(x: np.ndarray, edges: list) -> list[np.ndarray]:
        return [np.searchsorted(e, column, "right") for e, column in zip(edges, x.T, strict=True)]

    @staticmethod
    def _sums(bins, size, total, y) -> tuple[np.ndarray, np.ndarray]:
        """By bin: gradient and curvature of the log loss."""
        p = 1 / (1 + np.exp(-total))
        gradient = np.bincount(bins, y - p, minlength=size)
        return gradient, np.bincount(bins, p * (1 - p), minlength=size)

    def _value(self, gradient, curvature):
        return self.rate * np.clip(gradient / (curvature + self.smooth), -4, 4)

    def _step(self, gradient: np.ndarray, curvature: np.ndarray) -> np.ndarray:
        """A tree over ordered bins: the best leaf is cut at its best place, ``leaves`` - 1 times."""
        g, h = np.r_[0, np.cumsum(gradient)], np.r_[0, np.cumsum(curvature)]
        leaves = [(0, len(gradient))]

        def gain(low, high, at):
            left = (g[at] - g[low]) ** 2 / (h[at] - h[low] + self.smooth)
            right = (g[high] - g[at]) ** 2 / (h[high] - h[at] + self.smooth)
            return left + right - (g[high] - g[low]) ** 2 / (h[high] - h[low] + self.smooth)

        for _ in range(self.leaves - 1):
            best = (1e-9, 0, 0)
            for k, (low, high) in enumerate(leaves):
                if high - low > 1:
                    gains = gain(low, high, np.arange(low + 1, high))
                    at = int(gains.argmax())
                    best = max(best, (float(gains[at]), k, low + 1 + at))
            if not best[2]:
                break
            low, high = leaves[best[1]]
            leaves[best[1] : best[1] + 1] = [(low, best[2]), (best[2], high)]
        step = np.zeros(len(gradient))
        for low, high in leaves:
            step[low:high] = self._value(g[high] - g[low], h[high] - h[low])
        return step

    def _cross(self, gradient: np.ndarray, curvature: np.ndarray) -> tuple[np.ndarray, float]:
        """The tree of one cut on each axis that explains most, and what it explains."""
        g = np.pad(gradient.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
        h = np.pad(curvature.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
        if min(gradient.shape) < 2:
            return np.zeros_like(gradient), 0.0

        def quarters(s):
            inner = s[1:-1, 1:-1]
            down, right = s[-1:, 1:-1], s[1:-1, -1:]
            return np.stack([inner, right - inner, down - inner, s[-1, -1] - down - right + inner])

        gs, hs = quarters(g), quarters(h)
        gains = (gs**2 / (hs + self.smooth)).sum(0)
        i, j = np.unravel_index(int(gains.argmax()), gains.shape)
        values = self._value(gs[:, i, j], hs[:, i, j])
        step = np.empty_like(gradient)
        step[: i + 1, : j + 1], step[: i + 1, j + 1 :] = values[0], values[1]
        step[i + 1 :, : j + 1], step[i + 1 :, j + 1 :] = values[2], values[3]
        return step, float(gains[i, j])


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(folds))


def train(
    documents: DataFrame,
    labels: DataFrame,
    most_rows: int = 20_000,
    folds: int = 3,
    held_out: int = 1,
    id_column: str = "doc_id",
) -> AdditiveModel:
    """Fits on at most ``most_rows`` labelled documents outside the held-out fold, the first by
    hash of the id. Their ids are the only thing broadcast, their features the only thing
    collected. A document with several labels has their majority, 1 on a tie.
    """
    chosen = (
        labels.where(F.col("quality").isNotNull() & (fold(id_column, folds) != held_out))
        .groupBy(F.col(id_column).cast("long").alias("id"))
        .agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(most_rows)
    )
    texts = documents.select(F.col(id_column).cast("long").alias("id"), F.col("text"))
    # A repeated id brings all its rows; the order makes the sums, and so the model, repeatable.
    rows = texts.join(F.broadcast(chosen), "id").select("id", "label", "text")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [features(t) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.float64()))],
            names=["id", "label", "x"],
        )

    found = map_arrow(rows, run, "id long, label int, x array<double>").toArrow()
    x = found.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    y = found.column("label").to_numpy().astype(float)
    order = np.lexsort((*x.T, found.column("id").to_numpy()))[: 2 * most_rows]
    return AdditiveModel().fit(x[order], y[order])


def score(documents: DataFrame, model: AdditiveModel, id_column: str = "doc_id") -> DataFrame:
    """``documents`` reduced to (id, score), one row per row: a map without any shuffle.

    Null and empty texts get the score of an empty text, repeated rows equal scores.
    """
    held = Shipped(documents.sparkSession, model)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x = np.array([features(t) for t in batch.column(1).to_pylist()])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(held.value.score(x))], names=["id", "score"]
        )

    rows = documents.select(F.col(id_column).alias("id"), F.col("text"))
    kind = documents.schema[id_column].dataType.simpleString()
    return map_arrow(rows, run, f"id {kind}, score double").withColumnRenamed("id", id_column)


def accepted(documents: DataFrame, model: AdditiveModel, least: float = 0.5) -> DataFrame:
    """The rows of ``documents`` that score at least ``least``, with all their columns."""
    held = Shipped(documents.sparkSession, model)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
        good = held.value.score(np.array([features(t) for t in texts])) >= least
        yield batch.filter(pa.array(good))

    return map_arrow(documents, run, documents.schema)
