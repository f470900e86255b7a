"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A text is read in overlapping windows of words. A word enters as its own vector,
if it is among the frequent words of the training sample, beside the mean of the
vectors of its hashed character trigrams. One network reads a window forwards,
one backwards; attention weighs their states at each word into one logit. A
text scores as its worst window.

Labels say that a text is toxic, not where. Training therefore starts with
windows drawn from the texts, and then goes on with the window of each text that
the network itself finds worst: for a toxic text that one should score high, for
a clean text even that one should score low.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorebook.llm.quality_classifier import fold
from scorebook.llm.shared import blocks, map_arrow

#: Words, of at most 24 characters; longer runs, as in text without spaces, are several words.
WORD = re.compile(r"\w{1,24}")
#: Words in a window, and from one window to the next.
WINDOW, STRIDE = 32, 24
#: Words whose inputs a task remembers, windows it scores at once, and characters it splits at once.
KEPT, AT_ONCE, BLOCK = 100_000, 4096, 1 << 21


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def window_starts(words: int) -> range:
    """Of windows that overlap and hold every word; a text without words has one empty window."""
    return range(0, max(1, words - (WINDOW - STRIDE)), STRIDE)


def trigrams(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams of all words, with a mark at both ends, and how many each word has."""
    n = np.array(list(map(len, words)), np.int64)
    marked = "<" + "><".join(words) + ">"
    codes = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32)
    h = (codes[:-2] * np.uint32(0x9E3779B1) + codes[1:-1]) * np.uint32(0x85EBCA6B) + codes[2:]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(13)
    start = np.cumsum(n + 2) - (n + 2)
    at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return (h[at] % np.uint32(buckets)).astype(np.int64), n


def _sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-x))


def _tanh(x: np.ndarray) -> np.ndarray:
    return 2 * _sigmoid(2 * x) - 1


@dataclass
class Network:
    """Plain arrays and a word list; a copy of its fields is all that is shipped."""

    size: int = 16
    word_size: int = 12
    gram_size: int = 12
    buckets: int = 2048
    base: float = 0.0
    words: dict = field(default_factory=dict)
    weights: dict = field(default_factory=dict)

    def start(self, frequent: list[str], seed: int = 7) -> None:
        """Small random weights. Row 0 of the word vectors is for all other words."""
        r = np.random.default_rng(seed)
        self.words = {w: i + 1 for i, w in enumerate(frequent)}
        inputs, h = self.word_size + self.gram_size, self.size

        def drawn(*shape: int, scale: float) -> np.ndarray:
            return r.normal(0, scale, shape).astype(np.float32)

        self.weights = {
            "word": drawn(len(frequent) + 1, self.word_size, scale=0.1),
            "gram": drawn(self.buckets, self.gram_size, scale=0.3),
        }
        for way in ("ahead", "back"):
            self.weights[f"{way}_in"] = drawn(inputs, 3 * h, scale=inputs**-0.5)
            self.weights[f"{way}_bias"] = np.zeros(3 * h, np.float32)
            self.weights[f"{way}_state"] = drawn(h, 3 * h, scale=h**-0.5)
        # What a state says for attention, and for the logit.
        self.weights["say"] = drawn(2 * h, 2, scale=(2 * h) ** -0.5)
        self.weights["say_bias"] = np.zeros(1, np.float32)

    # Inputs: a table with a row for each different word.

    def inputs(self, vocabulary: list[str], known: np.ndarray | int = 1) -> tuple[np.ndarray, tuple]:
        own = np.array([self.words.get(w, 0) for w in vocabulary], np.int64) * known
        flat, n = trigrams(vocabulary, self.buckets)
        start = np.cumsum(n) - n
        mean = np.add.reduceat(self.weights["gram"][flat], start) / n[:, None].astype(np.float32)
        x = np.hstack([self.weights["word"][own], mean]).astype(np.float32)
        return x, (own, flat, n)

    def gates(self, x: np.ndarray, way: str) -> np.ndarray:
        return x @ self.weights[f"{way}_in"] + self.weights[f"{way}_bias"]

    # Scoring.

    def _said(self, table: np.ndarray, ids: np.ndarray, mask: np.ndarray, way: str) -> np.ndarray:
        """By step and window, what the states of one direction say."""
        h, state = self.size, self.weights[f"{way}_state"]
        say = self.weights["say"][:h] if way == "ahead" else self.weights["say"][h:]
        steps = range(ids.shape[1]) if way == "ahead" else range(ids.shape[1] - 1, -1, -1)
        s = np.zeros((len(ids), h), np.float32)
        out = np.empty((ids.shape[1], len(ids), 2), np.float32)
        for t in steps:
            x, u = table[ids[:, t]], s @ state
            zr = x[:, : 2 * h] + u[:, : 2 * h]
            np.negative(zr, out=zr)
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            n = u[:, 2 * h :]
            n *= zr[:, h:]
            n += x[:, 2 * h :]
            n *= -2
            np.exp(n, out=n)
            n += 1
            np.divide(2, n, out=n)
            n -= 1
            n -= s
            n *= zr[:, :h]
            s += n
            if way == "back":
                s *= mask[:, t, None]
            out[t] = s @ say
        return out

    def logits(self, tables: tuple[np.ndarray, np.ndarray], ids: np.ndarray) -> np.ndarray:
        """Of windows, given as rows of word numbers; -1 where a window has no more words."""
        out = np.full(len(ids), self.base, np.float32)
        if not self.weights:
            return out
        for low in range(0, len(ids), AT_ONCE):
            part = ids[low : low + AT_ONCE]
            mask = (part >= 0).astype(np.float32)
            some = np.maximum(part, 0)
            with np.errstate(over="ignore"):
                said = self._said(tables[0], some, mask, "ahead") + self._said(tables[1], some, mask, "back")
                attention = np.where(mask.T > 0, said[..., 0], -1e9)
                attention = np.exp(attention - attention.max(0)) * mask.T
            total = np.maximum(attention.sum(0), 1e-9)
            out[low : low + len(part)] += (attention * said[..., 1]).sum(0) / total + self.weights["say_bias"][0]
        return out

    # Training.

    def _read(self, gx: np.ndarray, mask: np.ndarray, way: str):
        """States by step, and what ``_unread`` needs; ``gx`` by step, window, gate."""
        h, state = self.size, self.weights[f"{way}_state"]
        s = np.zeros((gx.shape[1], h), np.float32)
        states, kept = [], []
        for x, m in zip(gx, mask, strict=True):
            u = s @ state
            zr = _sigmoid(x[:, : 2 * h] + u[:, : 2 * h])
            z, r = zr[:, :h], zr[:, h:]
            n = _tanh(x[:, 2 * h :] + r * u[:, 2 * h :])
            kept.append((s, z, r, n, u[:, 2 * h :]))
            s = (s + z * (n - s)) * m[:, None]
            states.append(s)
        return np.stack(states), kept

    def _unread(self, grad: np.ndarray, kept: list, mask: np.ndarray, way: str):
        """Gradients of the gate inputs and of the state weights."""
        state = self.weights[f"{way}_state"]
        d_state, d_gx = np.zeros_like(state), np.empty((len(kept), grad.shape[1], 3 * self.size), np.float32)
        ds = np.zeros_like(grad[0])
        for t in range(len(kept) - 1, -1, -1):
            s, z, r, n, u = kept[t]
            ds = (ds + grad[t]) * mask[t][:, None]
            dn = ds * z * (1 - n * n)
            dz = ds * (n - s) * z * (1 - z)
            dr = dn * u * r * (1 - r)
            d_gx[t] = np.hstack([dz, dr, dn])
            back = np.hstack([dz, dr, dn * r])
            d_state += s.T @ back
            ds = ds * (1 - z) + back @ state.T
        return d_gx, d_state

    def gradients(self, vocabulary: list[str], ids: np.ndarray, y: np.ndarray, weight: np.ndarray, kept=None, known=1):
        """The weighted log loss over windows, and its gradient for each weight.

        ``kept`` scales the inputs, 0 for those left out; words not ``known`` enter by their trigrams alone.
        """
        h, w = self.size, self.weights
        x, (own, flat, n_grams) = self.inputs(vocabulary, known)
        x = x if kept is None else x * kept
        mask, steps = (ids >= 0).T.astype(np.float32), np.maximum(ids, 0).T
        reads = {}
        for way, order in (("ahead", slice(None)), ("back", slice(None, None, -1))):
            reads[way] = self._read(self.gates(x, way)[steps[order]], mask[order], way)
        states = np.concatenate([reads["ahead"][0], reads["back"][0][::-1]], axis=2)
        said = states @ w["say"]
        raw = np.where(mask > 0, said[..., 0], -1e9)
        attention = np.exp(raw - raw.max(0)) * mask
        attention = (attention / np.maximum(attention.sum(0), 1e-9)).astype(np.float32)
        logit = (attention * said[..., 1]).sum(0) + w["say_bias"][0] + self.base
        p = _sigmoid(logit)
        loss = -(weight * np.log(np.where(y > 0, p, 1 - p) + 1e-9)).sum()
        d_logit = (weight * (p - y)).astype(np.float32)
        d_out = attention * d_logit
        share = (attention * said[..., 1]).sum(0)
        d_raw = attention * (said[..., 1] - share) * d_logit
        d_said = np.stack([d_raw, d_out], axis=2).astype(np.float32)
        grads = {
            "say": np.tensordot(states, d_said, axes=([0, 1], [0, 1])),
            "say_bias": d_logit.sum(keepdims=True),
        }
        d_states = d_said @ w["say"].T
        flat_ids = np.argsort(steps.ravel(), kind="stable")
        sorted_ids = steps.ravel()[flat_ids]
        first = np.flatnonzero(np.r_[True, sorted_ids[1:] != sorted_ids[:-1]])
        d_x = np.zeros_like(x)
        for way, part, order in (("ahead", slice(0, h), slice(None)), ("back", slice(h, None), slice(None, None, -1))):
            d_gx, grads[f"{way}_state"] = self._unread(d_states[order, :, part], reads[way][1], mask[order], way)
            d_gates = np.zeros((len(x), 3 * h), np.float32)
            d_gates[sorted_ids[first]] = np.add.reduceat(d_gx[order].reshape(-1, 3 * h)[flat_ids], first)
            grads[f"{way}_in"], grads[f"{way}_bias"] = x.T @ d_gates, d_gates.sum(0)
            d_x += d_gates @ w[f"{way}_in"].T
        d_x = d_x if kept is None else d_x * kept
        grads["word"], grads["gram"] = np.zeros_like(w["word"]), np.zeros_like(w["gram"])
        np.add.at(grads["word"], own, d_x[:, : self.word_size])
        each = (d_x[:, self.word_size :] / n_grams[:, None]).astype(np.float32)
        np.add.at(grads["gram"], flat, np.repeat(each, n_grams, axis=0))
        return float(loss), grads


@dataclass
class Sample:
    """Training windows: rows of word numbers, the text each belongs to, and the texts' labels."""

    vocabulary: list[str]
    ids: np.ndarray
    of: np.ndarray
    y: np.ndarray

    @classmethod
    def of_texts(cls, windows: list[list[str]], labels: list[int]) -> Sample:
        """From the windows of each text, given as words with a space between."""
        number: dict[str, int] = {}
        rows, of = [], []
        for text, found in enumerate(windows):
            for window in found:
                ids = [number.setdefault(w, len(number)) for w in window.split()]
                rows.append(ids + [-1] * (WINDOW - len(ids)))
                of.append(text)
        ids = np.array(rows, np.int32).reshape(-1, WINDOW)
        return cls(list(number), ids, np.array(of, np.int64), np.array(labels, np.float32))


def _adam(weights: dict, grads: dict, memory: dict, rate: float, decay: float = 0.4) -> None:
    """One step of Adam with weights that decay."""
    memory["step"] = step = memory.get("step", 0) + 1
    for name, g in grads.items():
        first, second = memory.setdefault(name, (np.zeros_like(g), np.zeros_like(g)))
        first += 0.1 * (g - first)
        second += 0.01 * (g * g - second)
        scaled = first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-7)
        weights[name] -= (rate * (scaled + decay * weights[name])).astype(np.float32)


def fit(sample: Sample, rounds: int = 10, batch: int = 128, left_out: float = 0.3, seed: int = 7) -> Network:
    """The network of the round that does best on one in eight texts, which it does not learn from.

    In each step a share of every word's inputs, ``left_out``, is not seen, so that no chance pattern
    decides, and the same share of words has no vector of its own, so that trigrams learn them too.
    Without texts of both labels, every score is the share of ones (0.5 without texts).
    """
    network, y = Network(), sample.y
    if not len(y) or y.min() == y.max() or not sample.vocabulary:
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
        network.base = float(np.log(share / (1 - share)))
        return network
    words, texts = len(sample.vocabulary), len(y)
    # Words in at least five texts (three of a small sample), at most 4096 of them.
    found = np.unique((sample.of[:, None] * words + sample.ids)[sample.ids >= 0]) % words
    count = np.bincount(found, minlength=words)
    order = sorted(np.flatnonzero(count >= (5 if texts >= 1000 else 3)), key=lambda i: (-count[i], sample.vocabulary[i]))
    network.start([sample.vocabulary[i] for i in order[:4096]], seed)
    r, memory = np.random.default_rng(seed), {}
    start = np.searchsorted(sample.of, np.arange(texts + 1))
    apart = np.arange(texts) % 8 == 0
    if apart.sum() < 100 or y[apart].min() == y[apart].max():
        apart[:] = False

    def learn(rows: np.ndarray, weight: np.ndarray, rate: float) -> None:
        # A small sample is gone through several times in a round.
        times = max(1, -(-40 * batch // max(1, len(rows))))
        rows, weight = np.tile(rows, times), np.tile(weight, times)
        order = r.permutation(len(rows))
        for low in range(0, len(rows), batch):
            chosen, part = rows[order[low : low + batch]], weight[order[low : low + batch]]
            present, local = np.unique(sample.ids[chosen], return_inverse=True)
            local = local.reshape(-1, WINDOW) - (1 if present[0] < 0 else 0)
            vocabulary = [sample.vocabulary[i] for i in present[present >= 0]]
            if vocabulary:
                shape = len(vocabulary), network.word_size + network.gram_size
                kept = (r.random(shape) >= left_out).astype(np.float32) / np.float32(1 - left_out)
                known = r.random(len(vocabulary)) >= left_out
                _, grads = network.gradients(vocabulary, local, y[sample.of[chosen]], part / part.sum(), kept, known)
                _adam(network.weights, grads, memory, rate)

    def logits() -> np.ndarray:
        x, _ = network.inputs(sample.vocabulary)
        return network.logits((network.gates(x, "ahead"), network.gates(x, "back")), sample.ids)

    drawn = start[:-1] + r.integers(0, 1 << 30, (4, texts)) % np.diff(start)
    drawn = drawn[:, ~apart].ravel()
    for _ in range(2):
        learn(drawn, np.ones(len(drawn), np.float32), 0.01)
    best, best_loss = network.weights, np.inf
    for k in range(rounds + 1):
        found = logits()
        worst = np.maximum.reduceat(found, start[:-1])
        if apart.any():
            p = np.clip(_sigmoid(worst[apart]), 1e-4, 1 - 1e-4)
            loss = -np.log(np.where(y[apart] > 0, p, 1 - p)).mean()
        else:
            loss = -k
        if loss < best_loss:
            best, best_loss = {name: w.copy() for name, w in network.weights.items()}, loss
        if k == rounds:
            break
        # The worst window of a toxic text, the three worst of a clean one.
        order = np.lexsort((-found, sample.of))
        rank = np.arange(len(order)) - start[sample.of[order]]
        taken = order[(rank < np.where(y[sample.of[order]] > 0, 1, 3)) & ~apart[sample.of[order]]]
        clean = np.minimum(3, np.diff(start))[sample.of[taken]]
        weight = np.where(y[sample.of[taken]] > 0, 1, 1 / clean).astype(np.float32)
        learn(taken, weight, 0.01 * 0.75**k)
    network.weights = best
    return network


def train(
    documents: DataFrame,
    labels: DataFrame,
    most_rows: int = 4_000,
    most_windows: int = 64,
    folds: int = 5,
    held_out: int = 0,
    id_column: str = "doc_id",
) -> Network:
    """Fits on at most ``most_rows`` labelled documents outside the held-out fold, the first by hash
    of the id, and of each on at most ``most_windows`` windows, spread evenly over the whole text.

    Their ids are the only thing broadcast, these windows the only thing collected. A document
    with several labels has their majority, toxic on a tie. Null labels and ids are left out.
    """
    chosen = (
        labels.where(F.col("toxic").isNotNull() & (fold(id_column, folds) != held_out))
        .groupBy(F.col(id_column).cast("long").alias("id"))
        .agg((F.avg("toxic") >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(most_rows)
    )
    texts = documents.select(F.col(id_column).cast("long").alias("id"), F.col("text"))
    rows = texts.join(F.broadcast(chosen), "id").select("id", "label", "text")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = []
        for text in batch.column(2).to_pylist():
            words = words_of(text)
            starts = window_starts(len(words))
            n = min(len(starts), most_windows)
            found.append([" ".join(words[s : s + WINDOW]) for s in (starts[i * len(starts) // n] for i in range(n))])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.string()))],
            names=["id", "label", "windows"],
        )

    found = map_arrow(rows, run, "id long, label int, windows array<string>").toArrow().to_pylist()
    # Rows arrive in any order; this one makes the model repeatable.
    found.sort(key=lambda row: (crc32(str(row["id"]).encode()), row["id"], row["windows"]))
    found = found[: 2 * most_rows]  # a repeated id brings all its rows
    return fit(Sample.of_texts([row["windows"] for row in found], [row["label"] for row in found]))


class Scorer:
    """Scores texts, remembering the gate inputs of words it has met."""

    def __init__(self, fields: dict):
        self.network = Network(**fields)
        self.forget()

    def forget(self) -> None:
        # Row 0 stands where a window has no word.
        self.number: dict[str, int] = {"": 0}
        gates = np.zeros((1, 3 * self.network.size), np.float32)
        self.tables = (gates, gates)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if len(self.number) > KEPT:
            self.forget()
        number, ids, sizes = self.number, [], []
        split = [words_of(text) for text in texts]
        new = sorted(set().union(*split) - number.keys())
        number.update(zip(new, range(len(number), len(number) + len(new)), strict=True))
        for words in split:
            windows = len(window_starts(len(words)))
            own = np.full((windows - 1) * STRIDE + WINDOW, -1, np.int32)
            own[: len(words)] = list(map(number.__getitem__, words))
            ids.append(own)
            sizes.append(windows)
        if new and self.network.weights:
            x, _ = self.network.inputs(new)
            self.tables = tuple(
                np.concatenate([table, self.network.gates(x, way)])
                for table, way in zip(self.tables, ("ahead", "back"), strict=True)
            )
        windows = np.concatenate(
            [np.lib.stride_tricks.sliding_window_view(own, WINDOW)[::STRIDE] for own in ids]
        )
        logits = self.network.logits(self.tables, windows)
        first = np.cumsum(sizes) - sizes
        return 1 / (1 + np.exp(-np.maximum.reduceat(logits, first).astype(float)))


def score(documents: DataFrame, network: Network, id_column: str = "doc_id") -> DataFrame:
    """``documents`` reduced to (id, score), one row per row: a map without any shuffle.

    Every window of the whole text counts. Null texts and texts without words
    score as one empty window, repeated rows alike; a null id is kept.
    """
    held = documents.sparkSession.sparkContext.broadcast(asdict(network))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(held.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [scorer.scores(texts[part]) for part in blocks(texts, BLOCK, 10_000)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate([np.zeros(0), *found]))], names=["id", "score"]
            )

    rows = documents.select(F.col(id_column).alias("id"), F.col("text"))
    kind = documents.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_column)
