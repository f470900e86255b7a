import zlib
from dataclasses import asdict

import numpy as np
import pytest

from scorebook.llm import toxicity
from scorebook.llm.queries import QUERIES
from scorebook.llm.toxicity import STRIDE, WINDOW, Network, Sample, Scorer, fit, trigrams, window_starts, words_of
from tests.llm.conftest import FOLDER, prose


@pytest.fixture(scope="module")
def network():
    """Untrained, with weights large enough that windows score apart."""
    found = Network(size=5, word_size=4, gram_size=3, buckets=64)
    found.start(["ba", "kulo", "mina", "po"], seed=3)
    for name in found.weights:
        found.weights[name] = found.weights[name] * 3
    return found


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def plain_score(network, text):
    """One window after the other, one word after the other, in double precision."""
    w = {k: v.astype(float) for k, v in network.weights.items()}
    words, h = words_of(text), network.size

    def step(s, word, way):
        flat, _ = trigrams([word], network.buckets)
        x = np.r_[w["word"][network.words.get(word, 0)], w["gram"][flat].mean(0)]
        gx, gs = x @ w[f"{way}_in"] + w[f"{way}_bias"], s @ w[f"{way}_state"]
        z, r = sigmoid(gx[:h] + gs[:h]), sigmoid(gx[h : 2 * h] + gs[h : 2 * h])
        return s + z * (np.tanh(gx[2 * h :] + r * gs[2 * h :]) - s)

    logits = []
    for start in range(0, max(1, len(words)), 1):
        if start % STRIDE or (start and start + WINDOW - STRIDE >= len(words)):
            continue
        window = words[start : start + WINDOW]
        states = np.zeros((len(window), 2 * h))
        for way, order in (("ahead", range(len(window))), ("back", range(len(window) - 1, -1, -1))):
            s = np.zeros(h)
            for t in order:
                s = step(s, window[t], way)
                states[t, slice(0, h) if way == "ahead" else slice(h, None)] = s
        said = states @ w["say"]
        a = np.exp(said[:, 0] - said[:, 0].max()) if len(window) else np.zeros(0)
        total = (a / a.sum() * said[:, 1]).sum() if len(window) else 0.0
        logits.append(total + w["say_bias"][0] + network.base)
    return sigmoid(max(logits))


def test_windows_overlap_and_hold_every_word():
    for n in range(200):
        starts = list(window_starts(n))
        covered = {i for s in starts for i in range(s, min(n, s + WINDOW))}
        assert covered == set(range(n)) and starts[0] == 0
        assert all(b - a == STRIDE < WINDOW for a, b in zip(starts, starts[1:], strict=False))
        assert len(starts) == 1 or starts[-1] + WINDOW - STRIDE < n


def test_scores_equal_a_plain_reading_of_every_window(network, odd_rows):
    texts = [t for _, t, _, _ in odd_rows if len(t or "") < 5000] + [prose(s, n) for s, n in ((1, 32), (2, 33), (3, 57), (4, 500))]
    scorer = Scorer(asdict(network))
    found = scorer.scores(texts)
    assert found == pytest.approx([plain_score(network, t) for t in texts], abs=1e-4)
    assert len(set(found.round(4))) > 5
    # Also one at a time, and with nothing remembered.
    assert Scorer(asdict(network)).scores(texts[-1:])[0] == pytest.approx(found[-1], abs=1e-5)


def test_the_worst_window_decides_wherever_it_is(network):
    scorer = Scorer(asdict(network))
    quiet, loud = prose(1, 3000).split(), prose(9, WINDOW).split()
    alone = scorer.scores([" ".join(quiet)])[0]
    found = scorer.scores([" ".join(quiet[:at] + loud + quiet[at:]) for at in (0, 24 * 60, 3000)])
    assert (found >= min(alone, scorer.scores([" ".join(loud)])[0]) - 0.2).all()


def test_gradients_equal_differences(network):
    r = np.random.default_rng(1)
    vocabulary = ["ba", "kulo", "x", "nevermet", "é"]
    ids = r.integers(0, 5, (6, WINDOW))
    for row, n in enumerate((WINDOW, 3, 1, 0, 20, 31)):
        ids[row, n:] = -1
    y, weight = np.array([1, 0, 1, 0, 1, 0.0]), r.random(6)
    kept = r.choice([0, 1, 2], (5, network.word_size + network.gram_size))
    known = np.array([1, 0, 1, 1, 1])
    exact = Network(**asdict(network))
    exact.weights = {k: v.astype(np.float64) / 3 for k, v in network.weights.items()}
    _, grads = exact.gradients(vocabulary, ids, y, weight, kept, known)
    for name, w in exact.weights.items():
        for at in r.choice(w.size, min(6, w.size), replace=False):
            place, step = np.unravel_index(at, w.shape), 1e-3
            losses = []
            for sign in (1, -1):
                w[place] += sign * step
                losses.append(exact.gradients(vocabulary, ids, y, weight, kept, known)[0])
                w[place] -= sign * step
            assert grads[name][place] == pytest.approx((losses[0] - losses[1]) / (2 * step), abs=2e-3), name


def planted(n, start=0):
    """Every third text has one of a few words somewhere, in some case and next to marks."""
    rows = []
    for i in range(start, start + n):
        words = prose(i, 60 + i % 90).split()
        if i % 3 == 0:
            words.insert((i * 7) % len(words), ["Vorkish,", "GRUMPLE!", "(skorn)"][i % 9 // 3])
        rows.append((" ".join(words), int(i % 3 == 0)))
    return rows


def test_learns_words_of_toxic_texts_and_their_near_forms():
    def windows(text):
        words = words_of(text)
        return [" ".join(words[s : s + WINDOW]) for s in window_starts(len(words))]

    rows = planted(400)
    model = fit(Sample.of_texts([windows(t) for t, _ in rows], [y for _, y in rows]))
    scorer, test = Scorer(asdict(model)), planted(150, 1000)
    right = (scorer.scores([t for t, _ in test]) >= 0.5) == [bool(y) for _, y in test]
    assert right.mean() >= 0.97
    assert scorer.scores([prose(5000, 40) + " vorkishness " + prose(5001, 40)])[0] >= 0.5


def test_odd_rows(spark, odd, odd_rows, empty):
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (10, 0), (10, 1), (None, 1), (3, None), (6, 0), (7, 0), (8, 1)], "doc_id long, toxic int"
    )
    model = toxicity.train(odd, labels)
    found = toxicity.score(odd, model).collect()
    assert len(found) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in found)
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in odd_rows)
    # The same model from rows in another order, and the same scores by a plain reading.
    again = toxicity.train(odd.repartition(5, "text"), labels)
    assert all((again.weights[k] == v).all() for k, v in model.weights.items())
    assert toxicity.score(empty, model).collect() == []
    untrained = toxicity.train(empty, labels.limit(0))
    assert {r["score"] for r in toxicity.score(odd, untrained).collect()} == {0.5}


def test_held_out_labels_are_not_learned(spark, make):
    ids = [i for i in range(80) if zlib.crc32(str(i).encode()) % 5 == 0]
    documents = make([(i, prose(i, 50), "en", "a") for i in ids])
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    assert not toxicity.train(documents, labels).weights


def test_held_out_accuracy(spark):
    folder = str(FOLDER).replace("sf0.001", "sf0.01")
    found = QUERIES["op11_toxicity"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic").distinct()
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert sum(r["predicted"] == r["toxic"] for r in rows) / len(rows) >= 0.93
    clean = [r for r in rows if r["toxic"] == 0]
    assert sum(r["predicted"] for r in clean) / len(clean) <= 0.03
