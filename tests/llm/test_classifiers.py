import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from scorebook.llm import language_id, quality_classifier
from scorebook.llm.quality_classifier import FEATURES, AdditiveModel, features
from scorebook.llm.queries import QUERIES

from tests.llm.conftest import FOLDER, prose


def test_additive_model_learns_shapes_and_interactions():
    r = np.random.default_rng(1)
    x = r.uniform(-1, 1, (3000, 4))
    y = (np.abs(x[:, 0]) - 0.5 + 4 * x[:, 1] * x[:, 2] > 0).astype(float)
    model = AdditiveModel().fit(x[:2000], y[:2000])
    alone = AdditiveModel(pair_rounds=0).fit(x[:2000], y[:2000])
    right = lambda m: ((m.score(x[2000:]) >= 0.5) == y[2000:]).mean()
    assert (1, 2) in model.pair_tables
    assert right(model) > right(alone) + 0.1 and right(model) > 0.85


def test_without_both_classes_the_share_is_the_score():
    none = AdditiveModel().fit(np.zeros((0, 3)), np.zeros(0))
    assert none.score(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    ones = AdditiveModel().fit(np.zeros((9, 3)), np.ones(9))
    assert ones.score(np.zeros((1, 3)))[0] == pytest.approx(0.95)


def test_features_of_odd_texts(odd_rows):
    for _, text, _, _ in odd_rows:
        found = features(text)
        assert len(found) == len(FEATURES) and np.isfinite(found).all()


def test_quality_on_odd_rows(spark, odd, odd_rows, empty):
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 1, 0), (10, 0, 0), (10, 0, 0), (None, 1, 0), (3, None, 0), (6, 0, 1)],
        "doc_id long, quality int, toxic int",
    )
    model = quality_classifier.train(odd, labels)
    found = quality_classifier.score(odd, model).collect()
    assert len(found) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in found)
    assert quality_classifier.accepted(odd, model).columns == odd.columns
    assert quality_classifier.score(empty, model).collect() == []
    untrained = quality_classifier.train(empty, labels.limit(0))
    assert {r["score"] for r in quality_classifier.score(odd, untrained).collect()} == {0.5}


def test_held_out_labels_are_not_learned(spark, make):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 == 1]
    documents = make([(i, prose(i, 50), "en", "a") for i in ids])
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    model = quality_classifier.train(documents, labels)
    assert not model.tables


def test_held_out_accuracy(spark):
    folder = str(FOLDER.parent / "sf0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = QUERIES["op7_quality_classifier"](spark, folder)
    held = scored.where("held_out").join(labels, "doc_id")
    assert held.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] > 0.95
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    named = QUERIES["op9_language_id"](spark, folder).where("held_out").join(documents, "doc_id")
    assert named.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] > 0.97


LATIN = {"aa": "ba be bo bi lo la", "bb": "xu xi xo gru gri gro"}


def speech(lang, seed, words):
    r = random.Random(seed)
    syllables = (LATIN | {"cc": "да не ми то ро"})[lang].split()
    return " ".join("".join(r.choices(syllables, k=3)) for _ in range(words))


def best_path(scores, penalty):
    """Viterbi by trying every path."""
    from itertools import product

    def value(path):
        total = sum(scores[i][s] for i, s in enumerate(path))
        return total - penalty * sum(a != b for a, b in zip(path, path[1:], strict=False))

    return max(value(p) for p in product(range(len(scores[0])), repeat=len(scores)))


def test_spans_of_mixed_texts(make, odd, odd_rows, empty):
    rows = [(i, speech("aabbcc"[i % 3 * 2 : i % 3 * 2 + 2], i, 60), ("aa", "bb", "cc")[i % 3], "s") for i in range(60)]
    model = language_id.train(make(rows))
    assert model.languages == ["aa", "bb", "cc"]
    a, b, c = speech("aa", 900, 12), speech("bb", 901, 15), speech("cc", 902, 5)
    mixed = make([(1, f"{a} 12, {b}: {c}", None, "x"), (2, c, None, "x"), (3, "12 - 34", "aa", "x")])
    found = {r["doc_id"]: r for r in language_id.identify(mixed, model).collect()}
    spans = [(s["from"], s["to"], s["lang"]) for s in found[1]["spans"]]
    second = len(a) + 5
    third = second + len(b) + 2
    assert spans == [(0, len(a), "aa"), (second, second + len(b), "bb"), (third, third + len(c), "cc")]
    assert found[1]["lang_pred"] == "bb" and 0 < found[1]["score"] < 1
    assert (found[2]["lang_pred"], found[2]["score"]) == ("cc", 1.0)
    assert (found[3]["lang_pred"], found[3]["score"], found[3]["spans"]) == ("und", 0.0, [])

    words = language_id.split([f"{speech('aa', 5, 3)} {speech('bb', 6, 4)}", "", speech("cc", 7, 2)])
    scores = model.word_scores(words)
    labels = model.label(words, 3)
    for text in (0, 2):
        own = np.flatnonzero(words.text == text)
        path = labels[own]
        got = scores[own, path].sum() - model.penalty * (path[1:] != path[:-1]).sum()
        assert got == pytest.approx(best_path(scores[own].tolist(), model.penalty))

    pairs = [(r["doc_id"], r["lang_pred"]) for r in language_id.identify(odd, model).collect()]
    assert len(pairs) == len(odd_rows)
    assert {lang for i, lang in pairs if i in (3, 4, 5)} == {"und"}
    assert language_id.identify(empty, model).collect() == []
    nothing = language_id.train(empty)
    assert {r["lang_pred"] for r in language_id.identify(odd, nothing).collect()} == {"und"}
