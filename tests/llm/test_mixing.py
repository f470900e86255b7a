import pytest
from pyspark.sql import functions as F
from scorebook.llm.mixing import mix, source_targets

from tests.llm.conftest import prose


def filled(sizes, weights, most):
    """Shares by weight, the excess over the caps dealt again until there is none."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, free = dict.fromkeys(order, 0.0), float(sum(sizes.values())), set(order)
    while left > 1e-9 and free:
        total = sum(weight[s] for s in free)
        share = {s: left * weight[s] / total for s in free}
        left = 0.0
        for s in list(free):
            target[s] += share[s]
            if target[s] > most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                free.discard(s)
    return target


@pytest.mark.parametrize("weights,most", [((5.0, 2.0, 1.0), 3.0), ((1.0,), 1.0), ((100.0, 1.0), 2.0)])
def test_targets(spark, weights, most):
    sizes = {"a": 10, "Z": 500, "é": 40, None: 70, "b": 0, "c": 1}
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    found = {r["source"]: r["target"] for r in source_targets(rows, weights, most).collect()}
    assert found == pytest.approx(filled(sizes, weights, most))


def words(text):
    return len((text or "").encode().split())


def test_taken_words_come_near_their_targets(make):
    rows = [(i, prose(i, 20 + i % 60), "en", f"s{i % 4}" if i % 9 else None) for i in range(400)]
    documents = make(rows)
    mixed = mix(documents)
    size, source_size, target, copies, taken = mixed.columns[-5:]
    found = mixed.collect()
    assert len(found) == len(rows) and mixed.columns[: len(documents.columns)] == documents.columns
    for source in {r["source"] for r in found}:
        own = [r for r in found if r["source"] == source]
        assert own[0][source_size] == sum(words(r["text"]) for r in own)
        assert sum(r[taken] for r in own) == pytest.approx(own[0][target], rel=0.01)
    assert all(r[taken] == r[copies] * words(r["text"]) and 0 <= r[copies] <= 3 for r in found)
    again = mix(make(rows[::-1])).collect()
    assert {(r["doc_id"], r[taken]) for r in found} == {(r["doc_id"], r[taken]) for r in again}


def test_fewer_copies_than_expected_is_rare(make):
    """Whole copies are certain: only the rest of the ratio is drawn."""
    rows = [(i, "w " * 10, "en", "ab"[i % 10 > 0]) for i in range(200)]
    found = mix(make(rows), weights=(1.0, 1.0))
    size, source_size, target, copies, taken = found.columns[-5:]
    shares = found.groupBy("source").agg(F.min(copies).alias("low"), F.max(copies).alias("high"), F.first(target).alias("t"))
    assert {r["source"]: (r["low"], r["high"], r["t"]) for r in shares.collect()} == {
        "a": (3, 3, 600.0), "b": (0, 1, 1400.0)
    }


def test_inclusions_follow_their_probabilities(make):
    """Three lengths in one source: how often each is taken, against p, and rank against its formula."""
    lengths = {10: 3000, 30: 800, 90: 200}
    rows = [(i, "w " * n + str(i), "en", "a") for i, n in enumerate(n for n, k in lengths.items() for _ in range(k))]
    rows += [(10_000 + i, "w " * 400, "en", "b") for i in range(150)]
    found = mix(make(rows), weights=(1.0, 3.0), most=2.0)
    size, source_size, target, copies, taken = found.columns[-5:]
    own = [r for r in found.where("source = 'a'").collect()]
    total, goal = own[0][source_size], own[0][target]
    assert 0.2 < goal / total < 0.8
    mean = total / len(own)
    favour = {r[size]: 2 + min(2, int(r[size] // mean)) for r in own}
    assert sorted(favour.values()) == [2, 3, 4]
    weighted = sum(favour[r[size]] * r[size] for r in own)
    for n, k in zip(sorted(favour), lengths.values(), strict=True):
        p = min(1, goal * favour[n] / weighted)
        share = sum(r[copies] for r in own if r[size] == n) / k
        assert share == pytest.approx(p, abs=4 * (p * (1 - p) / k) ** 0.5 + 0.01)
    assert sum(r[taken] for r in own) == pytest.approx(goal, rel=0.002)


def test_pareto_rank_is_the_ratio_of_odds(spark):
    from scorebook.llm.mixing import UNIT, pareto_rank

    pairs = [(u, p) for u in (0.001, 0.3, 0.7, 0.999) for p in (0.0, 0.1, 0.5, 0.9, 1.0)]
    rows = spark.createDataFrame([(int(u * UNIT), p) for u, p in pairs], "u long, p double")
    found = [r[0] / UNIT for r in rows.select(pareto_rank(F.col("u"), F.col("p"))).collect()]
    for (u, p), rank in zip(pairs, found, strict=True):
        odds = u / (1 - u) * (1 - p) / p if p else float("inf")
        assert rank == pytest.approx(odds / (1 + odds) if p else 1.0, abs=1e-9)


def test_odd_rows(odd, odd_rows, empty):
    found = mix(odd)
    size, source_size, target, copies, taken = found.columns[-5:]
    rows = found.collect()
    assert len(rows) == len(odd_rows)
    assert all(r[taken] <= 3 * r[size] for r in rows)
    repeated = {r[copies] for r in rows if r["doc_id"] == 1}
    assert len(repeated) == 1
    assert mix(empty).collect() == []
