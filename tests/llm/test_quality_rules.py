import math
import re
from collections import Counter

import pytest
from scorebook.llm.quality_rules import _PASSES, CLASSES, quality_rules

from tests.llm.conftest import FOLDER, prose

WORD = r"[^\x20\x09-\x0D]+"


def base(text):
    words = re.findall(WORD, text or "")
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


def classes(text):
    counts, left = dict.fromkeys(CLASSES, 0), text
    for name, pattern in _PASSES:
        if name == "letter":
            shorter = "".join(c for c in left if not c.isalpha())
        else:
            shorter = re.sub(pattern.replace("\\x09-\\x0D", "\t-\r"), "", left)
        counts[name], left = len(left) - len(shorter), shorter
    counts["rest"] = len(left)
    return counts


def distance(p, q):
    total = 0.0
    for k in {*p, *q}:
        a, b = p.get(k, 0.0), q.get(k, 0.0)
        total += (a and a * math.log2(2 * a / (a + b))) + (b and b * math.log2(2 * b / (a + b)))
    return math.sqrt(max(0.0, total / 2))


def shares(counts, words, common):
    found = {w: counts[w] / max(1, words) for w in common if counts[w]}
    return found | {None: max(0.0, 1 - sum(found.values()))}


def test_against_brute_force(spark):
    """Counts, distances and verdicts of the smallest folder, from the definition."""
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = documents.collect()
    found = {r["doc_id"]: r for r in quality_rules(documents, common=20).collect()}
    bags = {r["doc_id"]: Counter(w.lower() for w in re.findall(WORD, r["text"])) for r in rows}
    sizes = {r["doc_id"]: base(r["text"])[0] for r in rows}
    references = []
    for lang in sorted({r["lang"] for r in rows}):
        own = [r for r in rows if r["lang"] == lang]
        letters, words = Counter(), Counter()
        for r in own:
            letters.update(classes(r["text"]))
            words.update(bags[r["doc_id"]])
        best = dict(sorted(words.items(), key=lambda x: (-x[1], x[0]))[:20])
        n = sum(sizes[r["doc_id"]] for r in own)
        references.append(({k: v / letters.total() for k, v in letters.items()}, shares(best, n, best), list(best)))
    for r in rows:
        f, text = found[r["doc_id"]], r["text"]
        got = tuple(f[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert got == base(text)
        counts = classes(text)
        mine = {k: v / max(1, sum(counts.values())) for k, v in counts.items()}
        near = min(
            (distance(mine, c) + distance(w, shares(bags[r["doc_id"]], f["n_words"], common)),
             distance(mine, c), distance(w, shares(bags[r["doc_id"]], f["n_words"], common)))
            for c, w, common in references
        )
        assert f["class_distance"] == pytest.approx(near[1], abs=1e-6)
        assert f["word_distance"] == pytest.approx(near[2], abs=1e-6)
        failed = f["n_words"] < 50 or 100 * f["n_repeat_words"] > 50 * f["n_words"]
        assert f["base_failed"] == failed
        near_enough = near[1] <= 0.28 and (f["n_words"] < 80 or near[2] <= 0.4)
        assert f["kept"] == (not failed and near_enough)


def test_odd_rows(odd, odd_rows, empty):
    found = quality_rules(odd).collect()
    got = [(r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, [(i, *base(t)) for i, t, *_ in odd_rows]))
    assert not any(r["kept"] for r in found if r["n_words"] < 50)
    assert quality_rules(empty).collect() == []


def test_without_languages_only_the_base_rule_holds(make):
    rows = [(1, "#### " * 30 + prose(1, 100), None, "a"), (2, "short", None, "a")]
    assert {r["doc_id"]: r["kept"] for r in quality_rules(make(rows)).collect()} == {1: True, 2: False}
