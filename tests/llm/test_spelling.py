import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow.parquet as pq
import pytest

from scorebook.llm import spelling
from scorebook.llm.queries import QUERIES
from tests.llm.conftest import FOLDER, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, damage=31):
    """The words and counts of (doc_id, text) rows, one occurrence after the other."""
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if damage and h % damage == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    """By the definition: one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_force(words, times=10):
    """Every word against every other of a like length."""
    sizes = {}
    for w in words:
        sizes.setdefault(len(w), []).append(w)
    out = {}
    for w, n in words.items():
        near = [v for k in (-1, 0, 1) for v in sizes.get(len(w) + k, []) if one_edit(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form = best if best and words[best] >= times * n else None
        out[w] = [form, n, len(near), words[form] if form else None]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def as_dict(df):
    rows = df.collect()
    found = {r["word"]: (r["form"], r["n"], r["n_near"], r["form_n"], r["root"]) for r in rows}
    assert len(found) == len(rows)
    return found


def test_neighbourhood_is_every_string_one_edit_away():
    symbols = np.array(sorted(map(ord, set(spelling.alphabet(4)))), np.uint32)
    letters = [chr(s) for s in symbols]
    word = "".join(letters[i] for i in (0, 1, 1, 3, 2, 0, 2))
    strings = {word}
    for i in range(len(word) + 1):
        strings |= {word[:i] + s + word[i:] for s in letters}
        strings |= {word[:i] + s + word[i + 1 :] for s in letters if i < len(word)}
        strings |= {word[:i] + word[i + 1 :]} if i < len(word) else set()
    codes = lambda s: np.array([list(map(ord, s))], np.uint32)
    expected = {int(spelling._hashes(codes(s))[0]) for s in strings}
    assert len(expected) == len(strings)
    assert set(spelling.neighbourhood(codes(word), symbols)[0].tolist()) == expected


def test_alphabet_is_dealt_evenly_and_grows_with_the_vocabulary():
    for k in (4, 7, len(spelling.LETTERS)):
        sizes = Counter(spelling.alphabet(k)).values()
        assert len(sizes) == k and max(sizes) - min(sizes) <= 1
    assert [spelling.symbols_for(n, 7) for n in (0, 8 * 4**7, 8 * 4**7 + 1, 10**9)] == [4, 4, 5, 15]


def test_groups_equal_brute_force_with_chains_ties_and_hot_words(spark, make):
    r = random.Random(5)
    letters = "abcdeéÀz"
    base = ["".join(r.choices(letters, k=r.randint(7, 10))) for _ in range(40)]
    words = Counter()
    for b in base:
        words[b] += r.choice([2, 20, 300])
        for _ in range(12):
            at = r.randrange(len(b))
            words[r.choice([b[:at] + b[at + 1 :], b[:at] + r.choice(letters) + b[at:], b[:at] + "z" + b[at + 1 :]])] += r.choice([2, 3, 25])
    words.update({"chained": 4000, "chaineds": 300, "chainedst": 20, "chainedstz": 2, "tiewordsa": 20, "tiewordsb": 20, "tiewordsc": 2})
    rows = [(i, " ".join([w] * n), "en", "a") for i, (w, n) in enumerate(words.items())]
    expected = brute_force(counted([(i, t) for i, t, _, _ in rows], damage=0))
    assert expected["chainedstz"][-1] == "chained" and expected["tiewordsc"][0] == "tiewordsa"
    assert as_dict(spelling.spelling_groups(make(rows))) == expected


def test_many_words_behind_one_reduced_word(spark, make):
    """Words of letters that share their symbols: one cell holds them all."""
    alphabet = spelling.alphabet(4)
    same = [x for x, s in zip(spelling.LETTERS, alphabet, strict=True) if s == alphabet[0]][:6]
    r = random.Random(6)
    words = {"".join(r.choices(same, k=7)) for _ in range(400)}
    rows = [(i, f"{w} {w}", "en", "a") for i, w in enumerate(sorted(words))]
    found = as_dict(spelling.spelling_groups(make(rows)))
    assert found == brute_force({w: 2 for w in words})
    assert any(v[2] for v in found.values())


def test_odd_rows(spark, make, odd_rows, empty):
    long = "ab" * 20_000
    rows = [*odd_rows, (20, f"{long} {long} {long}x {long}x", None, None), (None, "Damaged damaged DAMAGED", None, None)]
    found = spelling.spelling_groups(make(rows), damage=31)
    expected = brute_force(counted([(i, t) for i, t, _, _ in rows]))
    assert as_dict(found) == expected and expected[long][2] == 1
    assert spelling.spelling_groups(empty).collect() == []


@pytest.mark.parametrize("folder", [FOLDER])
def test_query_equals_brute_force_on_the_whole_table(spark, folder):
    table = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"])
    rows = list(zip(*(table.column(c).to_pylist() for c in ("doc_id", "text")), strict=True))
    expected = brute_force(counted(rows))
    assert as_dict(QUERIES["op12_spelling_variants"](spark, str(folder))) == expected
    assert len(expected) > 1000 and any(v[0] for v in expected.values())


def test_prose_without_repeats_has_no_words(spark, make):
    assert spelling.spelling_groups(make([(1, prose(3, 1), "en", "a")])).collect() == []
