import random
from collections import Counter

import pytest
from scorebook.llm.suffix_dedup import PIECE, remove_repeats

from tests.llm.conftest import prose


def brute_force(texts, length):
    raws = [(t or "").encode() for t in texts]
    counts = Counter(hash(r[i : i + length]) for r in raws for i in range(len(r) - length + 1))
    for raw in raws:
        gone = bytearray(len(raw))
        reach = 0
        for i in range(len(raw) - length + 1):
            if counts[hash(raw[i : i + length])] > 1:
                start = max(reach, i)
                gone[start : i + length] = b"\x01" * (i + length - start)
                reach = i + length
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        yield len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone, strict=True) if not g)


def check(df, rows, **lengths):
    found = remove_repeats(df, **lengths).collect()
    length = lengths.get("length", 400)
    expected = [
        (i, *x) for (i, *_), x in zip(rows, brute_force([r[1] for r in rows], length), strict=True)
    ]
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, expected))


@pytest.mark.parametrize("length,core", [(400, 100), (60, 20), (50, 50)])
def test_passages_in_other_surroundings(make, length, core):
    r = random.Random(length)
    shared = [prose(100 + i, 130) for i in range(4)]
    rows = []
    for i in range(40):
        parts = [prose(i, 60)]
        for _ in range(r.randint(0, 3)):
            text = r.choice(shared)
            a = r.randint(0, len(text) // 2)
            parts += [text[a : a + r.randint(length - 30, length + 200)], prose(1000 + r.randint(0, 99), 20)]
        rows.append((i, "".join(parts), "en", "a"))
    rows += [(100, "ab" * 900, "en", "a"), (101, "a" * 700, "en", "a"), (102, rows[3][1], "en", "b")]
    check(make(rows), rows, length=length, core=core)


def test_odd_rows(odd, odd_rows, empty):
    check(odd, odd_rows)
    assert remove_repeats(empty).collect() == []


def test_a_text_longer_than_a_piece(make):
    """Pieces overlap: a repeat across the border of two is found."""
    text = prose(9, 200_000)[: PIECE + 5000]
    assert len(text) > PIECE
    rows = [(1, text, "en", "a"), (2, text[PIECE - 600 : PIECE + 700], "en", "a"), (3, text[:300], "en", "a")]
    found = {r["doc_id"]: r for r in remove_repeats(make(rows)).collect()}
    assert [tuple(s) for s in found[1]["spans"]] == [(PIECE - 600, PIECE + 700)]
    assert found[2]["kept"] == b"" and found[3]["n_removed"] == 0
