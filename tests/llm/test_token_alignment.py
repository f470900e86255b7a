import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from scorebook.llm import token_alignment
from scorebook.llm.queries import QUERIES
from scorebook.llm.token_alignment import Aligned, Encoder, align_tokens, group_starts
from tests.llm.conftest import FOLDER

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(FILES[0])
    first.encode_special_tokens = True
    return first, SentencePieceProcessor(model_file=FILES[1])


def byte_table():
    """The bytes-to-characters rule of byte-level vocabularies, by its definition."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    table, free = {}, 256
    for b in range(256):
        table[chr(b) if b in shown else chr(free)] = b
        free += b not in shown
    return table


def tokens_of(libraries, text):
    """(id, bytes) of both tokenizers over the whole text, as the libraries give them."""
    first, second = libraries
    table = byte_table()
    a = first.encode(" " + text, add_special_tokens=False).ids
    a = [(i, bytes(table[c] for c in first.id_to_token(i))) for i in a]
    b = []
    for i in second.encode(text):
        piece = second.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if any(b"".join(x for _, x in side) != whole for side in (a, b)):
        return [], []
    return a, b


def brute_force(libraries, texts):
    """Figures of each text, from sets of ends and all link pairs."""
    documents = []
    for text in texts:
        a, b = tokens_of(libraries, text) if text else ([], [])
        groups, ends = [], []
        for side in (a, b):
            at, found = 0, []
            for i, raw in side:
                at += len(raw)
                found.append((at, i))
            ends.append(found)
        cuts = {e for e, _ in ends[0]} & {e for e, _ in ends[1]}
        sides = []
        for found in ends:
            sides.append([[]])
            for end, i in found:
                sides[-1][-1].append(i)
                if end in cuts:
                    sides[-1].append([])
        groups = [[x, y] for x, y in zip(*(side[:-1] for side in sides), strict=True)]
        documents.append((len(a), len(b), groups))
    held = Counter()
    for _, _, groups in documents:
        held.update({(x, y) for ga, gb in groups for x in ga for y in gb})
    best = {}
    for (x, _), n in held.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for n_a, n_b, groups in documents:
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        spelt = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        digest = hashlib.sha256(spelt.encode()).hexdigest() if groups else ""
        n_best = sum(held[p] == best[p[0]] for p in links)
        out.append((n_a, n_b, len(groups), len(links), n_best, sum(held[p] for p in links), digest))
    return out


def figures(df, id_column="doc_id"):
    return sorted(((r[id_column], *(r[f] for f in FIGURES)) for r in df.collect()), key=repr)


def test_groups_by_parting_equal_shared_ends():
    r = random.Random(1)
    for _ in range(300):
        sides, starts = ([], []), ([0], [0])
        at = 0
        for _ in range(r.randint(1, 4)):
            size = r.choice([0, 1, 2, 7, 60])
            for side, start in zip(sides, starts, strict=True):
                share = r.choice([0.1, 0.5, 0.9])
                inner = [e for e in range(1, size) if r.random() < share]
                side.extend(at + e for e in [*inner, *([size] if size else [])])
                start.append(len(side))
            at += size
        a, b = (np.array(s, np.int64) for s in sides)
        found = group_starts(a, b, *(np.array(s) for s in starts))
        shared = [0, *sorted(set(sides[0]) & set(sides[1]))][: -1 if at else None]
        assert found[0].tolist() == [int(np.searchsorted(a, s, "right")) for s in shared if at]
        assert found[1].tolist() == [int(np.searchsorted(b, s, "right")) for s in shared if at]


@pytest.mark.parametrize("large", [1, 1024])
def test_odd_rows_equal_brute_force(spark, make, odd_rows, empty, libraries, large, monkeypatch):
    monkeypatch.setattr(token_alignment, "LARGE", large)
    texts = [
        "  two  spaces \n\n lines\n\tand tabs \r\n", "a b c　d\x1c e\x85f \x1f", "<s> </s> <unk> <0x41> ▁ <|endoftext|>",
        "it's they'll 1234567 12 34 $5.00", "🎉🎉👩‍👩‍👧 日本語のテキスト ไทย", "ﬁ Å ①", " lead", "trail ", "   ", "\n", "x",
        "abab" * 400, "\x00\x01 �", "the the the cat", "é" * 900, "- -- --- ----- " * 30,
    ]
    rows = [*odd_rows, *((100 + i, t, "en", None) for i, t in enumerate(texts))]
    expected = brute_force(libraries, [t for _, t, _, _ in rows])
    expected = sorted(((r[0], *e) for r, e in zip(rows, expected, strict=True)), key=repr)
    assert figures(align_tokens(make(rows), *FILES, buckets=3)) == expected
    assert align_tokens(empty, *FILES).collect() == []


def test_white_space_before_a_word_and_at_the_end(spark, make, libraries):
    """Runs of it lose their last character to a token of its own where a word follows."""
    runs = ["\n\n", "\n", "\r\n", "\r\n\r\n", "\r\r", "\n \n", "\xa0\xa0", "\n\xa0", " \u3000", "\t\t", "\x85", " \n\n "]
    texts = [f"{run}one{run}two.{run}3{run}" for run in runs] + [f"one{run}" for run in runs] + runs
    texts.append("".join(f"word{run}" for run in runs))
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    expected = sorted(((i, *e) for i, e in enumerate(brute_force(libraries, texts))), key=repr)
    assert figures(align_tokens(make(rows), *FILES)) == expected


def test_blocks_of_texts_change_nothing(spark, make, odd_rows, monkeypatch):
    whole = figures(align_tokens(make(odd_rows), *FILES))
    monkeypatch.setattr(token_alignment, "BLOCK", 50)
    monkeypatch.setattr(token_alignment, "KEPT", 5)
    monkeypatch.setattr(token_alignment, "HELD", 5)
    assert figures(align_tokens(make(odd_rows), *FILES, buckets=1)) == whole


@pytest.fixture
def encoder():
    files = []
    for name in FILES:
        with open(name, "rb") as file:
            files.append(file.read())
    return Encoder(*files)


def test_a_repeated_chunk_is_parted_once(encoder, monkeypatch):
    """Groups of a chunk are remembered with its tokens, not looked for in every text that has it."""
    handed = []

    def counted(a_end, *others):
        handed.append(len(a_end))
        return group_starts(a_end, *others)

    monkeypatch.setattr(token_alignment, "group_starts", counted)
    sizes = tuple(side.size for side in encoder.sides)
    text = "ungauschzuach Thanesea, tokenizers misaligned\n\nhere"
    once = Aligned(encoder.encode([text]), sizes)
    many = Aligned(encoder.encode([text, None, *[text] * 50]), sizes)
    assert sum(handed) == len(once.tokens.a)
    assert len(many.a_at) == 51 * len(once.a_at) > 51
    assert many.figures()["n_links"].tolist() == [once.links.sum(), 0, *[once.links.sum()] * 50]


def test_chunks_used_again_outlive_those_used_once(encoder, monkeypatch):
    monkeypatch.setattr(token_alignment, "KEPT", 8)
    encoder.encode(["common words"] * 3)
    encoder.encode([" ".join(f"rare{c}" for c in "abcdefgh")])
    encoder.encode(["x"])
    assert " common" in encoder.number and " words" in encoder.number
    assert " rarea" not in encoder.number
    tokens = encoder.encode(["words rareb common"])
    for side, ids in zip(encoder.sides, (tokens.a, tokens.b), strict=True):
        assert b"".join(side.bytes[i] for i in ids) == b" words rareb common"


def test_query_equals_brute_force_on_the_whole_table(spark, libraries):
    table = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text"])
    ids, texts = (table.column(c).to_pylist() for c in ("doc_id", "text"))
    expected = brute_force(libraries, texts)
    expected = sorted(((i, *e) for i, e in zip(ids, expected, strict=True)), key=repr)
    assert figures(QUERIES["op13_token_alignment"](spark, str(FOLDER))) == expected
