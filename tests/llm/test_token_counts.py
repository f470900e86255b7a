import pytest
from scorebook.llm.queries import default_vocabulary
from scorebook.llm.token_counts import CHUNK, TextCounter, Vocabulary, token_counts

from tests.llm.conftest import prose

tokenizers = pytest.importorskip("tokenizers")
tiktoken = pytest.importorskip("tiktoken")

TEXTS = [
    "",
    " ",
    "a\n\nb",
    "  x  y ",
    "don't we'll  ' s 'll",
    "\x1c\x1d a 　　b c\x85d",
    "<|endoftext|>hi <|endoftext|> x<|endoftext|>",
    "日本語 テキスト 🎉🎉 é",
    "x" * (3 * CHUNK + 5),
    "y" * CHUNK + " " * (2 * CHUNK) + "z\n" * CHUNK,
    "1234567890 " * 5000,
    prose(3, 20_000),
    prose(4, 9_000).upper() + "!!",
]


def test_counts_are_the_librarys():
    library = tokenizers.Tokenizer.from_file(default_vocabulary())
    counter = TextCounter(Vocabulary.load(default_vocabulary()))
    expected = [len(e.ids) for e in library.encode_batch(TEXTS, add_special_tokens=False)]
    assert [counter.count(t) for t in TEXTS] == expected


def test_chunk_maps_compose_in_any_grouping():
    counter = TextCounter(Vocabulary.load(default_vocabulary()))
    text = "one two  three\n\nfour'll five " * 3
    parts = [counter.chunk_map(text[i : i + 7]) for i in range(0, len(text), 7)]
    left = parts[0]
    for part in parts[1:]:
        left = counter.compose(left, part)
    right = parts[-1]
    for part in parts[-2::-1]:
        right = counter.compose(part, right)
    assert left == right


def test_rank_files_too():
    import base64

    import public_tokenizers as P

    path = P.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding(
        "own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    counter = TextCounter(Vocabulary.load(path))
    for text in (prose(5, 3000), "don't  stop\n\n日本語 1234 <|endoftext|>"):
        assert counter.count(text) == len(library.encode_ordinary(text))


def test_odd_rows(odd, odd_rows, empty):
    library = tokenizers.Tokenizer.from_file(default_vocabulary())
    found = token_counts(odd, default_vocabulary()).collect()
    texts = [t or "" for _, t, _, _ in odd_rows]
    sizes = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    expected = [
        (i, len(t.encode()), n, n > 512)
        for (i, *_), t, n in zip(odd_rows, texts, sizes, strict=True)
    ]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))
    assert token_counts(empty, default_vocabulary()).collect() == []


def test_other_kinds_of_vocabulary_are_refused():
    with pytest.raises(ValueError, match="not a plain byte-level vocabulary"):
        Vocabulary.load(default_vocabulary("word_bpe_49k.json"))
