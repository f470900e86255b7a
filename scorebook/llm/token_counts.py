"""Token counts by a compiled transducer.

A byte-level BPE vocabulary is compiled into a deterministic transducer whose
transitions carry the number of tokens they add. It is built where texts lead
it. A state knows the longest end of what was read that starts some token, and
the last token at each place in that end; no later token can start before it.
Reading a byte, the new last token is the longest vocabulary entry that ends
there and is *compatible* with the last token before it, that is, the two stay
apart when tokenized together. This determines the merge-order tokenization,
so no merges are simulated on texts, and words that end alike share states.

A text is cut into chunks. A chunk's state map is either *open* (no place in
it where every state agrees) or *closed*: a head that completes whatever came
before, a count that holds from any state, and a tail whose state the next
chunk receives. White space after a non-space is such a place. Maps compose
associatively, and a parallel-prefix tree composes the chunks of a text.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorebook.llm.shared import Shipped, map_arrow

#: Unicode white space, and the byte-level pattern that splits texts into pieces.
SPACE = r"\t-\r \x85\xa0  -     　"
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d"
    r"| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)

#: The longest end of what was read that starts some token, and for each place in it, before
#: its first byte to after its last, the last token there and the tokens relative to the end.
State = tuple[bytes, tuple[tuple[bytes, int], ...]]

CHUNK = 1 << 15
EMITS_FROM = 512
MAX_STATES = 350_000
MAX_WORDS = 400_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes
    stand for themselves, the others for the code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass(frozen=True)
class Vocabulary:
    """Rank of each merge, and special strings that are one token wherever they occur."""

    merges: dict[tuple[bytes, bytes], int]
    special: tuple[str, ...] = ()

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """From a byte-level BPE ``.json`` or a ``.tiktoken`` rank file; others are refused."""
        if path.endswith(".tiktoken"):
            with open(path, "rb") as file:
                rows = [line.split() for line in file if line.strip()]
            return cls(pairs_of({base64.b64decode(token): int(rank) for token, rank in rows}))
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        refuse_unhandled(spec)
        letters = byte_letters()
        merges: dict[tuple[bytes, bytes], int] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            pair = merge.split(" ") if isinstance(merge, str) else merge
            left, right = (bytes(letters[c] for c in token) for token in pair)
            merges.setdefault((left, right), rank)
        return cls(merges, tuple(t["content"] for t in spec.get("added_tokens", ())))


def refuse_unhandled(spec: dict) -> None:
    """Raises where a ``.json`` file asks for more than byte-level words and merges, which would
    otherwise be miscounted."""
    first, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    plain = first.get("type") == "ByteLevel" and not first.get("add_prefix_space")
    odd = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    asked = [name for name in odd if model.get(name)]
    strips = any(t.get(k) for t in spec.get("added_tokens", ()) for k in ("single_word", "lstrip", "rstrip"))
    if spec.get("normalizer") or not plain or not first.get("use_regex", True) or model.get("type") != "BPE":
        asked.append("normalizer, pre_tokenizer or model type")
    if asked or strips:
        raise ValueError(f"not a plain byte-level vocabulary: {', '.join(asked) or 'added tokens'}")


def pairs_of(ranks: dict[bytes, int]) -> dict[tuple[bytes, bytes], int]:
    """The merge behind each ranked token: what its bytes become by the merges before it."""
    merges = {}
    for token, rank in ranks.items():
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            joined = [ranks.get(a + b, rank) for a, b in zip(parts, parts[1:], strict=False)]
            at = min(range(len(joined)), key=joined.__getitem__)
            if joined[at] >= rank:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2:
            merges[parts[0], parts[1]] = rank
    return merges


class Transducer:
    """The lazily compiled transducer. ``count(piece)`` runs it over the bytes of one piece."""

    def __init__(self, vocabulary: Vocabulary):
        self.merges = vocabulary.merges
        #: token -> (rank, left part, right part); a single byte has no parts
        self.made: dict[bytes, tuple[int, bytes, bytes]] = {
            bytes([b]): (-1, b"", b"") for b in range(256)
        }
        for (left, right), rank in self.merges.items():
            self.made.setdefault(left + right, (rank, left, right))
        self.starts = {token[:i] for token in self.made for i in range(len(token) + 1)}
        self._clear()

    def _clear(self) -> None:
        self.next: dict[int, int] = {}  # state and byte -> state and tokens emitted, shifted
        self.states: list[State] = [(b"", ((b"", 0),))]
        self.number: dict[State, int] = {self.states[0]: 0}

    def count(self, piece: bytes) -> int:
        if len(self.states) > MAX_STATES:
            self._clear()
        state = total = 0
        known = self.next
        for byte in piece:
            try:
                step = known[state << 8 | byte]
            except KeyError:
                step = known[state << 8 | byte] = self._compile(state, byte)
            state = step >> 10
            total += step & 1023
        return total - EMITS_FROM * len(piece)

    def _compile(self, state: int, byte: int) -> int:
        kept, window = self.states[state]
        text = kept + bytes([byte])
        for start, (left, before) in enumerate(window):
            token = text[start:]
            if token in self.made and (not left or self.compatible(left, token)):
                break
        emitted = before + 1  # relative to the count so far; negative if tokens joined
        start = next(i for i in range(len(text) + 1) if text[i:] in self.starts)
        places = (*window, (token, emitted))[start:]
        reached = (text[start:], tuple((last, tokens - emitted) for last, tokens in places))
        number = self.number.get(reached)
        if number is None:
            number = self.number[reached] = len(self.states)
            self.states.append(reached)
        return number << 10 | (emitted + EMITS_FROM)

    def compatible(self, left: bytes, right: bytes) -> bool:
        """Whether the two, joined, are tokenized as these two again.

        Both are taken apart along the border, the later merge first. They do
        not stay apart if the two that face each other at some point merge
        earlier than what was taken apart last.
        """
        merges, made = self.merges, self.made
        before = len(merges)
        while True:
            rank = merges.get((left, right))
            if rank is not None and rank < before:
                return False
            left_rank, _, left_end = made[left]
            right_rank, right_start, _ = made[right]
            if left_rank < 0 and right_rank < 0:
                return True
            if left_rank > right_rank:
                before, left = left_rank, left_end
            else:  # of equal merges the left one comes first, so the border merge may tie
                before, right = right_rank + 1, right_start


@dataclass(frozen=True)
class ChunkMap:
    """What a chunk does to any state: see the module's docstring."""

    head: str
    tokens: int
    tail: str | None  # None: open, the head is the whole chunk


_MARKS = {".", ",", ";", ":", "!", "?"}


class Memo(dict):
    """Results of a function by its argument."""

    def __init__(self, function):
        self.function = function

    def __missing__(self, key):
        found = self[key] = self.function(key)
        return found


class TextCounter:
    def __init__(self, vocabulary: Vocabulary):
        self.transducer = Transducer(vocabulary)
        self.pieces = regex.compile(PIECES).findall
        self.meeting = regex.compile(rf"(?<=[^{SPACE}])[{SPACE}]")
        self.uneven = regex.compile(rf"[ \n][ \n]|[{SPACE}--[ \n]]", regex.V1).search
        self.special = (
            regex.compile("|".join(map(regex.escape, vocabulary.special)))
            if vocabulary.special
            else None
        )
        self.words = Memo(self._word)

    def settled(self, text: str) -> int:
        """Tokens of a text that starts and ends where all states agree."""
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        parts = self.special.split(text)
        return sum(map(self._plain, parts)) + len(parts) - 1

    def _plain(self, text: str) -> int:
        """Without special strings. Words after single spaces or line ends are looked up whole."""
        if self.uneven(text):
            return self._pieces(text)
        if len(self.words) > MAX_WORDS:
            self.words.clear()
        first, *rest = text.replace("\n", " \n").split(" ")
        return self._pieces(first) + sum(map(self.words.__getitem__, rest))

    def _word(self, word: str) -> int:
        """Tokens of a word after a space; of one after a line end, if it starts with that."""
        if word.isalpha():  # most words are one piece, or one and a mark
            return self.transducer.count(b" " + word.encode())
        if word[-1:] in _MARKS and word[:-1].isalpha():
            return self.transducer.count(b" " + word[:-1].encode()) + 1
        return self._pieces(word if word[:1] == "\n" else " " + word)

    def _pieces(self, text: str) -> int:
        return sum(self.transducer.count(piece.encode()) for piece in self.pieces(text))

    def chunk_map(self, chunk: str) -> ChunkMap:
        first = self.meeting.search(chunk)
        if first is None:
            return ChunkMap(chunk, 0, None)
        start, last = first.start(), len(chunk) - 1
        while not (chunk[last - 1].strip() and self.meeting.match(chunk, last)):
            last -= 1
        return ChunkMap(chunk[:start], self.settled(chunk[start:last]), chunk[last:])

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        if a.tail is None:
            return ChunkMap(a.head + b.head, b.tokens, b.tail)
        if b.tail is None:
            return ChunkMap(a.head, a.tokens, a.tail + b.head)
        return ChunkMap(a.head, a.tokens + self.settled(a.tail + b.head) + b.tokens, b.tail)

    def count(self, text: str) -> int:
        if len(text) <= CHUNK:
            return self.settled(text)
        maps = [self.chunk_map(text[i : i + CHUNK]) for i in range(0, len(text), CHUNK)]
        while len(maps) > 1:  # neighbours compose, level by level
            pairs = [self.compose(*maps[i : i + 2]) for i in range(0, len(maps) - 1, 2)]
            maps = pairs + maps[len(pairs) * 2 :]
        whole = maps[0]
        return self.settled(whole.head) + whole.tokens + self.settled(whole.tail or "")


_COUNTERS: dict[str, TextCounter] = {}


def token_counts(
    documents: DataFrame, vocabulary: str, limit: int = 512, id_column: str = "doc_id"
) -> DataFrame:
    """Tokens of every text, one row per row: (id, n_bytes, n_tokens, over_limit).

    ``vocabulary`` is the path of a byte-level BPE file. It is read once, by the
    driver; its size is fixed by the tokenizer and it travels as a broadcast.
    Null texts count as empty: 0 bytes, 0 tokens. Repeated rows are counted each;
    other columns are ignored, whatever their names. A map without any shuffle.
    """
    spark = documents.sparkSession
    loaded = Shipped(spark, Vocabulary.load(vocabulary))

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counter = _COUNTERS.get(vocabulary)
        if counter is None:
            counter = _COUNTERS[vocabulary] = TextCounter(loaded.value)
        texts = batch.column(1).to_pylist()
        sizes = [len(t.encode()) if t else 0 for t in texts]
        tokens = [counter.count(t) if t else 0 for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())],
            names=["id", "n_bytes", "n_tokens"],
        )

    rows = documents.select(F.col(id_column).cast("long").alias("id"), F.col("text"))
    counted = map_arrow(rows, count, "id long, n_bytes long, n_tokens long")
    return counted.select(
        F.col("id").alias(id_column),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
