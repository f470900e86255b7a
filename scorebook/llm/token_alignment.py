"""Alignment of two tokenizers over the same bytes, and how well their ids go together.

Each text is encoded by both. Token ends are byte offsets, and an offset where
tokens of both end is a cut. Cuts are found by divide and conquer: probe the
ends of the one tokenizer around the middle of an interval, look each up among
those of the other by bisection, part the interval there and go on with both
halves; an interval without a cut inside is a group. Chunks of a text end with
tokens of both, so each different chunk is parted once; all intervals of the
chunks met first together are parted at the same time, level by level.

Which ids are linked in how many documents is counted over the corpus. A block
writes its linked id pairs by bucket of the first id, with the documents that
hold them; one pass adds the counts up by bucket, a second one brings counts
and blocks together bucket by bucket. No task holds more than one bucket of the
counts and one block.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorebook.llm.shared import blocks, stored

#: Unicode white space, which the byte-level pattern tells from other characters.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: A word with the one space before it, or a longer stretch of white space with the word behind it:
#: the byte-level pattern gives the stretch's last character a token of its own if a word follows. Only a
#: single character is the same token in either case. Some pieces end in a carriage return; such a one
#: does not part a chunk.
_WORD = f"[^{SPACE}]+(?:\r[{SPACE}]*[^{SPACE}]*)*"
CHUNK = re.compile(f" {_WORD}|{_WORD}|[{SPACE}](?![{SPACE}])|[{SPACE}]+(?:{_WORD})?")
#: Chunks that stay what they are in a row of their like.
PLAIN = re.compile(f" [^{SPACE}]+\\Z")
#: Text (in characters) and documents worked on at once in a task; texts are never cut.
BLOCK, BLOCK_DOCUMENTS = 1 << 20, 60_000
#: Chunks handed to a tokenizer at once.
AT_ONCE = 4_000
#: Chunks, and characters of them, whose tokens a worker remembers.
KEPT, KEPT_CHARACTERS = 400_000, 1 << 24
#: Groups with more links than this are counted by distinct ids.
LARGE = 1024
#: Spreads ids over buckets.
SPREAD = 40503
#: Pair counts a task holds before it hands them on.
HELD = 1 << 20


def _byte_of() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: themselves where printable,
    else the next free code points from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class BytePairs:
    """Byte-level BPE (.json); special strings in texts are plain text."""

    def __init__(self, file: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(file.decode())
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        byte_of = _byte_of()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.size = max([self.tokenizer.get_vocab_size() - 1, *vocabulary.values()]) + 1
        self.bytes = [b""] * self.size
        for piece, at in vocabulary.items():
            self.bytes[at] = bytes(byte_of[c] for c in piece)
        how = json.loads(file)
        first = how.get("pre_tokenizer") or {}
        plain = first.get("type") == "ByteLevel" and not first.get("add_prefix_space")
        self.by_chunk = plain and first.get("use_regex", True) and not how.get("normalizer")

    def encode(self, chunks: list[str], by_chunk: bool) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]


class Pieces:
    """A sentencepiece model, which adds the space before a text itself."""

    LEAD = "\n"

    def __init__(self, file: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=file)
        self.size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(self.size)]
        spelt = re.compile("<0x([0-9A-F]{2})>")
        self.bytes = []
        for at, piece in enumerate(pieces):
            byte = spelt.fullmatch(piece) if self.model.is_byte(at) else None
            self.bytes.append(
                bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()
            )
        whole = (len(CHUNK.findall(p.replace("▁", " "))) == 1 for p in pieces if p)
        self.lead = self.model.encode(self.LEAD)
        led = self._joined(self.lead) == b" \n" and len(self.lead) == 2
        kept = self._joined(self.model.encode("a  b ")) == b" a  b "
        self.by_chunk = led and kept and all(whole)

    def _joined(self, ids: list[int]) -> bytes:
        return b"".join(self.bytes[i] for i in ids)

    def encode(self, chunks: list[str], by_chunk: bool) -> list[list[int]]:
        """No piece goes beyond a chunk, so a chunk behind a line end has the tokens it has in its text."""
        if not by_chunk:
            return self.model.encode([c[1:] for c in chunks], num_threads=1)
        encoded = self.model.encode([self.LEAD + c for c in chunks], num_threads=1)
        return [ids[len(self.lead) :] for ids in encoded]


@dataclass
class Tokens:
    """The tokens of a block of texts, one after the other, where each text starts, and their groups' first tokens."""

    a: np.ndarray
    b: np.ndarray
    a_from: np.ndarray
    b_from: np.ndarray
    a_at: np.ndarray
    b_at: np.ndarray
    groups_from: np.ndarray


def _within(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers ``first``, ``first`` + 1, ... of runs of the given sizes, end to end."""
    before = np.cumsum(size) - size
    return np.repeat(first - before, size) + np.arange(size.sum())


class Runs:
    """Runs of values by number."""

    def __init__(self):
        self.values = np.zeros(0, np.int32)
        self.first, self.size = np.zeros((2, 0), np.int64)

    def add(self, values: np.ndarray, size: np.ndarray, place: np.ndarray) -> None:
        """Further runs, end to end; the i-th gets the ``place[i]``-th of the new numbers."""
        first = np.empty((2, len(size)), np.int64)
        first[:, place] = len(self.values) + np.cumsum(size) - size, size
        self.values = np.concatenate([self.values, values.astype(np.int32)])
        self.first, self.size = (np.concatenate(x) for x in ((self.first, first[0]), (self.size, first[1])))

    def of(self, at: np.ndarray) -> np.ndarray:
        return self.values[_within(self.first[at], self.size[at])]

    def keep(self, at: np.ndarray) -> None:
        """The runs ``at`` alone, numbered anew."""
        self.values, self.size = self.of(at), self.size[at]
        self.first = np.cumsum(self.size) - self.size


class Encoder:
    """Both tokenizers, with the tokens and groups of chunks seen before.

    Where neither tokenizer's tokens reach beyond a chunk, each different chunk is
    encoded once; otherwise a text is one chunk.
    """

    def __init__(self, first: bytes, second: bytes):
        self.sides = (BytePairs(first), Pieces(second))
        self.by_chunk = all(side.by_chunk for side in self.sides)
        self.lengths = [np.array([len(b) for b in side.bytes], np.int64) for side in self.sides]
        self.good = np.zeros(0, bool)
        self.uses = np.zeros(0, np.int64)
        self.ids, self.groups = (Runs(), Runs()), (Runs(), Runs())
        self._numbered([])

    def _numbered(self, chunks: list[str]) -> None:
        """Chunks get numbers in turn; one that is looked up for the first time gets the next."""
        self.number = defaultdict(count(len(chunks)).__next__, zip(chunks, range(len(chunks)), strict=True))
        self.characters = sum(map(len, chunks))

    def _forget(self) -> None:
        """Goes on with the chunks used most among those used again: at most half of what may be kept."""
        chunks = list(self.number)
        self.number.clear()
        most = np.argsort(-self.uses, kind="stable")[: KEPT // 2]
        most = most[self.uses[most] > 1]
        length = np.array([len(chunks[i]) for i in most.tolist()], np.int64)
        most = most[np.cumsum(length) <= KEPT_CHARACTERS // 2]
        self.good, self.uses = self.good[most], self.uses[most] >> 1
        for runs in (*self.ids, *self.groups):
            runs.keep(most)
        self._numbered([chunks[i] for i in most.tolist()])

    def _learn(self, known: int) -> None:
        """Encodes the chunks numbered ``known`` and up. Words with their space are encoded as one text
        and told apart by their bytes, others one by one."""
        words, others = [], []
        for chunk in sorted(islice(self.number, known, None)):
            (words if self.by_chunk and PLAIN.match(chunk) else others).append(chunk)
        found = []
        for run, part in ((True, words), (False, others)):
            for low in range(0, len(part), AT_ONCE):
                found.append(self._encoded(part[low : low + AT_ONCE], run))
        if not found:
            return
        chunks = words + others
        place = np.array([self.number[c] for c in chunks], np.int64) - known
        good, *lists = (np.concatenate(x) for x in zip(*found, strict=True))
        a, n_a, b, n_b, a_at, b_at, n_groups = lists
        for runs, values, size in zip(
            (*self.ids, *self.groups), (a, b, a_at, b_at), (n_a, n_b, n_groups, n_groups), strict=True
        ):
            runs.add(values, size, place)
        fresh = np.empty(len(good), bool)
        fresh[place] = good
        self.good = np.concatenate([self.good, fresh])
        self.uses = np.concatenate([self.uses, np.zeros(len(good), np.int64)])
        self.characters += sum(map(len, chunks))

    def _encoded(self, chunks: list[str], as_text: bool) -> tuple[np.ndarray, ...]:
        """Which chunks both restore; ids and their number by chunk, of a and of b; the groups' first tokens
        within their chunk, of a and of b, and the number of groups by chunk. Chunks not restored have none."""
        raw = [c.encode() for c in chunks]
        good = np.ones(len(chunks), bool)
        sides = []
        if as_text:
            bounds, whole = np.cumsum(list(map(len, raw))), b"".join(raw)
            for side, length in zip(self.sides, self.lengths, strict=True):
                ids = side.encode(["".join(chunks)], False)[0]
                flat = np.array(ids, np.int32)
                ends = np.cumsum(length[flat])
                last = np.minimum(np.searchsorted(ends, bounds), len(ends) - 1)
                if b"".join(map(side.bytes.__getitem__, ids)) != whole or (ends[last] != bounds).any():
                    return self._encoded(chunks, False)
                sides.append((flat, ends, np.r_[0, last + 1]))
        else:
            lists = [side.encode(chunks, self.by_chunk) for side in self.sides]
            for side, found in zip(self.sides, lists, strict=True):
                restored = (b"".join(map(side.bytes.__getitem__, ids)) for ids in found)
                good &= [text == r for text, r in zip(restored, raw, strict=True)]
            for found, length in zip(lists, self.lengths, strict=True):
                found = [ids if ok else [] for ids, ok in zip(found, good.tolist(), strict=True)]
                flat = np.array(list(chain.from_iterable(found)), np.int32)
                sides.append((flat, np.cumsum(length[flat]), np.r_[0, np.cumsum(list(map(len, found)))]))
        (a, a_end, a_from), (b, b_end, b_from) = sides
        a_at, b_at = group_starts(a_end, b_end, a_from, b_from)
        of = np.searchsorted(a_from, a_at, "right") - 1
        n_groups = np.bincount(of, minlength=len(chunks))
        return good, a, np.diff(a_from), b, np.diff(b_from), a_at - a_from[of], b_at - b_from[of], n_groups

    def encode(self, texts: list[str | None]) -> Tokens:
        """Of the texts in turn; those that are null, empty or not restored by both have no tokens."""
        if len(self.number) > KEPT or self.characters > KEPT_CHARACTERS:
            self._forget()
        known = len(self.number)
        split = CHUNK.findall if self.by_chunk else lambda text: [text]
        chunks = (split(" " + text) if text else [] for text in texts)
        found = [np.fromiter(map(self.number.__getitem__, part), np.int64, len(part)) for part in chunks]
        sizes = np.array(list(map(len, found)), np.int64)
        at = np.concatenate(found)
        self._learn(known)
        self.uses += np.bincount(at, minlength=len(self.uses))
        good = self.good[at]
        if not good.all():
            text = np.repeat(np.arange(len(texts)), sizes)
            spoilt = np.bincount(text[~good], minlength=len(texts)) > 0
            at = at[~spoilt[text]]
            sizes[spoilt] = 0
        chunks_from = np.r_[0, np.cumsum(sizes)]
        tokens, first, starts = [], [], []
        for ids, groups in zip(self.ids, self.groups, strict=True):
            before = np.r_[0, np.cumsum(ids.size[at])]
            tokens.append(ids.of(at))
            first.append(groups.of(at) + np.repeat(before[:-1], groups.size[at]))
            starts.append(before[chunks_from])
        n_groups = np.r_[0, np.cumsum(self.groups[0].size[at])]
        return Tokens(*tokens, *starts, *first, n_groups[chunks_from])


def group_starts(a_end: np.ndarray, b_end: np.ndarray, a_from: np.ndarray, b_from: np.ndarray):
    """First tokens (of a, of b) of all groups, in order.

    ``a_from`` and ``b_from`` bound the chunks, whose last tokens end together.
    An interval runs from one cut to another. Its inner ends are probed outwards
    from the middle, for all intervals at once; where one is an end of the other
    tokenizer too, the interval is parted there.
    """
    full = np.flatnonzero(a_from[1:] > a_from[:-1])
    low, high = a_from[full], a_from[full + 1]
    b_low, b_high = b_from[full], b_from[full + 1]
    leaves = []
    while len(low):
        middle = (low + high - 1) >> 1
        cut, b_cut = np.full(len(low), -1), np.zeros(len(low), np.int64)
        inside = high - low - 1  # ends that may be cuts
        open_ = np.flatnonzero((inside > 0) & (b_high - b_low > 1))
        step = 0
        while len(open_):
            # 0, 1, -1, 2, -2, ...: the middle is the lower one, so all inner ends come up.
            offset = (step + 1) >> 1 if step & 1 else -(step >> 1)
            probe = middle[open_] + offset
            fits = (probe >= low[open_]) & (probe < high[open_] - 1)
            place, end = open_[fits], a_end[probe[fits]]
            j = np.searchsorted(b_end, end)
            hit = b_end[j] == end
            cut[place[hit]], b_cut[place[hit]] = probe[fits][hit], j[hit]
            step += 1
            open_ = open_[(cut[open_] < 0) & (step < inside[open_] + 2)]
        leaf = cut < 0
        leaves.append(np.stack([low[leaf], b_low[leaf]]))
        parted = ~leaf
        at, b_at = cut[parted] + 1, b_cut[parted] + 1
        low, high = np.concatenate([low[parted], at]), np.concatenate([at, high[parted]])
        b_low, b_high = (
            np.concatenate([b_low[parted], b_at]),
            np.concatenate([b_at, b_high[parted]]),
        )
    if not leaves:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.concatenate(leaves, axis=1)
    return starts[0][order := np.argsort(starts[0])], starts[1][order]


class Aligned:
    """Groups and links of a block of texts."""

    def __init__(self, tokens: Tokens, sizes: tuple[int, int]):
        self.tokens, self.sizes = tokens, sizes
        self.a_at, self.b_at = tokens.a_at, tokens.b_at
        self.a_next = np.r_[self.a_at[1:], len(tokens.a)] if len(self.a_at) else self.a_at
        self.b_next = np.r_[self.b_at[1:], len(tokens.b)] if len(self.b_at) else self.b_at
        n_groups = np.diff(tokens.groups_from)
        self.document = np.repeat(np.arange(len(n_groups)), n_groups)
        self.links = (self.a_next - self.a_at) * (self.b_next - self.b_at)

    def figures(self) -> dict[str, np.ndarray]:
        links = np.r_[0, np.cumsum(self.links)]
        return {
            "n_a": np.diff(self.tokens.a_from),
            "n_b": np.diff(self.tokens.b_from),
            "n_groups": np.diff(self.tokens.groups_from),
            "n_links": np.diff(links[self.tokens.groups_from]),
        }

    def digests(self, spelt: np.ndarray) -> Iterator[str]:
        """SHA-256 of each text's groups; '' without tokens.

        ``spelt`` has, for both tokenizers' ids, the id with the mark inside and at the end of a group,
        as bytes of one width, filled up with zeros.
        """
        tokens, (a_size, b_size) = self.tokens, self.sizes
        code = np.zeros(len(tokens.a) + len(tokens.b), np.int64)
        group_a = np.repeat(np.arange(len(self.a_at)), self.a_next - self.a_at)
        group_b = np.repeat(np.arange(len(self.b_at)), self.b_next - self.b_at)
        last_a, last_b = np.zeros(len(tokens.a), np.int64), np.zeros(len(tokens.b), np.int64)
        last_a[self.a_next - 1] = last_b[self.b_next - 1] = 1
        code[np.arange(len(tokens.a)) + self.b_at[group_a]] = tokens.a + a_size * last_a
        code[np.arange(len(tokens.b)) + self.a_next[group_b]] = (
            tokens.b + b_size * last_b + 2 * a_size
        )
        bounds = (tokens.a_from + tokens.b_from).tolist()
        for low, high in zip(bounds, bounds[1:], strict=False):
            text = spelt[code[low:high]].tobytes().translate(None, b"\0")
            yield hashlib.sha256(text[:-1]).hexdigest() if text else ""

    def pairs(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys of (id pair, document), each once, and how many links each stands for.

        A key is (spread first id * second ids + second id) * ``width`` + document.
        """
        second = self.sizes[1]
        spread = spread_ids(self.tokens.a, self.sizes[0])
        small = self.links <= LARGE
        n = self.links[small]
        start = np.cumsum(n) - n
        within = np.arange(n.sum()) - np.repeat(start, n)
        wide = np.repeat((self.b_next - self.b_at)[small], n)
        ai = np.repeat(self.a_at[small], n) + within // wide
        bi = np.repeat(self.b_at[small], n) + within % wide
        key = spread[ai] * second + self.tokens.b[bi]
        key = np.sort(key * width + np.repeat(self.document[small], n))
        keys, counts = _runs(key, None)
        if small.all():
            return keys, counts
        parts = [(keys, counts)]
        for g in np.flatnonzero(~small):
            first, n_first = np.unique(spread[self.a_at[g] : self.a_next[g]], return_counts=True)
            other, n_other = np.unique(self.tokens.b[self.b_at[g] : self.b_next[g]], return_counts=True)
            key = (first[:, None] * second + other).ravel() * width + self.document[g]
            parts.append((key, np.outer(n_first, n_other).ravel()))
        key, count = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.argsort(key, kind="stable")
        return _runs(key[order], count[order])


def _runs(sorted_keys: np.ndarray, weights: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, with the sum of its weights."""
    if not len(sorted_keys):
        return sorted_keys, np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]])
    if weights is None:
        return sorted_keys[first], np.diff(np.r_[first, len(sorted_keys)])
    return sorted_keys[first], np.add.reduceat(weights, first)


def spread_ids(ids: np.ndarray, size: int) -> np.ndarray:
    """A permutation of ids within the next power of two, so that frequent ids lie apart."""
    mask = (1 << max(1, (size - 1).bit_length())) - 1
    return (ids.astype(np.int64) * SPREAD) & mask


def _numbers(values: np.ndarray, kind: type) -> bytes:
    return values.astype(kind).tobytes()


_BLOCK = (
    "id {id}, block long, place int, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, bucket int, pairs binary, held binary, places binary, links binary"
)
_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _align(documents: DataFrame, first: bytes, second: bytes, buckets: int, id_column: str) -> DataFrame:
    """A row for each document, and one for each block and bucket with its id pairs."""
    kind = documents.schema[id_column].dataType.simpleString()
    held = documents.sparkSession.sparkContext.broadcast((first, second))
    fields = [field.split() for field in _BLOCK.split(",")]
    schema = _BLOCK.format(id=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*held.value)
        sizes = tuple(side.size for side in encoder.sides)
        spelt = [f"{i}{mark}" for n, marks in zip(sizes, (",|", ",;"), strict=True) for mark in marks for i in range(n)]
        spelt = np.array(spelt, f"S{max(8, *map(len, spelt))}")
        block = TaskContext.get().partitionId() << 32

        def filled(n: int, **columns) -> pa.RecordBatch:
            """The given columns, nulls for the others."""
            arrays = [
                pa.array(columns[name], kind) if name in columns else pa.nulls(n, kind)
                for name, kind in kinds.items()
            ]
            return pa.RecordBatch.from_arrays(arrays, names=list(kinds))

        for batch in batches:
            kinds = {name: _ARROW.get(kind, batch.column(0).type) for name, kind in fields}
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for part in blocks(texts, BLOCK, BLOCK_DOCUMENTS):
                aligned = Aligned(encoder.encode(texts[part]), sizes)
                n = part.stop - part.start
                yield filled(
                    n,
                    id=ids.slice(part.start, n).to_pylist(),
                    block=np.full(n, block),
                    place=np.arange(n, dtype=np.int32),
                    groups_sha256=list(aligned.digests(spelt)),
                    **aligned.figures(),
                )
                keys, links = aligned.pairs(n)
                pairs, place = np.divmod(keys, n)
                pair, docs = _runs(pairs, None)
                of = pair // sizes[1] * buckets >> max(1, (sizes[0] - 1).bit_length())
                edge = np.searchsorted(of, np.arange(buckets + 1))
                entry = np.r_[0, np.cumsum(docs)]
                used = np.flatnonzero(np.diff(edge))
                cut = [(edge[u], edge[u + 1], entry[edge[u]], entry[edge[u + 1]]) for u in used]
                yield filled(
                    len(used),
                    block=np.full(len(used), block),
                    bucket=used.astype(np.int32),
                    pairs=[_numbers(pair[p:q], np.int64) for p, q, _, _ in cut],
                    held=[_numbers(docs[p:q], np.int32) for p, q, _, _ in cut],
                    places=[_numbers(place[s:t], np.uint16) for _, _, s, t in cut],
                    links=[_numbers(links[s:t], np.int64) for _, _, s, t in cut],
                )
                block += 1

    rows = documents.select(F.col(id_column).alias("id"), "text")
    return rows.mapInArrow(run, schema)


def _column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def _pair_counts(blocks: DataFrame) -> DataFrame:
    """(bucket, pair, n): in how many documents each id pair is linked, added up in tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {}
        size = 0

        def flush():
            for bucket, found in parts.items():
                pairs, held = (np.concatenate(p) for p in zip(*found, strict=True))
                order = np.argsort(pairs, kind="stable")
                pairs, held = _runs(pairs[order], held[order])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pairs), bucket, np.int32)), pa.array(pairs), pa.array(held)],
                    names=["bucket", "pair", "n"],
                )
            parts.clear()

        for batch in batches:
            for bucket, pairs, held in zip(
                *(_column(batch, c) for c in ("bucket", "pairs", "held")), strict=True
            ):
                found = np.frombuffer(pairs, np.int64), np.frombuffer(held, np.int32).astype(np.int64)
                parts.setdefault(bucket, []).append(found)
                size += len(found[0])
            if size > HELD:
                yield from flush()
                size = 0
        yield from flush()

    counts = blocks.select("bucket", "pairs", "held").mapInArrow(run, "bucket int, pair long, n long")
    return counts.groupBy("bucket", "pair").agg(F.sum("n").alias("n"))


def _count_tables(counts: DataFrame, second: int) -> DataFrame:
    """(bucket, pairs, counts, best): the counts of a bucket as sorted arrays, in one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(bucket: int, parts: list) -> pa.RecordBatch:
            pairs, n = (np.concatenate(p) for p in zip(*parts, strict=True))
            first = pairs // second
            start = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
            most = np.repeat(np.maximum.reduceat(n, start), np.diff(np.r_[start, len(n)]))
            values = [_numbers(pairs, np.int64), _numbers(n, np.int64), _numbers(n == most, np.bool_)]
            return pa.RecordBatch.from_arrays(
                [pa.array([bucket], pa.int32()), *(pa.array([v], pa.binary()) for v in values)],
                names=["bucket", "pairs", "counts", "best"],
            )

        current, parts = None, []
        for batch in batches:
            of, pair, n = (batch.column(i).to_numpy() for i in range(3))
            edges = np.r_[0, np.flatnonzero(of[1:] != of[:-1]) + 1, len(of)]
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                if low == high:
                    continue
                if of[low] != current and parts:
                    yield row(current, parts)
                    parts = []
                current = int(of[low])
                parts.append((pair[low:high], n[low:high]))
        if parts:
            yield row(current, parts)

    rows = counts.select("bucket", "pair", "n").repartition("bucket").sortWithinPartitions("bucket", "pair")
    return rows.mapInArrow(run, "bucket int, pairs binary, counts binary, best binary")


def _looked_up(blocks: DataFrame, tables: DataFrame, salts: int) -> DataFrame:
    """(block, place, n_best, count_sum): what each bucket adds to each document.

    Blocks of a bucket are dealt to ``salts`` tasks, each of which gets the
    bucket's counts first and then the blocks, one at a time.
    """
    none = F.lit(None).cast("binary")
    dealt = tables.select(
        "bucket", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("turn"),
        F.lit(None).cast("long").alias("block"), "pairs", "counts", "best",
        none.alias("held"), none.alias("places"), none.alias("links"),
    )
    blocks = blocks.select(
        "bucket", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt"), F.lit(1).alias("turn"),
        "block", "pairs", none.alias("counts"), none.alias("best"), "held", "places", "links",
    )
    names = ("turn", "block", "pairs", "counts", "best", "held", "places", "links")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counts = best = None
        for batch in batches:
            for row in range(batch.num_rows):
                turn, block, pairs, *rest = (
                    batch.column(batch.schema.get_field_index(name))[row].as_py() for name in names
                )
                pairs = np.frombuffer(pairs, np.int64)
                if turn == 0:
                    known, counts, best = pairs, np.frombuffer(rest[0], np.int64), np.frombuffer(rest[1], np.bool_)
                    continue
                held = np.frombuffer(rest[2], np.int32)
                place, links = np.frombuffer(rest[3], np.uint16), np.frombuffer(rest[4], np.int64)
                at = np.repeat(np.searchsorted(known, pairs), held)
                n_best, count_sum = np.zeros((2, int(place.max()) + 1), np.int64)
                np.add.at(n_best, place, links * best[at])
                np.add.at(count_sum, place, links * counts[at])
                used = np.flatnonzero(count_sum)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(used), block)),
                        pa.array(used.astype(np.int32)),
                        pa.array(n_best[used]),
                        pa.array(count_sum[used]),
                    ],
                    names=["block", "place", "n_best", "count_sum"],
                )

    rows = dealt.unionByName(blocks).repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", "turn")
    return rows.mapInArrow(run, "block long, place int, n_best long, count_sum long")


def align_tokens(
    documents: DataFrame,
    first_file: str,
    second_file: str,
    buckets: int = 16,
    id_column: str = "doc_id",
) -> DataFrame:
    """One row per row of ``documents`` (id, text) with its groups and links.

    ``first_file`` is byte-level BPE for the library tokenizers, ``second_file`` a
    sentencepiece model; the driver reads both and hands them to the tasks.
    Returns the id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.
    Null and empty texts, and texts that a tokenizer does not restore byte for
    byte, have zeros and ''. Repeated rows count as documents of their own. A
    null id is kept. Other columns are ignored.
    """
    files = []
    for name in (first_file, second_file):
        with open(name, "rb") as file:
            files.append(file.read())
    second = Pieces(files[1]).size
    both = stored(_align(documents, *files, buckets, id_column), "alignment-blocks")
    blocks = both.where("bucket IS NOT NULL")
    tables = stored(_count_tables(_pair_counts(blocks), second), "alignment-counts")
    tasks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sums = _looked_up(blocks, tables, max(1, 2 * tasks // buckets)).groupBy("block", "place")
    sums = sums.agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    figures = ("n_a", "n_b", "n_groups", "n_links")
    rows = both.where("bucket IS NULL").select("id", "block", "place", *figures, "groups_sha256")
    return rows.join(sums, ["block", "place"], "left").select(
        F.col("id").alias(id_column),
        *figures,
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"),
        "groups_sha256",
    )
