"""Byte-level BPE by a SentencePiece model that is written straight from a rank vocabulary, and the way back.

Every byte stands for one character, every token is the piece of its characters, scored by its negative rank. Merging the
best-scored pair first, leftmost on ties, is then the merge order of the ranks. Texts are cut into pre-tokens first; a
pre-token that is a token itself needs no merges.
"""

from __future__ import annotations

import base64
import functools
import struct
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Byte b is written as this character; none of them is white space or changed by a normalisation to itself.
FIRST = 0x100
MAPPED = {b: chr(FIRST + b) for b in range(256)}
#: Pre-tokens worked on at once, and pre-tokens remembered with their ids; neither changes the result.
CHUNK, KNOWN = 1 << 16, 400_000
#: The unknown piece. It stands between the pre-tokens of one call: no piece holds it, so no merge crosses it.
BARRIER = "\N{REPLACEMENT CHARACTER}"
MOST_TOKENS = 1 << 20
#: Up to so many characters the pre-tokens of a text are listed at once, which is faster than one by one.
SHORT = 1 << 20


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protobuf field: bytes, a 32-bit float or a whole number."""
    def varint(n: int) -> bytes:
        out = bytearray()
        while n > 0x7F:
            out.append(n & 0x7F | 0x80)
            n >>= 7
        return bytes([*out, n])

    if isinstance(value, bytes):
        return varint(number << 3 | 2) + varint(len(value)) + value
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3) + varint(value)


def mapped(token: bytes) -> str:
    return token.decode("latin-1").translate(MAPPED)


def unmapped(piece: str) -> bytes:
    return bytes([ord(c) - FIRST for c in piece])


def read_ranks(vocabulary: bytes) -> dict[bytes, int]:
    """Token -> rank of a file with one base64 token and its rank a line."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing or len(set(ranks.values())) != len(ranks):
        raise ValueError(f"the vocabulary needs every byte as a token and no rank twice; bytes missing: {missing[:5]}")
    return ranks


def model_proto(ranks: dict[bytes, int]) -> bytes:
    """The serialised SentencePiece model: piece number n is the token of the n-th rank, the unknown piece comes last.

    Scores are 32-bit floats, so ranks from 2 ** 24 on would not be told apart.
    """
    if max(ranks.values()) >= 1 << 24:
        raise ValueError("ranks must stay below 2 ** 24")
    pieces = [_field(1, _field(1, mapped(t).encode()) + _field(2, -float(ranks[t]))) for t in sorted(ranks, key=ranks.get)]
    unknown = _field(1, _field(1, BARRIER.encode()) + _field(2, 0.0) + _field(3, 2))
    trainer = _field(2, _field(3, 2) + _field(4, len(pieces) + 1) + _field(40, len(pieces)))
    normalizer = _field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0))
    return b"".join([*pieces, unknown, trainer, normalizer])


@functools.cache
def stand_ins() -> dict[int, str]:
    """Characters that the reference splitter and ``regex`` put into different classes, as their tables of Unicode differ,
    with a character that ``regex`` classes as the splitter does."""
    import regex
    import tiktoken

    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    single = {bytes([b]): b for b in range(256)}

    def of(pattern: str) -> tuple[set[int], set[int]]:
        ids = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)
        return set(map(ord, bytes(ids).decode())), {ord(c) for c in regex.findall(pattern, every)}

    (letters, here_l), (numbers, here_n), (spaces, here_s) = (of(p) for p in (r"\p{L}", r"\p{N}", r"\s"))
    differ = (letters ^ here_l) | (numbers ^ here_n) | (spaces ^ here_s)
    return {c: "a" if c in letters else "0" if c in numbers else "\t" if c in spaces else "#" for c in sorted(differ)}


class Codec:
    """Encoder and decoder of one vocabulary, as a task holds it."""

    def __init__(self, vocabulary: bytes, pattern: str, odd: dict[int, str]):
        import regex
        import sentencepiece

        self.ranks = read_ranks(vocabulary)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_proto(self.ranks))
        self.rank_of = sorted(self.ranks.values())
        n = self.unknown = len(self.rank_of)
        self.tokens = {self.rank_of[i]: unmapped(self.model.id_to_piece(i)) for i in range(n)}
        self.gapless = self.rank_of[-1] == n - 1
        self.ranks_sorted, self.pieces = np.array(self.rank_of), pa.array(self.tokens.values(), pa.binary())
        self.split, self.odd = regex.compile(pattern), odd
        self.first_odd, self.odd_characters = min(odd, default=1 << 21), frozenset(map(chr, odd))
        self.known: dict[str, list[int]] = {}

    def pre_tokens(self, text: str) -> Iterator[str]:
        if self._holds_odd(text):
            return (text[m.start():m.end()] for m in self.split.finditer(text.translate(self.odd)))
        if len(text) <= SHORT and not self.split.groups:
            return iter(self.split.findall(text))
        return (m.group() for m in self.split.finditer(text))

    def _holds_odd(self, text: str) -> bool:
        if text.isascii():
            return self.first_odd < 128 and not self.odd_characters.isdisjoint(text)
        highest = max((int(np.frombuffer(text[i:i + SHORT].encode("utf-32-le"), "<u4").max()) for i in range(0, len(text), SHORT)))
        return highest >= self.first_odd and not self.odd_characters.isdisjoint(text)

    def encode(self, text: str) -> Iterator[np.ndarray]:
        """The ids of a text in pieces of bounded size, so that only the text and one piece are held."""
        rest = self.pre_tokens(text)
        while cut := list(islice(rest, CHUNK)):
            if len(self.known) > KNOWN:
                self.known = {}
            new = [w for w in set(cut) if w not in self.known]
            merge = []
            for word in new:
                whole = self.ranks.get(word.encode())
                if whole is None:
                    merge.append(word)
                else:
                    self.known[word] = [whole]
            ids, start = self.model.encode(BARRIER.join([mapped(w.encode()) for w in merge])), 0
            ids.append(self.unknown)
            for word in merge:
                stop = ids.index(self.unknown, start)
                self.known[word] = ids[start:stop] if self.gapless else [self.rank_of[i] for i in ids[start:stop]]
                start = stop + 1
            yield np.fromiter(chain.from_iterable(map(self.known.__getitem__, cut)), np.int32)
            for word in merge:
                if len(word) > 1_000:
                    del self.known[word]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def decode_lists(self, lists: pa.ListArray) -> pa.BinaryArray:
        """The bytes of each list of ids: those of all ids in a row, cut where a list ends."""
        ids, ends = lists.flatten().to_numpy(zero_copy_only=False), np.zeros(len(lists) + 1, np.int64)
        ends[1:] = np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False))
        at = ids if self.gapless else np.minimum(np.searchsorted(self.ranks_sorted, ids), len(self.rank_of) - 1)
        if len(ids) and (at.min() < 0 or at.max() >= len(self.rank_of) or not np.array_equal(self.ranks_sorted[at], ids)):
            raise KeyError("an id that is no rank of the vocabulary")
        taken = self.pieces.take(pa.array(at, pa.int64()))
        _, offsets, data = taken.buffers()
        offsets = np.frombuffer(offsets, np.int32)[taken.offset:taken.offset + len(taken) + 1] if len(taken) else np.zeros(1, np.int32)
        return pa.BinaryArray.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(offsets[ends].astype(np.int32)), data])


@functools.lru_cache(2)
def _codec(vocabulary: bytes, pattern: str, odd: tuple[tuple[int, str], ...]) -> Codec:
    return Codec(vocabulary, pattern, dict(odd))


def _given(vocabulary: str | None, pattern: str | None) -> tuple[bytes, str, tuple[tuple[int, str], ...]]:
    import public_tokenizers

    with open(vocabulary or public_tokenizers.path(VOCABULARY), "rb") as f:
        return f.read(), pattern or public_tokenizers.PATTERN, tuple(stand_ins().items())


def encode(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and ids (array of ranks) of every row of ``docs``; other columns are not read.

    ``vocabulary`` is a rank file (about 1 MB), read by the driver and sent with the tasks, ``pattern`` cuts the text;
    characters that match nowhere get no token. Null and empty texts have no ids; repeated rows give repeated rows; no rows
    give no rows. A task holds one text and its ids at a time, however long; what it remembers of pre-tokens is bounded.
    """
    given = _given(vocabulary, pattern)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(*given)
        ids: list[np.ndarray] = []
        keys: list[int | None] = []
        ends, held = [0], 0

        def flush() -> pa.RecordBatch:
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), lists], schema=schema)

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                for piece in codec.encode(text.as_py() or ""):
                    ids.append(piece)
                    held += len(piece)
                keys.append(key.as_py())
                ends.append(held)
                if held > MOST_TOKENS:
                    yield flush()
                    ids, keys, ends, held = [], [], [0], 0
        if keys:
            yield flush()

    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text").mapInArrow(
        run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, ids and decoded (the bytes that the ids stand for) of every row of ``encoded``; null ids give no bytes.

    The bytes of a whole text are the text in UTF-8; the ids of a part of one may end inside a character.
    """
    given = _given(vocabulary, None)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(*given)
        for batch in batches:
            lists = batch.column(1).cast(schema.field(1).type)
            lengths, start = pc.list_value_length(lists).fill_null(0).to_pylist(), 0
            while start < batch.num_rows:
                stop, held = start, 0
                while stop < batch.num_rows and held <= MOST_TOKENS:
                    held += lengths[stop]
                    stop += 1
                part = lists.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), part, codec.decode_lists(part)], schema=schema)
                start = stop

    return encoded.selectExpr("cast(doc_id as bigint) as doc_id", "ids").mapInArrow(
        run, "doc_id long, ids array<int>, decoded binary")
