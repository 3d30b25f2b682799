"""Byte-level BPE encoding of a corpus with a public vocabulary.

A token's rank is the order of its merge. For each piece of text that the splitting
pattern gives, an Aho-Corasick automaton over the vocabulary (bytes as Latin-1
characters) finds the longest token at every position. Encoding goes from left to
right with that token, falls back to its next shorter prefix where the token cannot
stand next to its neighbour, and steps back where no prefix can; positions that
turned out dead are remembered, so every position is tried a bounded number of
times. Two tokens can be neighbours if no merge across their border comes before the
merges that made them; that is found once per pair and memoised. The result is
exactly that of applying the merges in order.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from wavequarry.session import arrow_batches

#: Fixed value: the pattern that splits text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Where the vocabulary lies unless the caller says otherwise.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: A vocabulary larger than this is not broadcast.
VOCABULARY_BYTES = 64 << 20
#: Pieces and token pairs that a worker remembers before it starts afresh.
MEMORY = 500_000


class Encoder:
    """Encodes text with ranked tokens (lines of base64 token and rank)."""

    def __init__(self, vocabulary: bytes, pattern: str = PATTERN) -> None:
        ranked = [line.split() for line in vocabulary.splitlines() if line.strip()]
        self.rank = {base64.b64decode(token).decode("latin-1"): int(rank) for token, rank in ranked}
        self.token = {rank: token for token, rank in self.rank.items()}
        self.beyond = max(self.token, default=0) + 2
        self.pieces = regex.compile(pattern)
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.rank.items():
            self.automaton.add_word(token, (rank, len(token)))
        self.automaton.make_automaton()
        self.merged: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.shorter: dict[int, int | None] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        for rank in sorted(self.token):
            self._learn(rank)
        self.fits.clear()  # pairs were judged with the merges known so far

    def _learn(self, rank: int) -> None:
        """Find the token's next shorter prefix and the two tokens that its merge joins."""
        token = self.token[rank]
        prefixes = [self.rank[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in self.rank]
        self.shorter[rank] = prefixes[0] if prefixes else None
        self.halves[rank] = (rank, rank)
        for left in prefixes:
            right = self.rank.get(token[len(self.token[left]) :])
            if left < rank and right is not None and right < rank and self._compatible(left, right):
                self.merged[left, right] = rank
                self.halves[rank] = (left, right)
                return

    def _compatible(self, left: int, right: int) -> bool:
        """Whether the merges of ``left`` followed by ``right`` leave the border between them alone."""
        bound = self.beyond
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < bound:
                return False
            # undo the later of the two merges at the border; a merge across it must come before what is undone
            if left > right:
                bound, part = left, self.halves[left][1]
                if part != left:
                    left = part
                    continue
                bound, part = right + 1, self.halves[right][0]
                if part == right:
                    return True
                right = part
            else:
                bound, part = right + 1, self.halves[right][0]
                if part != right:
                    right = part
                    continue
                bound, part = left, self.halves[left][1]
                if part == left:
                    return True
                left = part

    def _fit(self, left: int, right: int) -> bool:
        found = self.fits.get((left, right))
        if found is None:
            if len(self.fits) >= MEMORY:
                self.fits.clear()
            found = self.fits[left, right] = self._compatible(left, right)
        return found

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """The ids of one piece, given as Latin-1 characters of its bytes."""
        if piece in self.rank:
            return (self.rank[piece],)
        longest = [0] * len(piece)
        size = [0] * len(piece)
        for end, (rank, length) in self.automaton.iter(piece):
            start = end - length + 1
            if length > size[start]:
                longest[start], size[start] = rank, length
        ids: list[int] = []
        alive = bytearray(b"\x01") * (len(piece) + 1)
        at, candidate = 0, longest[0]
        while at < len(piece):
            end = at + len(self.token[candidate])
            if alive[end] and (not ids or self._fit(ids[-1], candidate)):
                ids.append(candidate)
                at = end
                if at < len(piece):
                    candidate = longest[at]
                continue
            prefix = self.shorter[candidate]
            if prefix is not None:
                candidate = prefix
                continue
            alive[at] = 0
            candidate = ids.pop()
            at -= len(self.token[candidate])
        return tuple(ids)

    def encode(self, text: str | None) -> list[int]:
        """The ids of a text; none for a null or empty text."""
        ids: list[int] = []
        known = self.known
        for piece in self.pieces.findall(text or ""):
            found = known.get(piece)
            if found is None:
                found = self.encode_piece(piece.encode("utf-8").decode("latin-1"))
                if len(piece) <= 64:  # long pieces hardly ever come back
                    if len(known) >= MEMORY:
                        known.clear()
                    known[piece] = found
            ids += found
        return ids


_encoders: dict[int, Encoder] = {}


def _encode(vocabulary) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = vocabulary.value
        encoder = _encoders.get(hash(data))
        if encoder is None:
            encoder = _encoders[hash(data)] = Encoder(data)
        for batch in batches:
            ids = [encoder.encode(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(ids, type=pa.list_(pa.int32()))], names=["id", "ids"])

    return run


def encode_corpus(documents: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, ids) of every row of ``documents``: the token ids of its text, without special tokens.

    Texts are taken as they are, whole, at any length; a string that spells a
    special token is ordinary text. An empty and a null text give an empty list,
    repeated rows stay repeated, an empty table gives an empty result. Only the two
    named columns are read. The vocabulary file is read by the driver and broadcast,
    which its checked size allows.
    """
    spark = documents.sparkSession
    with open(vocabulary, "rb") as file:
        data = file.read(VOCABULARY_BYTES + 1)
    if len(data) > VOCABULARY_BYTES:
        raise ValueError(f"{vocabulary} is larger than {VOCABULARY_BYTES} bytes")
    arrow_batches(spark)
    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(documents[key].alias("id"), documents[text].alias("text"))
    encoded = rows.mapInArrow(_encode(spark.sparkContext.broadcast(data)), f"id {kind}, ids array<int>")
    return encoded.withColumnRenamed("id", key)
