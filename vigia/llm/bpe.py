"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A text is cut by the pre-tokenizer pattern; every match is encoded by itself.
A match is encoded by halves: ``encode(left + right)`` is
``join(encode(left), encode(right))``, down to short leaves that run the merge
rule directly (lowest rank first, leftmost on ties).

``join`` rests on one fact about rank-ordered merging: a sequence of tokens is
*the* encoding of its bytes exactly if every two neighbours, encoded together,
stay these two tokens.  (No merge ever crosses a boundary that survives, so the
merges left and right of it run independently of each other; a crossing merge
would already happen inside the two neighbours alone.)  So only the seam can be
wrong.  ``join`` re-encodes a window around the seam and doubles it until both
window edges are stable against the tokens outside; those are then proven final.

Decoding looks each id up and concatenates pairwise up a tree.
"""

from __future__ import annotations

import base64
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import attach, lasting

#: Bytes up to which a piece is merged directly.
LEAF = 5
#: Entries that the worker's memos hold before they start anew (speed only).
CHUNKS, PIECES = 500_000, 600_000
#: Longer strings are never memoised.
MEMO_CHARS = 64
#: Where cutting at single spaces could change a match of the pattern.
_SPACES = regex.compile(r"\s ")


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a rank file (base64 token, space, rank)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merger:
    """Encodes one pre-token's bytes."""

    def __init__(self, ranks: dict[bytes, int], leaf: int = LEAF):
        self.ranks, self.leaf = ranks, max(1, leaf)
        self.stable_pairs: dict[tuple[bytes, bytes], bool] = {}
        self.merged: dict[bytes, list[bytes]] = {}

    def merge(self, piece: bytes) -> list[bytes]:
        """:meth:`_merge`, with a memo of short pieces (halves and windows of
        different words are often the same)."""
        if len(piece) > 2 * MEMO_CHARS:
            return self._merge(piece)
        got = self.merged.get(piece)
        if got is None:
            if len(self.merged) > PIECES // 4:
                self.merged.clear()
            got = self.merged[piece] = self._merge(piece)
        return got

    def _merge(self, piece: bytes) -> list[bytes]:
        """The merge rule itself: join the neighbours of lowest rank, leftmost
        first, until no two neighbours form a token."""
        rank, none = self.ranks.get, len(self.ranks) + (1 << 40)
        parts = [piece[i:i + 1] for i in range(len(piece))]
        costs = [rank(piece[i:i + 2], none) for i in range(len(piece) - 1)]
        while costs and (best := min(costs)) < none:
            at = costs.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del costs[at]
            if at:
                costs[at - 1] = rank(parts[at - 1] + parts[at], none)
            if at < len(costs):
                costs[at] = rank(parts[at] + parts[at + 1], none)
        return parts

    def stable(self, a: bytes, b: bytes) -> bool:
        """Whether neighbours a, b stay as they are when encoded together."""
        got = self.stable_pairs.get((a, b))
        if got is None:
            got = self.merge(a + b) == [a, b]
            if len(self.stable_pairs) > PIECES // 4:
                self.stable_pairs.clear()
            if len(a) + len(b) <= 2 * MEMO_CHARS:
                self.stable_pairs[a, b] = got
        return got

    def join(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        """Tokens of the concatenation from the tokens of its two halves."""
        if not left or not right:
            return left or right
        if self.stable(left[-1], right[0]):
            return left + right
        k = 1
        while True:
            a, b = max(0, len(left) - k), min(len(right), k)
            window = self.merge(b"".join(left[a:]) + b"".join(right[:b]))
            if ((a == 0 or self.stable(left[a - 1], window[0]))
                    and (b == len(right) or self.stable(window[-1], right[b]))):
                return left[:a] + window + right[b:]
            k *= 2

    def tokens(self, piece: bytes) -> list[bytes]:
        if piece in self.ranks:
            return [piece]
        if len(piece) <= self.leaf:
            return self.merge(piece)
        half = len(piece) // 2
        return self.join(self.tokens(piece[:half]), self.tokens(piece[half:]))

    def ids(self, piece: bytes) -> tuple[int, ...]:
        return tuple(map(self.ranks.__getitem__, self.tokens(piece)))


class TextEncoder:
    """Whole texts to ids: each match of ``pattern`` through ``piece_ids``.

    Where a text has no white space before a space, cutting it before every
    space never cuts a match (a match takes a space only at its start), so
    words are looked up in a memo without running the pattern."""

    def __init__(self, pattern: str, piece_ids: Callable[[str], tuple[int, ...]]):
        encoder, self.pattern = self, regex.compile(pattern)

        def pack(piece: str) -> bytes:
            return np.array(piece_ids(piece), dtype="<i4").tobytes()

        class Pieces(dict):
            def __missing__(self, piece: str) -> bytes:
                got = pack(piece)
                if len(piece) <= MEMO_CHARS:
                    self[piece] = got
                return got

        class Words(dict):
            def __missing__(self, word: str) -> bytes:
                found = encoder.pattern.findall(" " + word)
                # a word that is one match is not held a second time as a piece
                got = pack(found[0]) if len(found) == 1 else b"".join(map(encoder.pieces.__getitem__, found))
                if len(word) <= MEMO_CHARS:
                    self[word] = got
                return got

        self.pieces, self.words = Pieces(), Words()

    def by_pattern(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(text)))

    def ids(self, text: str) -> np.ndarray:
        """The ids (int32); words are held as packed ids, so a text is one
        concatenation of them."""
        if _SPACES.search(text):
            out = self.by_pattern(text)
        else:
            first, *words = text.split(" ")
            out = self.by_pattern(first) + b"".join(map(self.words.__getitem__, words))
        if len(self.pieces) > PIECES:
            self.pieces.clear()
        if len(self.words) > CHUNKS:
            self.words.clear()
        return np.frombuffer(out, dtype="<i4")


def concat_tree(parts: list[bytes]) -> bytes:
    """Concatenate neighbours pairwise, level by level."""
    while len(parts) > 1:
        parts = [b"".join(parts[i:i + 64]) for i in range(0, len(parts), 64)]
    return parts[0] if parts else b""


def shared_encoder(rank_path: str, pattern: str, leaf: int) -> TextEncoder:
    """The encoder of a Python worker: its memos last from task to task."""
    def make() -> TextEncoder:
        merger = Merger(load_ranks(rank_path), leaf)
        return TextEncoder(pattern, lambda piece: merger.ids(piece.encode("utf-8")))
    return lasting((rank_path, pattern, str(leaf)), make)


def shared_tokens(rank_path: str) -> dict[int, bytes]:
    return lasting((rank_path, "tokens"), lambda: {rank: piece for piece, rank in load_ranks(rank_path).items()})


def encode(df: DataFrame, rank_path: str, pattern: str, text_col: str = "text",
           ids_col: str = "ids", leaf: int = LEAF) -> DataFrame:
    """``df`` with ``ids_col`` array<int>: the ids of the whole text.

    Null text: as the empty text, no ids.  Special tokens' strings are
    ordinary text.  Every row is encoded by itself, so repeated rows, ties and
    empty tables need nothing special; other columns pass through, and a
    clashing ``ids_col`` raises."""
    def make():
        encoder = shared_encoder(rank_path, pattern, leaf)
        return lambda texts: pa.array([encoder.ids(t or "") for t in texts], type=pa.list_(pa.int32()))

    return attach(df, text_col, ids_col, "array<int>", make)


def decode(df: DataFrame, rank_path: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``df`` with ``bytes_col`` binary: the bytes of the ids.  Null ids: no
    bytes.  An id that is not in the vocabulary raises (KeyError)."""
    def make():
        token = shared_tokens(rank_path).__getitem__

        def run(rows: pa.ListArray) -> list:
            ids = rows.values.to_numpy(zero_copy_only=False)  # not sliced as the rows are: offsets are places in it
            ends = rows.offsets.to_pylist()
            return [concat_tree(list(map(token, ids[a:b].tolist()))) for a, b in zip(ends, ends[1:], strict=False)]
        return run

    return attach(df, ids_col, bytes_col, "binary", make, arrow=True)


def digests(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per input row: id, number of ids, SHA-256 of the decimal ids
    joined by commas, SHA-256 of the decoded bytes."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = encode(rows, rank_path, pattern).drop("text")
    rows = decode(rows, rank_path)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
