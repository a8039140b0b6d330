"""Byte-level BPE encoding and decoding by backtracking over longest matches.

A piece of text is mapped byte by byte to Latin-1, so that a string automaton finds every vocabulary entry in it. The
encoding of a piece is the only sequence of entries in which every two neighbours are compatible: merging in rank order would
not have joined across their border. The search takes the longest entry at each place, falls back to its shorter prefixes where
the border is incompatible, and steps back where none fits; a place that was given up is never tried again, so the number of
steps is linear in the piece. Compatibility of two entries is memoised.

Null texts count as empty; the empty text has no ids. The ids of a text are packed as little-endian unsigned 32-bit integers.
"""

import base64
import re
from collections.abc import Callable, Iterator
from struct import Struct

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType

#: Entries of the per-process memories; they are emptied when full, which costs time only. Just under two thirds of a power of two, where a dict
#: doubles its table: a piece takes some 150 bytes, a match or a pair 80.
PIECES_KEPT = 340_000
PAIRS_KEPT = 340_000
#: Signs and ids of the pieces in one memory; with it the two memories of pieces, old ones included, stay under some 250 MB whatever the script.
PIECE_BYTES_KEPT = 16 << 20
#: Bytes of ids that leave a task at once; Spark hands over 10,000 texts together.
HANDED_ON = 1 << 20
#: Bytes by which most longest matches are decided.
NEAR = 6
#: A vocabulary file is sent to every executor; larger ones are refused.
MOST_VOCABULARY_BYTES = 64 << 20
# The characters that Unicode calls white space.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Fixed value: a common pattern of words with the space before them, numbers, signs and white space.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CHUNK = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+").findall


class Ranks:
    """A vocabulary with merge ranks, as ids and as compatibility of neighbours."""

    def __init__(self, file_content: bytes):
        lines = (line.split() for line in file_content.splitlines() if line.strip())
        self.id_of = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.bytes_of = {i: token for token, i in self.id_of.items()}
        self.merged: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.fits: dict[int, bool] = {}
        self.matcher = ahocorasick.Automaton()
        for i in sorted(self.bytes_of):
            self._learn(i)
        self.entry = {token.decode("latin-1"): i for token, i in self.id_of.items()}
        self.near: dict[str, int | None] = {}
        self.width = max(map(len, self.id_of), default=1)
        # The automaton tells how far some entry goes on from a place; the longest entry that ends on that way is the match.
        self.best: dict[str, int | None] = {"": None}
        self.prefixes: dict[int, tuple[tuple[int, int], ...]] = {}  # an entry and its shorter prefixes, with their sizes
        for word in sorted(self.matcher):
            for k in range(1, len(word)):
                if word[:k] not in self.best:
                    self.best[word[:k]] = self.best[word[: k - 1]]
            i = self.best[word] = self.matcher.get(word)
            shorter = self.best[word[:-1]]
            self.prefixes[i] = ((i, len(word)), *(self.prefixes[shorter] if shorter is not None else ()))
        self.fits.clear()

    def _learn(self, i: int) -> None:
        """Add entry ``i``, all lower ranks being known: the two entries that its last merge joins are its parts."""
        token = self.bytes_of[i]
        if len(token) == 1:
            self.parts[i] = None
        else:
            for cut in range(1, len(token)):
                left, right = self.id_of.get(token[:cut]), self.id_of.get(token[cut:])
                if left in self.parts and right in self.parts and self._compatible(left, right):
                    self.parts[i], self.merged[left, right] = (left, right), i
                    break
            else:
                return  # no merge makes it: it can only be a whole piece
        self.matcher.add_word(token.decode("latin-1"), i)

    def _compatible(self, left: int, right: int) -> bool:
        """Whether merges in rank order leave a border between the two: undo the later merge of both sides again and again;
        the border is gone if the two entries that then meet would have merged before what was undone last."""
        bound = None
        while True:
            joined = self.merged.get((left, right))
            if joined is not None and (bound is None or joined < bound):
                return False
            # On equal ranks the left merge comes first, so the right side's merge is undone first.
            undo_left = left > right
            first, second = ("left", "right") if undo_left else ("right", "left")
            for side in (first, second):
                parts = self.parts[left if side == "left" else right]
                if parts is None:
                    continue
                if side == "left":
                    bound, left = left, parts[1]
                else:
                    bound, right = right + 1, parts[0]
                break
            else:
                return True

    def longest(self, text: str, at: int) -> int:
        """The longest entry that starts at a place of a Latin-1 text. The next few bytes decide mostly, and are remembered."""
        way = self.matcher.longest_prefix(text[at : at + self.width])
        token = self.best[text[at : at + way]]
        if way < NEAR or at + NEAR > len(text):
            if len(self.near) >= PAIRS_KEPT:
                self.near.clear()
            self.near[text[at : at + NEAR]] = token
        return token

    def encode_piece(self, text: str) -> list[int]:
        """Ids of one piece, given as its bytes in Latin-1."""
        whole = self.entry.get(text)
        if whole is not None:
            return [whole]
        n, near, prefixes, fits = len(text), self.near, self.prefixes, self.fits
        given_up = bytearray(n + 1)
        out: list[int] = []
        at, before = 0, -1
        token = near.get(text[:NEAR]) if n else None
        if token is None and n:
            token = self.longest(text, 0)
        while n:
            if token is None:
                raise ValueError("the vocabulary lacks a byte")
            for candidate, size in prefixes[token]:
                end = at + size
                if given_up[end]:
                    continue
                if before < 0:
                    break
                pair = before << 32 | candidate
                fit = fits.get(pair)
                if fit is None:
                    if len(fits) >= PAIRS_KEPT:
                        fits.clear()
                    fit = fits[pair] = self._compatible(before, candidate)
                if fit:
                    break
            else:
                if before < 0:
                    raise ValueError("the vocabulary lacks a byte")
                given_up[at] = 1
                token = out.pop()
                at -= prefixes[token][0][1]
                before = out[-1] if out else -1
                continue
            out.append(candidate)
            at, before = end, candidate
            if end == n:
                break
            token = near.get(text[end : end + NEAR])
            if token is None:
                token = self.longest(text, end)
        return out


class Memory(dict):
    """What ``make`` returns, by key. The older half of the entries goes when there are too many; that costs time only."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.older, self.held = make, {}, 0

    def __missing__(self, key: str) -> bytes:
        if len(self) >= PIECES_KEPT or self.held >= PIECE_BYTES_KEPT:
            self.older = dict(self)
            self.clear()
            self.held = 0
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= 64:
            self[key] = value
            self.held += len(key) + len(value)
        return value

    def forget(self) -> None:
        self.clear()
        self.older, self.held = {}, 0


#: Packing of short lists of ids.
_PACK = [Struct(f"<{n}I").pack for n in range(33)]


class Codec:
    """With the pattern ``WORDS`` text is cut before each run of white space first: none of its matches crosses such a place, as
    words, numbers and signs take at most one space, in front. So whole chunks can be remembered, white space and word together."""

    def __init__(self, file_content: bytes, pattern: str):
        self.ranks = Ranks(file_content)
        self.split = regex.compile(pattern).findall
        self.pieces = Memory(self._piece)
        self.cut, self.parts = (CHUNK, Memory(self._chunk)) if pattern == WORDS else (self.split, self.pieces)

    def _piece(self, piece: str) -> bytes:
        ids = self.ranks.encode_piece(piece if piece.isascii() else piece.encode().decode("latin-1"))
        return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else np.array(ids, "<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        body = chunk[1:] if chunk[0] == " " else chunk
        if body.isalpha():
            return self._piece(chunk)
        if body[-1:] in (".", ",") and body[:-1].isalpha():
            return self.parts[chunk[:-1]] + self.pieces[body[-1]]
        return b"".join(map(self.pieces.__getitem__, self.split(chunk)))

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.parts.__getitem__, self.cut(text))) if text else b""

    def encoded(self, batches: Iterator[pa.Array]) -> Iterator[list[bytes]]:
        """Ids of all texts in order, a few texts at a time, so that no batch of Spark's stands whole in Python. The memories are emptied in the end and
        given back, as processes take turns: one that waits, perhaps for other work, would go on holding them."""
        for texts in batches:
            out, size = [], 0
            for text in texts:
                out.append(self.encode(text.as_py()))
                size += len(out[-1])
                if size >= HANDED_ON:
                    yield out
                    out, size = [], 0
            if out:
                yield out
        self.forget()

    def forget(self) -> None:
        """Empty all memories."""
        self.ranks.near.clear()
        self.ranks.fits.clear()
        self.pieces.forget()
        self.parts.forget()
        pa.default_memory_pool().release_unused()

    def decode(self, packed: bytes | None) -> bytes:
        ids = np.frombuffer(packed or b"", dtype="<u4").tolist()
        return b"".join(map(self.ranks.bytes_of.__getitem__, ids))


_codecs: dict[tuple, Codec] = {}


def _codec(content, pattern: str) -> Codec:
    """One codec for each process and vocabulary."""
    key = (hash(content), len(content), pattern)
    if key not in _codecs:
        _codecs[key] = Codec(content, pattern)
    return _codecs[key]


class BytePairs:
    """Encoding and decoding of columns with one vocabulary, read on the driver and sent to the executors once."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        with open(path, "rb") as file:
            content = file.read(MOST_VOCABULARY_BYTES + 1)
        if len(content) > MOST_VOCABULARY_BYTES:
            raise ValueError(f"{path} is larger than {MOST_VOCABULARY_BYTES} bytes")
        sent = spark.sparkContext.broadcast(content)

        @F.arrow_udf(BinaryType())
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for ids in _codec(sent.value, pattern).encoded(batches):
                yield pa.array(ids, pa.binary())

        @F.pandas_udf(BinaryType())
        def decode(packed: pd.Series) -> pd.Series:
            return packed.map(_codec(sent.value, pattern).decode)

        @F.arrow_udf("ids binary, decoded binary")
        def round_trip(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            codec = _codec(sent.value, pattern)
            for ids in codec.encoded(batches):
                columns = [pa.array(ids, pa.binary()), pa.array(map(codec.decode, ids), pa.binary())]
                yield pa.StructArray.from_arrays(columns, ["ids", "decoded"])

        self.encode, self.decode, self._round_trip = encode, decode, round_trip

    def round_trip(self, df: DataFrame, text: Column, name: str) -> DataFrame:
        """``df`` with a column ``name``: a struct of ``ids``, the packed ids of ``text``, and ``decoded``, the bytes that they decode to. One process
        does both, so a task holds one vocabulary."""
        return df.withColumn(name, self._round_trip(F.coalesce(text, F.lit(""))))

    def encoded(self, df: DataFrame, text: Column, ids: str) -> DataFrame:
        """``df`` with a column ``ids``: the packed ids of ``text``."""
        return df.withColumn(ids, self.encode(F.coalesce(text, F.lit(""))))


def n_ids(packed: Column) -> Column:
    return (F.octet_length(packed) / 4).cast("long")
