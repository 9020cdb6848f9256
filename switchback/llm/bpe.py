"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece there is one token that its encoding ends with. It
is the token ending there that is compatible with the last token of the prefix
before it: the two stay apart when their bytes are merged together. The list of
last tokens is the whole state, so bytes can be appended exactly, and time is
linear in the piece whatever it holds. The last token depends on the prefix
alone, so short pieces share what is known of their beginnings, and only the
prefixes that their last tokens lead to are looked at.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterator
from functools import cached_property

import ahocorasick
import pandas as pd
import regex
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchback.llm.common import fresh_name, short_batches

#: Entries and bytes of keys and values kept in a task's memo; a full memo is emptied, which changes no result.
MEMO, MEMO_BYTES = 250_000, 16_000_000
#: Pairs of tokens of which a task keeps whether they stay apart, and prefixes of which it keeps the last token.
MEMO_PAIRS = 150_000
#: Bytes of a piece whose prefixes are kept for other pieces.
SHORT_PIECE = 32


class Vocabulary:
    """Token ranks with what the dynamic programme asks of them."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._apart: dict[tuple[int, int], bool] = {}
        self._last: dict[bytes, int] = {}

    @classmethod
    def load(cls, content: bytes) -> Vocabulary:
        """From the text of a rank file: a base64 token and its rank a line."""
        return cls({base64.b64decode(t): int(i) for t, i in map(bytes.split, content.splitlines()) if t})

    @cached_property
    def endings(self) -> ahocorasick.Automaton:
        """Finds all tokens that end at each byte, longest first."""
        found = ahocorasick.Automaton()
        for token, i in self.ranks.items():
            found.add_word(token.decode("latin-1"), (len(token), i))
        found.make_automaton()
        return found

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for one byte and for a token that merging never makes."""
        if token not in self._halves:
            parts = [self.ranks[bytes([b])] for b in self.bytes_of[token]]
            while len(parts) > 2:
                rank, at = min((self.ranks.get(self.bytes_of[a] + self.bytes_of[b], token), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
                if rank >= token:
                    break
                parts[at : at + 2] = [rank]
            self._halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[token]

    def reachable(self, token: int) -> bool:
        return len(self.bytes_of[token]) == 1 or self.halves(token) is not None

    def apart(self, left: int, right: int) -> bool:
        """Whether the encoding of both tokens' bytes together is just these two."""
        key = (left, right)
        known = self._apart.get(key)
        if known is None:
            if len(self._apart) > MEMO_PAIRS:
                self._apart.clear()
            known = self._apart[key] = self._stay(left, right)
        return known

    def _stay(self, left: int, right: int) -> bool:
        # undo the merges, latest first; a merge across the border must never come before the one undone
        ranks, text = self.ranks, self.bytes_of
        if text[left] + text[right] in ranks:
            return False
        while True:
            a, b = self.halves(left), self.halves(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and left > right):
                made, left = left, a[1]
                across = ranks.get(text[left] + text[right])
                if across is not None and across < made:
                    return False
            else:
                made, right = right, b[0]
                across = ranks.get(text[left] + text[right])
                if across is not None and across <= made:
                    return False

    def extend(self, piece: bytes, last: list[int]) -> list[int]:
        """Appends to ``last``, which holds the last token of every shorter prefix, those of the other prefixes."""
        apart, known, done = self.apart, self._apart, len(last)
        offset = max(0, done - self.longest)
        for at, (size, token) in self.endings.iter(piece[offset:].decode("latin-1")):
            end = at + offset
            if end != done:  # found already
                continue
            begin = end + 1 - size
            if begin:
                left = last[begin - 1]
                fits = known.get((left, token))
                if fits is None:
                    fits = apart(left, token)
            else:
                fits = self.reachable(token)
            if fits:
                last.append(token)
                done += 1
        if done != len(piece):
            raise ValueError("a byte is missing in the vocabulary")
        return last

    def walk_back(self, last: list[int]) -> list[int]:
        """The tokens of the longest prefix in ``last``."""
        ids, at = [], len(last)
        while at:
            ids.append(last[at - 1])
            at -= len(self.bytes_of[last[at - 1]])
        return ids[::-1]

    def last_of(self, prefix: bytes) -> int:
        """The last token of a short prefix, from those of the shorter prefixes that its candidates leave."""
        ranks, known, pairs, end = self.ranks, self._last, self._apart, len(prefix)
        for begin in range(max(0, end - self.longest), end):  # longest first
            token = ranks.get(prefix[begin:])
            if token is None:
                continue
            if begin:
                left = known.get(before := prefix[:begin])
                if left is None:
                    left = self.last_of(before)
                fits = pairs.get((left, token))
                if fits is None:
                    fits = self.apart(left, token)
            else:
                fits = self.reachable(token)
            if fits:
                known[prefix] = token
                return token
        raise ValueError("a byte is missing in the vocabulary")

    def encode_short(self, piece: bytes) -> list[int]:
        if len(self._last) > MEMO_PAIRS:
            self._last.clear()
        ids, known, text = [], self._last, self.bytes_of
        while piece:
            token = known.get(piece)
            if token is None:
                token = self.last_of(piece)
            ids.append(token)
            piece = piece[: -len(text[token])]
        return ids[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        return self.encode_short(piece) if len(piece) <= SHORT_PIECE else self.walk_back(self.extend(piece, []))


class _Memo(dict):
    """Encoded pieces by key; a missing one is encoded."""

    def __init__(self, make):
        super().__init__()
        self.make, self.held = make, 0

    def __missing__(self, key):
        value = self.make(key)
        self.held += len(key) + len(value)
        if len(self) > MEMO or self.held > MEMO_BYTES:
            self.clear()
            self.held = len(key) + len(value)
        if self.held <= MEMO_BYTES:  # one larger than all others together is not kept
            self[key] = value
        return value


class _OddSpace(Exception):
    pass


class Encoder:
    """Texts to packed ids (little-endian unsigned 32-bit) and back."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary = vocabulary
        compiled = regex.compile(pattern)
        self.find = compiled.finditer
        self.split = (lambda text: [m.group() for m in compiled.finditer(text)]) if compiled.groups else compiled.findall
        self.space = regex.compile(r"\s").match
        self.pieces = _Memo(lambda piece: pack(vocabulary.encode_piece(piece.encode())))
        self.chunks = _Memo(self._chunks_by(self.pieces, self.split, self.space))

    @staticmethod
    def _chunks_by(pieces: _Memo, split, space):
        # without the encoder itself, which so is freed as soon as its task ends, not when cycles are collected
        def chunk_of(chunk: str) -> bytes:
            if not chunk or space(chunk):
                raise _OddSpace
            return b"".join(map(pieces.__getitem__, split(" " + chunk)))

        return chunk_of

    def _by_pieces(self, text: str) -> bytes:
        pieces = self.pieces
        return b"".join([pieces[m.group()] for m in self.find(text)])

    def encode(self, text: str | None) -> bytes:
        """A space before a non-space always opens a piece, so most texts are encoded by such chunks."""
        if not text:
            return b""
        first, *rest = text.split(" ")
        try:
            return self._by_pieces(first) + b"".join(map(self.chunks.__getitem__, rest))
        except _OddSpace:
            return self._by_pieces(text)

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, unpack(packed)))

    def replace(self, text: str, packed: bytes, start: int, end: int, new: str) -> tuple[str, bytes]:
        """``text[start:end]`` becomes ``new``; only pieces near the edit are encoded again.

        A piece depends on no more than one code point after it, and pieces are
        found from left to right, so those that end two code points before the
        edit stay, and so do those after it from the first shared border on.
        """
        edited, shift = text[:start] + new + text[end:], len(new) - (end - start)
        old = [(m.end(), len(self.pieces[m.group()])) for m in self.find(text)]
        left = max((b for b, _ in old if b <= start - 2), default=0)
        tails, right, middle = {b for b, _ in old if b >= end}, len(edited), []
        for m in self.find(edited, left):
            middle.append(self.pieces[m.group()])
            if m.end() >= start + len(new) and m.end() - shift in tails:
                right = m.end()
                break
        head = sum(n for b, n in old if b <= left)
        tail = sum(n for b, n in old if b > right - shift)
        return edited, packed[:head] + b"".join(middle) + packed[len(packed) - tail :]


def pack(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def unpack(packed: bytes) -> array:
    out = array("I")
    out.frombytes(packed)
    if sys.byteorder == "big":
        out.byteswap()
    return out


def _with_encoder(df: DataFrame, path: str, pattern: str, work, kind: str):
    """A pandas UDF over batches; the rank file, of fixed size, is read on the driver and broadcast."""
    short_batches(df)
    with open(path, "rb") as f:
        content = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(Vocabulary.load(content.value), pattern)
        for batch in batches:
            yield pd.Series([work(encoder, value) for value in batch], dtype=object)

    def run_pairs(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for made in run(batches):
            yield pd.DataFrame(made.tolist(), columns=["ids", "decoded"], dtype=object)

    return F.pandas_udf(run, kind) if kind == "binary" else F.pandas_udf(run_pairs, kind)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the packed ids of ``text``: little-endian unsigned 32-bit, no special tokens.

    Null and empty texts have no ids. Rows and other columns stay; a column
    named ``ids`` is replaced.
    """
    udf = _with_encoder(docs, path, pattern, lambda e, t: e.encode(t), "binary")
    return docs.withColumn(ids, udf(F.col(text)))


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the bytes that packed ids stand for; no ids give no bytes."""
    udf = _with_encoder(encoded, path, pattern, lambda e, packed: e.decode(packed or b""), "binary")
    return encoded.withColumn(out, udf(F.col(ids)))


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Adds ``ids`` as :func:`encode` and ``decoded`` as :func:`decode` of them, in one pass through Python."""
    def both(encoder: Encoder, text: str | None) -> tuple[bytes, bytes]:
        packed = encoder.encode(text)
        return packed, encoder.decode(packed)

    udf = _with_encoder(docs, path, pattern, both, "ids binary, decoded binary")
    made = fresh_name(docs, "made", "ids", "decoded")
    both_of = docs.withColumn(made, udf(F.col("text")))
    return both_of.withColumns({"ids": F.col(f"{made}.ids"), "decoded": F.col(f"{made}.decoded")}).drop(made)


def apply_edits(encoded: DataFrame, edits: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encodings after one edit a document, encoding again only what is near it.

    ``encoded`` has doc_id, text and packed ids; ``edits`` has doc_id, start,
    end (code points) and new; start = end = length appends. Documents without
    an edit stay as they are.
    """
    short_batches(encoded)
    with open(path, "rb") as f:
        content = encoded.sparkSession.sparkContext.broadcast(f.read())

    @F.pandas_udf("text string, ids binary")
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(Vocabulary.load(content.value), pattern)
        for batch in batches:
            yield pd.DataFrame([encoder.replace(t or "", i or b"", int(a), int(b), n or "") for t, i, a, b, n in zip(*batch)], columns=["text", "ids"])

    e = edits.select("doc_id", F.col("start").alias("__a"), F.col("end").alias("__b"), F.col("new").alias("__n"))
    joined = encoded.join(e, "doc_id", "left")
    same = joined.filter(F.col("__a").isNull()).select(*encoded.columns)
    edited = joined.filter(F.col("__a").isNotNull()).withColumn("__out", run("text", "ids", "__a", "__b", "__n"))
    return same.unionByName(edited.withColumns({"text": F.col("__out.text"), "ids": F.col("__out.ids")}).select(*encoded.columns))


def n_tokens(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
