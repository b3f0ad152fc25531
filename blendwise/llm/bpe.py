"""Byte-level BPE encoding and decoding with an Aho-Corasick automaton.

The bytes of a text are mapped to Latin-1 characters, one per byte, so that
pyahocorasick can match tokens over them. Encoding a piece (one match of the
split pattern) walks from left to right, takes the longest token at each
position and backtracks to shorter ones. A token may follow another only if BPE
merging of the two would leave exactly these two tokens; that test is memoised per
pair. A sequence of tokens whose neighbours are all compatible is the result
of the merges, and positions proven to be dead ends are marked, so every
position is left at most once per token length: the time is linear in the piece.
"""

from __future__ import annotations

import base64
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORDS = 400_000  # words whose ids a worker keeps
PAIRS = 300_000  # compatibility results a worker keeps
SIGNS = ".,;:!?#*$%&|"
SHORT = 64  # bytes up to which a piece is matched position by position


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class ByteBPE:
    """Encoder and decoder for a rank file; ``pattern`` splits texts into pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.split = regex.compile(pattern)
        self.parts = {}  # rank -> the two ranks whose merge forms it; itself for bytes
        self.formed = {}  # (left, right) -> rank
        self.shorter = {}  # rank -> rank of the longest proper prefix in the automaton
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            halves = self._halves(token, rank)
            if halves:
                self.parts[rank] = halves
                if len(token) > 1:
                    self.formed[halves] = rank
                self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self.automaton.make_automaton()
        for rank in self.parts:
            token = self.token[rank]
            self.shorter[rank] = self._longest_token(token[:-1])
        self.longest_of = {}  # every prefix of a token (as Latin-1) -> its longest token
        for rank in self.parts:
            token = self.token[rank]
            for end in range(len(token), 0, -1):
                prefix = token[:end].decode("latin-1")
                if prefix in self.longest_of:
                    break
                self.longest_of[prefix] = self._longest_token(token[:end])
        self.sizes = {rank: len(token) for rank, token in self.token.items()}
        self.compatible = {}
        self.words = {}
        self.inside_run = regex.compile(r"\s (?!\S)")

    def _halves(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """Last merge of a token; None if merging lower ranks never leads to it."""
        if len(token) == 1:
            return rank, rank
        parts = [token[i:i + 1] for i in range(len(token))]
        ranks = self.ranks
        while len(parts) > 2:
            best, at = min(((ranks.get(a + b, rank), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))),
                           default=(rank, 0))
            if best >= rank:
                return None
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return ranks[parts[0]], ranks[parts[1]]

    def _longest_token(self, prefix: bytes) -> int | None:
        for end in range(len(prefix), 0, -1):
            rank = self.ranks.get(prefix[:end])
            if rank in self.parts:
                return rank
        return None

    def _follows(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens gives exactly these tokens.

        The merges are undone from the latest on: the token of higher rank was
        formed later, so before that its inner part faced the boundary. If the two
        parts at the boundary could have merged before the younger of them grew
        on, the boundary would not have survived.
        """
        key = (left, right)
        a, b, limit = left, right, 1 << 62
        result = None
        while result is None:
            merged = self.formed.get((a, b))
            if merged is not None and merged < limit:
                result = False
            elif a > b:
                limit, inner = a, self.parts[a][1]
                if inner != a:
                    a = inner
                else:  # a single byte: undo the other side instead
                    limit, inner = b + 1, self.parts[b][0]
                    if inner == b:
                        result = True
                    b = inner
            else:
                limit, inner = b + 1, self.parts[b][0]
                if inner != b:
                    b = inner
                else:
                    limit, inner = a, self.parts[a][1]
                    if inner == a:
                        result = True
                    a = inner
        if len(self.compatible) >= PAIRS:
            self.compatible.clear()
        self.compatible[key] = result
        return result

    def _all_longest(self, text: str) -> list[int]:
        """Rank of the longest token that begins at each byte, from one pass of the automaton."""
        longest, size = [0] * len(text), [0] * len(text)
        for end, (rank, length) in self.automaton.iter(text):
            start = end - length + 1
            if length > size[start]:
                longest[start], size[start] = rank, length
        return longest

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        text, n = piece.decode("latin-1"), len(piece)
        reach, longest_of = self.automaton.longest_prefix, self.longest_of
        at_byte = self._all_longest(text) if n > SHORT else None
        sizes, compatible = self.sizes, self.compatible
        closed = set()  # positions that no sequence of compatible tokens continues from
        ids, at, last = [], 0, None
        candidate = at_byte[0] if at_byte else longest_of[text[:reach(text)]]
        while True:
            end = at + sizes[candidate]
            if end not in closed:
                if last is None:
                    fits = True
                else:
                    fits = compatible.get((last, candidate))
                    if fits is None:
                        fits = self._follows(last, candidate)
                if fits:
                    ids.append(candidate)
                    if end == n:
                        return ids
                    at, last = end, candidate
                    if at_byte:
                        candidate = at_byte[at]
                    else:
                        rest = text[at:]
                        candidate = longest_of[rest[:reach(rest)]]
                    continue
            candidate = self.shorter[candidate]
            while candidate is None:  # dead end: give up the token before
                closed.add(at)
                gone = ids.pop()
                at -= sizes[gone]
                last = ids[-1] if ids else None
                candidate = self.shorter[gone]

    def encode(self, text: str) -> bytes:
        """Ids of a text, packed as little-endian unsigned 32-bit numbers.

        A piece never crosses a space that a non-space follows or precedes, so the
        text is cut there first and the ids of frequent words are kept. Only spaces
        inside a longer run of white space need the text as a whole.
        """
        if self.inside_run.search(text):
            return self._encode_part(text)
        known, out = self.words, []
        words = text.split(" ")
        words[1:] = [" " + w for w in words[1:]]
        for word in words:
            ids = known.get(word)
            if ids is None:
                ids = self._encode_part(word)
                if len(word) <= SHORT:
                    if len(known) >= WORDS:
                        known.clear()
                    known[word] = ids
            out.append(ids)
        return b"".join(out)

    def _encode_part(self, text: str) -> bytes:
        if text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):  # one run of letters is one piece
            return array("I", self.encode_piece(text.encode("utf-8"))).tobytes()
        letters = text.rstrip(SIGNS)
        if letters != text and letters[1:].isalpha() and (letters[0] == " " or letters[0].isalpha()):
            known = self.words.get(letters)  # the signs after a run of letters are a piece of their own
            if known is None:
                known = array("I", self.encode_piece(letters.encode("utf-8"))).tobytes()
                if len(letters) <= SHORT and len(self.words) < WORDS:
                    self.words[letters] = known
            return known + array("I", self.encode_piece(text[len(letters):].encode())).tobytes()
        ids = []
        for piece in self.split.findall(text):
            ids += self.encode_piece(piece.encode("utf-8"))
        return array("I", ids).tobytes()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> ByteBPE:  # once per worker
    return ByteBPE(read_ranks(path), pattern)


@lru_cache(maxsize=2)
def _tokens(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(path).items()}


def _mapped(df: DataFrame, column: str, name: str, kind, fn) -> DataFrame:
    """``df`` with ``name`` added last (a column of that name is replaced)."""
    kept = [c for c in df.columns if c != name]
    source = df.select(*[f"`{c}`" for c in kept], F.col(f"`{column}`").alias("__in"))
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(name, kind)])

    def run(batches):
        convert = fn()
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                values = [None if v is None else convert(v) for v in part.column(part.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(values, pa.binary())], names=[*kept, name])

    return source.mapInArrow(run, schema)


def encode(df: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with ``ids_col``: the token ids of ``text_col``, packed as little-endian
    unsigned 32-bit numbers (binary).

    ``path`` is a rank file (base64 token and rank a line) that every executor can
    read, ``pattern`` the regular expression that cuts a text into pieces. Null texts
    give null ids, empty texts empty ids; no special tokens are recognised. A column
    of the name ``ids_col`` is replaced, all others pass through unchanged.
    """
    def worker():
        bpe = _encoder(path, pattern)
        return bpe.encode

    return _mapped(df, text_col, ids_col, T.BinaryType(), worker)


def decode(df: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with ``out_col``: the bytes of the packed ids in ``ids_col`` (null: null).

    An id that the file does not hold is an error.
    """
    def worker():
        token = _tokens(path)
        return lambda packed: b"".join(map(token.__getitem__, np.frombuffer(packed, "<u4").tolist()))

    return _mapped(df, ids_col, out_col, T.BinaryType(), worker)
