"""Packing token pieces into windows by best-fit decreasing.

Overlong documents are first cut into full windows and a rest. Pieces are dealt
by a hash of their row into groups of bounded size; each group is packed on its own: the
longest piece first, into the open window with the least remaining capacity that
still holds it. A segment tree indexed by remaining capacity (leaf c: the open
windows with c tokens left) finds that window in O(log capacity); among equal
ones the last opened is taken.

Only lengths take part, so a group is a few numbers per piece; the ids travel in
other columns or not at all.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from blendwise.llm.common import bounded_slices, unused, written

WINDOW = 4096
GROUP_PIECES = 20_000  # pieces packed together
END_ID = 2
WORDS = 400_000  # words whose ids a worker keeps
BATCH_BYTES = 4 << 20  # text that is split at a time; one longer text is split by itself
MARK = "\x01"  # no letter, so a piece of its own, whose id no word without it can have
SIGNS = ".,;:!?#*$%&|"


class OpenWindows:
    """Segment tree over remaining capacities; every leaf is a stack of windows."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.stacks = [[] for _ in range(capacity + 1)]

    def add(self, capacity: int, window: int) -> None:
        self.stacks[capacity].append(window)
        self._change(capacity, 1)

    def _change(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Remove and return (capacity, window) of the smallest capacity >= need."""
        if need >= len(self.stacks):
            return None
        node = need + self.leaves
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not self.count[node]:
                    node += 1
        capacity = node - self.leaves
        self._change(capacity, -1)
        return capacity, self.stacks[capacity].pop()


def best_fit_decreasing(lengths: list[int], capacity: int = WINDOW) -> tuple[list[int], list[int]]:
    """(window, offset) of each piece; pieces of equal length keep their order.

    Lengths are 0 to ``capacity``; a piece of length 0 takes no room but a place.
    """
    tree, window, offset, opened = OpenWindows(capacity), [0] * len(lengths), [0] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.tightest(lengths[i])
        if found is None:
            found = capacity, opened
            opened += 1
        room, window[i] = found
        offset[i] = capacity - room
        tree.add(room - lengths[i], window[i])
    return window, offset


_TOKENIZERS: dict = {}


class WordTokenizer:
    """``tokenizers`` file applied word by word, keeping the ids of frequent words.

    Only for tokenizers whose pieces never span white space (``spaces_split`` of
    the file's splitting rule); the ids are those of the whole text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks of a worker's cores
        self.tokenizer = Tokenizer.from_file(path)
        (self.mark,) = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.known: dict[str, np.ndarray] = {}

    def _learn(self, words: list[str]) -> None:
        """Ids of new words. A run of Latin letters and the signs after it are
        separate pieces, and ASCII letters are lower-cased, so most new words are
        made of known runs. A run of ASCII letters is a piece as it is and goes to the model
        without the tokenizer's normaliser and splitter; only what is left goes through all of it."""
        known, later, new, pieces = self.known, [], {}, self.tokenizer.model.tokenize
        for w in words:
            letters = w.rstrip(SIGNS)
            if not letters.isalpha():
                new[w] = None
                continue
            if letters.isascii():
                run = letters.lower()
                ids = known.get(run)
                if ids is None:
                    ids = known[run] = array("I", [t.id for t in pieces(run)]).tobytes()
            elif max(letters) < "\u0250":
                run, ids = letters, known.get(letters)
                if ids is None:
                    new[run] = None
            else:
                new[w] = None
                continue
            signs = w[len(letters):]
            tail = known.get(signs) if signs else b""
            if ids is not None and tail is not None:
                known[w] = ids + tail
            elif run != w:
                if tail is None:
                    new[signs] = None
                later += w, run, signs  # flat, as a tuple each would be work for the garbage collector
        plain = [w for w in new if MARK not in w]
        for lo in range(0, len(plain), 2048):  # many words in one call, told apart by a mark between them
            part = plain[lo:lo + 2048]
            ids = np.array(self.tokenizer.encode(f" {MARK} ".join(part), add_special_tokens=False).ids, "<u4")
            raw, at = ids.tobytes(), 0
            for w, end in zip(part, [*(4 * np.flatnonzero(ids == self.mark)).tolist(), len(raw)]):
                known[w] = raw[at:end]
                at = end + 4
        for w in new:
            if MARK in w:
                known[w] = array("I", self.tokenizer.encode(w, add_special_tokens=False).ids).tobytes()
        for w, run, signs in zip(later[::3], later[1::3], later[2::3]):
            known[w] = known[run] + (known[signs] if signs else b"")

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text (null: none). Arrow splits the texts and numbers their words, so
        that only distinct words become Python objects; numpy puts the ids together."""
        known = self.known
        if len(known) > WORDS:
            known.clear()
        texts = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), "\n", " ")
        words = pc.split_pattern(texts, " ")  # at spaces and line ends; other white space is inside a word
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self._learn([w for w in distinct if w not in known])
        raw = [known[w] for w in distinct]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        table, starts = np.frombuffer(b"".join(raw), "<u4"), np.cumsum(sizes) - sizes
        word = coded.indices.to_numpy()
        lengths = sizes[word]
        ends = np.cumsum(lengths)
        kind = np.int32 if len(table) + (ends[-1] if len(ends) else 0) < 1 << 31 else np.int64
        ids = table[np.repeat((starts[word] - (ends - lengths)).astype(kind), lengths) + np.arange(ends[-1] if len(ends) else 0, dtype=kind)]
        edges = np.concatenate([[0], ends])[words.offsets.to_numpy() - words.offsets[0].as_py()]
        return [ids[a:b] for a, b in zip(edges[:-1], edges[1:])]


def tokenised_pieces(docs: DataFrame, path: str, end_id: int = END_ID, window: int = WINDOW,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row_id, doc_id, start, length, ids, doc_tokens`` per piece of every document.

    A document's ids are those of its text (null: empty) and ``end_id``; they are cut
    into full windows and a rest, so a document has one piece at least and each
    id lies in one piece. ``ids`` are packed little-endian unsigned 32-bit numbers.
    ``row_id`` numbers the document rows of one run, repeated doc_ids included.
    """
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("doc_id", kind),
                           *(T.StructField(c, T.LongType()) for c in ("start", "length")),
                           T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType())])

    def cut(batches):
        if path not in _TOKENIZERS:
            _TOKENIZERS[path] = WordTokenizer(path)
        row_id, end = TaskContext.get().partitionId() << 40, np.array([end_id], "<u4")
        for batch in batches:
            for part in bounded_slices(batch, 1, BATCH_BYTES):
                rows = {"row_id": [], "at": [], "start": [], "length": [], "ids": [], "doc_tokens": []}
                for i, ids in enumerate(_TOKENIZERS[path].encode(part.column(1))):
                    ids = np.append(ids, end).astype("<u4")
                    for start in range(0, len(ids), window):
                        piece = ids[start:start + window]
                        for k, v in zip(rows, (row_id, i, start, len(piece), piece.tobytes(), len(ids))):
                            rows[k].append(v)
                    row_id += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows["row_id"], pa.int64()), part.column(0).take(pa.array(rows["at"], pa.int64())),
                     *(pa.array(rows[k], pa.int64()) for k in ("start", "length")), pa.array(rows["ids"], pa.binary()),
                     pa.array(rows["doc_tokens"], pa.int64())], names=[f.name for f in schema])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(cut, schema)


def pack(pieces: DataFrame, capacity: int = WINDOW, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (row_id, start, length and any other columns) with ``sequence_id, offset``.

    ``pieces`` is written to the shared folder first, so that its rows and the size of the
    groups are fixed. Groups are formed by a hash of (row_id, start): one very
    frequent doc_id does not gather in a group. An empty table gives an empty result.
    """
    fixed = written(pieces, "pieces")
    groups = max(1, round(fixed.count() / group_pieces))
    schema = T.StructType([*(f for f in fixed.schema if f.name not in ("sequence_id", "offset")),
                           T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = [f.name for f in schema][:-2]

    def packed(key, table):
        table = table.sort_by([("row_id", "ascending"), ("start", "ascending")])
        window, offset = best_fit_decreasing(table.column("length").to_pylist(), capacity)
        ids = (key[0].as_py() << 32) + np.array(window, np.int64)
        return (table.select(names).append_column("sequence_id", pa.array(ids, pa.int64()))
                .append_column("offset", pa.array(offset, pa.int64())))

    group = unused("group", names)
    dealt = fixed.select(*names, F.pmod(F.xxhash64("row_id", "start"), F.lit(groups)).alias(group))
    return dealt.groupBy(group).applyInArrow(packed, schema)


def padding(length):
    """Tokens of padding of a sequence of ``length`` tokens (none at a power of two)."""
    power = F.bit_count(length) == 1
    return F.when(power, F.lit(0)).otherwise(F.lit(WINDOW) - length)
