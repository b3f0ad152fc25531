"""LM scoring by masked pseudo-likelihood with a bidirectional window network.

Every token of a document is masked in turn and predicted from the token on its
left and the token on its right; the sum of the conditional log-probabilities
scores the document (Wang & Cho 2019).

Tokens: the corpus's most frequent lower-cased words and, for all other words,
hash classes; one more token stands for both ends of a text. Counting the words
covers every document. A word of a class is predicted as itself: the probability of
its class in the context, times the word's share of the class, counted over the whole corpus. The shares
are a table of all words. Those of the KNOWN most frequent words go to the workers, the others are joined to
the words of the documents; no word is left to its class alone.

Network: a left and a right embedding are added and pass through tanh to a
softmax over all tokens. It is fitted to the counts of (left, token, right)
over the whole corpus, which Spark aggregates: for a network of this window they
hold all that the corpus says about it, their number is bounded by the
vocabulary, and one training pass costs the same at any corpus size. Each of
PARTS partitions of contexts runs Adam steps in numpy, the parameters are
averaged by token counts, and ROUNDS such rounds are made.

Scoring needs one normaliser per context; that table is bounded by the
vocabulary too and goes to the workers with the parameters.
"""

from __future__ import annotations

from collections import Counter
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blendwise.llm.common import bounded_slices, written

WORDS, CLASSES = 191, 64  # frequent words and hash classes; with the end token 256
VOCABULARY = WORDS + CLASSES + 1
END = VOCABULARY - 1
WIDTH = 32
PARTS, ROUNDS, STEP_CONTEXTS = 8, 3, 512
LEFT_PARTS = 32  # tasks that add the context counts; each holds the cells of the left tokens it has
BILLION = 1_000_000_000
REMEMBERED = 100_000  # words of classes that a worker keeps the tokens of
SLICE_BYTES = 1 << 20  # text that a worker splits into words at a time; one longer text is split by itself
KNOWN, LONGEST = 50_000, 100  # shares that workers hold, of words of at most so many characters; all others are joined


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def _word_counts(batches):
    """(word, n) of the task's documents, combined in memory and emitted when many."""
    counts = Counter()
    _TABLES.clear()  # of a model before; its worker counts now

    def emit():
        return pa.record_batch([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                               names=["word", "n"])

    for batch in batches:
        for part in bounded_slices(batch, 0, SLICE_BYTES):
            for text in part.column(0).to_pylist():
                counts.update(words_of(text))
                if len(counts) > 200_000:
                    yield emit()
                    counts.clear()
    yield emit()


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(word, n)``: every lower-cased word of all documents."""
    counts = docs.select(F.col(text_col).alias("text")).mapInArrow(_word_counts, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


def _most_frequent(counts: DataFrame) -> list[str]:
    return [r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(WORDS).collect()]


def vocabulary(docs: DataFrame, text_col: str = "text") -> list[str]:
    """The WORDS most frequent lower-cased words of all documents (ties by word); ``class_shares`` has the rest."""
    return _most_frequent(word_counts(docs, text_col))


def class_shares(counts: DataFrame, words: list[str]) -> DataFrame:
    """``(word, n, share)`` of every word outside ``words``: log of its share of its hash class, in whole billionths."""

    @F.pandas_udf("int")
    def token(column: pd.Series) -> pd.Series:
        tokens = Tokens(words)
        return column.map(tokens.__getitem__)

    classed = counts.select("word", "n", token("word").alias("token")).where(F.col("token") >= WORDS)
    totals = classed.groupBy("token").agg(F.sum("n").alias("total"))  # CLASSES rows
    share = F.round(F.log(F.col("n") / F.col("total")) * BILLION).cast("long")
    return classed.join(F.broadcast(totals), "token").select("word", "n", share.alias("share"))


def _class_of(word: str) -> int:
    return WORDS + xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) % CLASSES


class Tokens(dict):
    """word -> token; words outside the vocabulary go to hash classes.

    The i-th of the words ``known`` (from 1) also has VOCABULARY * i in its number.
    """

    def __init__(self, words: list[str], known: list[str] = ()):
        super().__init__((w, i) for i, w in enumerate(words))
        self.update((w, VOCABULARY * i + _class_of(w)) for i, w in enumerate(known, 1))
        self.first = len(self)

    def __missing__(self, word):
        token = _class_of(word)
        if len(self) > self.first + REMEMBERED:
            kept = list(islice(self.items(), self.first))  # a dict keeps the order of its words
            self.clear()
            self.update(kept)
        self[word] = token
        return token

    def of(self, text: str | None) -> np.ndarray:
        """Tokens of a text between two end tokens."""
        return self.of_words(words_of(text))

    def of_words(self, words: list[str]) -> np.ndarray:
        out = np.full(len(words) + 2, END, np.int64)
        out[1:-1] = np.array(list(map(self.__getitem__, words)), np.int64)
        return out


def context_counts(docs: DataFrame, words: list[str], text_col: str = "text") -> DataFrame:
    """``(context, token, n)`` over all documents; context is left * VOCABULARY + right.

    A task's counts leave it as one row per left token, which holds the (right, token) cells
    seen and their counts as numbers, so that they are added without a row for each.
    """

    def count(batches):
        tokens, cells, one = Tokens(words), np.zeros(VOCABULARY ** 3, np.int32), np.int32(1)  # of the same type, which numpy adds much faster
        for batch in batches:
            for part in bounded_slices(batch, 0, SLICE_BYTES):
                for text in part.column(0).to_pylist():
                    t = tokens.of(text)
                    if len(t) > 2:
                        np.add.at(cells, (t[:-2] * VOCABULARY + t[2:]) * VOCABULARY + t[1:-1], one)
        for left, of_left in enumerate(cells.reshape(VOCABULARY, -1)):
            seen = np.flatnonzero(of_left)
            if len(seen):
                yield pa.record_batch([pa.array([left], pa.int32()), pa.array([seen.astype("<u2").tobytes()], pa.binary()),
                                       pa.array([of_left[seen].astype("<i4").tobytes()], pa.binary())], names=["left", "cells", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "left int, cells binary, n binary")
    return rows.repartition(LEFT_PARTS, "left").mapInArrow(_added, "context int, token int, n long")


def _added(batches):
    """Rows of ``context_counts`` of the left tokens that a task has, a few; their cells are bounded by the vocabulary."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for i in range(batch.num_rows):
            left, cells, n = (c[i] for c in batch.columns)
            if left.as_py() not in sums:
                sums[left.as_py()] = np.zeros(VOCABULARY ** 2, np.int64)
            sums[left.as_py()][np.frombuffer(cells.as_buffer(), "<u2")] += np.frombuffer(n.as_buffer(), "<i4")
    for left, n in sums.items():
        seen = np.flatnonzero(n)
        yield pa.record_batch([pa.array((left * VOCABULARY + seen // VOCABULARY).astype(np.int32)),
                               pa.array((seen % VOCABULARY).astype(np.int32)), pa.array(n[seen])], names=["context", "token", "n"])


def initial(seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = lambda *s: rng.normal(0, 0.1, s).astype(np.float32)
    return {"left": draw(VOCABULARY, WIDTH), "right": draw(VOCABULARY, WIDTH), "hidden": np.zeros(WIDTH, np.float32),
            "out": draw(WIDTH, VOCABULARY), "bias": np.zeros(VOCABULARY, np.float32)}


def _log_softmax(logits: np.ndarray) -> np.ndarray:
    logits = logits - logits.max(1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(1, keepdims=True))


def activations(p, left, right) -> np.ndarray:
    return np.tanh(p["left"][left] + p["right"][right] + p["hidden"])


def gradients(p, contexts: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the mean negative log-likelihood of dense (contexts, VOCABULARY) counts."""
    left, right = contexts // VOCABULARY, contexts % VOCABULARY
    h = activations(p, left, right)
    total = counts.sum(1, keepdims=True)
    d = (np.exp(_log_softmax(h @ p["out"] + p["bias"])) * total - counts) / counts.sum()
    d = d.astype(np.float32)
    dh = (d @ p["out"].T) * (1 - h * h)
    g = {"out": h.T @ d, "bias": d.sum(0), "hidden": dh.sum(0), "left": np.zeros_like(p["left"]),
         "right": np.zeros_like(p["right"])}
    np.add.at(g["left"], left, dh)
    np.add.at(g["right"], right, dh)
    return g


def _fit_part(p, contexts, tokens, n, rate: float):
    """Adam over the part's contexts, in an order mixed by a fixed rule; returns parameters and weight."""
    order = np.lexsort((tokens, contexts))
    contexts, tokens, n = contexts[order], tokens[order], n[order].astype(np.float32)
    firsts = np.flatnonzero(np.diff(contexts, prepend=-1))
    ends = np.append(firsts[1:], len(contexts))
    mixed = np.random.default_rng(len(firsts)).permutation(len(firsts))
    p = {k: v.copy() for k, v in p.items()}
    m, s = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for step, lo in enumerate(range(0, len(mixed), STEP_CONTEXTS), 1):
        chosen = mixed[lo:lo + STEP_CONTEXTS]
        dense = np.zeros((len(chosen), VOCABULARY), np.float32)
        for row, c in enumerate(chosen):
            dense[row, tokens[firsts[c]:ends[c]]] = n[firsts[c]:ends[c]]
        for k, g in gradients(p, contexts[firsts[chosen]], dense).items():
            m[k] = 0.9 * m[k] + 0.1 * g
            s[k] = 0.98 * s[k] + 0.02 * g * g
            p[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.98 ** step)) + 1e-7)
    return p, float(n.sum())


def _pack(p) -> bytes:
    return b"".join(np.ascontiguousarray(p[k], np.float32).tobytes() for k in sorted(p))


def _unpack(raw: bytes) -> dict[str, np.ndarray]:
    p, at, flat = initial(), 0, np.frombuffer(raw, np.float32)
    for k in sorted(p):
        p[k], at = flat[at:at + p[k].size].reshape(p[k].shape).copy(), at + p[k].size
    return p


def train(counts: DataFrame, rounds: int = ROUNDS, rate: float = 0.02) -> dict[str, np.ndarray]:
    """Parameters fitted to ``counts`` (see context_counts); the start values if it is empty.

    Per round the driver receives PARTS parameter sets of fixed size.
    """
    counts = written(counts.withColumn("part", F.pmod(F.xxhash64("context"), F.lit(PARTS)).cast("int")), "lm-counts")
    unigrams = {r["token"]: r["n"] for r in counts.groupBy("token").agg(F.sum("n").alias("n")).collect()}
    p = initial()
    if not unigrams:
        return p
    p["bias"][:] = np.log([unigrams.get(t, 0) + 0.5 for t in range(VOCABULARY)])
    p["bias"] -= p["bias"].max()
    for i in range(rounds):
        # a part holds a fixed share of a table that the vocabulary bounds
        sets = (counts.groupBy("part").applyInArrow(_round(_pack(p), rate / (1 + i)), "part int, weight double, params binary")
                .orderBy("part").collect())
        total = sum(r["weight"] for r in sets)
        p = {k: sum(np.float32(r["weight"] / total) * _unpack(r["params"])[k] for r in sets) for k in p}
    return p


def _round(start: bytes, rate: float):
    def fit(key, table):
        columns = [table.column(c).to_numpy() for c in ("context", "token", "n")]
        p, weight = _fit_part(_unpack(start), *columns, rate)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "weight": [weight],
                         "params": pa.array([_pack(p)], pa.binary())})

    return fit


def normalisers(p) -> np.ndarray:
    """log of the softmax denominator of every context, (left, right)."""
    out, right = np.empty((VOCABULARY, VOCABULARY), np.float32), np.arange(VOCABULARY)
    for left in range(VOCABULARY):
        logits = activations(p, np.full(VOCABULARY, left), right) @ p["out"] + p["bias"]
        top = logits.max(1, keepdims=True)
        out[left] = (top + np.log(np.exp(logits - top).sum(1, keepdims=True)))[:, 0]
    return out


def log_probabilities(p, z: np.ndarray) -> np.ndarray:
    """log p(token | left, right) of every (left, right, token)."""
    out = np.empty((VOCABULARY,) * 3, np.float32)
    right, token = np.divmod(np.arange(VOCABULARY ** 2), VOCABULARY)
    weights, bias = p["out"].T[token], p["bias"][token]
    for left in range(VOCABULARY):
        h = activations(p, np.full(VOCABULARY, left), right[::VOCABULARY])[right]
        out[left] = (np.einsum("ij,ij->i", h, weights) + bias - z[left, right]).reshape(VOCABULARY, -1)
    return out


_TABLES: dict[bytes, np.ndarray] = {}


def document_score(p, z: np.ndarray, t: np.ndarray) -> float:
    """Sum of log p(token | left, right) over the tokens between the two ends.

    A worker makes the table of all (left, right, token) once per model; the vocabulary bounds it.
    """
    return _score(_table(p, z), t)


def _table(p, z: np.ndarray) -> np.ndarray:
    key = xxhash.xxh3_128_digest(_pack(p) + z.tobytes())
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = log_probabilities(p, z).ravel()
    return _TABLES[key]


def _score(table: np.ndarray, t: np.ndarray) -> float:
    return float(table[(t[:-2] * VOCABULARY + t[2:]) * VOCABULARY + t[1:-1]].sum(dtype=np.float64))


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, log_likelihood, mean_log_likelihood`` per row of ``docs``.

    Null and empty texts and texts of white space have no tokens, log-likelihood 0
    and a null mean. Repeated rows each get their score. Extra columns are not
    read. An empty table gives an empty result.
    """
    counts = written(word_counts(docs, text_col), "lm-words")
    words = _most_frequent(counts)
    shares = written(class_shares(counts, words), "lm-shares")
    top = shares.where(F.length("word") <= LONGEST).orderBy(F.desc("n"), "word").limit(KNOWN).select("word", "share")
    known = {r["word"]: r["share"] for r in top.collect()}
    p = train(context_counts(docs, words, text_col))
    z = normalisers(p)
    shares_of = np.array([0, *known.values()], np.int64)

    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()),
                           T.StructField("log_likelihood", T.DoubleType()), T.StructField("known", T.LongType()),
                           T.StructField("others", T.ArrayType(T.StringType()))])

    def score(batches):
        tokens, table = Tokens(words, list(known)), _table(p, z)
        for batch in batches:
            for part in bounded_slices(batch, 1, SLICE_BYTES):
                rows = []
                for t in part.column(1).to_pylist():
                    own = words_of(t)
                    place, row = np.divmod(tokens.of_words(own), VOCABULARY)
                    others = np.flatnonzero((row[1:-1] >= WORDS) & (place[1:-1] == 0))
                    rows.append((len(own), _score(table, row), int(shares_of[place].sum()), [own[i] for i in others.tolist()]))
                columns = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), pa.float64(), pa.int64(), pa.list_(pa.string()))))],
                    names=schema.names)

    # written, so that a row keeps its number
    scored = written(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(score, schema)
                     .withColumn("row", F.monotonically_increasing_id()), "lm-scores")
    found = scored.select(F.col("row").alias("of"), F.explode("others").alias("word")).join(shares.select("word", "share"), "word")
    within = found.groupBy("of").agg(F.sum("share").alias("within"))
    total = F.col("log_likelihood") + (F.col("known") + F.coalesce("within", F.lit(0).cast("long"))) / BILLION
    return (scored.drop("others").join(within, F.col("row") == F.col("of"), "left")
            .select("doc_id", "n_tokens", total.alias("log_likelihood"),
                    F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean_log_likelihood")))
