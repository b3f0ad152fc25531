"""Quality classifier: a byte-level convolutional network in numpy.

The UTF-8 bytes of a document are cut into chunks of CHUNK bytes that overlap by
half and cover the whole document. Learned filters of WIDTH bytes over byte
embeddings run over every chunk; each filter is max-pooled per chunk. The
document's vector, the maximum and the mean of its chunks' pooled activations,
goes through a small hidden layer to one probability.

Memory is bounded: a document of any length is processed in blocks of chunks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK, HALF = 256, 128
WIDTH, STRIDE = 8, 4
EMBED, FILTERS, HIDDEN = 4, 24, 16
BLOCK = 1024  # half chunks convolved at once
SAMPLE = 2400  # labelled documents used for fitting
LEAK = 0.05  # slope of a hidden unit below zero
EPOCHS, STEPS = 10, 300  # at least so many passes, and so many steps


def _halves(raw: bytes) -> np.ndarray:
    """Rows of HALF bytes plus the filter overhang; at least one row unless empty."""
    n = -(-len(raw) // HALF)
    buffer = np.zeros(n * HALF + WIDTH - STRIDE, np.uint8)
    buffer[:len(raw)] = np.frombuffer(raw, np.uint8)
    return np.lib.stride_tricks.as_strided(buffer, (n, HALF + WIDTH - STRIDE), (HALF, 1))


class ByteCNN:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        scale = lambda *s: rng.normal(0, (2 / s[0]) ** 0.5, s).astype(np.float32)
        self.p = {"emb": rng.normal(0, 0.5, (256, EMBED)).astype(np.float32), "conv": scale(WIDTH * EMBED, FILTERS),
                  "conv_b": np.zeros(FILTERS, np.float32), "h": scale(2 * FILTERS, HIDDEN), "h_b": np.zeros(HIDDEN, np.float32),
                  "o": scale(HIDDEN, 1), "o_b": np.zeros(1, np.float32)}
        self.p["emb"][0] = 0  # padding

    def windows(self, rows: np.ndarray) -> np.ndarray:
        """(rows, windows, WIDTH * EMBED) embedded filter inputs."""
        e = np.ascontiguousarray(self.p["emb"][rows])
        view = np.lib.stride_tricks.as_strided(
            e, (len(rows), HALF // STRIDE, WIDTH * EMBED), (e.strides[0], STRIDE * e.strides[1], e.strides[2]))
        return view.reshape(-1, WIDTH * EMBED)

    def pooled(self, raw: bytes, where: bool = False):
        """Max-pooled activations (half chunks, FILTERS) before the ReLU, and the winning windows."""
        rows = _halves(raw)
        best, at = np.empty((len(rows), FILTERS), np.float32), []
        for lo in range(0, len(rows), BLOCK):
            out = (self.windows(rows[lo:lo + BLOCK]) @ self.p["conv"]).reshape(-1, HALF // STRIDE, FILTERS)
            if lo + BLOCK >= len(rows):  # windows that begin after the text do not count
                used = -(-(len(raw) - (len(rows) - 1) * HALF) // STRIDE)
                out[-1, used:] = -np.inf
            if where:
                at.append(out.argmax(1))
            out.max(axis=1, out=best[lo:lo + BLOCK])
        return best + self.p["conv_b"], (np.concatenate(at) if where else None)

    @staticmethod
    def document(best: np.ndarray):
        """Document vector of pooled halves: maximum and mean over overlapping chunks."""
        halves = np.maximum(best, 0)
        chunks = np.maximum(halves[:-1], halves[1:]) if len(halves) > 1 else halves
        return np.concatenate([halves.max(0), chunks.mean(0)]), halves, chunks

    def head(self, vector):
        hidden = vector @ self.p["h"] + self.p["h_b"]
        hidden = np.where(hidden > 0, hidden, LEAK * hidden)  # a unit that is negative everywhere still learns
        return hidden, 1 / (1 + np.exp(-np.clip(hidden @ self.p["o"] + self.p["o_b"], -30, 30)))

    def score(self, text: str | None) -> float:
        raw = (text or "").encode("utf-8", "surrogatepass")
        vector = self.document(self.pooled(raw)[0])[0] if raw else np.zeros(2 * FILTERS, np.float32)
        return float(self.head(vector)[1][0])

    def gradient(self, raw: bytes, label: float, grads: dict) -> None:
        if raw:
            best, at = self.pooled(raw, where=True)
            vector, halves, chunks = self.document(best)
        else:
            vector = np.zeros(2 * FILTERS, np.float32)
        hidden, prob = self.head(vector)
        d = (prob - label).astype(np.float32)
        grads["o"] += hidden[:, None] * d
        grads["o_b"] += d
        dh = (self.p["o"][:, 0] * d) * np.where(hidden > 0, np.float32(1), np.float32(LEAK))
        grads["h"] += np.outer(vector, dh)
        grads["h_b"] += dh
        if not raw:
            return
        dv = self.p["h"] @ dh
        top, mean = dv[:FILTERS], dv[FILTERS:] / len(chunks)
        db = np.zeros_like(halves)
        cols = np.arange(FILTERS)
        db[halves.argmax(0), cols] += top
        if len(halves) > 1:
            first = halves[:-1] >= halves[1:]
            db[:-1] += first * mean
            db[1:] += ~first * mean
        else:
            db += mean
        db *= halves > 0
        grads["conv_b"] += db.sum(0)
        row, col = np.nonzero(db)
        if not len(row):  # every hidden unit or filter is silent for this document
            return
        starts = at[row, col] * STRIDE
        rows = _halves(raw)
        data = rows[row[:, None], starts[:, None] + np.arange(WIDTH)]  # (k, WIDTH) bytes
        g = db[row, col]
        inputs = self.p["emb"][data].reshape(len(row), -1)
        np.add.at(grads["conv"].T, col, inputs * g[:, None])
        np.add.at(grads["emb"], data.ravel(), (self.p["conv"].T[col] * g[:, None]).reshape(-1, EMBED))

    def fit(self, examples: list[tuple[bytes, int]], epochs: int = EPOCHS, batch: int = 32, rate: float = 4e-3, seed: int = 11):
        epochs = max(epochs, -(-STEPS // -(-len(examples) // batch)))
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, total = 0, epochs * -(-len(examples) // batch)
        for _ in range(epochs):
            order = _mixed_classes([y for _, y in examples], rng)
            for lo in range(0, len(order), batch):
                grads = {k: np.zeros_like(v) for k, v in self.p.items()}
                chosen = order[lo:lo + batch]
                for i in chosen:
                    self.gradient(*examples[i], grads)
                step += 1
                now = rate * (1 - step / (total + 1))
                for k, g in grads.items():
                    g /= len(chosen)
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v2[k] = 0.999 * v2[k] + 0.001 * g * g
                    self.p[k] -= now * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v2[k] / (1 - 0.999 ** step)) + 1e-8)
                self.p["emb"][0] = 0
        return self


def _mixed_classes(labels: list[int], rng) -> np.ndarray:
    """Places of as many examples as there are, in turns of both labels: the rarer label's are drawn again and again,
    so that every batch has both, however rare one is and in whatever order the rows come."""
    labels = np.array(labels)
    sides = [rng.permutation(np.flatnonzero(labels == y)) for y in (0, 1)]
    if not all(map(len, sides)):
        return rng.permutation(len(labels))
    half = -(-len(labels) // 2)
    sides = [np.concatenate([rng.permutation(s) for _ in range(-(-half // len(s)))])[:half] for s in sides]
    return np.stack(sides, axis=1).ravel()[:len(labels)]


def held_out(id_col: str = "doc_id"):
    """Whether a row belongs to the held-out fold: crc32 of the id as text, mod 5, is 0.

    A null id counts as the empty text.
    """
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str = "quality", size: int = SAMPLE,
                    id_col: str = "doc_id", text_col: str = "text") -> list[tuple[bytes, int]]:
    """At most ``size`` labelled texts outside the held-out fold, fetched to the driver.

    Chosen by a hash of the id, so the sample is the same in every run. Of a label
    that is given twice the smaller value counts; rows with null labels, ids or
    texts are left out. The broadcast side holds at most ``size`` ids.
    """
    chosen = (labels.where(F.col(target).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
              .groupBy(F.col(id_col).alias("__id")).agg(F.min(target).alias("__label"))
              .orderBy(F.xxhash64("__id"), "__id").limit(size))
    rows = (docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).where(F.col("__text").isNotNull())
            .join(F.broadcast(chosen), "__id").orderBy(F.xxhash64("__id"), "__id", "__text").limit(size)
            .select("__text", "__label").collect())
    return [(r[0].encode("utf-8", "surrogatepass"), int(r[1])) for r in rows]


def score_column(model: ByteCNN, text):
    """Column of probabilities (double, 0 to 1) of a string column; null counts as empty."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return score(text)


def fit_quality(docs: DataFrame, labels: DataFrame, target: str = "quality", size: int = SAMPLE,
                id_col: str = "doc_id", text_col: str = "text") -> ByteCNN:
    """Fit the network on a bounded labelled sample, both labels taking equal parts in it.

    Without any labelled row the untrained network's prior (one half) is what every text
    scores. Repeated rows are sampled as they come, columns besides the named ones are not read.
    """
    examples = labelled_sample(docs, labels, target, size, id_col, text_col)
    model = ByteCNN()
    if not examples:
        model.p["o"][:] = 0
        return model
    return model.fit(examples)
