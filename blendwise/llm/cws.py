"""Document fingerprints by consistent weighted sampling.

Terms are lower-cased words, weighted by their number of occurrences. Each of
SAMPLES samples draws, per term, r and c from a Gamma(2, 1) distribution and b
uniformly, all from a hash of the term (Ioffe 2010). With weight w,
    t = floor(ln w / r + b),  y = exp(r (t - b)),  a = c / (y exp r),
and the sample is the (term, t) with the smallest a. Two documents agree in a
sample with the probability of their generalised Jaccard similarity, the sum of the smaller
over the sum of the larger weights. A fingerprint holds 16 bits of a hash of every
(term, t): unequal samples agree by chance once in 65,536.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLES = 64
BLOCK = 2048  # (term, weight) pairs compared at once
DRAWN = 256  # pairs drawn at once: their numbers stay in a core's cache
RANGE_BYTES = 4 << 20  # text per range of documents
MAX_RANGES = 5000  # beyond it ranges grow: they are sorted with spill and read as a stream


def _mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: independent 64-bit values from a counter."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    shifted = np.empty_like(x)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= np.right_shift(x, np.uint64(shift), out=shifted)
        x *= np.uint64(factor)
    x ^= np.right_shift(x, np.uint64(31), out=shifted)
    return x


def _uniform(terms: np.ndarray, samples: int, draw: int) -> np.ndarray:
    """(terms, samples) values in (0, 1), fixed by term, sample and draw."""
    seeds = np.arange(samples, dtype=np.uint64) * np.uint64(8) + np.uint64(draw)
    with np.errstate(over="ignore"):
        bits = _mixed(terms[:, None] ^ _mixed(seeds * np.uint64(0xD1B54A32D192ED03))[None, :])
    return ((bits >> np.uint64(40)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0 ** -24)


def draw(terms: np.ndarray, weights: np.ndarray, samples: int = SAMPLES) -> tuple[np.ndarray, np.ndarray]:
    """(ln a, 16-bit value) of every (term, weight) and sample."""
    u = [_uniform(terms, samples, i) for i in range(5)]
    r = -np.log(u[0] * u[1])
    ln_c = np.log(-np.log(u[2] * u[3]))
    t = np.floor(np.log(weights.astype(np.float32))[:, None] / r + u[4])
    ln_a = ln_c - r * (t - u[4]) - r
    with np.errstate(over="ignore"):
        value = _mixed(terms[:, None] ^ (t.astype(np.int64).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)))
    return ln_a, (value >> np.uint64(48)).astype(np.uint16)


def term_weights(text: str) -> Counter:
    return Counter(text.lower().split())


def _pairs(text: str) -> list[str | tuple[str, int]]:
    """The (term, weight) pairs of a text; a term of weight 1, as most are, stands for itself."""
    return [w if n == 1 else (w, n) for w, n in term_weights(text).items()]


class Sampler:
    """Fingerprints of texts; the draws of frequent (term, weight) pairs are kept."""

    def __init__(self, samples: int = SAMPLES, kept: int = 200_000):
        self.samples, self.kept = samples, kept
        self._start()

    def _start(self):
        self.rows: dict[str | tuple[str, int], int] = {}
        self.ln_a = np.empty((BLOCK, self.samples), np.float32)
        self.value = np.empty((BLOCK, self.samples), np.uint16)

    def _learn(self, pairs: list[str | tuple[str, int]]) -> None:
        terms = [p if isinstance(p, str) else p[0] for p in pairs]
        hashes = np.array([xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in terms], np.uint64)
        weights = np.array([1 if isinstance(p, str) else p[1] for p in pairs], np.int64)
        at = len(self.rows)
        while len(self.ln_a) < at + len(pairs):  # doubled, so that rows are copied a few times only
            self.ln_a = np.concatenate([self.ln_a, np.empty_like(self.ln_a)])
            self.value = np.concatenate([self.value, np.empty_like(self.value)])
        for lo in range(0, len(pairs), DRAWN):
            rows = slice(at + lo, at + min(lo + DRAWN, len(pairs)))
            self.ln_a[rows], self.value[rows] = draw(hashes[lo:lo + DRAWN], weights[lo:lo + DRAWN], self.samples)
        self.rows.update(zip(pairs, range(at, at + len(pairs))))

    def fingerprints(self, texts: list[str]) -> list[np.ndarray | None]:
        """One array of SAMPLES 16-bit values per text; None for a text without words."""
        counted = [_pairs(t) for t in texts]
        if len(self.rows) > self.kept:
            self._start()
        new = [p for p in dict.fromkeys(chain.from_iterable(counted)) if p not in self.rows]
        if new:
            self._learn(new)
        out, row, cols = [], self.rows.__getitem__, np.arange(self.samples)
        for pairs in counted:
            if not pairs:
                out.append(None)
                continue
            best_a = best_v = None
            for lo in range(0, len(pairs), BLOCK):  # bounded memory for very long texts
                at = np.array(list(map(row, pairs[lo:lo + BLOCK])))
                a = self.ln_a[at]
                win = a.argmin(0)
                a, v = a[win, cols], self.value[at[win], cols]
                if best_a is None:
                    best_a, best_v = a, v
                else:
                    less = a < best_a
                    best_a, best_v = np.where(less, a, best_a), np.where(less, v, best_v)
            out.append(best_v)
        return out


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    """Share of equal samples; two texts without words are alike, one is unlike any other."""
    if a is None or b is None:
        return float(a is None and b is None)
    return float((a == b).mean())


def as_hex(values: np.ndarray | None) -> str:
    return "" if values is None else values.astype(">u2").tobytes().hex()


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter (rounded down) replaced by as much of ``following``."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


def _ranges(docs: DataFrame, size: int) -> list[int]:
    """doc_ids that begin a range of documents, about ``size`` bytes of text each."""
    total, n = docs.agg(F.sum(F.octet_length("text")), F.count("doc_id")).first()
    parts = min(int((total or 0) // size), n or 0, MAX_RANGES)
    if parts < 2:
        return []
    cuts = docs.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 20 * parts)).first()[0]
    return sorted(set(cuts))


def with_neighbours(docs: DataFrame, per_range, schema: str, id_col: str = "doc_id", text_col: str = "text",
                    range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Apply ``per_range`` to documents in ascending order, each with the one after it.

    The documents are split at doc_ids into ranges; one shuffle brings every range
    together and sorts it (ids, then text). The first document of a range is sent to the
    range before as well, marked ``guest``; the very first goes to the last range. A
    task holds a few documents of its range at a time.
    Null ids come last.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    cuts = _ranges(source, range_bytes)
    first = source.agg(F.min("doc_id")).first()[0]
    begins = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    last = len(cuts)
    n_range = F.when(F.col("doc_id").isNull(), last).otherwise(F.size(F.filter(begins, lambda c: c <= F.col("doc_id"))))
    before = F.when(F.col("doc_id").eqNullSafe(F.lit(first).cast("long")), F.lit(last)).when(
        F.array_contains(begins, F.col("doc_id")), n_range - 1)
    places = F.array(F.struct(n_range.alias("part"), F.lit(False).alias("guest")),
                     F.struct(before.alias("part"), F.lit(True).alias("guest")))
    dealt = (source.withColumn("p", F.explode(F.filter(places, lambda x: x["part"].isNotNull())))
             .select("doc_id", "text", F.col("p.part").alias("part"), F.col("p.guest").alias("guest")))
    ordered = dealt.repartitionById(last + 1, F.col("part")).sortWithinPartitions(
        "part", "guest", F.col("doc_id").asc_nulls_last(), "text")
    return ordered.mapInArrow(per_range, schema)


def _fingerprint_range(batches):
    """Rows of SCHEMA; the rows arrive sorted by part, own documents before guests."""
    sampler = Sampler()
    held: list = []  # the document that waits for the one after it: [part, doc_id, text, values]

    def finished(rows):
        """rows: (part, doc_id, text, values, following text, following values)"""
        changed = [edited(r[2], r[4]) for r in rows]
        for lo in range(0, len(rows), 256):
            part, texts = rows[lo:lo + 256], changed[lo:lo + 256]
            own = sampler.fingerprints(texts)
            yield pa.RecordBatch.from_pylist([
                {"doc_id": r[1], "n_chars": len(r[2]),
                 "edited_sha256": hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest(), "fingerprint": as_hex(r[3]),
                 "edited_fingerprint": as_hex(e), "near_edited": likeness(r[3], e), "near_next": likeness(r[3], r[5])}
                for r, t, e in zip(part, texts, own)], schema=_ARROW)

    guests_of = None
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            ids, texts, parts, guests = (part.column(i).to_pylist() for i in range(4))
            rows = []
            for row in zip(parts, ids, texts, sampler.fingerprints(texts), guests):
                if row[4]:
                    if guests_of != row[0]:  # the first guest only: others repeat its doc_id
                        guests_of = row[0]
                        if held and held[0] == row[0]:
                            rows.append((*held, row[2], row[3]))
                            held = []
                    continue
                if held and held[0] == row[0]:
                    rows.append((*held, row[2], row[3]))
                held = list(row[:4])
            yield from finished(rows)
    if held:  # no guest: the only document left, as when all ids are null
        yield from finished([(*held, held[2], held[3])])


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                    ("near_edited", pa.float64()), ("near_next", pa.float64())])


def weighted_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text replaces the last floor(n_chars / 4) code points by the first as
    many of the next document (ascending doc_id, then text; after the last the first).
    Null texts count as empty; a text without words has the empty fingerprint. Repeated
    rows are documents of their own that follow each other. Null ids come last; if all
    are null, the last document follows itself. Extra columns are not read. An empty
    table gives an empty result.
    """
    return with_neighbours(docs, _fingerprint_range, SCHEMA, id_col, text_col)
