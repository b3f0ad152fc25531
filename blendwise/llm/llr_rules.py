"""Quality rules [native]: base counts and a hashed n-gram log-likelihood ratio.

Everything is built-in column functions: no Python runs on the executors.

Each word and each pair of neighbouring words falls into one of BUCKETS hash
buckets. Two multinomials over the buckets are counted: the trusted target
(documents labelled good) and the raw corpus (all documents). A document's score is the mean
over its n-grams of log(target share / raw share), add-one smoothed. Ratios are held in whole
millionths, so sums do not depend on their order and the threshold decides the
same way in every run. The model is one array of BUCKETS longs, a bound that does not
depend on the data; scoring is a projection without a join or shuffle.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 14
THRESHOLD = -0.05  # mean log ratio below which a document is dropped
MILLION = 1_000_000
SYMBOLS = "#*$%&|<>"
SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Array of the words of a string column; null, empty and blank texts have none."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^{SPACE}|{SPACE}\z", "")
    return let(trimmed, lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE)))


def _repeated(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more (``hashes``: one per word)."""
    n = F.size(hashes)

    def covered(windows):
        at = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s):
            twice = F.filter(s, lambda x, j: ((j > 0) & (F.get(s, j - 1)["h"] == x["h"]))
                             | ((j < F.size(s) - 1) & (F.get(s, j + 1)["h"] == x["h"])))
            return F.sort_array(F.transform(twice, lambda x: x["i"]))

        # sorted starts: each adds what lies beyond the end of the one before
        return F.aggregate(let(at, positions), F.struct(F.lit(0).alias("sum"), F.lit(0).alias("end")),
                           lambda a, p: F.struct((a["sum"] + p + WINDOW - F.greatest(a["end"], p)).alias("sum"),
                                                 (p + WINDOW).alias("end")))["sum"]

    windows = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))
    return F.when(n < WINDOW + 1, F.lit(0)).otherwise(
        let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w))))


def buckets(hashes: Column) -> Column:
    """Bucket of each word and of each pair of neighbouring words."""
    one = F.transform(hashes, lambda h: F.pmod(h, F.lit(BUCKETS)))
    two = F.transform(F.sequence(F.lit(1), F.size(hashes) - 1),
                      lambda i: F.pmod(F.xxhash64(F.get(hashes, i - 1), F.get(hashes, i)), F.lit(BUCKETS)))
    return F.when(F.size(hashes) < 2, one).otherwise(F.concat(one, two))


def word_hashes(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(F.lower(x)))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Every doc_id with quality 1 and no 0."""
    good = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("trusted_id")).agg(
        F.min("quality").alias("q")).where("q = 1")
    return good.select("trusted_id")


def bucket_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(bucket, raw, good)``: n-grams of all and of the trusted documents.

    The documents meet the trusted ids in a shuffle whatever the number of ids, so that disk grows with
    the texts alone; the ids, one row each, are the hashed side and the texts are not sorted.
    """
    ids = trusted_ids(labels).hint("shuffle_hash")
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(ids, F.col("id") == F.col("trusted_id"), "left")
            .select(F.col("trusted_id").isNotNull().cast("long").alias("good"),
                    F.explode(let(word_hashes(words(F.col("t"))), buckets)).alias("bucket")))
    return rows.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("good").alias("good"))


def fit_ratios(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Log ratio per bucket in millionths, from the counts of all documents.

    The only fetch is one row per bucket. Without trusted documents all ratios are 0.
    """
    counts = bucket_counts(docs, labels, id_col, text_col).collect()
    raw, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counts:
        raw[r["bucket"]], good[r["bucket"]] = r["raw"], r["good"]
    if not good.sum():
        return np.zeros(BUCKETS, np.int64)
    ratio = np.log((good + 1) / (good.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))
    return np.rint(ratio * MILLION).astype(np.int64)


def quality_rules(docs: DataFrame, ratios: np.ndarray, threshold: float = THRESHOLD,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, log_ratio, kept``.

    Null and empty texts have no words, fail the base rules and have log_ratio 0.
    ``log_ratio`` is the mean in millionths, rounded down. Repeated rows each get a row,
    extra columns are not read, an empty table gives an empty result.
    """
    text = F.coalesce(F.col("t"), F.lit(""))
    table = F.lit(ratios)
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    per_doc = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t")).select(
        "doc_id",
        let(words(F.col("t")), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            let(word_hashes(w), lambda h: F.aggregate(
                buckets(h), F.lit(0).cast("long"), lambda a, b: a + F.get(table, b.cast("int")))).alias("sum"),
            _repeated_of(w).cast("long").alias("n_repeat_words"))).alias("w"),
        F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    n = F.col("w.n_words")
    grams = F.greatest(2 * n - 1, F.lit(1).cast("long"))
    failed = (n < 10) | (F.col("w.n_repeat_words") * 100 > n * 20)
    ratio = F.floor(F.col("w.sum") / grams).cast("long")
    return per_doc.select("doc_id", n.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words",
                          failed.alias("base_failed"), ratio.alias("log_ratio"),
                          (~failed & (F.col("w.sum") >= F.lit(round(threshold * MILLION)) * grams)).alias("kept"))


def _repeated_of(w: Column) -> Column:
    # windows compare the words as they are, the ratio lower-cased ones
    return let(F.transform(w, lambda x: F.xxhash64(x)), _repeated)
