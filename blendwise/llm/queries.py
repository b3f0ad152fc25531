"""The registered queries of the ten operators, one each, and the pipeline's."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blendwise.llm import (bpe, cws, line_dedup, lloyd, llr_rules, merkle, oracles, packing, pii, pseudo_likelihood, quality_cnn,
                           simhash, topk, warc)
from blendwise.llm.common import new_path, table

QUALITY_THRESHOLD = 0.3
WIDTH, RADIUS = 3, 2  # shingle words and differing bits of SimHash near-dedup


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document row: how many lines it has, and for each line that goes the (doc_id, line) that stays."""
    docs = table(spark, sf_dir, "documents")
    found = line_dedup.line_decisions(line_dedup.line_classes(docs)).select(F.col("doc_key").alias("of"), "n_lines", "dropped")
    keyed = docs.select("doc_id", line_dedup.document_key("doc_id", "text").alias("key"))
    return keyed.join(found, F.col("key") == F.col("of"), "left").select(
        "doc_id", F.coalesce("n_lines", F.lit(0).cast("long")).alias("n_lines"), F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.col("dropped.line_no").alias("dropped_lines"), F.col("dropped.keep_id").alias("kept_doc_ids"), F.col("dropped.keep_no").alias("kept_lines"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    texts = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ids = bpe.encode(texts, path, public_tokenizers.PATTERN).select("doc_id", "ids")
    return bpe.decode(ids, path).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.page_records(warc.read_archives(spark, path))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"), WIDTH, RADIUS)
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op5_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_cnn.fit_quality(docs, table(spark, sf_dir, "labels"))
    return (docs.select("doc_id", quality_cnn.held_out().alias("held_out"), quality_cnn.score_column(model, F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= QUALITY_THRESHOLD).cast("int")))


def op6_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood.pseudo_likelihood(table(spark, sf_dir, "documents"))


def op7_llr_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return llr_rules.quality_rules(docs, llr_rules.fit_ratios(docs, table(spark, sf_dir, "labels")))


def op8_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = pii.fit_field(docs)
    spans = docs.select("doc_id", pii.spans_column(field, F.col("text")).alias("s"))
    joined = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = F.filter("s", lambda x: x["base"])
    count = lambda kind: F.size(F.filter("s", lambda x: x["base"] & (x["kind"] == kind))).cast("long").alias(f"n_{kind}")
    return spans.select("doc_id", *[count(k) for k in pii.KINDS], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("s")).alias("spans"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenised_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    numbers = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(numbers).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op10_cws_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cws.weighted_fingerprints(table(spark, sf_dir, "documents"))


def op11_dual_tree_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = lloyd.product_codes(table(spark, sf_dir, "embeddings"))
    digits = F.transform("code", lambda x: F.lpad(F.lower(F.hex(x)), 2, "0"))
    return coded.select("vec_id", F.array_join(digits, "").alias("code"), "error", "label_error",
                        F.lit(lloyd.codebook_digest(books)).alias("codebooks_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every second document (by checksum of the id) the copy to be verified has lost its line breaks."""
    fields = {c: F.col(c) for c in merkle.FIELDS} | {"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))}
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, merkle.leaf_digest(fields))
    leaves = merkle.manifest(table(spark, sf_dir, "documents"), also={"tampered": changed})
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("steps"))
    return leaves.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("steps")).alias("proof_sha256"),
                         folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_byte_bpe, op3_warc_salvage, op4_simhash, op5_quality_cnn, op6_pseudo_likelihood, op7_llr_rules,
    op8_pii_crf, op9_packing, op10_cws_fingerprint, op11_dual_tree_lloyd, op12_merkle_manifest, op13_pivot_topk, pipeline)}

# Word hashing (XXH64), trained models, tokenizers and connected components have no
# DuckDB form that could run on whole tables.
ORACLE_SQL = oracles.ORACLE_SQL
