"""One thin query per operator: the operator over its whole table, and the columns of its contract."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_folder
from . import align, balltree, licenses, lm, mixing, neardup, nndescent, pieces, quality, repeats, setm, token_files, warc
from .common import crc_remainder, table


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan_mix(table(spark, sf_dir, "documents"))
    taken = (F.col("n_copies") * F.col("size")).cast("bigint").alias("taken")
    return planned.select("doc_id", "size", "source_size", "target", taken)


def op1_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.find_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.coalesce("kept", F.lit(b"")), 256).alias("kept_sha256"))


def op2_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "llm-tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end=1)
    return token_files.read_checksums(spark, path).withColumnRenamed("key", "doc_id")


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nndescent.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.select("vec_id", "n_links", "component_id", "kept", "audited_recall")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality.fit_quality(documents, quality.training_labels(table(spark, sf_dir, "labels")))
    scored = quality.score_quality(documents.select("doc_id", "text"), model)
    held_out = crc_remainder("doc_id", 3) == 1
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = pieces.encode_texts(documents, model, binary=True, remembered=2 * pieces.REMEMBERED)
    return encoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"),
        F.sha2(pieces.decoded(model), 256).alias("decoded_sha256"),
    )


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.top_products(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0, k=5)


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    joined = lambda labels: F.array_join(labels, ",")
    return scanned.select(
        "doc_id", "scan.n_words", "scan.n_base", "scan.first_word", "scan.last_word",
        joined(F.col("scan.base_labels")).alias("base_labels"), joined(licenses.labels_of()).alias("labels"),
        licenses.confidence_of().alias("score"),
    )


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    remainder = crc_remainder("doc_id", 7)
    scored = lm.score_texts(documents, trains=remainder != 2)
    return scored.withColumn("held_out", remainder == 2)


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), k=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, folder = table(spark, sf_dir, "pages"), scratch_folder(spark, "llm-warc")
    listing = warc.write_archives(pages, f"{folder}/raw", key="page_id", payload="html", uri="url")
    done = warc.normalise(listing, f"{folder}/archives", warc.find_revisits(listing, "bigint"))
    read = warc.read_records(warc.read_index(done), payload=False)
    return read.select(
        F.col("key").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    byte_level, pieces_of = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    aligned = align.align_documents(table(spark, sf_dir, "documents"), byte_level, pieces_of, key="doc_id")
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps", "n_in_groups")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setm.mine_phrases(table(spark, sf_dir, "documents"), longest=3, least=10, absorbed_pct=50, top=2000)
