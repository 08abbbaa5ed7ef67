"""The corpus pipeline: from raw documents to the token ids of a cleaned, deduplicated, mixed corpus.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stage before it kept; its result is written
and read again before the next stage. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from assaylake.llm import mixing, neardup, pieces, quality, repeats
from assaylake.llm.common import stored, table
from assaylake.session import ensure_shared_folder, tune

#: Bytes of a passage that may stand once only: less than fifty words have, at some six bytes a word with its space.
PASSAGE_BYTES = 250


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores 0.5 or more; it learns from the labels for training."""
    tune(ensure_shared_folder(spark))
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity of 0.8 or more): the least id."""
    tune(ensure_shared_folder(spark))
    return neardup.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of ``PASSAGE_BYTES`` or more that occur more than once are cut out of the texts; all documents stay."""
    tune(ensure_shared_folder(spark))
    cut = repeats.remove_repeats(docs, width=PASSAGE_BYTES)
    return cut.withColumn("n_chars", F.char_length("text").cast(cut.schema["n_chars"].dataType)) if "n_chars" in cut.columns else cut


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask for."""
    tune(ensure_shared_folder(spark))
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text and their number, in place of the text."""
    tune(ensure_shared_folder(spark))
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = pieces.encode_texts(docs, model).drop("text")
    return encoded.withColumn("n_tokens", F.size("ids").cast("bigint"))


STAGES = [
    ("quality classifier", keep_quality),
    ("minhash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("mixing to weights", mix_sources),
    ("sentencepiece ids", encode_pieces),
]

#: Compression, signatures and Viterbi paths are beyond SQL; tests/llm compares run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(ensure_shared_folder(spark))
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name.split()[0])
    return docs
