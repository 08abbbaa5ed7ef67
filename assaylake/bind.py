"""Role frames over the relational test tables.

Orders with their customers stand for file metadata, line items with their parts for measurement rows, documents
for the class-labelled values of the model plans, and embeddings for scored rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .functions import character_counts, log2p1
from .operators import prepare
from .plans.trusted import Trusted
from .roles import DEFAULT as R
from .session import reliable

CLASSES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
NEEDLE = "i"
SUBJECT_PREFIX = 18
N_SCORES = 10
LABELS = [f"c{k}" for k in range(N_SCORES)]
SPLIT_CUTS = ("b3", "d9")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat metadata, one row per order."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    rank = F.substring("o_orderpriority", 1, 1)
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_orderkey").cast("string").alias(R.file),
        F.concat(F.lit("order-"), F.col("o_orderkey"), F.lit(".tsv")).alias(R.file_name),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias(R.file_size),
        F.concat(F.lit("case-"), F.col("o_custkey")).alias(R.case),
        F.when(F.col("o_custkey") % 7 != 0, F.col("c_name")).alias(R.case_submitter),
        F.concat_ws("-", F.col("o_custkey").cast("string"), rank).alias(R.sample),
        F.concat_ws("-", "c_name", rank).alias(R.sample_submitter),
        F.col("o_orderpriority").alias(R.sample_type),
        F.concat(F.lit("SEG-"), F.col("c_mktsegment")).alias(R.project),
        F.col("c_mktsegment").alias(R.cls),
        F.lower("c_mktsegment").alias(R.cls_name),
    )


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurement rows: technical ones, unwanted types, nulls, zeros and repeated features all occur."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"
    )
    technical = F.col("l_linenumber") == 7
    unknown = F.round(F.col("l_tax") * 100) == 8
    return line.join(part, line.l_partkey == part.p_partkey).select(
        F.col("l_orderkey").cast("string").alias(R.file),
        F.when(technical, F.lit("N_unmapped"))
        .otherwise(F.concat_ws(".", "p_brand", F.col("l_linenumber").cast("string")))
        .alias("gene_id"),
        F.lower("p_brand").alias(R.feature_name),
        F.when(F.col("l_returnflag") == "A", "lncRNA").otherwise("protein_coding").alias(R.feature_type),
        F.when(~unknown, F.when(F.col("l_discount") == 0, F.lit(0.0)).otherwise(F.col("l_extendedprice") / 1000)).alias(
            R.measure
        ),
        F.concat(F.lit("/raw/"), F.col("l_orderkey"), F.lit(".tsv")).alias(R.source),
    )


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.clean_measurements(measurements(spark, sf_dir))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The samples table. It is stored before it is used, as the pipeline does."""
    return reliable(
        prepare.chosen_files(clean(spark, sf_dir), metadata(spark, sf_dir), CLASSES, NEEDLE, SUBJECT_PREFIX)
    )


def trusted(spark: SparkSession, sf_dir: str) -> Trusted:
    chosen = samples(spark, sf_dir)
    long = prepare.trusted_long(measurements(spark, sf_dir), chosen)
    return Trusted(long, chosen, prepare.feature_dictionary(long))


def long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trusted(spark, sf_dir).long


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All official files with rows, before one is chosen per sample."""
    official = prepare.official_samples(metadata(spark, sf_dir), CLASSES, NEEDLE, SUBJECT_PREFIX)
    return prepare.candidate_samples(prepare.with_rows(official, clean(spark, sf_dir)))


def undeduplicated_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chosen files, joined by the row-level operators, with repeated (sample, feature) pairs still in."""
    official = prepare.official_samples(metadata(spark, sf_dir), CLASSES, NEEDLE, SUBJECT_PREFIX)
    joined = prepare.attach_metadata(clean(spark, sf_dir), official)
    return prepare.select_present(prepare.keep_selected(joined, samples(spark, sf_dir)), R.long_columns)


def document_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long frame with class signal: how often each letter occurs in each whole document.

    A document is one row, so its letters are counted inside the row, in one pass, and nothing is shuffled.
    """
    letters = (
        table(spark, sf_dir, "documents")
        .select("doc_id", "lang", F.inline(character_counts(F.lower("text"))))
        .filter(F.col("letter").rlike(r"^\p{L}$"))
    )
    return letters.select(
        F.col("doc_id").cast("string").alias(R.sample),
        F.concat_ws("-", "lang", F.expr("string(doc_id div 3)")).alias(R.subject),
        F.col("lang").alias(R.cls),
        F.concat(F.lit("ch_"), F.hex(F.encode("letter", "UTF-16BE"))).alias(R.feature),
        F.col("letter").alias(R.feature_name),
        log2p1("n").alias(R.value),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows of one scorer; a class's score is the sum of every tenth value of the whole embedding."""
    score = _class_scores()
    return _as_predictions(table(spark, sf_dir, "embeddings"), "score", F.lit("all"), score)


def _class_scores():
    """The values at places k, k + 10, ... in millionths, added up: whole numbers, so their order does not matter."""
    millionths = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1_000_000))

    def of_class(k: int):
        own = F.filter(millionths, lambda x, at: at % N_SCORES == k)
        return F.aggregate(own, F.lit(0).cast("bigint"), lambda a, x: a + x).cast("double") / 1_000_000

    return F.array(*map(of_class, range(N_SCORES)))


def scored_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two scorers, the second with reversed scores, on three splits given by the hash of the row id."""
    digits = F.substring(F.md5(F.col("vec_id").cast("string")), 1, 2)
    split = F.when(digits < SPLIT_CUTS[0], "train").when(digits < SPLIT_CUTS[1], "validation").otherwise("test")
    rows = table(spark, sf_dir, "embeddings")
    score = _class_scores()
    reversed_score = F.transform(score, lambda x: -x)
    return _as_predictions(rows, "score", split, score).unionByName(
        _as_predictions(rows, "reversed", split, reversed_score)
    )


def _as_predictions(rows: DataFrame, model: str, split, score) -> DataFrame:
    return rows.select("vec_id", "label", split.alias("split"), score.alias("probability")).select(
        F.lit(model).alias("modelo"),
        "split",
        F.col("vec_id").cast("string").alias(R.sample),
        F.col("vec_id").cast("string").alias(R.subject),
        F.element_at(F.array(*[F.lit(x) for x in LABELS]), F.col("label") + 1).alias(R.cls),
        "label",
        (F.array_position("probability", F.array_max("probability")) - 1).cast("int").alias("prediction"),
        "probability",
    )
