"""Mixing sources to target weights.

The tokens of each source are summed, target totals come from source weights, and the ratio of both is the
source's repetition rate. A document is emitted floor(rate) times, and once more if a coin seeded by its id
falls below the fraction of the rate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import stored

#: A word is a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code-point order, repeating.
WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
_BIG = "decimal(38,0)"


def word_count(text: str | Column) -> Column:
    """Words of a text; none for a null text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per source (null is one of them): ``source``, ``source_size``, ``target`` and ``rate``.

    All sources together get the sum of all sizes. A source gets its weight's share of it, ``max_repeat`` times its
    size at most; what is cut off goes to the other sources by weight until none is above. In order of
    ``max_repeat * size / weight`` the capped sources come first, so one ordered pass finds the level at which the
    rest stands; it compares whole numbers only. A source of size 0 has the rate 0.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source: these windows see the catalogue of sources, not the documents.
    position = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (position % len(weights) + 1).cast("int"))
    common = 1
    for w in weights:
        common *= w
    per_source = per_source.select("source", "source_size", position.alias("at"), weight.alias("w"))
    full = (F.col("source_size") * max_repeat).cast(_BIG)
    every, order = W.partitionBy(), W.orderBy("ratio", "at")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    level = (
        per_source.select("*", full.alias("cap"), (full * F.lit(common) / F.col("w")).cast(_BIG).alias("ratio"))
        .select(
            "*",
            (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast(_BIG).alias("rest"),
            (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0))).alias("w_rest"),
        )
        .select("*", (F.col("cap") * F.col("w_rest") < F.col("rest") * F.col("w")).alias("capped"))
    )
    first = F.min(F.when(~F.col("capped"), F.struct("ratio", "at", "rest", "w_rest"))).over(every)
    open_ = F.struct("ratio", "at") >= F.struct(F.col("first.ratio"), F.col("first.at"))
    share = F.col("first.rest").cast("double") * F.col("w") / F.col("first.w_rest")
    target = F.when(open_, share).otherwise(F.col("cap").cast("double"))
    return (
        level.select("*", first.alias("first"))
        .select("source", "source_size", target.alias("target"))
        .select("*", F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)).alias("rate"))
    )


def coin(key: str, seed: str) -> Column:
    """A number in [0, 1) that depends on the seed and the row's key alone, so reruns agree."""
    digits = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    return F.conv(F.substring(digits, 1, 12), 16, 10).cast("bigint") / F.lit(float(1 << 48))


def copies(key: str, seed: str) -> Column:
    """How often the mix takes a document, from its source's ``rate``."""
    whole = F.floor("rate")
    return whole + F.when(coin(key, seed) < F.col("rate") - whole, 1).otherwise(0)


def plan_mix(documents: DataFrame, seed: str = "mix", weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``rate``, ``n_copies``.

    Texts are read once: a slim table of sizes is stored and serves both the totals and the result. Null texts have
    size 0, a null source is a source. Rows that repeat an id fall the same way. An empty table gives no rows.
    """
    sizes = stored(documents.select("doc_id", "source", word_count("text").alias("size")), "sizes")
    targets = source_targets(sizes, weights, max_repeat).withColumnRenamed("source", "of")
    return sizes.join(targets, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "source", "size", "source_size", "target", "rate", copies("doc_id", seed).alias("n_copies")
    )


def mix(documents: DataFrame, seed: str = "mix", weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """The mixed corpus: every document as often as its source's rate says, with all columns it came with, of any name.

    Null and empty texts have size 0 and follow their source's rate like any other; a null source is a source, a null id
    draws its coin as the text "null" does. Rows that repeat an id are dealt alike, each on its own. An empty table gives no rows.
    """
    targets = source_targets(documents.select("source", word_count("text").alias("size")), weights, max_repeat)
    # The document's own columns stay within a struct, so that none of them meets a name of the plan.
    whole = documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("document"))
    dealt = whole.join(targets.select(F.col("source").alias("of"), "rate"), F.col("document.source").eqNullSafe(F.col("of")))
    n = copies("document.doc_id", seed).cast("int")
    return dealt.where(n > 0).select("document", F.explode(F.sequence(F.lit(1), n))).select("document.*")
