"""Long to wide, and the split by subject."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from ..functions import split_label
from ..roles import DEFAULT, Roles
from .ordered import running_totals


def to_matrix(
    long: DataFrame,
    features: Sequence[str],
    keys: Sequence[str] | None = None,
    *,
    unique: bool = False,
    placed: bool = False,
    r: Roles = DEFAULT,
) -> DataFrame:
    """One row per sample, one double column per listed feature in the listed order; a missing cell is 0.0.

    The cells of a sample are brought together before the pivot. Otherwise every task would ship a full-width
    row for each sample it has one cell of. Repeated cells are averaged before that shuffle, unless the long
    table is known to be ``unique`` in sample and feature, as the trusted one is. A table that is stored by sample is
    ``placed``: its cells lie together, and nothing is shuffled.

    Meant for up to a few thousand features, see ``to_vectors`` beyond.
    """
    keys = list(keys) if keys is not None else [r.sample, r.subject, r.cls]
    features = _different(features)
    cells = long.filter(F.col(r.feature).isin(features)).select(*keys, r.feature, r.value)
    if not unique:
        cells = cells.groupBy(*keys, r.feature).agg(F.avg(r.value).alias(r.value))
    together = cells if placed else cells.repartition(*keys)
    return together.groupBy(*keys).pivot(r.feature, features).agg(F.avg(r.value)).fillna(0.0, features)


def _different(features: Sequence[str]) -> list[str]:
    features = list(features)
    if len(set(features)) < len(features):
        raise ValueError("a feature is listed more than once")
    return features


def to_vectors(
    long: DataFrame,
    features: Sequence[str],
    keys: Sequence[str] | None = None,
    *,
    unique: bool = False,
    placed: bool = False,
    block: int = 256,
    r: Roles = DEFAULT,
) -> DataFrame:
    """One row per sample with a ``features_raw`` vector in the listed order, without a column per feature.

    Features are numbered and cut into blocks. A pivot over the place within a block makes the dense values of
    one block, and a sample gathers its blocks, so the plan has ``block`` columns for any number of features.
    As in ``to_matrix`` a sample's cells meet once, unless they are ``placed``, and repeated ones are averaged before unless
    ``unique``.
    """
    keys = list(keys) if keys is not None else [r.sample, r.subject, r.cls]
    features = _different(features)
    block = min(block, len(features))
    n_blocks = -(-len(features) // block)
    places = [(f, at // block, at % block) for at, f in enumerate(features)]
    numbered = long.sparkSession.createDataFrame(places, f"{r.feature} string, _block int, _place int")
    cells = long.select(*keys, r.feature, r.value).join(F.broadcast(numbered), r.feature).drop(r.feature)
    if not unique:
        cells = cells.groupBy(*keys, "_block", "_place").agg(F.avg(r.value).alias(r.value))
    slots = [str(at) for at in range(block)]
    dense = (
        (cells if placed else cells.repartition(*keys))
        .groupBy(*keys, "_block")
        .pivot("_place", list(range(block)))
        .agg(F.avg(r.value))
        .fillna(0.0, slots)
        .select(*keys, "_block", F.array(*slots).alias("_values"))
    )
    whole = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.lit(n_blocks - 1)),
            lambda at: F.coalesce(F.try_element_at("_blocks", at), F.array_repeat(F.lit(0.0), block)),
        )
    )
    return (
        dense.groupBy(*keys)
        .agg(F.map_from_entries(F.collect_list(F.struct("_block", "_values"))).alias("_blocks"))
        .select(*keys, array_to_vector(F.slice(whole, 1, len(features))).alias("features_raw"))
    )


def split_subjects(
    df: DataFrame, seed: int = 42, cuts: Sequence[float] = (0.70, 0.85), r: Roles = DEFAULT
) -> DataFrame:
    """(subject, class, split): each class's subjects in hash order, cut at the given shares.

    The order is the MD5 of subject and seed, so a subject keeps its place however the rows are spread. The
    first four digits of the hash cut a class into 65,536 even buckets, which rank in parallel.
    """
    subjects = (
        df.select(r.subject, r.cls)
        .distinct()
        .withColumn("_hash", F.md5(F.concat(F.col(r.subject), F.lit(f"-{seed}"))))
        .withColumn("one", F.lit(1))
    )
    ranked = running_totals(
        subjects, [r.cls], ["_hash", r.subject], ["one"], bucket=F.substring("_hash", 1, 4)
    )
    return ranked.select(r.subject, r.cls, split_label(F.col("cum_one") / F.col("all_one"), cuts).alias("split"))


def stratified_split(
    df: DataFrame, seed: int = 42, cuts: Sequence[float] = (0.70, 0.85), r: Roles = DEFAULT
) -> DataFrame:
    """``df`` with a ``split`` column; all rows of a subject within a class fall on one side."""
    return df.join(split_subjects(df, seed, cuts, r), [r.subject, r.cls], "inner")


def take_split(df: DataFrame, name: str, split: str = "split") -> DataFrame:
    return df.filter(F.col(split) == name).drop(split)
