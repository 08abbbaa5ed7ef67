"""Exact running totals and quantiles without one task per group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Halving steps: enough for 2**20 cut points, that is 10**12 rows of a group.
_MOST_BITS = 20
#: Buckets of a group at least, and rows of a bucket, about, in a larger group.
BUCKETS, ROWS = 64, 1_000_000


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Sequence[str],
    descending: bool = False,
    bucket: Column | None = None,
    buckets: int = BUCKETS,
    few_groups: bool = False,
) -> DataFrame:
    """Adds ``cum_<c>`` (running total up to and including the row) and ``all_<c>`` (group total) for each sum.

    ``df`` has one row per keys and order value, with non-negative sums. A plain ordered window would put each
    group into one task. Here a group is cut into ordered buckets. Every bucket starts with a row that carries
    the total of the buckets before it, and runs its own window.

    ``bucket`` may give the bucket as an expression that rises with the order; otherwise cut points are taken
    from the group, see ``_place_by_sample``; they grow with the group, so that no bucket has much more than
    ``ROWS`` rows. ``few_groups`` says that the groups are a closed list (labels, models, splits), so that their cut
    points may be broadcast.
    """
    keys, order = list(keys), list(order)
    if bucket is None:
        placed = _place_by_sample(df, keys, order[0], sums, buckets, few_groups)
    else:
        placed = df.withColumn("_bucket", bucket)

    def turn(c: str) -> Column:
        return F.col(c).desc() if descending else F.col(c).asc()

    before = Window.partitionBy(*keys).orderBy(turn("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    starts = (
        placed.groupBy(*keys, "_bucket")
        .agg(*[F.sum(c).alias(f"_in_{c}") for c in sums])
        .select(
            *keys,
            "_bucket",
            F.lit(0).alias("_row"),
            *[F.coalesce(F.sum(f"_in_{c}").over(before), F.lit(0)).alias(f"_add_{c}") for c in sums],
            *[F.sum(f"_in_{c}").over(whole).alias(f"all_{c}") for c in sums],
        )
    )
    rows = placed.select(
        "*", F.lit(1).alias("_row"), *[F.col(c).alias(f"_add_{c}") for c in sums]
    )
    within = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy("_row", *[turn(c) for c in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    both = rows.unionByName(starts, allowMissingColumns=True)
    totals = [F.sum(f"_add_{c}").over(within).alias(f"cum_{c}") for c in sums]
    wholes = [F.max(f"all_{c}").over(within).alias(f"all_{c}") for c in sums]
    return both.select(*df.columns, "_row", *totals, *wholes).filter(F.col("_row") == 1).drop("_row")


def _place_by_sample(
    df: DataFrame, keys: list[str], order: str, sums: Sequence[str], buckets: int, few_groups: bool
) -> DataFrame:
    """``df`` with a bucket per row: how many of its group's cut points lie below the order value.

    Cut points are the order values with the lowest hashes, and one of ``ROWS`` by another hash: the same sample on every
    run, however the rows are spread, and one that grows with the group. Beyond few groups they are joined by a shuffle, in which adaptive execution splits the hot groups.
    """
    # Rows without weight move no total. The filter also keeps the sums in the plan of the sample, so that the
    # sample and the rows read one and the same shuffle.
    weighty = df.filter(sum((F.col(c) for c in sums), F.lit(0)) > 0)
    lowest = Window.partitionBy(*keys).orderBy(F.xxhash64(order), order)
    few = weighty.withColumn("_nth", F.row_number().over(lowest)).filter(F.col("_nth") < buckets).select(*keys, order)
    share = weighty.filter(F.pmod(F.xxhash64(order, F.lit("cut")), F.lit(ROWS)) == 0).select(*keys, order)
    cuts = few.union(share).groupBy(*keys).agg(F.sort_array(F.collect_set(order)).alias("_cuts"))
    placed = join_null_safe(df, F.broadcast(cuts) if few_groups else cuts, keys).withColumn("_bucket", F.lit(0))
    # Halving steps over the sorted cut points; a place beyond the array is null and adds nothing.
    for step in (1 << i for i in reversed(range(_MOST_BITS))):
        reached = F.get("_cuts", F.col("_bucket") + (step - 1)) < F.col(order)
        placed = placed.withColumn("_bucket", F.col("_bucket") + F.when(reached, step).otherwise(0))
    return placed.drop("_cuts")


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join in which a null key is a key like any other, as it is for groupBy."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(renamed, same, "left").drop(*[f"_right_{k}" for k in keys])


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
    buckets: int = BUCKETS,
    few_groups: bool = False,
) -> DataFrame:
    """Per group the least value whose share of rows at or below it reaches each quantile; nulls do not count."""
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    ranked = running_totals(counted, keys, [value], ["n"], buckets=buckets, few_groups=few_groups)
    return ranked.groupBy(*keys).agg(
        *[
            F.min(F.when(F.col("cum_n") >= F.lit(q) * F.col("all_n"), F.col(value))).alias(name)
            for name, q in quantiles.items()
        ]
    )
