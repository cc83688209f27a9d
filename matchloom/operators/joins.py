"""Joins with catalogues and between frames.

No join carries a broadcast hint: Spark compares the size of each side with its
broadcast limit, at planning and again at run time, and shuffles beyond it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.operators.filters import drop_any_null


def unique_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The frame with one row per key; a key that occurs twice stops the job."""
    rest = [c for c in df.columns if c not in keys]
    values = [F.any_value(c).alias(c) for c in rest]
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *values)
    found = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    single = F.when(
        F.col("_n") > 1, F.raise_error(F.concat(F.lit("merge keys are not unique: "), found)).cast("boolean")
    ).otherwise(F.lit(True))
    return grouped.filter(single).select(*keys, *rest)


def lookup_join(
    df: DataFrame,
    catalogue: DataFrame,
    on: str | Mapping[str, str],
    take: Sequence[str] | Mapping[str, str],
    many_to_one: bool = False,
    spread: tuple[int, Sequence[str]] | None = None,
) -> DataFrame:
    """Left join a catalogue on its key and take some of its columns.

    `on` maps columns of the frame to columns of the catalogue, `take` maps catalogue columns
    to their new names. With `many_to_one` a repeated catalogue key stops the job; without it
    the row fans out. `spread=(n, columns)` divides every key over n parts by the hash of the
    given columns, for frames in which one key holds a large share of the rows.
    """
    on = {on: on} if isinstance(on, str) else dict(on)
    take = dict(take) if isinstance(take, Mapping) else {c: c for c in take}
    right = catalogue.select(*on.values(), *[c for c in take if c not in on.values()])
    if many_to_one:
        right = unique_rows(right, list(on.values()))
    right = right.select(
        *[F.col(r).alias(f"_key_{i}") for i, r in enumerate(on.values())],
        *[F.col(c).alias(name) for c, name in take.items()],
    )
    condition = [F.col(left) == F.col(f"_key_{i}") for i, left in enumerate(on)]
    helpers = [f"_key_{i}" for i in range(len(on))]
    if spread:
        n, columns = spread
        df = df.withColumn("_part", F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int"))
        right = right.withColumn("_right_part", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        condition.append(F.col("_part") == F.col("_right_part"))
        helpers += ["_part", "_right_part"]
    return df.join(right, condition, "left").drop(*helpers)


def role_join(df: DataFrame, catalogue: DataFrame, key: str, roles: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Left join one catalogue several times, once per role.

    `roles` maps a column of the frame to {catalogue column: new name}.
    """
    for column, take in roles.items():
        df = lookup_join(df, catalogue, {column: key}, take)
    return df


def map_lookup(c: Column | str, values: Mapping[str, object]) -> Column:
    """Value of a small dictionary given as an argument; null for an unknown key."""
    pairs = [F.lit(x) for item in values.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), F.col(c) if isinstance(c, str) else c)


def unmatched_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of the left frame that the right one lacks. Both sides are reduced to keys first."""
    left_keys = drop_any_null(left.select(*keys), keys).distinct()
    return left_keys.join(right.select(*keys).distinct(), list(keys), "left_anti")


def merge_same_grain(basic: DataFrame, extra: DataFrame | None, keys: Sequence[str], prefix: str) -> DataFrame:
    """Left join two tables of the same grain, the right columns prefixed; the right one may be absent."""
    if extra is None:
        return basic
    renamed = extra.withColumnsRenamed({c: prefix + c for c in extra.columns if c not in keys})
    return basic.join(renamed, list(keys), "left")


def override_merge(defaults: DataFrame, overrides: DataFrame, key: str) -> DataFrame:
    """All keys of both frames; where both have one, the override row wins."""
    rest = [c for c in defaults.columns if c != key]
    rows = defaults.select(key, F.lit(0).alias("_rank"), *rest).unionByName(
        overrides.select(key, F.lit(1).alias("_rank"), *rest)
    )
    best = F.max(F.struct("_rank", *rest)).alias("_best")
    return rows.groupBy(key).agg(best).select(key, *[F.col(f"_best.{c}").alias(c) for c in rest])


def frame_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that occur more often in one frame, with `surplus` > 0 for the first and < 0 for the second.

    One aggregation over both frames; empty when they hold the same rows.
    """
    b = b.select(*a.columns)
    signed = a.withColumn("_sign", F.lit(1)).unionByName(b.withColumn("_sign", F.lit(-1)))
    return (
        signed.groupBy(*a.columns)
        .agg(F.sum("_sign").alias("surplus"))
        .filter(F.col("surplus") != 0)
    )


def reconcile_counts(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row counts of two frames per key, side by side; a key absent on one side counts as null."""
    counted = [
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)) for df, name in ((a, "n_left"), (b, "n_right"))
    ]
    joined = counted[0].join(counted[1], list(keys), "full")
    return joined.withColumn("agree", F.col("n_left").eqNullSafe(F.col("n_right")))
