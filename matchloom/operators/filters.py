"""Keeping and dropping rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.dates import is_iso_date
from matchloom.functions.fixed_values import PLAYER_SENTINELS, SUMMARY_ROW_PATTERN
from matchloom.functions.text import safe_text


def drop_any_null(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of the columns; one condition per column, so that scans can use them."""
    for name in names:
        df = df.filter(F.col(name).isNotNull())
    return df


def drop_all_null(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Drop rows in which all the columns (by default every one) are null."""
    return df.dropna("all", subset=list(names) if names is not None else None)


def keep_keyed(df: DataFrame, key: str) -> DataFrame:
    """Keep rows with a key, which drops totals."""
    return df.filter(F.col(key).isNotNull())


def keep_iso_dates(df: DataFrame, date: str) -> DataFrame:
    """Keep rows whose date text is written year-month-day."""
    return df.filter(is_iso_date(date))


def drop_sentinels(df: DataFrame, name: str, sentinels: Sequence[str] = PLAYER_SENTINELS) -> DataFrame:
    """Drop rows without a name and rows whose name is a heading."""
    return df.filter(F.col(name).isNotNull() & ~F.col(name).isin(*sentinels))


def drop_summary_rows(df: DataFrame, name: str, pattern: str = SUMMARY_ROW_PATTERN) -> DataFrame:
    """Drop rows whose name reads like "16 Players"; rows without a name stay."""
    return df.filter(~F.coalesce(F.col(name), F.lit("")).rlike(pattern))


def drop_blank_rows(df: DataFrame, names: Sequence[str] | None = None, null_is_blank: bool = False) -> DataFrame:
    """Drop rows in which every cell is blank text. A null counts as blank only on request."""
    cells = F.array(*[F.col(c).cast("string") for c in (names or df.columns)])
    filled = lambda x: safe_text(x) != ""
    keep = filled if null_is_blank else (lambda x: x.isNull() | filled(x))
    return df.filter(F.exists(cells, keep))


def filled_cells(names: Sequence[str]) -> Column:
    """Number of non-null cells in a row."""
    return sum((F.col(c).isNotNull().cast("int") for c in names), F.lit(0))


def keep_filled_tables(df: DataFrame, table_keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Keep tables in which some row has more than one filled cell."""
    filled = df.groupBy(*table_keys).agg(F.max(filled_cells(names)).alias("_filled"))
    return df.join(filled.filter("_filled > 1").select(*table_keys), list(table_keys), "left_semi")


def keep_values(df: DataFrame, **allowed: Sequence[object] | object | None) -> DataFrame:
    """Keep rows whose columns hold one of the given values; None means no restriction."""
    for name, values in allowed.items():
        if values is not None:
            values = [values] if isinstance(values, (str, int)) else list(values)
            df = df.filter(F.col(name).isin(*values))
    return df


def keep_ids(df: DataFrame, ids: DataFrame, key: str, required: bool = False) -> DataFrame:
    """Keep rows whose id is listed. With `required`, one job checks that some row is left."""
    kept = df.join(ids.select(key), key, "left_semi")
    if required and kept.isEmpty():
        raise ValueError(f"no rows found for the given {key}")
    return kept


def first_seen(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one that comes first, kept by a partial aggregation."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*").select(*df.columns)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the newest one."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = F.max(F.struct(*order, *rest)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "_newest.*").select(*df.columns)


def with_freshness(df: DataFrame, fetched_at: str, as_of: Column, max_age: int | dt.timedelta | None) -> DataFrame:
    """Flag rows that are young enough at `as_of`; without a limit all are fresh.

    A number counts calendar days; a time span is compared in full, down to the second.
    """
    if max_age is None:
        return df.withColumn("is_fresh", F.lit(True))
    if isinstance(max_age, dt.timedelta):
        oldest = as_of.cast("timestamp") - F.lit(max_age)
        return df.withColumn("is_fresh", F.col(fetched_at).cast("timestamp") >= oldest)
    age = F.datediff(as_of.cast("date"), F.col(fetched_at).cast("date"))
    return df.withColumn("is_fresh", age <= max_age)


def quarantine(df: DataFrame, is_good: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that pass a test, and the others (a null result counts as failed)."""
    good = F.coalesce(is_good, F.lit(False))
    return df.filter(good), df.filter(~good)


def top_rows(df: DataFrame, k: int, by: Sequence[Column]) -> DataFrame:
    """The first k rows in the given order, found by a distributed top-k."""
    return df.orderBy(*by).limit(k)


def stable_sample(df: DataFrame, n: int, key: str) -> DataFrame:
    """n rows chosen by the hash of their key, the same on every run."""
    return df.orderBy(F.md5(F.col(key).cast("string")), F.col(key)).limit(n)


def random_sample(df: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    """n rows chosen at random."""
    return df.orderBy(F.rand(seed) if seed is not None else F.rand()).limit(n)
