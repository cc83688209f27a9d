"""Ratings that are valid for an interval of time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.dates import parse_date
from matchloom.operators.aliases import name_and_aliases
from matchloom.operators.filters import latest, with_freshness
from matchloom.operators.series import Series, fill_forward, next_row

FROM, TO = "from", "to"


def validity_intervals(df: DataFrame, series: Series, start: str) -> DataFrame:
    """Each row valid from its own time to that of the key's next row; the last one has no end."""
    return next_row(df, series, {TO: F.col(start)}).withColumn(FROM, F.col(start))


def valid_at(df: DataFrame, when: Column) -> DataFrame:
    """Rows whose interval holds a point in time; the end does not belong to it, no end is open."""
    return df.filter((F.col(FROM) <= when) & (F.col(TO).isNull() | (F.col(TO) > when)))


def ratings_at(df: DataFrame, date: str | dt.date | dt.datetime | None = None) -> DataFrame:
    """Ratings valid on a day, by default today."""
    return valid_at(df, F.lit(parse_date(date)).cast("timestamp"))


def overlapping_intervals(df: DataFrame, series: Series) -> DataFrame:
    """Rows whose interval reaches into the next one of the same key."""
    following = next_row(df, series, {"next_from": F.col(FROM)})
    return following.filter(F.col("next_from") < F.coalesce(F.col(TO), F.lit(dt.datetime(9999, 1, 1))))


def interval_join(
    facts: DataFrame,
    intervals: DataFrame,
    key: str,
    time: str,
    bucket: Sequence[Column],
    take: Sequence[str],
    rows_per_task: int = 1_000_000,
) -> DataFrame:
    """Left join each fact with the interval of its key that holds the fact's time.

    The intervals of a key must not overlap (see `overlapping_intervals`), so the only
    candidate is the latest one that starts at or before the fact. It is carried forward over
    the facts in time order: no pairs are built, however many rows a key has. `bucket` cuts
    the column "_time" of large keys.
    """
    values = [FROM, TO, *take]
    row = F.struct(*facts.columns)
    events = facts.select(
        F.col(key).alias("_key"), F.col(time).alias("_time"), F.lit(1).alias("_kind"),
        row.alias("_fact"), F.lit(None).alias("_interval"),
    )
    spans = intervals.select(
        F.col(key).alias("_key"), F.col(FROM).alias("_time"), F.lit(0).alias("_kind"),
        F.lit(None).alias("_fact"), F.struct(*values).alias("_interval"),
    )
    line = Series(["_key"], ["_time", "_kind"], bucket, rows_per_task)
    line = fill_forward(spans.unionByName(events), line, {"_valid": F.col("_interval")})
    holds = F.col("_valid.to").isNull() | (F.col("_time") < F.col("_valid.to"))
    keyed = line.filter("_kind = 1").select(
        "_fact.*", *[F.when(holds, F.col(f"_valid.{c}")).alias(c) for c in values]
    )
    keyless = facts.filter(F.col(key).isNull())
    return keyed.unionByName(keyless, allowMissingColumns=True)


def entity_history(
    df: DataFrame, column: str, entity: str, aliases: DataFrame | None = None, required: bool = False
) -> DataFrame:
    """All rows of one entity under any of its names. With `required`, one job checks that there are some."""
    names = F.lit(entity)
    rows = (
        df.filter(F.col(column) == names)
        if aliases is None
        else df.join(name_and_aliases(aliases, entity).withColumnRenamed("name", column), column, "left_semi")
    )
    if required and rows.isEmpty():
        raise ValueError(f"No data found for team {entity}")
    return rows


def latest_snapshot(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], as_of: Column, max_age: int | dt.timedelta | None
) -> DataFrame:
    """Newest row per key with `is_fresh`: whether it is young enough. The others form the list to renew."""
    if max_age is not None and not isinstance(max_age, (int, dt.timedelta)):
        raise TypeError("'max_age' must be of type int or datetime.timedelta")
    return with_freshness(latest(df, keys, order), order[0], as_of, max_age)


#: Intervals of a class are at most so many times as long as its bins, and longer than one bin.
CLASS_BASE = 8


def overlap_join(
    facts: DataFrame,
    intervals: DataFrame,
    key: str,
    time: str,
    take: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """Each fact with every interval of its key that holds the fact's time; intervals may overlap.

    Intervals are dealt to classes by length, and cut into bins of the time axis that suit their class: each
    one lies in 2 to 9 bins, and in each bin it covers a good part of the facts, so hardly any pair is tried
    in vain. Facts are looked up once per class present; there are at most 20 classes, as lengths of one
    class differ by a factor of up to 8. The join is on key, class and bin: a large key is split by time,
    and what still falls on one bin is split by adaptive execution. Beside the classes, the driver sees
    the first and last time of the facts, to which open and long intervals are cut.

    With `how="left"` facts without any interval stay, with nulls; null keys, times and starts match nothing.
    Intervals that end before or when they start hold nothing. The result has the columns of facts,
    then the bounds and `take`, which must not clash.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    at = F.unix_micros(F.col(time).cast("timestamp"))
    first, last = facts.agg(F.min(at), F.max(at)).first()
    first, last = F.lit(first).cast("long"), F.lit(last).cast("long")
    bounds = {"_from": F.unix_micros(F.col(FROM).cast("timestamp")), "_to": F.coalesce(F.unix_micros(F.col(TO).cast("timestamp")), last + 1)}
    spans = intervals.select(F.col(key).alias("_key"), F.struct(FROM, TO, *take).alias("_interval"), *(c.alias(n) for n, c in bounds.items()))
    spans = spans.select("_key", "_interval", F.greatest("_from", first).alias("_from"), F.least("_to", last + 1).alias("_to"))
    spans = spans.filter("_key IS NOT NULL AND _interval.from IS NOT NULL AND _from < _to")
    # The class is found by comparing whole numbers; a logarithm would round.
    widths = [CLASS_BASE**c for c in range(20)]
    size = F.col("_to") - F.col("_from")
    width = F.coalesce(*(F.when(size <= CLASS_BASE * w, F.lit(w)) for w in widths), F.lit(widths[-1] * CLASS_BASE)).cast("long")
    spans = spans.withColumn("_width", width)
    present = sorted(r[0] for r in spans.select("_width").distinct().collect())
    spans = spans.withColumn("_bin", F.explode(F.sequence(_bin("_from"), _bin(F.col("_to") - 1))))
    points = facts.select(F.col(key).alias("_key"), at.alias("_at"), F.struct(*facts.columns).alias("_fact"))
    asked = points.withColumn("_width", F.explode(F.array(*map(F.lit, present)).cast("array<bigint>"))).withColumn("_bin", _bin("_at"))
    pairs = asked.join(spans, ["_key", "_width", "_bin"]).filter("_from <= _at AND _at < _to")
    found = pairs.select("_fact.*", "_interval.*")
    if how == "inner":
        return found
    # Key and time decide what a fact meets, so the facts left over are those whose pair of both meets nothing.
    met = pairs.select("_key", "_at").distinct()
    alone = points.join(met, ["_key", "_at"], "left_anti").select("_fact.*")
    return found.unionByName(alone, allowMissingColumns=True)


def _bin(at: Column | str) -> Column:
    """Start of the bin of a time, in bins from the origin; rounding is downwards before it, too."""
    at = F.col(at) if isinstance(at, str) else at
    return F.call_function("div", at - F.pmod(at, F.col("_width")), F.col("_width"))
