"""Choosing, naming and aligning columns."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import starmap

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.functions.fixed_values import COLUMN_SYNONYMS, NULL_TOKENS
from matchloom.functions.text import null_if_token, snake_case


def front_columns(df: DataFrame, keys: Sequence[str], drop: Sequence[str] = (), last: bool = False) -> DataFrame:
    """Put the key columns first (or last), keep the others in order, leave out `drop`."""
    rest = [c for c in df.columns if c not in keys and c not in drop]
    return df.select(*rest, *keys) if last else df.select(*keys, *rest)


def select_existing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[c for c in names if c in df.columns])


def rename_synonyms(df: DataFrame, synonyms: Mapping[str, str] = COLUMN_SYNONYMS) -> DataFrame:
    """Rename columns that exist; other entries are ignored."""
    return df.withColumnsRenamed(dict(synonyms))


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the columns that exist; other names are ignored."""
    return df.drop(*names)


def drop_by_suffix(df: DataFrame, suffix: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.endswith(suffix)])


def filled_columns(df: DataFrame, blank_is_empty: bool = True) -> list[str]:
    """Names of the columns that hold a value in some row (one aggregation, run at once)."""

    def has_value(field: T.StructField):
        c = F.col(field.name)
        if blank_is_empty and isinstance(field.dataType, T.StringType):
            c = F.nullif(F.trim(c), F.lit(""))
        return (F.count(c) > 0).alias(field.name)

    if not df.columns:
        return []
    found = df.agg(*[has_value(f) for f in df.schema.fields]).first()
    return [c for c, filled in zip(df.columns, found) if filled]


def drop_empty_columns(df: DataFrame, blank_is_empty: bool = True) -> DataFrame:
    """Drop columns without any value. The schema depends on the data, so this runs one job."""
    return df.select(*filled_columns(df, blank_is_empty))


def prefix_columns(df: DataFrame, prefix: str, keys: Sequence[str]) -> DataFrame:
    """Prefix every column name but the keys."""
    return df.withColumnsRenamed({c: prefix + c for c in df.columns if c not in keys})


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Add the same values to every row."""
    return df.withColumns({name: F.lit(v) for name, v in values.items()})


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The frame itself; an error names the columns it lacks."""
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def find_column(df: DataFrame, part: str) -> str | None:
    """First column whose name contains a text, whatever its case."""
    wanted = re.compile(re.escape(part), re.IGNORECASE)
    for name in filter(wanted.search, df.columns):
        return name
    return None


def standardize_columns(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Rename the listed columns (by default all) to lower case with "_" between words."""
    chosen = df.columns if names is None else names
    return df.withColumnsRenamed({c: snake_case(c) for c in chosen})


def null_tokens(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Text columns with the tokens for missing values turned into nulls."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: null_if_token(c, tokens) for c in text})


# -- two-level headers ----------------------------------------------------------------------


@dataclass(frozen=True)
class Header:
    """A column's header in two levels; parsers write placeholders where a level is blank."""

    group: str | None
    name: str | None

    @property
    def levels(self) -> list[str]:
        """The levels that say something, the group first."""
        return [level.strip() for level in (self.group, self.name) if level and level.strip() and "Unnamed" not in level]

    @property
    def best(self) -> str:
        """The most specific level, or the placeholder if there is none."""
        return self.levels[-1] if self.levels else str(self.name)

    @property
    def in_group(self) -> bool:
        return len(self.levels) == 2


def unique_names(names: Sequence[str]) -> list[str]:
    """Names made distinct: a repeated name gets "_2", "_3", ..."""
    taken, seen, out = set(names), Counter(), []
    for name in names:
        seen[name] += 1
        number, candidate = seen[name], name
        while number > 1 and candidate in taken:
            candidate, number = f"{name}_{number}", number + 1
        taken.add(candidate)
        out.append(candidate)
    return out


def join_levels(headers: Sequence[tuple[str | None, str | None]]) -> list[str]:
    """Column names from (group, name) headers: group and name where both are there."""
    return unique_names(["_".join(h.levels) or h.best for h in starmap(Header, headers)])


def last_level(headers: Sequence[tuple[str | None, str | None]]) -> list[str]:
    """Column names from (group, name) headers: the name alone, with its group from its second use on."""
    used: set[str] = set()
    out = []
    for header in starmap(Header, headers):
        again = header.best in used and header.in_group
        used.add(header.best)
        out.append("_".join(header.levels) if again else header.best)
    return unique_names(out)


def merge_headers(headers: Sequence[tuple[str, str]]) -> list[str]:
    """Column names from two header rows, the lower one winning; a column may be blank in both."""
    return unique_names([h.best if h.levels else "" for h in starmap(Header, headers)])


def resolve_groups(
    frames_headers: Sequence[Sequence[tuple[str, str]]], keys: Sequence[str]
) -> list[list[str]]:
    """One name per (group, name) header, the same for a statistic in whatever frame it stands.

    A statistic without a named group takes the group it has in another frame (the first in
    alphabetical order), so the result does not depend on the order of the frames. A name in the
    group level counts as well.
    """
    frames = [list(starmap(Header, headers)) for headers in frames_headers]
    groups: dict[str, str] = {}
    for header in (h for headers in frames for h in headers if h.in_group):
        group = header.levels[0]
        groups[header.best] = min(group, groups.get(header.best, group))

    def final(header: Header) -> str:
        if header.best in keys:
            return header.best
        group = header.levels[0] if header.in_group else groups.get(header.best)
        return f"{group}_{header.best}" if group else header.best

    return [[final(h) for h in headers] for headers in frames]


# -- putting frames together ----------------------------------------------------------------


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a schema in its order: missing ones null, others left out, types cast."""
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def union_missing(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of the frames, matched by column name; what a frame lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_sorted(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """`union_missing` with the keys first and the other columns in name order."""
    united = union_missing(frames)
    return united.select(*keys, *sorted(c for c in united.columns if c not in keys))
