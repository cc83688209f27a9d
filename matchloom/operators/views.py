"""Views of one dataset: leagues, seasons, matches, teams."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.functions.dates import constant_season_code
from matchloom.operators.aliases import alias_filter
from matchloom.operators.filters import keep_values

_SEASON = re.compile(r"\d{2}|\d{4}|\d{2}-\d{2}|\d{4}-\d{2}|\d{4}-\d{4}")


def as_list(value: object) -> list:
    return list(value) if isinstance(value, (list, tuple, set, range)) else [value]


def keep_seasons(df: DataFrame, seasons: object, single: bool = False) -> DataFrame:
    """Rows of the given seasons, in whatever form they are written. The codes are constants, so partitions are pruned."""
    texts = [str(s) for s in as_list(seasons)]
    for text in texts:
        if not _SEASON.fullmatch(text):
            raise ValueError(f"Invalid season '{text}'")
    return df.filter(F.col("season").isin(*[constant_season_code(t, single) for t in texts]))


def dataset_view(
    df: DataFrame,
    leagues: str | Sequence[str] | None = None,
    seasons: object = None,
    match_id: object = None,
    team: str | Sequence[str] | None = None,
    player: str | Sequence[str] | None = None,
    aliases: DataFrame | None = None,
    single_year: bool = False,
    required: bool = False,
) -> DataFrame:
    """Rows of a landed table for the given leagues, seasons, matches, teams and players.

    Leagues and seasons without data give no rows. With `required`, one job checks that the
    given match ids exist.
    """
    view = keep_values(df, league=leagues, player=player)
    if seasons is not None:
        view = keep_seasons(view, seasons, single_year)
    if match_id is not None:
        view = keep_values(view, match_id=as_list(match_id))
        if required and view.isEmpty():
            raise ValueError(f"No matches found with the given IDs: {match_id}")
    if team is not None:
        teams = as_list(team)
        view = keep_values(view, team=teams) if aliases is None else alias_filter(view, "team", aliases, *teams)
    return view
