"""Match results: home and away records, league tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.operators.reshape import melt_roles

_ROLES = {"home_team": "Home", "away_team": "Away"}


def result_flags(side: Column, result: Column, home: str = "H", away: str = "A", draw: str = "D") -> dict[str, Column]:
    """win, lose and draw as 0 or 1 for a side; a match without result counts as none of them."""
    is_home = side == "Home"

    def flag(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0)

    return {
        "win": flag((is_home & (result == home)) | (~is_home & (result == away))),
        "lose": flag((is_home & (result == away)) | (~is_home & (result == home))),
        "draw": flag(result == draw),
    }


def team_results(games: DataFrame, result: str, ids: Sequence[str] = (), codes: Sequence[str] = ("H", "A", "D")) -> DataFrame:
    """One row per team and match with the flags; matches without a team are left out."""
    sides = melt_roles(games, [*ids, result], _ROLES, "is_home", "team").filter(F.col("team").isNotNull())
    return sides.withColumns(result_flags(F.col("is_home"), F.col(result), *codes))


def home_away_results(games: DataFrame, result: str, codes: Sequence[str] = ("H", "A", "D")) -> DataFrame:
    """Number and share of wins, losses and draws per team, at home and away, in one aggregation."""
    measures = [("win", "n_win", "win_pct"), ("lose", "n_lose", "lose_pct"), ("draw", "n_draw", "draw_pct")]
    return (
        team_results(games, result, codes=codes)
        .groupBy("team", "is_home")
        .agg(*[f for flag, n, pct in measures for f in (F.sum(flag).alias(n), F.avg(flag).alias(pct))])
    )


def standings(games: DataFrame, result: str, season: Sequence[str], codes: Sequence[str] = ("H", "A", "D")) -> DataFrame:
    """League table per season: matches, results, points and place. Ranked after aggregation, one row per team.

    `season` names at least one column: places are counted within a season.
    """
    if not season:
        raise ValueError("a league table needs the columns of its season")
    table = (
        team_results(games, result, ids=season, codes=codes)
        .groupBy(*season, "team")
        .agg(
            F.count(F.lit(1)).alias("played"),
            F.sum("win").alias("n_win"),
            F.sum("draw").alias("n_draw"),
            F.sum("lose").alias("n_lose"),
        )
        .withColumn("points", 3 * F.col("n_win") + F.col("n_draw"))
    )
    place = Window.partitionBy(*season).orderBy(F.desc("points"), F.desc("n_win"), F.asc("team"))
    return table.withColumn("place", F.rank().over(place).cast("bigint"))


def side_averages(team_rows: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Mean of each measure per team and side."""
    return team_rows.groupBy("team_id", "side").agg(
        F.count(F.lit(1)).alias("n_matches"), *[F.avg(m).alias(f"avg_{m}") for m in measures]
    )
