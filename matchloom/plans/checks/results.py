"""Match results."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.operators import results as S
from matchloom.plans.checks import check, table
from matchloom.plans.checks.joins import LINES, match_lines

_CODES = ("F", "O", "P")  # home win, away win, draw

_SIDES = (
    LINES
    + """
    , sides AS (
      SELECT home_team AS team, 'Home' AS is_home, year(o_orderdate)::INTEGER AS season,
             (o_orderstatus = 'F')::INTEGER AS win, (o_orderstatus = 'O')::INTEGER AS lose,
             (o_orderstatus = 'P')::INTEGER AS draw FROM lines
      UNION ALL
      SELECT away_team, 'Away', year(o_orderdate)::INTEGER, (o_orderstatus = 'O')::INTEGER,
             (o_orderstatus = 'F')::INTEGER, (o_orderstatus = 'P')::INTEGER FROM lines
    )
"""
)


@check(
    "home_away_results",
    _SIDES
    + """
    SELECT team, is_home, sum(win)::BIGINT AS n_win, round(avg(win), 6) AS win_pct,
           sum(lose)::BIGINT AS n_lose, round(avg(lose), 6) AS lose_pct,
           sum(draw)::BIGINT AS n_draw, round(avg(draw), 6) AS draw_pct
    FROM sides WHERE team IS NOT NULL GROUP BY team, is_home
    """,
)
def home_away_results(spark, sf):
    games = match_lines(spark, sf).select("home_team", "away_team", "o_orderstatus")
    results = S.home_away_results(games, "o_orderstatus", _CODES)
    return results.withColumns({c: F.round(c, 6) for c in ("win_pct", "lose_pct", "draw_pct")})


@check(
    "standings",
    _SIDES
    + """
    , totals AS (
      SELECT season, team, count(*) AS played, sum(win)::BIGINT AS n_win, sum(draw)::BIGINT AS n_draw,
             sum(lose)::BIGINT AS n_lose, (3 * sum(win) + sum(draw))::BIGINT AS points
      FROM sides WHERE team IS NOT NULL GROUP BY season, team
    )
    SELECT *, rank() OVER (PARTITION BY season ORDER BY points DESC, n_win DESC, team) AS place FROM totals
    """,
)
def standings(spark, sf):
    games = match_lines(spark, sf).select(
        "home_team", "away_team", "o_orderstatus", F.year("o_orderdate").alias("season")
    )
    return S.standings(games, "o_orderstatus", ["season"], _CODES)


@check(
    "side_averages",
    LINES
    + """
    SELECT team_id, side, count(*) AS n_matches,
           CAST(round(sum(CAST(acctbal AS DECIMAL(18, 2))) / count(*), 2) AS DOUBLE) AS avg_acctbal
    FROM (
      SELECT home_nation_id AS team_id, 'HOME' AS side, home_acctbal AS acctbal FROM lines
      UNION ALL SELECT away_nation_id, 'AWAY', away_acctbal FROM lines
    ) GROUP BY team_id, side
    """,
)
def side_averages(spark, sf):
    from matchloom.operators.reshape import side_split
    from matchloom.plans.checks.joins import order_lines

    columns = lambda place: {
        "team_id": F.col(f"{place}_nation_id"), "acctbal": F.col(f"{place}_acctbal").cast("decimal(18,2)"),
    }
    rows = side_split(order_lines(spark, sf), {"HOME": columns("home"), "AWAY": columns("away")}, "team_id", [])
    return S.side_averages(rows, ["acctbal"]).withColumn("avg_acctbal", F.round("avg_acctbal", 2).cast("double"))
