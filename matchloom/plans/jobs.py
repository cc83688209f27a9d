"""The two batch jobs, each one lazy plan (but for the step that drops empty columns)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.dates import month_name
from matchloom.functions.fixed_values import (
    KEEPER_ADVANCED_TABLE_PATTERN,
    KEEPER_TABLE_PATTERN,
    LABEL_CARDS,
    LABEL_SAVES,
    LABEL_SHOTS,
    RANK_COLUMNS,
)
from matchloom.functions.ids import match_id, match_id_of, player_id
from matchloom.functions.text import is_percent, normalize_text, percent_int, score_pair, stat_pair
from matchloom.functions.web import table_id_part
from matchloom.operators.columns import (
    drop_by_suffix,
    drop_columns,
    drop_empty_columns,
    filled_columns,
    find_column,
    front_columns,
    rename_synonyms,
    require_columns,
    select_existing,
)
from matchloom.operators.filters import (
    drop_all_null,
    drop_any_null,
    drop_blank_rows,
    drop_summary_rows,
    keep_iso_dates,
    keep_keyed,
)
from matchloom.operators.joins import lookup_join, role_join
from matchloom.operators.links import link_names, link_parts
from matchloom.operators.quality import name_dictionary
from matchloom.operators.reshape import set_union, team_match_rows
from matchloom.operators.series import Series, number_bucket, scan, scan_whole
from matchloom.operators.splits import two_name_split
from matchloom.sources.pages import cell, player_rows

_ROWS_PER_BUCKET = 100_000


def fixtures_with_goals(fixtures: DataFrame) -> DataFrame:
    """Fixtures with the goals taken from the score."""
    if "Score" not in fixtures.columns:
        fixtures = fixtures.withColumn("Score", F.lit(None).cast("string"))
    score = score_pair("Score")
    return fixtures.withColumns({"HomeGoals": score["home"], "AwayGoals": score["away"]})


def fixtures_with_ids(fixtures: DataFrame) -> DataFrame:
    """Fixtures with a proper date and both teams, with their match id."""
    rows = drop_any_null(keep_iso_dates(fixtures, "Date"), ["Home", "Away"])
    return rows.withColumn("id", match_id("Home", "Away", "Date"))


def fixtures_final(fixtures: DataFrame, teams: DataFrame) -> DataFrame:
    """Fixtures with match id and team ids in front, without team names."""
    rows = role_join(
        fixtures_with_ids(fixtures),
        teams,
        "equipo",
        {"Home": {"team_id": "home_team_id"}, "Away": {"team_id": "away_team_id"}},
    )
    return front_columns(rows, ["id", "home_team_id", "away_team_id"], drop=["Home", "Away"])


def match_records(raw: DataFrame) -> DataFrame:
    """Raw (match_url, row_no, home, away) rows as one row per match with its measures.

    A row of two percentages opens a record; under a label stands the row with its values.
    """
    line = Series(["match_url"], ["row_no"], [number_bucket("row_no", _ROWS_PER_BUCKET)])
    opens = is_percent("home") & is_percent("away")
    following = {"next_home": F.col("home"), "next_away": F.col("away")}
    whole, large = line.parted(raw.select("match_url", "row_no", "home", "away"))
    series = [read(part, line, following, {"record": opens.cast("bigint")}) for read, part in ((scan_whole, whole), (scan, large))]

    def last_where(condition, value):
        return F.max_by(value, F.when(condition, F.col("row_no")))

    def under(label: str, cell: str, part: str):
        return last_where(F.col("home") == label, stat_pair(cell)[part])

    measures = (
        last_where(opens, percent_int("home")).alias("poss_home"),
        last_where(opens, percent_int("away")).alias("poss_away"),
        under(LABEL_SHOTS, "next_home", "part").alias("shots_ot_home"),
        under(LABEL_SHOTS, "next_home", "total").alias("shots_total_home"),
        under(LABEL_SHOTS, "next_away", "part").alias("shots_ot_away"),
        under(LABEL_SHOTS, "next_away", "total").alias("shots_total_away"),
        under(LABEL_SAVES, "next_home", "part").alias("saves_home"),
        under(LABEL_SAVES, "next_away", "part").alias("saves_away"),
        F.max(F.when(F.col("home") == LABEL_CARDS, 0)).alias("cards_home"),
        F.max(F.when(F.col("home") == LABEL_CARDS, 0)).alias("cards_away"),
    )
    # Apart, as records of whole keys need no further shuffle.
    whole, large = [rows.filter("record > 0").groupBy("match_url", "record").agg(*measures) for rows in series]
    return whole.union(large)


def with_teams(rows: DataFrame, links: DataFrame, fixtures: DataFrame) -> DataFrame:
    """Rows with the fixture names of both teams of their `match_url` and the month; `links` holds each link of them.

    The names are null when the link names no known pair.
    """
    known = name_dictionary(set_union([fixtures, fixtures], ["Home", "Away"], "team"), "team")
    known = known.select(F.translate("norm_name", " ", "-").alias("slug_name"), F.col("name").alias("team"))

    def slugs(df: DataFrame) -> DataFrame:
        urls = link_names(df, "match_url")
        return urls.withColumn("slug", F.translate(normalize_text("link_teams"), " ", "-"))

    texts = slugs(links.select("match_url").distinct())
    split = two_name_split(slugs(rows), "slug", known, "slug_name", fallback=False, distinct_rows=True, take=["team"], texts=texts)
    both = F.col("score") == 2
    teams = {f"{role}_team": F.when(both, F.col(f"{side}_team")) for role, side in (("home", "left"), ("away", "right"))}
    return split.select(*rows.columns, *[c.alias(name) for name, c in teams.items()], F.col("link_month").alias("month_txt"))


def teams_of_links(links: DataFrame, fixtures: DataFrame) -> DataFrame:
    """Each distinct `match_url` with the fixture names of both teams and the month, as in `with_teams`."""
    return with_teams(links.select("match_url").distinct(), links, fixtures)


_MEASURES = (
    "poss_home", "poss_away", "shots_ot_home", "shots_total_home", "shots_ot_away", "shots_total_away",
    "saves_home", "saves_away", "cards_home", "cards_away",
)


def stats_with_ids(stats: DataFrame, fixtures: DataFrame, season: str | None = None) -> DataFrame:
    """Match records with the id of their fixture, found by both names and the month.

    A pair meets once a month within one season; with several seasons in the data, both
    frames need a `season` column, which then belongs to the key.
    """
    dated = drop_any_null(keep_iso_dates(fixtures, "Date"), ["Home", "Away"]).select(
        normalize_text("Home").alias("home_norm"),
        normalize_text("Away").alias("away_norm"),
        month_name(F.col("Date").try_cast("date")).alias("month_txt"),
        "Date",
        *([season] if season else []),
    )
    named = drop_any_null(stats, ["home_team", "away_team"]).withColumns(
        {"home_norm": normalize_text("home_team"), "away_norm": normalize_text("away_team")}
    )
    key = ["home_norm", "away_norm", "month_txt", *([season] if season else [])]
    joined = lookup_join(named, dated, {c: c for c in key}, ["Date"], many_to_one=True)
    with_id = joined.withColumn("id", match_id_of(F.col("home_norm"), F.col("away_norm"), F.col("Date")))
    return select_existing(with_id, ["id", "home_team", "away_team", *_MEASURES])


def team_stats_final(stats: DataFrame, teams: DataFrame) -> DataFrame:
    """Match statistics with team ids in place of names; matches without any known team are left out."""
    rows = role_join(
        stats,
        teams,
        "equipo",
        {"home_team": {"team_id": "home_team_id"}, "away_team": {"team_id": "away_team_id"}},
    )
    rows = front_columns(rows, ["id", "home_team_id", "away_team_id"], drop=["home_team", "away_team"])
    return drop_all_null(rows, ["home_team_id", "away_team_id"])


def team_match_stats(raw: DataFrame, fixtures: DataFrame, teams: DataFrame) -> DataFrame:
    """From the raw rows of match pages to one row per match and side."""
    records = with_teams(match_records(raw), raw, fixtures)
    return team_match_rows(team_stats_final(stats_with_ids(records, fixtures), teams))


def unresolved_matches(raw: DataFrame, fixtures: DataFrame) -> DataFrame:
    """Links whose teams could not be told apart."""
    links = teams_of_links(raw, fixtures)
    return links.filter(F.col("home_team").isNull() | F.col("away_team").isNull()).select("match_url")


# -- players --------------------------------------------------------------------------------


def player_catalogue(players: DataFrame, teams: DataFrame) -> DataFrame:
    """Players with derived ids and the id of their team, ids first."""
    rows = drop_all_null(rename_synonyms(drop_columns(players, RANK_COLUMNS)))
    rows = lookup_join(rows.withColumn("player_id", player_id("Player")), teams, {"Squad": "equipo"}, ["team_id"])
    return front_columns(rows, ["player_id", "team_id"])


def without_summaries(raw: DataFrame) -> DataFrame:
    """Player rows without the summary rows of their tables."""
    player = find_column(raw, "player")
    return drop_summary_rows(raw, player) if player else raw


def without_helpers(rows: DataFrame) -> DataFrame:
    return drop_by_suffix(drop_columns(rows, ["match_url", "stat_type", "team"]), "_summary")


def players_with_match_id(raw: DataFrame, known_teams: DataFrame, name: str = "equipo") -> DataFrame:
    """Player rows with the match id derived from their link; summary rows are left out.

    Every distinct link is read once, however many rows it has.
    """
    require_columns(raw, ["match_url"])
    rows = without_summaries(raw)
    known = known_teams.select(F.translate(normalize_text(name), " ", "-").alias("slug_name"))
    links = link_parts(raw.select("match_url").distinct(), "match_url")
    links = links.withColumn("slug", F.translate(normalize_text("link_teams"), " ", "-"))
    split = two_name_split(links, "slug", known, "slug_name", distinct_rows=True)
    ids = split.select("match_url", match_id("left_name", "right_name", "link_date").alias("id"))
    return lookup_join(rows, ids, "match_url", ["id"])


def normalized_players(rows: DataFrame) -> DataFrame:
    """Player statistics without helper columns, empty columns and blank rows."""
    return drop_blank_rows(drop_all_null(drop_empty_columns(without_helpers(rows))))


def player_stats_final(rows: DataFrame, players: DataFrame) -> DataFrame:
    """Player statistics with the player's id in place of the name; rows of unknown players are left out."""
    joined = lookup_join(rows, players, "Player", ["player_id"])
    return keep_keyed(front_columns(joined, ["id", "player_id"], drop=["Player"]), "player_id")


def player_match_stats(raw: DataFrame, players: DataFrame, known_teams: DataFrame) -> DataFrame:
    """From the raw player rows of match pages to statistics by match id and player id.

    Which columns are empty is read from the raw rows alone, before anything is joined to them.
    """
    needed = {*filled_columns(without_summaries(raw)), "match_url", find_column(raw, "player")}
    rows = players_with_match_id(raw.select(*[c for c in raw.columns if c in needed]), known_teams)
    return player_stats_final(drop_blank_rows(drop_all_null(without_helpers(rows))), players)


def keeper_stats(tables: DataFrame, basic: Sequence[str], advanced: Sequence[str]) -> DataFrame:
    """Goalkeepers of each match: basic statistics with the advanced ones beside them (`adv_`).

    Both come from the same pages, so they are brought together by one grouping instead of a
    join that would parse the pages twice. A keeper named twice in one table counts once.
    """
    team = F.coalesce(
        table_id_part("table_id", KEEPER_TABLE_PATTERN), table_id_part("table_id", KEEPER_ADVANCED_TABLE_PATTERN)
    )
    is_basic = F.col("table_id").rlike(KEEPER_TABLE_PATTERN)
    place = F.struct("table_no", "row_no")

    def first(name: str, condition: Column) -> Column:
        return F.min_by(cell(name), F.when(condition, place))

    rows = player_rows(tables).select("*", team.alias("team"), cell("Player").alias("Player")).filter("team is not null")
    return (
        rows.groupBy("Player", "team", F.col("url").alias("match_url"))
        .agg(
            F.max(is_basic).alias("_has_basic"),
            *[first(n, is_basic).alias(n) for n in basic],
            *[first(n, ~is_basic).alias(f"adv_{n}") for n in advanced],
        )
        .filter("_has_basic")
        .drop("_has_basic")
    )
