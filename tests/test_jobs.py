"""The batch jobs on small invented tables."""

import pytest
from pyspark.sql import functions as F

from matchloom.functions.ids import match_id
from matchloom.operators.joins import frame_difference
from matchloom.operators.results import side_averages
from matchloom.plans import jobs as J
from matchloom.sources.config_files import team_catalogue
from matchloom.sources.pages import extract_tables

BASE = "https://example.com/en/matches/12c8079e/"
GIRONA = BASE + "Girona-Rayo-Vallecano-August-15-2025-La-Liga"
DERBI = BASE + "El-Derbi-Madrileno-Atletico-Madrid-Real-Madrid-September-27-2025-La-Liga"
GRAN = BASE + "El-Gran-Derbi-Sevilla-Real-Betis-September-28-2025-La-Liga"
BAD = BASE + "Ajax-Amsterdam-PSV-August-16-2025-La-Liga"


def page(url, poss, shots, saves, cards=True):
    lines = [("Possession", "Possession"), poss, ("Shots on Target", "Shots on Target"), shots, ("Saves", "Saves"), saves]
    lines += [("Cards", "Cards"), (None, None)] if cards else []
    return [(url, i, h, a) for i, (h, a) in enumerate(lines)]


@pytest.fixture
def raw(spark):
    data = (
        page(GIRONA, ("44%", "56%"), ("2 of 7 — 29%", "31% — 5 of 16"), ("2 of 5 — 40%", "50% — 1 of 2"))
        + page(DERBI, ("50%", "51%"), ("3 of 9", "no data"), ("1 of 4", "0 of 3"), cards=False)
        + page(GRAN, ("60%", "40%"), ("1 of 2", "3 of 4"), ("5 of 6", "7 of 8"))
        + page(BAD, ("10%", "90%"), ("9 of 9", "9 of 9"), ("9 of 9", "9 of 9"))
        + [(GRAN, 20, None, None)]
    )
    return spark.createDataFrame(data, "match_url string, row_no bigint, home string, away string").repartition(4)


@pytest.fixture
def fixtures(spark):
    data = [
        ("2025-08-15", "Girona", "Rayo Vallecano", "1–3"),
        ("2025-09-27", "Atlético Madrid", "Real Madrid", "5–2"),
        ("2025-09-28", "Sevilla", "Real Betis", "(4) 0–0 (3)"),
        ("2026-02-28", "Real Madrid", "Atlético Madrid", None),
        ("Date", "Home", "Away", "Score"),
        ("2025-10-01", None, "Girona", None),
    ]
    return spark.createDataFrame(data, "Date string, Home string, Away string, Score string")


def test_fixtures(spark, fixtures):
    goals = J.fixtures_with_goals(fixtures)
    assert {r.Score: (r.HomeGoals, r.AwayGoals) for r in goals.collect()} == {
        "1–3": (1, 3), "5–2": (5, 2), "(4) 0–0 (3)": (None, None), "Score": (None, None), None: (None, None),
    }
    final = J.fixtures_final(goals, team_catalogue(spark))
    assert final.columns == ["id", "home_team_id", "away_team_id", "Date", "Score", "HomeGoals", "AwayGoals"]
    assert final.count() == 4 and final.filter("id = 247102277803306").count() == 1
    assert final.filter("home_team_id is null or away_team_id is null").count() == 0


def test_team_match_stats(spark, raw, fixtures):
    teams = team_catalogue(spark)
    found = J.team_match_stats(raw, fixtures, teams)
    named = found.join(teams, "team_id").select("equipo", "side", "possession", "shots_on_target", "shots_total", "saves", "cards")
    assert {tuple(r) for r in named.collect()} == {
        ("Girona", "HOME", 44, 2, 7, 2, 0), ("Rayo Vallecano", "AWAY", 56, 5, 16, 1, 0),
        ("Atlético Madrid", "HOME", 50, 3, 9, 1, None), ("Real Madrid", "AWAY", 51, None, None, 0, None),
        ("Sevilla", "HOME", 60, 1, 2, 5, 0), ("Real Betis", "AWAY", 40, 3, 4, 7, 0),
    }
    assert found.filter("match_id = '247102277803306'").count() == 2
    assert [r.match_url for r in J.unresolved_matches(raw, fixtures).collect()] == [BAD]
    averages = side_averages(found, ["possession"])
    assert averages.count() == 6


def test_two_fixtures_in_one_month_stop_the_job(spark, raw, fixtures):
    twice = fixtures.union(spark.createDataFrame([("2025-08-20", "Girona", "Rayo Vallecano", None)], fixtures.schema))
    with pytest.raises(Exception, match="merge keys are not unique"):
        J.team_match_stats(raw, twice, team_catalogue(spark)).collect()


def test_seasons_in_the_key(spark, fixtures):
    stats = spark.createDataFrame([("Girona", "Rayo Vallecano", "August", "2526")], "home_team string, away_team string, month_txt string, season string")
    both = fixtures.withColumn("season", F.lit("2526")).union(
        spark.createDataFrame([("2024-08-20", "Girona", "Rayo Vallecano", None, "2425")], "a string, b string, c string, d string, e string")
    )
    assert J.stats_with_ids(stats, both, season="season").first().id == 247102277803306


def test_partitions_change_nothing(spark, raw, fixtures):
    teams = team_catalogue(spark)
    one = J.team_match_stats(raw.coalesce(1), fixtures.coalesce(1), teams)
    many = J.team_match_stats(raw.repartition(8), fixtures.repartition(8), teams)
    assert frame_difference(one, many).count() == 0


def test_records_of_usual_links_are_shuffled_once(spark, raw, fixtures):
    """Raw rows go to their link as one row each run, and their records stay there; all else is small."""
    plan = J.match_records(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("Exchange hashpartitioning(match_url#") >= 1
    whole = plan[: plan.index("MapInArrow")]
    assert whole.count("Exchange") == 1 and "record" not in whole[whole.index("Exchange") :]
    parts = [raw.filter("home is not null").coalesce(1), raw.repartition(8, "row_no")]
    records = [J.match_records(p) for p in parts]
    assert frame_difference(*records).count() == 0 and records[0].count() == 4


@pytest.fixture
def players(spark):
    data = [("1", "Ann", "MF,FW", "Girona"), ("2", "Bob", "GK", "Nowhere"), (None, None, None, None)]
    return spark.createDataFrame(data, ["Rk", "Player", "Posición", "Team"])


def test_player_catalogue(spark, players, rows):
    found = J.player_catalogue(players, team_catalogue(spark)).filter("Player is not null")
    assert found.columns == ["player_id", "team_id", "Player", "Pos", "Squad"]
    assert rows(found, "Player", "team_id") == [("Ann", "TEAM-51EA86E0"), ("Bob", None)]


def test_player_match_stats(spark, players, rows):
    data = [
        ("Ann", "1", None, "g", "x", GIRONA), ("Bob", "0", " ", "g", "x", DERBI), ("Zoe", "2", None, "g", "x", GIRONA),
        ("16 Players", "3", None, "g", "x", GIRONA), ("Ann", "4", None, "g", "x", BASE + "nothing"),
    ]
    raw = spark.createDataFrame(data, "Player string, Gls string, gap string, team string, min_summary string, match_url string")
    teams = team_catalogue(spark)
    catalogue = J.player_catalogue(players, teams)
    with_id = J.players_with_match_id(raw, teams)
    assert with_id.count() == 4 and with_id.filter("id is null").count() == 1
    found = J.player_match_stats(raw, catalogue, teams)
    assert found.columns == ["id", "player_id", "Gls"]
    expected = spark.createDataFrame([("Atlético Madrid", "Real Madrid", "2025-09-27")], "h string, a string, d string")
    derbi = expected.select(match_id("h", "a", "d")).first()[0]
    assert {(r.id, r.Gls) for r in found.collect()} == {(247102277803306, "1"), (derbi, "0"), (None, "4")}


def test_keepers(spark, rows):
    def table(kind, team, *lines):
        body = "".join(f"<tr><td>{p}</td><td>{v}</td></tr>" for p, v in lines)
        return f'<table id="{kind}_stats_{team}"><thead><tr><th>Player</th><th>V</th></tr></thead><tbody>{body}</tbody></table>'

    html = table("keeper", "h1", ("Ann", 1), ("Bench", 9), ("Bob", 2)) + "<!--" + table("keeper_adv", "h1", ("Ann", 5), ("Zed", 6)) + "-->"
    pages = [("m1", html), ("m2", table("keeper", "h2", ("Cy", 3))), ("m3", table("keeper_adv", "h3", ("Di", 4)))]
    tables = extract_tables(spark.createDataFrame(pages, "url string, html string"))
    found = J.keeper_stats(tables, ["V"], ["V"])
    assert rows(found, "match_url", "team", "Player", "V", "adv_V") == [
        ("m1", "h1", "Ann", "1", "5"), ("m1", "h1", "Bob", "2", None), ("m2", "h2", "Cy", "3", None),
    ]
