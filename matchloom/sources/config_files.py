"""Configuration in JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.functions.fixed_values import TEAM_CATALOGUE
from matchloom.functions.ids import team_id
from matchloom.operators.aliases import alias_rows
from matchloom.sources.inline import inline_table


def _read_map(spark: SparkSession, path: str, schema: str) -> DataFrame:
    document = spark.read.text(path, wholetext=True)
    return document.select(F.from_json("value", schema).alias("config"))


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    """Alias file {canonical: [alias, ...]} as rows (canonical, alias)."""
    return alias_rows(_read_map(spark, path, "map<string,array<string>>"), "config")


def read_leagues(spark: SparkSession, path: str) -> DataFrame:
    """League file {league: {source: its name there, season_start, season_end}} as one row per league."""
    leagues = _read_map(spark, path, "map<string,map<string,string>>").select(
        F.explode("config").alias("league", "settings")
    )
    setting = lambda name: F.try_element_at(F.col("settings"), F.lit(name))
    return leagues.withColumns({m: setting(m) for m in ("season_start", "season_end")})


def team_catalogue(spark: SparkSession) -> DataFrame:
    """The built-in team catalogue with the derived team ids."""
    teams = inline_table(spark, TEAM_CATALOGUE, "equipo string, estadio string, ciudad string, capacidad int")
    return teams.withColumn("team_id", team_id("equipo"))
