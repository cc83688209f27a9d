"""Teams and leagues under several names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.operators.joins import override_merge, unique_rows


def alias_rows(config: DataFrame, column: str = "aliases") -> DataFrame:
    """A map {canonical: [alias, ...]} as rows (canonical, alias)."""
    teams = config.select(F.explode(column).alias("canonical", "names"))
    return teams.select("canonical", F.explode("names").alias("alias"))


def alias_collisions(aliases: DataFrame) -> DataFrame:
    """Aliases that name more than one team, with the number of teams."""
    counted = aliases.groupBy("alias").agg(F.count_distinct("canonical").alias("n_canonical"))
    return counted.filter("n_canonical > 1")


def unique_aliases(aliases: DataFrame) -> DataFrame:
    """One canonical name per alias: of several, the last one in name order."""
    return aliases.groupBy("alias").agg(F.max("canonical").alias("canonical"))


def canonical_names(df: DataFrame, column: str, aliases: DataFrame, out: str | None = None) -> DataFrame:
    """Replace aliases by the canonical name; other names stay."""
    lookup = unique_aliases(aliases).select(F.col("alias").alias("_alias"), F.col("canonical").alias("_canonical"))
    joined = df.join(lookup, F.col(column) == F.col("_alias"), "left")
    return joined.withColumn(out or column, F.coalesce("_canonical", column)).drop("_alias", "_canonical")


def alias_sets(df: DataFrame, column: str, aliases: DataFrame) -> DataFrame:
    """Distinct names with all names they also go by (`alias_names`) and with their canonical name (`standard_names`)."""
    names = df.select(F.col(column).alias("name")).dropna().distinct()
    pairs = aliases.filter("alias is not null")
    also = names.join(pairs.withColumnRenamed("canonical", "name"), "name", "left")
    standard = unique_aliases(pairs).withColumnRenamed("alias", "name")
    grouped = also.groupBy("name").agg(F.collect_set("alias").alias("_aliases"))
    return grouped.join(standard, "name", "left").select(
        F.col("name").alias(column),
        F.array_sort(F.array_distinct(F.concat(F.array("name"), "_aliases"))).alias("alias_names"),
        F.array_sort(F.array_compact(F.array_distinct(F.array(F.col("name"), F.col("canonical"))))).alias("standard_names"),
    )


def name_and_aliases(aliases: DataFrame, *names: str) -> DataFrame:
    """Every name (column `name`) under which the given teams appear, canonical or not."""
    given = F.array(*[F.lit(n) for n in names])
    spark = aliases.sparkSession
    asked = spark.range(1).select(F.explode(given).alias("name"))
    canonical = canonical_names(asked, "name", aliases)
    under = aliases.join(canonical.withColumnRenamed("name", "canonical"), "canonical", "left_semi")
    return asked.union(canonical).union(under.select("alias")).distinct()


def alias_filter(df: DataFrame, column: str, aliases: DataFrame, *names: str) -> DataFrame:
    """Rows of the given teams under any of their names."""
    return df.join(name_and_aliases(aliases, *names).withColumnRenamed("name", column), column, "left_semi")


def league_table(defaults: DataFrame, custom: DataFrame | None) -> DataFrame:
    """Leagues by name with their settings; a custom league replaces the default of its name."""
    return unique_rows(defaults, ["league"]) if custom is None else override_merge(defaults, custom, "league")


def available_leagues(leagues: DataFrame, source: str) -> DataFrame:
    """Names of the leagues that a source knows, sorted. `settings` maps the source to its own name."""
    known = F.try_element_at(F.col("settings"), F.lit(source)).isNotNull()
    return leagues.filter(known).select("league").distinct().orderBy("league")
