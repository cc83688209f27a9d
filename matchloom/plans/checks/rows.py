"""Keeping, dropping, counting and choosing rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.operators import filters as R
from matchloom.operators import quality as Q
from matchloom.operators.aliases import alias_filter, available_leagues
from matchloom.operators.views import dataset_view
from matchloom.plans.checks import check, table
from matchloom.sources.inline import inline_table


def urgent_by_customer(spark, sf):
    """Every customer with each of its orders; only urgent ones show their key, only urgent and low ones their price."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    priority = F.col("o_orderpriority")
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        F.when(priority == "1-URGENT", F.col("o_orderkey")).alias("o_orderkey"),
        F.when(priority.isin("1-URGENT", "5-LOW"), F.col("o_totalprice")).alias("o_totalprice"),
    )
    return customers.join(orders, "c_custkey", "left")


URGENT = """
    WITH base AS (
      SELECT c_custkey, c_name, c_mktsegment, CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END AS o_orderkey,
             CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') THEN o_totalprice END AS o_totalprice
      FROM customer LEFT JOIN orders ON c_custkey = o_custkey
    )
"""


@check("dropna_any", URGENT + "SELECT * FROM base WHERE c_name IS NOT NULL AND o_orderkey IS NOT NULL")
def dropna_any(spark, sf):
    return R.drop_any_null(urgent_by_customer(spark, sf), ["c_name", "o_orderkey"])


@check("dropna_all", URGENT + "SELECT o_orderkey, o_totalprice FROM base WHERE NOT (o_orderkey IS NULL AND o_totalprice IS NULL)")
def dropna_all(spark, sf):
    return R.drop_all_null(urgent_by_customer(spark, sf).select("o_orderkey", "o_totalprice"))


@check("keep_keyed", URGENT + "SELECT c_mktsegment, count(*) AS n_rows FROM base WHERE o_orderkey IS NOT NULL GROUP BY 1")
def keep_keyed(spark, sf):
    return Q.counts_by(R.keep_keyed(urgent_by_customer(spark, sf), "o_orderkey"), ["c_mktsegment"])


@check(
    "drop_both_null",
    """
    SELECT * FROM (
      SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS home_id,
             CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey + 1 END AS away_id
      FROM orders
    ) WHERE NOT (home_id IS NULL AND away_id IS NULL)
    """,
)
def drop_both_null(spark, sf):
    ids = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("home_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey") + 1).alias("away_id"),
    )
    return R.drop_all_null(ids, ["home_id", "away_id"])


@check(
    "iso_date_filter",
    """
    SELECT * FROM (
      SELECT o_orderkey,
             CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
                                WHEN 'O' THEN strftime(o_orderdate, '%d/%m/%Y') END AS date_text
      FROM orders
    ) WHERE regexp_full_match(date_text, '[0-9]{4}-[0-9]{2}-[0-9]{2}')
    """,
)
def iso_date_filter(spark, sf):
    text = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd")).when(
        F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "dd/MM/yyyy")
    )
    return R.keep_iso_dates(table(spark, sf, "orders").select("o_orderkey", text.alias("date_text")), "date_text")


@check(
    "drop_sentinels",
    "SELECT event_id, event_type, value FROM events WHERE event_type NOT IN ('', 'view', 'error')",
)
def drop_sentinels(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    return R.drop_sentinels(events, "event_type", ["", "view", "error"])


@check(
    "drop_summary_rows",
    r"""
    SELECT * FROM (
      SELECT o_orderkey,
             CASE o_orderstatus WHEN 'P' THEN ' ' || o_custkey || ' PLAYERS in all'
                                WHEN 'F' THEN o_orderpriority END AS player
      FROM orders
    ) WHERE player IS NULL OR NOT regexp_matches(player, '(?i)^\s*[0-9]+\s+players')
    """,
)
def drop_summary_rows(spark, sf):
    player = F.when(
        F.col("o_orderstatus") == "P", F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" PLAYERS in all"))
    ).when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
    return R.drop_summary_rows(table(spark, sf, "orders").select("o_orderkey", player.alias("player")), "player")


@check(
    "drop_blank_rows",
    """
    SELECT * FROM (
      SELECT CASE WHEN o_orderstatus = 'P' THEN ' ' ELSE o_orderpriority END AS first_cell,
             CASE WHEN o_orderstatus = 'P' AND o_orderpriority <> '5-LOW' THEN '  '
                  WHEN o_orderstatus = 'F' THEN o_orderstatus END AS second_cell
      FROM orders
    ) WHERE first_cell IS NULL OR trim(first_cell) <> '' OR second_cell IS NULL OR trim(second_cell) <> ''
    """,
)
def drop_blank_rows(spark, sf):
    is_p = F.col("o_orderstatus") == "P"
    cells = table(spark, sf, "orders").select(
        F.when(is_p, " ").otherwise(F.col("o_orderpriority")).alias("first_cell"),
        F.when(is_p & (F.col("o_orderpriority") != "5-LOW"), "  ")
        .when(F.col("o_orderstatus") == "F", F.col("o_orderstatus"))
        .alias("second_cell"),
    )
    return R.drop_blank_rows(cells)


@check(
    "nonnull_profile",
    URGENT
    + """
    SELECT n_filled, count(*) AS n_rows FROM (
      SELECT CAST((o_orderkey IS NOT NULL) AS INTEGER) + CAST((o_totalprice IS NOT NULL) AS INTEGER)
             + CAST((c_name IS NOT NULL) AS INTEGER) AS n_filled
      FROM base
    ) GROUP BY 1
    """,
)
def nonnull_profile(spark, sf):
    filled = R.filled_cells(["o_orderkey", "o_totalprice", "c_name"])
    return Q.counts_by(urgent_by_customer(spark, sf).select(filled.alias("n_filled")), ["n_filled"])


@check(
    "filled_tables",
    URGENT
    + """
    SELECT c_custkey, o_orderkey FROM base
    WHERE c_custkey IN (SELECT c_custkey FROM base WHERE o_orderkey IS NOT NULL AND o_totalprice IS NOT NULL)
    """,
)
def filled_tables(spark, sf):
    rows = urgent_by_customer(spark, sf).select("c_custkey", "o_orderkey", "o_totalprice")
    return R.keep_filled_tables(rows, ["c_custkey"], ["o_orderkey", "o_totalprice"]).select("c_custkey", "o_orderkey")


@check(
    "subset_filter",
    """
    SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem
    WHERE l_returnflag IN ('A', 'R') AND l_linestatus = 'F'
    """,
)
def subset_filter(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return R.keep_values(lines, l_returnflag=["A", "R"], l_linestatus="F")


@check(
    "ids_semi",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderkey IN (SELECT l_partkey FROM lineitem)
    """,
)
def ids_semi(spark, sf):
    """Orders whose number is also the number of a part in some order line."""
    ids = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("o_orderkey"))
    return R.keep_ids(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ids, "o_orderkey")


_ALIASES = [("NATION_2", "NATION_3"), ("NATION_2", "N2"), ("NATION_7", "NATION_8"), ("NATION_9", "NATION_8")]


def alias_table(spark):
    return inline_table(spark, _ALIASES, "canonical string, alias string")


def customers_with_nation(spark, sf):
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("team"))
    return table(spark, sf, "customer").select("c_custkey", "c_nationkey").join(nation, "c_nationkey", "left")


@check(
    "alias_filter",
    """
    SELECT c_custkey, n_name AS team FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    WHERE n_name IN ('NATION_2', 'NATION_3', 'N2', 'NATION_8', 'NATION_9')
    """,
)
def filter_by_alias(spark, sf):
    rows = customers_with_nation(spark, sf).select("c_custkey", "team")
    return alias_filter(rows, "team", alias_table(spark), "NATION_3", "NATION_8")


@check(
    "dataset_view",
    """
    SELECT o_orderkey AS match_id, o_orderpriority AS league,
           right('0' || (year(o_orderdate) % 100), 2) || right('0' || ((year(o_orderdate) + 1) % 100), 2) AS season,
           n_name AS team
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND year(o_orderdate) IN (1998, 1999)
      AND n_name IN ('NATION_2', 'NATION_3', 'N2')
    """,
)
def view_of_dataset(spark, sf):
    from matchloom.functions.dates import season_code

    teams = customers_with_nation(spark, sf).select(F.col("c_custkey").alias("o_custkey"), "team")
    games = (
        table(spark, sf, "orders")
        .join(teams, "o_custkey")
        .select(
            F.col("o_orderkey").alias("match_id"),
            F.col("o_orderpriority").alias("league"),
            season_code(F.year("o_orderdate")).alias("season"),
            "team",
        )
    )
    return dataset_view(
        games, leagues=["1-URGENT", "5-LOW"], seasons=[1998, "99-00"], team="NATION_2", aliases=alias_table(spark)
    )


# -- counts ---------------------------------------------------------------------------------


@check(
    "quality_counts",
    URGENT
    + """
    SELECT c_mktsegment, count(*) AS n_rows, count(o_orderkey) AS n_with_id,
           count(*) FILTER (WHERE o_orderkey IS NULL) AS n_without_id,
           count(*) FILTER (WHERE o_totalprice > 250000) AS n_large
    FROM base GROUP BY 1
    """,
)
def quality_counts(spark, sf):
    order = F.col("o_orderkey")
    checks = {
        "n_with_id": order.isNotNull(), "n_without_id": order.isNull(), "n_large": F.col("o_totalprice") > 250000,
    }
    return Q.quality_counts(urgent_by_customer(spark, sf), checks, ["c_mktsegment"])


@check("distinct_keys", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def distinct_keys(spark, sf):
    return table(spark, sf, "customer").select("c_nationkey", "c_mktsegment").distinct()


@check(
    "season_count",
    """
    SELECT o_orderstatus, count(DISTINCT year(o_orderdate)) AS n_seasons FROM orders GROUP BY 1
    """,
)
def season_count(spark, sf):
    from matchloom.functions.dates import season_code

    orders = table(spark, sf, "orders").withColumn("season", season_code(F.year("o_orderdate")))
    return Q.distinct_count(orders, ["o_orderstatus"], "season", "n_seasons")


@check(
    "null_profile",
    URGENT
    + """
    , counts AS (
      SELECT count(*) AS n, count(c_custkey) AS a, count(c_name) AS b, count(o_orderkey) AS c, count(o_totalprice) AS d
      FROM base
    )
    SELECT column_name, n AS n_rows, n - filled AS n_null, filled = 0 AS is_empty FROM (
      SELECT n, 'c_custkey' AS column_name, a AS filled FROM counts
      UNION ALL SELECT n, 'c_name', b FROM counts
      UNION ALL SELECT n, 'o_orderkey', c FROM counts
      UNION ALL SELECT n, 'o_totalprice', d FROM counts
      UNION ALL SELECT n, 'nothing', 0 FROM counts
    )
    """,
)
def null_profile(spark, sf):
    rows = urgent_by_customer(spark, sf).drop("c_mktsegment").withColumn("nothing", F.lit(None).cast("string"))
    return Q.null_profile(rows)


@check(
    "counts_by_period",
    "SELECT o_orderpriority AS league, year(o_orderdate)::INTEGER AS season, count(*) AS n_rows FROM orders GROUP BY ALL",
)
def counts_by_period(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("league"), F.year("o_orderdate").alias("season")
    )
    return Q.counts_by(orders, ["league", "season"])


@check(
    "norm_dictionary",
    r"""
    WITH names AS (
      SELECT DISTINCT name FROM (
        SELECT p_name AS name FROM part UNION ALL SELECT upper(replace(p_name, ' ', '-')) FROM part
        UNION ALL SELECT c_name FROM customer
      )
    )
    SELECT trim(regexp_replace(replace(lower(name), '-', ' '), '\s+', ' ', 'g')) AS norm_name,
           max(name) AS name, count(*) AS n_names
    FROM names GROUP BY 1
    """,
)
def norm_dictionary(spark, sf):
    parts = table(spark, sf, "part").select(
        F.explode(F.array("p_name", F.upper(F.translate("p_name", " ", "-")))).alias("name")
    )
    return Q.name_dictionary(parts.union(table(spark, sf, "customer").select("c_name")), "name")


# -- choosing -------------------------------------------------------------------------------


@check(
    "available_keys",
    """
    SELECT DISTINCT o_orderpriority AS league FROM orders WHERE o_orderstatus <> 'F' ORDER BY 1
    """,
)
def available_keys(spark, sf):
    """Each order states its priority as a league and, unless it is finished, the name a source has for it."""
    source = F.when(F.col("o_orderstatus") != "F", "open")
    settings = F.map_filter(F.create_map(F.coalesce(source, F.lit("none")), "o_orderpriority"), lambda k, v: k != "none")
    return available_leagues(
        table(spark, sf, "orders").select(F.col("o_orderpriority").alias("league"), settings.alias("settings")), "open"
    )


@check("topk", "SELECT s_suppkey, s_name, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 5")
def topk(spark, sf):
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return R.top_rows(suppliers, 5, [F.desc("s_acctbal"), F.asc("s_suppkey")])


@check(
    "problem_sample",
    URGENT + "SELECT DISTINCT c_name FROM base WHERE o_orderkey IS NULL ORDER BY c_name LIMIT 10",
)
def problem_sample(spark, sf):
    problems = urgent_by_customer(spark, sf).filter("o_orderkey IS NULL").select("c_name").distinct()
    return R.top_rows(problems, 10, [F.asc("c_name")])


@check(
    "stable_sample",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 100
    """,
)
def stable_sample(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return R.stable_sample(orders, 100, "o_orderkey")
