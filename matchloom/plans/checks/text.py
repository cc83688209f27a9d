"""Names, numbers in texts, ids, seasons."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.functions import dates as D
from matchloom.functions import ids as I
from matchloom.functions import text as X
from matchloom.operators.links import link_names, link_parts
from matchloom.plans.checks import check, table
from matchloom.plans.checks.joins import LINES, order_lines

_PLAIN = r"regexp_replace(strip_accents({}), '[^\x00-\x7F]', '', 'g')"
_NORM = r"trim(regexp_replace(replace(lower(" + _PLAIN + r"), '-', ' '), '\s+', ' ', 'g'))"


@check("strip_accents", f"SELECT doc_id, {_PLAIN.format('text')} || ' DZeko final 12 tm' AS plain FROM documents")
def strip_accents(spark, sf):
    """Every text, with characters behind it that turn into several letters."""
    text = F.concat("text", F.lit(" Ǆeko ﬁnal ½ tm"))
    return table(spark, sf, "documents").select("doc_id", X.strip_accents(text).alias("plain"))


@check("strip_accents_exact", f"SELECT doc_id, {_PLAIN.format('text')} AS plain FROM documents")
def strip_accents_exact(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.strip_accents_exact("text").alias("plain"))


@check("normalize_text", f"SELECT doc_id, {_NORM.format('text')} AS norm FROM documents")
def normalize_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.normalize_text("text").alias("norm"))


@check(
    "game_key",
    LINES + "SELECT o_orderkey, l_suppkey, strftime(o_orderdate, '%Y-%m-%d') || ' ' || customer || '-' || supplier AS game FROM lines",
)
def game_key(spark, sf):
    return order_lines(spark, sf).select(
        "o_orderkey", "l_suppkey", I.game_key("o_orderdate", "customer", "supplier").alias("game")
    )


@check(
    "match_id48",
    LINES
    + """
    SELECT o_orderkey, l_suppkey,
           CASE WHEN o_orderstatus <> 'P' THEN CAST('0x' || substr(md5(
             lower(customer) || '_' || lower(supplier) || '_' || strftime(o_orderdate, '%Y-%m-%d')), 1, 12) AS BIGINT) END
             AS match_id
    FROM lines
    """,
)
def match_id48(spark, sf):
    """Orders with status P carry no ISO date and so get no id. Names are brought to their comparison form
    in the catalogues, once per name instead of once per line."""
    date = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    lines = order_lines(spark, sf, name=X.normalize_text)
    return lines.select(
        "o_orderkey", "l_suppkey", I.match_id_of(F.col("customer"), F.col("supplier"), date).alias("match_id")
    )


@check(
    "hash_ids",
    """
    SELECT c_name AS name, 'PLY-' || upper(substr(md5(c_name), 1, 10)) AS id FROM customer
    UNION ALL SELECT s_name, 'TEAM-' || upper(substr(md5(s_name), 1, 8)) FROM supplier
    """,
)
def hash_ids(spark, sf):
    players = table(spark, sf, "customer").select(F.col("c_name").alias("name"), I.player_id("c_name").alias("id"))
    teams = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), I.team_id("s_name").alias("id"))
    return players.union(teams)


@check("month_name", "SELECT o_orderkey, monthname(o_orderdate) AS month_txt FROM orders")
def month_name(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", D.month_name("o_orderdate").alias("month_txt"))


@check(
    "slug_parse",
    """
    SELECT o_orderkey, monthname(o_orderdate) AS month_txt, strftime(o_orderdate, '%Y-%m-%d') AS match_date,
           CASE WHEN o_orderpriority = '5-LOW' THEN 'El-' ELSE '' END || 'Customer-' || o_custkey || '-Status-' || o_orderstatus AS teams,
           'Customer-' || o_custkey || '-Status-' || o_orderstatus AS teams_before_month
    FROM orders
    """,
)
def slug_parse(spark, sf):
    """Writes a match link for every order and takes names and date out of it again; a team may begin with "El"."""
    team = F.when(F.col("o_orderpriority") == "5-LOW", "El-Customer-").otherwise("Customer-")
    prefix = F.when(F.col("o_orderstatus") == "P", "El-Clasico-").when(F.col("o_orderstatus") == "O", "El-Gran-Derbi-")
    url = F.concat(
        F.lit("https://example.com/en/matches/"), F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 8), F.lit("/"),
        F.coalesce(prefix, F.lit("")), team, F.col("o_custkey").cast("string"), F.lit("-Status-"),
        F.col("o_orderstatus"), F.date_format("o_orderdate", "-MMMM-d-yyyy"), F.lit("-La-Liga"),
    )
    links = link_parts(table(spark, sf, "orders").select("o_orderkey", url.alias("url")), "url")
    named = links.withColumnsRenamed({"link_teams": "teams", "link_date": "match_date"})
    return link_names(named, "url").select(
        "o_orderkey", "match_date", "teams", F.col("link_month").alias("month_txt"),
        F.col("link_teams").alias("teams_before_month"),
    )


@check(
    "strip_prefix",
    """
    SELECT c_name AS name, replace(replace(c_name, 'Customer#00', ''), 'Customer#', '') AS stripped FROM customer
    UNION ALL SELECT s_name, substr(s_name, length('Supplier#') + 1) FROM supplier
    """,
)
def strip_prefix(spark, sf):
    names = table(spark, sf, "customer").select(F.col("c_name").alias("name")).union(
        table(spark, sf, "supplier").select("s_name")
    )
    return names.select("name", X.strip_prefix("name", ["Customer#00", "Customer#", "Supplier#"]).alias("stripped"))


@check(
    "strip_words",
    r"""
    SELECT doc_id, regexp_replace(text, '(?i)^(?:(?:the|and|is|of|de|la|le|les) )+', '') AS stripped FROM documents
    """,
)
def strip_words(spark, sf):
    words = ["the", "and", "is", "of", "de", "la", "le", "les"]
    return table(spark, sf, "documents").select("doc_id", X.strip_words("text", words, " ").alias("stripped"))


@check(
    "stat_pair",
    """
    SELECT p_partkey, CASE WHEN p_type <> 'SMALL' THEN p_size END AS part,
           CASE WHEN p_type <> 'SMALL' THEN p_size * 2 END AS total
    FROM part
    """,
)
def stat_pair(spark, sf):
    pair = F.concat(F.col("p_size").cast("string"), F.lit("  OF "), (F.col("p_size") * 2).cast("string"))
    text = (
        F.when(F.col("p_type") == "SMALL", F.concat(F.col("p_size").cast("string"), F.lit("%")))
        .when(F.col("p_type") == "ECONOMY", F.concat(pair, F.lit(" — 29%")))
        .otherwise(F.concat(F.lit("31% — "), pair))
    )
    found = X.stat_pair("cell")
    return table(spark, sf, "part").select("p_partkey", text.alias("cell")).select(
        "p_partkey", found["part"].alias("part"), found["total"].alias("total")
    )


@check(
    "score_pair",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN month(o_orderdate)::INTEGER END AS home_goals,
           CASE WHEN o_orderstatus = 'F' THEN day(o_orderdate)::INTEGER END AS away_goals
    FROM orders
    """,
)
def score_pair(spark, sf):
    plain = F.concat(F.month("o_orderdate").cast("string"), F.lit("–"), F.dayofmonth("o_orderdate").cast("string"))
    text = F.when(F.col("o_orderstatus") == "F", plain).when(
        F.col("o_orderstatus") == "O", F.concat(F.lit("(4) "), plain, F.lit(" (5)"))
    )
    score = X.score_pair("score")
    return table(spark, sf, "orders").select("o_orderkey", text.alias("score")).select(
        "o_orderkey", score["home"].alias("home_goals"), score["away"].alias("away_goals")
    )


@check(
    "percent_int",
    """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_returnflag <> 'N' THEN CAST(round(l_discount * 100) AS INTEGER) END AS discount_pct,
           l_returnflag = 'A' AS is_percent
    FROM lineitem
    """,
)
def percent_int(spark, sf):
    number = F.round(F.col("l_discount") * 100).cast("int").cast("string")
    text = F.when(F.col("l_returnflag") == "A", F.concat(number, F.lit("%"))).when(F.col("l_returnflag") == "R", number)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", text.alias("cell")).select(
        "l_orderkey", "l_linenumber", X.percent_int("cell").alias("discount_pct"), X.is_percent("cell").alias("is_percent")
    )


@check(
    "safe_text",
    """
    SELECT doc_id, trim(text, chr(9) || chr(10) || chr(13) || ' ') AS clean,
           CASE WHEN lang = 'en' THEN '' ELSE lang END AS lang_text
    FROM documents
    """,
)
def safe_text(spark, sf):
    padded = F.concat(F.lit(" \t"), F.col("text"), F.lit("\n "))
    lang = F.when(F.col("lang") != "en", F.col("lang"))
    return table(spark, sf, "documents").select(
        "doc_id", X.safe_text(padded).alias("clean"), X.safe_text(lang).alias("lang_text")
    )


@check("clean_id", "SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS VARCHAR) AS match_id FROM lineitem")
def clean_id(spark, sf):
    text = F.concat(F.lit(" "), F.col("l_orderkey").cast("string"), F.lit(".0"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", X.clean_match_id(text).alias("match_id"))


@check(
    "to_int",
    """
    SELECT c_custkey, CASE WHEN c_mktsegment <> 'MACHINERY' THEN CAST(trunc(c_acctbal) AS BIGINT) END AS whole FROM customer
    """,
)
def to_int(spark, sf):
    text = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("inf")).otherwise(
        F.concat(F.lit(" "), F.col("c_acctbal").cast("string"))
    )
    return table(spark, sf, "customer").select("c_custkey", X.to_int(text).alias("whole"))


_FORMS = """
    WITH forms AS (
      SELECT o_orderkey, year(o_orderdate) AS y, o_orderpriority AS p, o_orderdate, o_orderstatus,
             right('0' || (year(o_orderdate) % 100), 2) AS yy,
             right('0' || ((year(o_orderdate) + 1) % 100), 2) AS nn
      FROM orders
    )
"""


def _season_forms(spark, sf):
    """Every order with the season of its year, written in five ways."""
    year = F.year("o_orderdate")
    two = lambda y: F.lpad((y % 100).cast("string"), 2, "0")
    text = (
        F.when(F.col("o_orderpriority") == "1-URGENT", year.cast("string"))
        .when(F.col("o_orderpriority") == "2-HIGH", two(year))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat_ws("-", year.cast("string"), (year + 1).cast("string")))
        .when(F.col("o_orderpriority") == "5-LOW", F.concat_ws("-", two(year), two(year + 1)))
        .otherwise(F.concat_ws("-", year.cast("string"), two(year + 1)))
    )
    return table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", text.alias("season"))


@check(
    "season_code",
    _FORMS
    + """
    SELECT o_orderkey,
           CASE p WHEN '1-URGENT' THEN CAST(y AS VARCHAR) WHEN '2-HIGH' THEN yy WHEN '3-MEDIUM' THEN y || '-' || (y + 1)
                  WHEN '5-LOW' THEN yy || '-' || nn ELSE y || '-' || nn END AS season,
           yy || nn AS multi, CAST(y AS VARCHAR) AS single, FALSE AS is_ambiguous
    FROM forms
    """,
)
def season_code(spark, sf):
    return _season_forms(spark, sf).select(
        "o_orderkey",
        "season",
        D.season_code("season").alias("multi"),
        D.season_code("season", single=True).alias("single"),
        D.season_is_ambiguous("season").alias("is_ambiguous"),
    )


@check(
    "season_complete",
    _FORMS
    + """
    SELECT o_orderkey,
           CASE o_orderstatus
             WHEN 'F' THEN o_orderdate + INTERVAL 300 DAY >= make_date(y + 1, 7, 1)
             WHEN 'O' THEN o_orderdate + INTERVAL 300 DAY >= make_date(y + 1, 6, 1)
             ELSE o_orderdate + INTERVAL 300 DAY >= make_date(y, 12, 1) END AS complete
    FROM forms
    """,
)
def season_complete(spark, sf):
    """Seasons ending in June (by default), May, or November of the year they start in."""
    end = F.when(F.col("o_orderstatus") == "O", "May").when(F.col("o_orderstatus") == "P", "Nov")
    start = F.when(F.col("o_orderstatus") == "P", "Mar")
    as_of = F.date_add(F.col("o_orderdate").cast("date"), 300)
    return _season_forms(spark, sf).select(
        "o_orderkey", D.season_complete("season", as_of, end, start).alias("complete")
    )
