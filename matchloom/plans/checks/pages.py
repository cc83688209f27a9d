"""Stored web pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.functions import web as B
from matchloom.operators.columns import last_level
from matchloom.operators.links import match_details
from matchloom.plans.checks import check, table
from matchloom.plans.jobs import keeper_stats
from matchloom.sources import pages as P


@check(
    "page_title",
    r"""
    SELECT page_id, nullif(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '') AS title,
           nullif(regexp_extract(html, '(?i)<html[^>]*\slang="([^"]*)"', 1), '') AS lang
    FROM pages
    """,
)
def page_title(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", B.page_title("html").alias("title"), B.page_language("html").alias("lang")
    )


def pages_with_fixtures(spark, sf):
    """The pages, each behind a row of a fixture list: a date that is a link, a report with an escaped address, a plain name."""
    row = F.concat(
        F.lit("<tr><th data-stat='date'><a href=\"/en/matches/2025-08-15\">day</a></th><td class='x' data-stat=\"match_report\">"),
        F.lit("<A class='y' HREF='/en/matches/"), F.hex("page_id"), F.lit("?a=1&amp;b=&#39;2'>r</A>"),
        F.lit("<a href=\"/en/matches/later\">r</a></td><td data-stat='note'><b data-href=\"/no\">n</b></td></tr>"),
    )
    return table(spark, sf, "pages").select("page_id", F.concat(row, "html").alias("html"))


@check(
    "page_links",
    r"""
    WITH found AS (
      SELECT page_id, ['/en/matches/2025-08-15', '/en/matches/' || hex(page_id) || '?a=1&b=''2', '/en/matches/later'] ||
             list_transform(regexp_extract_all(html, '(?i)<a\s[^>]*?href="([^"]+)"', 1), lambda x: replace(x, '&amp;', '&')) AS hrefs
      FROM pages
    )
    SELECT page_id, CAST(unnest(range(0, len(hrefs))) AS INTEGER) AS pos, unnest(hrefs) AS href FROM found
    """,
)
def page_links(spark, sf):
    return pages_with_fixtures(spark, sf).select("page_id", F.posexplode(B.page_links("html")).alias("pos", "href"))


@check("match_links", "SELECT page_id, '/en/matches/' || hex(page_id) || '?a=1&b=''2' AS href FROM pages")
def match_links(spark, sf):
    pages = pages_with_fixtures(spark, sf)
    return pages.select("page_id", F.explode(B.match_links("html", "match_report")).alias("href"))


@check(
    "script_var",
    r"""SELECT page_id, nullif(regexp_extract(html, '\bvar\s+t\s*=\s*"([^"]*)"', 1), '') AS script_text FROM pages""",
)
def script_var(spark, sf):
    return table(spark, sf, "pages").select("page_id", B.script_string("html", "t").alias("script_text"))


@check(
    "script_json",
    r"""SELECT event_id, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k FROM events""",
)
def script_json(spark, sf):
    """Puts every event's properties into a script, escaped, and reads them back."""
    escaped = F.replace(F.replace("props", F.lit('"'), F.lit("\\x22")), F.lit("{"), F.lit("\\x7b"))
    html = F.concat(F.lit("<script>var statData = JSON.parse('"), escaped, F.lit("');</script>"))
    found = F.from_json(B.script_json("html", "statData"), "statData struct<k: bigint>")
    return table(spark, sf, "events").select("event_id", html.alias("html")).select(
        "event_id", found["statData"]["k"].alias("k")
    )


@check(
    "props_json",
    r"""SELECT event_id, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k FROM events""",
)
def props_json(spark, sf):
    return table(spark, sf, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@check(
    "url_parts",
    r"""
    SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS tail,
           nullif(regexp_extract(url, '^https?://([^/]+)', 1), '') AS host,
           nullif(regexp_extract(url, '/([a-z]{2})/[0-9]+', 1), '') AS lang
    FROM pages
    """,
)
def url_parts(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        B.url_tail("url").alias("tail"),
        B.table_id_part("url", "^https?://([^/]+)").alias("host"),
        B.table_id_part("url", "/([a-z]{2})/[0-9]+").alias("lang"),
    )


@check("uncomment_html", "SELECT page_id, replace(replace(html, '<!--', ''), '-->', '') AS html FROM pages")
def uncomment_html(spark, sf):
    return table(spark, sf, "pages").select("page_id", B.uncomment_html("html").alias("html"))


@check(
    "uncomment_tables",
    """
    SELECT page_id, ' <TABLE><tr></tr></Table> <!-- note --> &lt;Table x &lt;/TABLE&gt; ' || page_id || ' <table></table>' || html AS html
    FROM pages
    """,
)
def uncomment_tables(spark, sf):
    """Comments with tables in either case, plain and escaped, in front of each page; its own hold none and stay."""
    front = F.concat(
        F.lit("<!-- <TABLE><tr></tr></Table> --><!-- note --><!-- &lt;Table x &lt;/TABLE&gt; -->"),
        F.col("page_id").cast("string"), F.lit("<!-- <table></table>-->"),
    )
    return table(spark, sf, "pages").select("page_id", B.uncomment_tables(F.concat(front, "html")).alias("html"))


# -- tables ---------------------------------------------------------------------------------


def customer_pages(spark, sf):
    """One page per customer, with a player table and two goalkeeper tables, most of them inside comments.

    The player table of BUILDING customers comes twice, the commented copy first and without a
    balance; that of MACHINERY customers is commented.
    """
    lit, col = F.lit, F.col
    row = lambda *cells: F.concat(
        lit('<tr><th scope="row">'), cells[0], lit("</th>"),
        *[x for c in cells[1:] for x in (lit("<td>"), c, lit("</td>"))], lit("</tr>"),
    )

    def players(balance):
        return F.concat(
            lit('<table class="stats" id="stats_standard"><thead><tr><th></th><th colspan="2">Account</th></tr>'),
            lit("<tr><th>Player</th><th>Balance</th><th>Segment</th></tr></thead><tbody>"),
            row(col("c_name"), balance, col("c_mktsegment")),
            lit("<tr class=thead><th>Player</th><th>Balance</th><th>Segment</th></tr></tbody></table>"),
        )

    def keepers(kind, value):
        return F.concat(
            lit(f'<table id="{kind}_stats_N'), col("c_nationkey").cast("string"),
            lit('"><thead><tr><th>Player</th><th>Saves</th></tr></thead><tbody>'),
            row(col("c_name"), value), lit("</tbody></table>"),
        )

    comment = lambda html: F.concat(lit("<!-- "), html, lit(" -->"))
    balance = col("c_acctbal").cast("string")
    standard = (
        F.when(col("c_mktsegment") == "MACHINERY", comment(players(balance)))
        .when(col("c_mktsegment") == "BUILDING", F.concat(comment(players(lit(""))), players(balance)))
        .otherwise(players(balance))
    )
    advanced = F.when(
        col("c_mktsegment") != "HOUSEHOLD", comment(keepers("keeper_adv", (col("c_custkey") + 1).cast("string")))
    ).otherwise("")
    html = F.concat(
        lit("<html><body><div>"), standard, lit("</div>"),
        comment(keepers("keeper", col("c_custkey").cast("string"))), advanced, lit("</body></html>"),
    )
    url = F.concat(lit("/customers/"), col("c_custkey").cast("string"))
    return P.spread(table(spark, sf, "customer")).select(url.alias("url"), html.alias("html"))


@check(
    "table_extract",
    """
    SELECT '/customers/' || c_custkey AS url, id AS table_id, c_name AS player, is_commented
    FROM (
      SELECT *, 'stats_standard' AS id, c_mktsegment = 'MACHINERY' AS is_commented FROM customer
      UNION ALL SELECT *, 'stats_standard', TRUE FROM customer WHERE c_mktsegment = 'BUILDING'
      UNION ALL SELECT *, 'keeper_stats_N' || c_nationkey, TRUE FROM customer
      UNION ALL SELECT *, 'keeper_adv_stats_N' || c_nationkey, TRUE FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'
    )
    """,
)
def table_extract(spark, sf):
    rows = P.player_rows(P.extract_tables(customer_pages(spark, sf)))
    return P.table_columns(rows, ["Player"], ["url", "table_id", "is_commented"]).withColumnRenamed("Player", "player")


@check(
    "table_first",
    """
    SELECT '/customers/' || c_custkey AS url, c_name AS player, c_acctbal AS balance, c_mktsegment AS segment
    FROM customer
    """,
)
def table_first(spark, sf):
    rows = P.extract_tables(customer_pages(spark, sf), flatten=last_level)
    found = P.player_rows(P.first_table(rows, "stats_standard"))
    return found.select(
        "url", P.cell("Player").alias("player"), P.cell("Balance").try_cast("double").alias("balance"),
        P.cell("Segment").alias("segment"),
    )


@check(
    "table_by_id",
    """
    SELECT '/customers/' || c_custkey AS match_url, 'N' || c_nationkey AS team, c_name AS "Player",
           CAST(c_custkey AS VARCHAR) AS "Saves",
           CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN CAST(c_custkey + 1 AS VARCHAR) END AS "adv_Saves"
    FROM customer
    """,
)
def table_by_id(spark, sf):
    return keeper_stats(P.extract_tables(customer_pages(spark, sf)), ["Saves"], ["Saves"])


@check(
    "match_details",
    """
    SELECT '/orders/' || o_orderkey AS url,
           CASE WHEN o_orderstatus = 'F' AND o_orderkey % 10 <> 0 THEN 'Customer ' || o_custkey END AS home_team,
           CASE WHEN o_orderstatus = 'F' AND o_orderkey % 10 <> 0 THEN 'Priority ' || o_orderpriority END AS away_team,
           CASE WHEN o_orderstatus = 'F' AND o_orderkey % 10 <> 0 THEN month(o_orderdate) || ' 0.5' END AS score,
           CASE WHEN o_orderstatus = 'F' AND o_orderkey % 10 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS date
    FROM orders
    """,
)
def details_of_matches(spark, sf):
    """One page per order: status F with a full score box, O without a score, P without a box.

    Every tenth box lacks the second team, while a linked name stands behind the box. What stands in front
    of the date is nested 3 or 30 deep.
    """
    lit, col = F.lit, F.col

    def team(label, value, goals):
        score = F.concat(
            lit('<div class="scores"><div class="score">'), goals.cast("string"), lit("</div> <div>0.5</div></div>")
        )
        return F.concat(
            lit('<div class="team"><strong><a href="/t">'), lit(label), value, lit("</a></strong>"),
            F.when(col("o_orderstatus") == "F", score).otherwise(""), lit("</div>"),
        )

    second = team("Priority ", col("o_orderpriority"), F.dayofmonth("o_orderdate"))
    box = F.concat(
        lit('<div id="top" class="scorebox">'),
        team("Customer ", col("o_custkey").cast("string"), F.month("o_orderdate")),
        F.when(col("o_orderkey") % 10 == 0, lit("")).otherwise(second),
        F.when(col("o_orderkey") % 3 == 0, lit("<div>" * 30 + "x" + "</div>" * 30)).otherwise(lit("<div>" * 3 + "</DIV >" * 3)),
        lit('<div class="scorebox_meta"><div><b>'), F.date_format("o_orderdate", "yyyy-MM-dd"),
        lit("</b></div><div>Venue</div></div></div>"),
    )
    html = F.concat(lit("<body>"), F.when(col("o_orderstatus") != "P", box).otherwise("<br>"), lit('<p><strong><a href="/o">Other</a></strong></p></body>'))
    url = F.concat(lit("/orders/"), col("o_orderkey").cast("string"))
    return match_details(table(spark, sf, "orders").select(url.alias("url"), html.alias("html")))
