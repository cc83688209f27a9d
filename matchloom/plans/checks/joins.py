"""Catalogues, aliases, sets and comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.operators import joins as J
from matchloom.operators.aliases import alias_sets, canonical_names
from matchloom.operators.columns import front_columns
from matchloom.operators.reshape import expand_groups, set_union, side_split
from matchloom.operators.splits import two_name_split
from matchloom.plans.checks import check, table
from matchloom.plans.checks.rows import alias_table, customers_with_nation


def order_lines(spark, sf, name=F.col):
    """Distinct (order, supplier) with both parties' nations, names and balances; `name` turns names into another form."""
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey").distinct()
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    rows = lines.join(orders, "o_orderkey")
    customers = table(spark, sf, "customer").withColumn("c_name", name("c_name"))
    suppliers = table(spark, sf, "supplier").withColumn("s_name", name("s_name"))
    rows = J.lookup_join(
        rows, customers, {"o_custkey": "c_custkey"},
        {"c_name": "customer", "c_nationkey": "home_nation_id", "c_acctbal": "home_acctbal"},
    )
    return J.lookup_join(
        rows, suppliers, {"l_suppkey": "s_suppkey"},
        {"s_name": "supplier", "s_nationkey": "away_nation_id", "s_acctbal": "away_acctbal"},
    )


def match_lines(spark, sf):
    """`order_lines` with the nation of the customer as home and of the supplier as away side."""
    return J.role_join(
        order_lines(spark, sf), table(spark, sf, "nation"), "n_nationkey",
        {"home_nation_id": {"n_name": "home_team"}, "away_nation_id": {"n_name": "away_team"}},
    )


LINES = """
    WITH lines AS (
      SELECT o_orderkey, l_suppkey, o_custkey, o_orderstatus, o_orderdate,
             c_name AS customer, c_nationkey AS home_nation_id, c_acctbal AS home_acctbal,
             s_name AS supplier, s_nationkey AS away_nation_id, s_acctbal AS away_acctbal,
             h.n_name AS home_team, a.n_name AS away_team
      FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)
      JOIN orders ON o_orderkey = l_orderkey
      LEFT JOIN customer ON c_custkey = o_custkey
      LEFT JOIN supplier ON s_suppkey = l_suppkey
      LEFT JOIN nation h ON h.n_nationkey = c_nationkey
      LEFT JOIN nation a ON a.n_nationkey = s_nationkey
    )
"""


@check(
    "role_join",
    LINES + "SELECT o_orderkey, l_suppkey, home_nation_id, away_nation_id, home_team, away_team FROM lines",
)
def role_join(spark, sf):
    rows = match_lines(spark, sf).select(
        "home_team", "away_team", "o_orderkey", "l_suppkey", "home_nation_id", "away_nation_id"
    )
    return front_columns(rows, ["o_orderkey", "l_suppkey", "home_nation_id", "away_nation_id"])


@check(
    "side_split",
    LINES
    + """
    SELECT o_orderkey, 'CUSTOMER' AS side, customer AS party, home_nation_id AS nation_id, home_acctbal AS acctbal
    FROM lines WHERE customer IS NOT NULL
    UNION ALL
    SELECT o_orderkey, 'SUPPLIER', supplier, away_nation_id, away_acctbal FROM lines WHERE supplier IS NOT NULL
    """,
)
def sides(spark, sf):
    columns = lambda party, place: {
        "party": F.col(party), "nation_id": F.col(f"{place}_nation_id"), "acctbal": F.col(f"{place}_acctbal"),
    }
    return side_split(
        order_lines(spark, sf),
        {"CUSTOMER": columns("customer", "home"), "SUPPLIER": columns("supplier", "away")},
        "party",
        [F.col("o_orderkey")],
    )


@check(
    "lookup_join",
    "SELECT o_orderkey, o_custkey, c_name, c_mktsegment AS segment FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
)
def lookup_join(spark, sf):
    """The customers of the orders; every customer is spread over 16 parts, since one may hold most orders."""
    return J.lookup_join(
        table(spark, sf, "orders").select("o_orderkey", "o_custkey"),
        table(spark, sf, "customer"),
        {"o_custkey": "c_custkey"},
        {"c_name": "c_name", "c_mktsegment": "segment"},
        spread=(16, ["o_orderkey"]),
    )


@check(
    "m2o_join",
    """
    SELECT l_orderkey, n_lines, quantity, o_custkey, o_orderdate FROM (
      SELECT l_orderkey, count(*) AS n_lines, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY 1
    ) LEFT JOIN orders ON o_orderkey = l_orderkey
    """,
)
def m2o_join(spark, sf):
    totals = (
        table(spark, sf, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").cast("bigint").alias("quantity"))
    )
    return J.lookup_join(
        totals, table(spark, sf, "orders"), {"l_orderkey": "o_orderkey"}, ["o_custkey", "o_orderdate"], many_to_one=True
    )


@check(
    "map_lookup",
    """
    SELECT o_orderkey, o_orderpriority,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'TEAM-U' WHEN '2-HIGH' THEN 'TEAM-H' WHEN '5-LOW' THEN 'TEAM-L' END
             AS team_id
    FROM orders
    """,
)
def map_lookup(spark, sf):
    teams = {"1-URGENT": "TEAM-U", "2-HIGH": "TEAM-H", "5-LOW": "TEAM-L", "6-NONE": "TEAM-N"}
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", J.map_lookup("o_orderpriority", teams).alias("team_id")
    )


@check(
    "unmatched_keys",
    """
    SELECT DISTINCT o_custkey AS party_id FROM orders WHERE o_custkey NOT IN (SELECT l_suppkey FROM lineitem)
    """,
)
def unmatched_keys(spark, sf):
    """Customers with orders whose number no supplier of an order line has."""
    parties = lambda name, key: table(spark, sf, name).select(F.col(key).alias("party_id"))
    return J.unmatched_keys(parties("orders", "o_custkey"), parties("lineitem", "l_suppkey"), ["party_id"])


@check(
    "canonical_names",
    """
    SELECT c_custkey, CASE n_name WHEN 'NATION_3' THEN 'NATION_2' WHEN 'N2' THEN 'NATION_2'
                                  WHEN 'NATION_8' THEN 'NATION_9' ELSE n_name END AS team
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    """,
)
def canonical(spark, sf):
    return canonical_names(customers_with_nation(spark, sf).select("c_custkey", "team"), "team", alias_table(spark))


@check(
    "alias_sets",
    """
    WITH aliases(canonical, alias) AS (
      VALUES ('NATION_2', 'NATION_3'), ('NATION_2', 'N2'), ('NATION_7', 'NATION_8'), ('NATION_9', 'NATION_8')
    ), names AS (SELECT DISTINCT n_name AS team FROM customer JOIN nation ON c_nationkey = n_nationkey),
    one AS (SELECT alias, max(canonical) AS canonical FROM aliases GROUP BY 1)
    SELECT team,
           (SELECT string_agg(x, '|' ORDER BY x) FROM (
              SELECT team AS x UNION SELECT alias FROM aliases WHERE canonical = team)) AS alias_names,
           (SELECT string_agg(x, '|' ORDER BY x) FROM (
              SELECT team AS x UNION SELECT canonical FROM one WHERE alias = team)) AS standard_names
    FROM names
    """,
)
def sets_of_names(spark, sf):
    found = alias_sets(customers_with_nation(spark, sf), "team", alias_table(spark))
    return found.withColumns({c: F.array_join(c, "|") for c in ("alias_names", "standard_names")})


@check(
    "override_merge",
    """
    SELECT coalesce(s_suppkey, c_custkey) AS party_id,
           CASE WHEN s_suppkey IS NOT NULL THEN s_name ELSE c_name END AS name,
           CASE WHEN s_suppkey IS NOT NULL THEN s_acctbal ELSE c_acctbal END AS acctbal
    FROM customer FULL JOIN supplier ON s_suppkey = c_custkey
    """,
)
def override_merge(spark, sf):
    named = lambda df, p, key: df.select(
        F.col(key).alias("party_id"), F.col(f"{p}_name").alias("name"), F.col(f"{p}_acctbal").alias("acctbal")
    )
    return J.override_merge(
        named(table(spark, sf, "customer"), "c", "c_custkey"),
        named(table(spark, sf, "supplier"), "s", "s_suppkey"),
        "party_id",
    )


@check(
    "reconcile_counts",
    """
    WITH a AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n_left FROM orders GROUP BY 1),
         b AS (SELECT strftime(l_shipdate, '%Y-%m') AS month, count(*) AS n_right FROM lineitem GROUP BY 1)
    SELECT month, n_left, n_right, n_left IS NOT DISTINCT FROM n_right AS agree FROM a FULL JOIN b USING (month)
    """,
)
def reconcile_counts(spark, sf):
    month = lambda name, date: table(spark, sf, name).select(F.date_format(date, "yyyy-MM").alias("month"))
    return J.reconcile_counts(month("orders", "o_orderdate"), month("lineitem", "l_shipdate"), ["month"])


@check(
    "reconcile_rows",
    """
    SELECT custkey, sum(sign)::BIGINT AS surplus FROM (
      SELECT o_custkey AS custkey, 1 AS sign FROM orders WHERE o_orderstatus = 'F'
      UNION ALL SELECT o_custkey, -1 FROM orders WHERE o_orderstatus <> 'F'
    ) GROUP BY 1 HAVING sum(sign) <> 0
    """,
)
def reconcile_rows(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderstatus", F.col("o_custkey").alias("custkey"))
    return J.frame_difference(
        orders.filter("o_orderstatus = 'F'").select("custkey"), orders.filter("o_orderstatus <> 'F'").select("custkey")
    )


@check("set_union", "SELECT c_nationkey AS nation_id FROM customer UNION SELECT s_nationkey FROM supplier")
def union_of_keys(spark, sf):
    frames = [table(spark, sf, "customer"), table(spark, sf, "supplier")]
    return set_union(frames, ["c_nationkey", "s_nationkey"], "nation_id")


@check(
    "set_difference",
    """
    SELECT l_orderkey AS order_or_part FROM lineitem EXCEPT SELECT l_partkey FROM lineitem
    """,
)
def set_difference(spark, sf):
    numbers = lambda key: table(spark, sf, "lineitem").select(F.col(key).alias("order_or_part"))
    return J.unmatched_keys(numbers("l_orderkey"), numbers("l_partkey"), ["order_or_part"])


@check(
    "expand_groups",
    """
    SELECT r_name AS region, n_name AS part, n_customers FROM (
      SELECT r_regionkey, r_name, count(*) AS n_customers
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2
    ) JOIN nation ON n_regionkey = r_regionkey
    """,
)
def expanded_groups(spark, sf):
    nations = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", F.col("n_name").alias("part"), F.col("r_name").alias("region"))
    per_region = (
        table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("_n"))
        .join(nations.select("n_nationkey", "region"), "n_nationkey")
        .groupBy("region").agg(F.sum("_n").alias("n_customers"))
    )
    return expand_groups(per_region, nations.select("region", "part"), "region", split=True)


@check(
    "two_name_split",
    """
    WITH known AS (SELECT split_part(p_name, ' ', 1) AS w FROM part UNION SELECT split_part(p_name, ' ', 2) FROM part
                   WHERE p_size > 25),
    slugs AS (
      SELECT p_partkey, CASE WHEN p_size > 40 THEN 'grand-' ELSE '' END || replace(p_name, ' ', '-') AS slug FROM part
    ),
    words AS (SELECT DISTINCT slug, string_split(slug, '-') AS w FROM slugs),
    splits AS (
      SELECT slug, i AS at_word, array_to_string(w[1:i], '-') AS left_name, array_to_string(w[i+1:len(w)], '-') AS right_name
      FROM (SELECT slug, w, unnest(range(1, len(w))) AS i FROM words)
    ),
    scored AS (
      SELECT *, CAST((left_name IN (SELECT w FROM known)) AS INTEGER)
              + CAST((right_name IN (SELECT w FROM known)) AS INTEGER) AS score FROM splits
    ),
    best AS (
      SELECT *, row_number() OVER (PARTITION BY slug ORDER BY score DESC, at_word) AS n FROM scored
    )
    SELECT p_partkey, slug, score, left_name, right_name FROM slugs JOIN best USING (slug) WHERE n = 1
    """,
)
def split_names(spark, sf):
    part = table(spark, sf, "part")
    word = lambda i: F.split("p_name", " ").getItem(i).alias("word")
    known = part.select(word(0)).union(part.filter("p_size > 25").select(word(1)))
    slug = F.concat(F.when(F.col("p_size") > 40, "grand-").otherwise(""), F.translate("p_name", " ", "-"))
    return two_name_split(part.select("p_partkey", slug.alias("slug")), "slug", known, "word")
