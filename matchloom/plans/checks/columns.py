"""Choosing, naming and aligning columns."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.operators import columns as C
from matchloom.operators.joins import merge_same_grain
from matchloom.plans.checks import check, table


@check("front_columns", "SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders")
def front_columns(spark, sf):
    return C.front_columns(table(spark, sf, "orders"), ["o_custkey", "o_orderkey"], drop=["o_orderpriority"])


@check("select_existing", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def select_existing(spark, sf):
    return C.select_existing(
        table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_remark", "l_quantity"]
    )


@check(
    "rename_synonyms",
    'SELECT c_custkey, c_name AS "Player", c_nationkey AS "Nation", c_acctbal, c_mktsegment AS "Pos" FROM customer',
)
def rename_synonyms(spark, sf):
    names = {"c_name": "Player", "c_nationkey": "Nation", "c_mktsegment": "Pos", "c_position": "Pos"}
    return C.rename_synonyms(table(spark, sf, "customer"), names)


@check(
    "drop_columns",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag,
           l_linestatus, l_shipdate
    FROM lineitem
    """,
)
def drop_columns(spark, sf):
    return C.drop_columns(table(spark, sf, "lineitem"), ["l_tax", "l_discount", "l_comment"])


@check("drop_by_suffix", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders")
def drop_by_suffix(spark, sf):
    return C.drop_by_suffix(table(spark, sf, "orders"), "priority")


@check("drop_empty_columns", "SELECT * FROM orders")
def drop_empty_columns(spark, sf):
    orders = table(spark, sf, "orders").withColumns(
        {"o_note": F.lit(None).cast("string"), "o_gap": F.lit(" "), "o_rank": F.lit(None).cast("bigint")}
    )
    return C.drop_empty_columns(orders)


@check(
    "standardize_colnames",
    'SELECT event_id, ts, user_id, event_type, value, props AS "propsText" FROM events',
)
def standardize_colnames(spark, sf):
    events = table(spark, sf, "events").toDF("Event Id", "TS", "userId", "EventType", "Value", "propsText")
    return C.standardize_columns(events, ["Event Id", "TS", "userId", "EventType", "Value"])


@check(
    "align_schema",
    """
    SELECT s_suppkey AS c_custkey, s_name AS c_name, CAST(NULL AS INTEGER) AS c_nationkey,
           s_acctbal AS c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment
    FROM supplier
    """,
)
def align_schema(spark, sf):
    supplier = table(spark, sf, "supplier").withColumnsRenamed(
        {"s_suppkey": "c_custkey", "s_name": "c_name", "s_acctbal": "c_acctbal"}
    )
    return C.align_to_schema(supplier, table(spark, sf, "customer").schema)


@check(
    "union_missing",
    """
    SELECT c_custkey AS party_id, c_name AS name, c_acctbal AS acctbal, c_mktsegment AS segment,
           CAST(NULL AS INTEGER) AS nation
    FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, s_acctbal, NULL, s_nationkey FROM supplier
    """,
)
def union_missing(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("party_id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("acctbal"),
        F.col("s_suppkey").alias("party_id"), F.col("s_name").alias("name"),
    )
    return C.union_sorted([customers, suppliers], ["party_id"])


@check(
    "keeper_merge",
    """
    WITH basic AS (
      SELECT l_orderkey, l_partkey, l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS quantity, count(*) AS n_lines
      FROM lineitem GROUP BY ALL
    ), adv AS (
      SELECT l_orderkey, l_partkey, l_suppkey, max(l_discount) AS adv_discount, max(l_tax) AS adv_tax
      FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL
    )
    SELECT b.*, a.adv_discount, a.adv_tax, 'order lines' AS lineage
    FROM basic b LEFT JOIN adv a USING (l_orderkey, l_partkey, l_suppkey)
    """,
)
def keeper_merge(spark, sf):
    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    lines = table(spark, sf, "lineitem")
    basic = lines.groupBy(*keys).agg(
        F.sum("l_quantity").cast("bigint").alias("quantity"), F.count(F.lit(1)).alias("n_lines")
    )
    advanced = (
        lines.filter("l_returnflag = 'R'")
        .groupBy(*keys)
        .agg(F.max("l_discount").alias("discount"), F.max("l_tax").alias("tax"))
    )
    return C.with_constants(merge_same_grain(basic, advanced, keys, "adv_"), {"lineage": "order lines"})
