"""Ordered rows: series, records, ratings."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.operators import ratings as V
from matchloom.operators import series as W
from matchloom.operators.reshape import series_to_columns
from matchloom.operators.filters import top_rows
from matchloom.plans.checks import check, table
from matchloom.session import store
from matchloom.sources.inline import inline_table


def by_user():
    return W.Series(["user_id"], ["ts"], [W.time_bucket("ts")])


def by_type():
    """There are few event types, so each of them is large."""
    return W.Series(["event_type"], ["ts", "event_id"], [W.time_bucket("ts")], rows_per_task=1_000)


@check(
    "rolling_mean",
    """
    SELECT event_id,
           round(CASE WHEN count(value) OVER u = 10 THEN avg(value) OVER u END, 6) AS mean_user,
           round(CASE WHEN count(value) OVER t = 100 THEN avg(value) OVER t END, 6) AS mean_type
    FROM events
    WINDOW u AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 9 PRECEDING AND CURRENT ROW),
           t AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)
    """,
)
def rolling_mean(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts", "value")
    means = W.rolling_mean(events, by_user(), "value", 10, "mean_user")
    means = W.rolling_mean(means, by_type(), "value", 100, "mean_type", source=events)
    return means.select("event_id", F.round("mean_user", 6).alias("mean_user"), F.round("mean_type", 6).alias("mean_type"))


@check(
    "forward_fill",
    """
    SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
             OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_purchase
    FROM events
    """,
)
def forward_fill(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts", "value")
    purchase = F.when(F.col("event_type") == "purchase", F.col("value"))
    return W.fill_forward(events, by_user(), {"last_purchase": purchase}).select("event_id", "last_purchase")


@check(
    "fill_down_keys",
    """
    SELECT o_orderkey,
           CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1 THEN o_custkey END AS printed_key,
           o_custkey AS restored_key
    FROM orders
    """,
)
def fill_down_keys(spark, sf):
    """Prints each customer's key on its first row only, in blocks of numbered rows, and restores it from there."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey").withColumn("block", F.floor(F.col("o_custkey") / 100))
    ranges = [F.col("o_custkey"), W.number_bucket("o_orderkey", 1_000_000)]
    numbered = W.row_numbers(orders, W.Series(["block"], ["o_custkey", "o_orderkey"], ranges), "row_no")
    firsts = orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("first_order"))
    is_first = F.col("o_orderkey") == F.col("first_order")
    printed = numbered.join(firsts, "o_custkey").select(
        "block", "row_no", "o_orderkey", F.when(is_first, F.col("o_custkey")).alias("printed_key")
    )
    rows = W.Series(["block"], ["row_no"], [W.number_bucket("row_no", 100_000)])
    restored = W.fill_forward(store(printed, "printed"), rows, {"restored_key": F.col("printed_key")})
    return restored.select("o_orderkey", "printed_key", "restored_key")


@check(
    "label_value",
    """
    SELECT conv_id, turn, next_role, next_chars FROM (
      SELECT conv_id, turn, role, lead(role) OVER w AS next_role, CAST(lead(length(text)) OVER w AS INTEGER) AS next_chars
      FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
    ) WHERE role = 'user'
    """,
)
def label_value(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", F.length("text").alias("chars"))
    line = W.Series(["conv_id"], ["turn"], [W.number_bucket("turn", 10_000)])
    following = W.next_row(turns, line, {"next_role": F.col("role"), "next_chars": F.col("chars")})
    return following.filter("role = 'user'").select("conv_id", "turn", "next_role", "next_chars")


def _records(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts", "value")
    return W.segment_records(events, by_user(), F.col("event_type") == "signup", "record")


_RECORDS = """
    WITH records AS (
      SELECT * FROM (
        SELECT *, CAST(count(*) FILTER (WHERE event_type = 'signup') OVER (
                    PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS record
        FROM events
      ) WHERE record > 0
    )
"""


@check("segment_records", _RECORDS + "SELECT event_id, user_id, record FROM records")
def segment_records(spark, sf):
    return _records(spark, sf).select("event_id", "user_id", "record")


@check(
    "segment_fold",
    _RECORDS
    + """
    SELECT user_id, record,
           arg_max(value, ts) FILTER (WHERE event_type = 'signup') AS signup_value,
           arg_max(value, ts) FILTER (WHERE event_type = 'purchase') AS purchase_value,
           arg_max(event_id, ts) FILTER (WHERE event_type = 'error') AS last_error
    FROM records GROUP BY user_id, record
    """,
)
def segment_fold(spark, sf):
    value = F.col("value")
    wide = {
        "signup_value": ("signup", value), "purchase_value": ("purchase", value), "last_error": ("error", F.col("event_id")),
    }
    return W.fold_records(_records(spark, sf), ["user_id", "record"], "event_type", "ts", wide)


# -- ratings --------------------------------------------------------------------------------


def intervals(events):
    return V.validity_intervals(events.select("user_id", "ts", "value"), by_user(), "ts").select(
        "user_id", "from", "to", F.col("value").alias("rating")
    )


_INTERVALS = """
    WITH spans AS (
      SELECT user_id, ts AS "from", lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS "to", value AS rating
      FROM events {kept}
    )
"""


@check(
    "ratings_at_date",
    _INTERVALS.format(kept="")
    + """
    SELECT * FROM spans WHERE "from" <= TIMESTAMP '2024-01-15' AND ("to" IS NULL OR "to" > TIMESTAMP '2024-01-15')
    """,
)
def ratings_at_date(spark, sf):
    return V.ratings_at(intervals(table(spark, sf, "events")), "2024-01-15")


@check(
    "interval_join",
    _INTERVALS.format(kept="WHERE event_type = 'purchase'")
    + """
    SELECT e.event_id, e.user_id, e.ts, s."from", s."to", s.rating
    FROM events e LEFT JOIN spans s
      ON e.user_id = s.user_id AND e.ts >= s."from" AND (s."to" IS NULL OR e.ts < s."to")
    WHERE e.event_type <> 'purchase'
    """,
)
def interval_join(spark, sf):
    """Every purchase rates its user until the next one; all other events look up the rating of their time."""
    events = table(spark, sf, "events")
    others = events.filter("event_type <> 'purchase'").select("event_id", "user_id", "ts")
    spans = store(intervals(events.filter("event_type = 'purchase'")), "intervals")
    return V.interval_join(others, spans, "user_id", "ts", [W.time_bucket("_time")], ["rating"])


@check(
    "overlap_join",
    """
    WITH offers AS (
      SELECT user_id, event_id AS offer_id, ts AS "from",
             CASE WHEN event_id % 11 = 0 THEN NULL ELSE ts + to_hours(CAST(pow(2, event_id % 11) AS INT)) END AS "to"
      FROM events WHERE event_type = 'purchase'
    )
    SELECT e.event_id, e.user_id, e.ts, o."from", o."to", o.offer_id
    FROM events e LEFT JOIN offers o
      ON e.user_id = o.user_id AND e.ts >= o."from" AND (o."to" IS NULL OR e.ts < o."to")
    WHERE e.event_type <> 'purchase'
    """,
)
def overlap_join(spark, sf):
    """Every purchase opens an offer of two hours to six weeks, some without an end; all other events meet the offers of their time."""
    events = table(spark, sf, "events")
    others = events.filter("event_type <> 'purchase'").select("event_id", "user_id", "ts")
    hours = F.pow(F.lit(2), F.col("event_id") % 11).cast("int")
    end = F.when(F.col("event_id") % 11 != 0, F.col("ts") + F.make_dt_interval(hours=hours))
    offers = events.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("offer_id"), F.col("ts").alias("from"), end.alias("to"))
    return V.overlap_join(others, offers, "user_id", "ts", ["offer_id"], "left")


@check(
    "entity_history",
    """
    SELECT event_id, event_type, ts, value FROM events WHERE event_type IN ('click', 'view')
    """,
)
def entity_history(spark, sf):
    aliases = inline_table(spark, [("view", "click"), ("view", "look & feel")], "canonical string, alias string")
    events = table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    return V.entity_history(events, "event_type", "look & feel", aliases)


@check(
    "latest_snapshot",
    """
    SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus,
           date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') <= 365 AS is_fresh
    FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders
    ) WHERE n = 1
    """,
)
def latest_snapshot(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    return V.latest_snapshot(
        orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], F.to_date(F.lit("2001-08-01")), 365
    )


@check(
    "rating_rank",
    """
    SELECT c_custkey, c_nationkey, c_acctbal,
           rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC NULLS LAST) AS rating_rank
    FROM customer
    """,
)
def rating_rank(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return W.ranks(customers, ["c_nationkey"], "c_acctbal", W.number_bucket("c_acctbal", 100), "rating_rank")


@check(
    "topk_pivot",
    """
    WITH best AS (
      SELECT user_id, row_number() OVER (ORDER BY sum(CAST(value AS DECIMAL(18, 2))) DESC, user_id) AS place
      FROM events GROUP BY user_id QUALIFY place <= 5
    )
    SELECT CAST(ts AS DATE) AS day,
           CAST(round(sum(CAST(value AS DECIMAL(18, 2))) FILTER (WHERE place = 1) / count(*) FILTER (WHERE place = 1), 4) AS DOUBLE) AS place_1,
           CAST(round(sum(CAST(value AS DECIMAL(18, 2))) FILTER (WHERE place = 2) / count(*) FILTER (WHERE place = 2), 4) AS DOUBLE) AS place_2,
           CAST(round(sum(CAST(value AS DECIMAL(18, 2))) FILTER (WHERE place = 3) / count(*) FILTER (WHERE place = 3), 4) AS DOUBLE) AS place_3,
           CAST(round(sum(CAST(value AS DECIMAL(18, 2))) FILTER (WHERE place = 4) / count(*) FILTER (WHERE place = 4), 4) AS DOUBLE) AS place_4,
           CAST(round(sum(CAST(value AS DECIMAL(18, 2))) FILTER (WHERE place = 5) / count(*) FILTER (WHERE place = 5), 4) AS DOUBLE) AS place_5
    FROM events JOIN best USING (user_id) GROUP BY 1
    """,
)
def topk_pivot(spark, sf):
    events = table(spark, sf, "events").select(
        "user_id", F.col("ts").cast("date").alias("day"), F.col("value").cast("decimal(18,2)").alias("value")
    )
    totals = events.groupBy("user_id").agg(F.sum("value").alias("total"))
    best = top_rows(totals, 5, [F.desc("total"), F.asc("user_id")])
    places = best.select(
        F.posexplode(
            F.transform(
                F.array_sort(F.collect_list(F.struct((-F.col("total")).alias("t"), "user_id"))), lambda s: s["user_id"]
            )
        ).alias("at", "user_id")
    )
    named = places.select("user_id", F.concat(F.lit("place_"), (F.col("at") + 1).cast("string")).alias("place"))
    mean = F.round(F.avg("value"), 4).cast("double")
    return series_to_columns(events.join(named, "user_id"), "day", "place", mean, [f"place_{i}" for i in range(1, 6)])
