"""Reading, probing, loading what is new."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.operators.filters import first_seen, quarantine, top_rows
from matchloom.operators.joins import lookup_join
from matchloom.plans.checks import check, table
from matchloom.session import shared_dir
from matchloom.sources.inline import inline_table
from matchloom.sources.csv_files import read_divided
from matchloom.streaming.incremental import new_rows, start_incremental


@check(
    "probe_limit",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5",
)
def probe_limit(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return top_rows(orders, 5, [F.asc("o_orderkey")])


@check(
    "inline_dim",
    """
    SELECT c_custkey, c_mktsegment, s.short AS segment_code, s.weight AS segment_weight
    FROM customer
    LEFT JOIN (VALUES ('BUILDING', 'B', 1), ('MACHINERY', 'M', 2), ('HOUSEHOLD', 'H', 3)) AS s(segment, short, weight)
      ON c_mktsegment = s.segment
    """,
)
def inline_dim(spark, sf):
    rows = [("BUILDING", "B", 1), ("MACHINERY", "M", 2), ("HOUSEHOLD", "H", 3)]
    segments = inline_table(spark, rows, "segment string, segment_code string, segment_weight int")
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return lookup_join(customers, segments, {"c_mktsegment": "segment"}, ["segment_code", "segment_weight"])


@check("pages_scan", "SELECT page_id, url, CAST(length(html) AS BIGINT) AS n_chars FROM pages")
def pages_scan(spark, sf):
    return table(spark, sf, "pages").select("page_id", "url", F.length("html").cast("bigint").alias("n_chars"))


@check(
    "quarantine",
    "SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, '[?]page=[0-9]+')",
)
def quarantined_pages(spark, sf):
    _, bad = quarantine(table(spark, sf, "pages"), F.col("url").rlike("[?]page=[0-9]+"))
    return bad.select("page_id", "url")


def _links(spark, sf):
    from matchloom.functions.web import page_links

    return table(spark, sf, "pages").select("page_id", F.posexplode(page_links("html")).alias("pos", "href"))


_LINKS = r"""
    WITH found AS (
      SELECT page_id, regexp_extract_all(html, '(?i)<a\s[^>]*?href="([^"]+)"', 1) AS hrefs FROM pages
    ), links AS (
      SELECT page_id, CAST(unnest(range(0, len(hrefs))) AS INTEGER) AS pos, unnest(hrefs) AS href FROM found
    )
"""


@check(
    "first_seen",
    _LINKS
    + """
    SELECT href, page_id, pos FROM (
      SELECT *, row_number() OVER (PARTITION BY href ORDER BY page_id, pos) AS n FROM links
    ) WHERE n = 1
    """,
)
def first_seen_links(spark, sf):
    return first_seen(_links(spark, sf), ["href"], ["page_id", "pos"])


@check(
    "new_urls",
    _LINKS
    + """
    , firsts AS (
      SELECT href, min(page_id) AS page_id FROM links GROUP BY href
    )
    SELECT href, page_id FROM firsts
    WHERE href NOT IN (SELECT regexp_extract(url, '^https?://[^/]+(/[^/?#]+)', 1) FROM pages)
    """,
)
def new_urls(spark, sf):
    candidates = first_seen(_links(spark, sf).select("href", "page_id"), ["href"], ["page_id"])
    done = table(spark, sf, "pages").select(F.regexp_extract("url", "^https?://[^/]+(/[^/?#]+)", 1).alias("href"))
    return new_rows(candidates, done, "href")


@check("stream_incremental", "SELECT DISTINCT event_id, user_id, event_type, value FROM events")
def stream_incremental(spark, sf):
    """Runs the stream twice with separate progress; the second run meets only known events."""
    folder = shared_dir(spark, "stream")
    columns = ["event_id", "user_id", "event_type", "value"]
    source = table(spark, sf, "events").select(*columns)
    for run in (1, 2):
        stream = spark.readStream.schema(source.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
        query = start_incremental(
            stream.select(*columns), f"{folder}/events", f"{folder}/progress-{run}", "event_id", ["user_id"]
        )
        query.awaitTermination()
    return spark.read.schema(source.schema).parquet(f"{folder}/events")


@check("csv_line_breaks", "SELECT doc_id, NULLIF(lang, '') AS lang, NULLIF(text, '') AS text FROM documents")
def csv_line_breaks(spark, sf):
    """Documents written as CSV with their line breaks, and read back by blocks."""
    path = f"{shared_dir(spark, 'csv')}/documents"
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    plain = {"header": True, "escape": '"', "quoteAll": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    docs.write.options(**plain).csv(path)
    return read_divided(spark, path, docs.schema)
