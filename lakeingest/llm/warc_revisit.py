"""Not-modified revisits of web archives resolved by an as-of join.

A crawler that gets ``304 Not Modified`` stores a revisit record without a body. Each revisit is resolved to the latest
earlier full response of the same canonical URL:

- *canonical URL*: host in lower case without ``www.`` or ``m.``, path, and query without ``utm_`` parameters; scheme,
  fragment and a trailing slash are dropped;
- *earlier*: strictly smaller capture time; of responses at the same time the one with the larger record_id counts;
- *validators*: an ETag sent by the revisit must equal the response's (weak tags ``W/`` compare by value); without an
  ETag, Last-Modified must be equal; a revisit without validators takes the response as it is;
- *headers*: the response's headers, in which only the fields that a 304 may update (``PERMITTED``) are replaced by the
  revisit's.

Outcomes: ``resolved``, ``mismatch`` (validators differ; the response is named, its body and headers are not used) and
``no_response``. Every revisit has one row; nothing is searched beyond the latest response.

The as-of join works on narrow rows in two levels: inside (URL, day) by a running maximum over time, and over the days
of a URL for what carries over, so a URL with a third of all captures is split by day. Bodies join afterwards by
record_id. A null URL is a key of its own that resolves nothing; rows without capture time or record_id take no part as
responses, and stay unresolved as revisits. Repeated rows resolve alike. An empty table has an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Header fields that a 304 response may carry to update a stored response (fixed by the HTTP standard).
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
DAY = 86400


def canonical_url(url: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, "^[^/?]*", 0)), r"^(www|m)\.", "")
    rest = F.regexp_replace(bare, "^[^/?]*", "")
    path = F.regexp_replace(F.regexp_replace(rest, r"\?.*$", ""), "/$", "")
    query = F.regexp_replace(F.regexp_replace(F.regexp_extract(rest, r"\?(.*)$", 1), "(^|&)utm_[^&]*", ""), "^&", "")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def lower_keys(headers: Column) -> Column:
    """Header names in lower case; of names that then collide, the last one counts."""
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda x: x["key"] == e["key"]))
    return F.map_from_entries(last)


def _tag(headers: Column) -> Column:
    return F.regexp_replace(headers["etag"], "^W/", "")


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """One row per revisit: record_id, url_key, captured_at, outcome, resolved_id, resolved_at, headers, body.

    ``captures``: record_id long, url string, captured_at long (seconds), is_revisit boolean, headers map<string,string>,
    body string (null in revisits).
    """
    rows = captures.select("record_id", canonical_url(F.col("url")).alias("url_key"),
                           F.col("captured_at").cast("long").alias("captured_at"),
                           F.coalesce("is_revisit", F.lit(False)).alias("is_revisit"), "headers", "body")
    # narrow rows: no headers, no bodies
    full = ~F.col("is_revisit") & F.col("record_id").isNotNull() & F.col("captured_at").isNotNull() & \
        F.col("url_key").isNotNull()
    narrow = rows.select("record_id", "url_key", "captured_at", "is_revisit",
                         F.floor(F.col("captured_at") / DAY).alias("day"),
                         F.when(full, F.struct("captured_at", "record_id")).alias("response"))
    before = Window.partitionBy("url_key", "day").orderBy("captured_at").rangeBetween(Window.unboundedPreceding, -1)
    inside = narrow.withColumn("near", F.max("response").over(before)).filter("is_revisit")
    by_day = narrow.groupBy("url_key", "day").agg(F.max("response").alias("last"))
    earlier = Window.partitionBy("url_key").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    carried = by_day.withColumn("carried", F.max("last").over(earlier)).select("url_key", "day", "carried")
    found = inside.join(carried, ["url_key", "day"], "left").select(
        "record_id", "url_key", "captured_at", F.coalesce("near", "carried").alias("hit"))
    found = found.select("record_id", "url_key", "captured_at", F.col("hit.record_id").alias("resolved_id"),
                         F.col("hit.captured_at").alias("resolved_at"))

    # rows without record_id cannot be joined to their headers: they stay unresolved
    sent = rows.filter("is_revisit AND record_id IS NOT NULL").select(
        "record_id", "url_key", "captured_at", lower_keys(F.coalesce("headers", F.create_map().cast("map<string,string>")))
        .alias("sent")).dropDuplicates(["record_id", "url_key", "captured_at"])
    stored = rows.filter("NOT is_revisit AND record_id IS NOT NULL").select(
        F.col("record_id").alias("resolved_id"), F.col("url_key").alias("of_url"), F.col("captured_at").alias("resolved_at"),
        lower_keys(F.coalesce("headers", F.create_map().cast("map<string,string>"))).alias("stored"), "body") \
        .dropDuplicates(["resolved_id", "of_url", "resolved_at"])
    same = (F.col("a.record_id") == F.col("b.record_id")) & F.col("a.url_key").eqNullSafe(F.col("b.url_key")) & \
        F.col("a.captured_at").eqNullSafe(F.col("b.captured_at"))
    both = found.alias("a").join(sent.alias("b"), same, "left").select("a.*", "b.sent")
    both = both.alias("x").join(stored.alias("y"), (F.col("x.resolved_id") == F.col("y.resolved_id")) & (
        F.col("x.url_key") == F.col("y.of_url")) & (F.col("x.resolved_at") == F.col("y.resolved_at")), "left").select(
        "x.*", "y.stored", "y.body")
    matches = F.when(F.col("sent")["etag"].isNotNull(), _tag(F.col("sent")) == _tag(F.col("stored"))).when(
        F.col("sent")["last-modified"].isNotNull(), F.col("sent")["last-modified"] == F.col("stored")["last-modified"]
    ).otherwise(F.lit(True))
    outcome = F.when(F.col("stored").isNull(), "no_response").when(F.coalesce(matches, F.lit(False)), "resolved").otherwise(
        "mismatch")
    fresh = F.map_filter("sent", lambda k, v: k.isin(PERMITTED))
    merged = F.map_concat(F.map_filter("stored", lambda k, v: ~F.map_contains_key(fresh, k)), fresh)
    return both.withColumn("outcome", outcome).select(
        "record_id", "url_key", "captured_at", "outcome", "resolved_id", "resolved_at",
        F.when(F.col("outcome") == "resolved", merged).alias("headers"),
        F.when(F.col("outcome") == "resolved", F.col("body")).alias("body"))


def captures_of(pages: DataFrame) -> DataFrame:
    """An archive made from a table of pages, for the registered query: each page is a full response at hour page_id,
    and two later visits of its URL are revisits. Of these the first sends the ETag of the page (or, for every seventh
    page, that of another version), the second only Last-Modified."""
    page = pages.filter("page_id IS NOT NULL").select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    tag = F.md5(F.coalesce("html", F.lit("")).cast("binary"))
    modified = (F.col("page_id") % 1000).cast("string")
    response = page.select(
        (F.col("page_id") * 3).alias("record_id"), "url", (F.col("page_id") * 3600).alias("captured_at"),
        F.lit(False).alias("is_revisit"),
        F.create_map(F.lit("ETag"), tag, F.lit("Last-Modified"), modified, F.lit("Content-Type"), F.lit("text/html"),
                     F.lit("Date"), (F.col("page_id") * 3600).cast("string")).alias("headers"),
        F.col("html").alias("body"))

    def revisit(nth: int, delay: int, headers: Column) -> DataFrame:
        at = F.col("page_id") * 3600 + delay
        return page.select((F.col("page_id") * 3 + nth).alias("record_id"), "url", at.alias("captured_at"),
                           F.lit(True).alias("is_revisit"), headers.alias("headers"), F.lit(None).cast("string").alias("body"))
    sent = F.when(F.col("page_id") % 7 == 0, F.md5(F.concat(tag, F.lit("x")).cast("binary"))).otherwise(tag)
    first = revisit(1, 1800, F.create_map(F.lit("etag"), sent, F.lit("Content-Type"), F.lit("text/plain"), F.lit("date"),
                                          (F.col("page_id") * 3600 + 1800).cast("string")))
    second = revisit(2, 90000, F.create_map(F.lit("LAST-MODIFIED"), modified, F.lit("Cache-Control"), F.lit("max-age=60")))
    return response.unionByName(first).unionByName(second)


ORACLE = r"""
WITH p AS (SELECT page_id, url, html, md5(coalesce(html, '')) AS tag, CAST(page_id % 1000 AS VARCHAR) AS modified
           FROM pages WHERE page_id IS NOT NULL),
k AS (SELECT *, regexp_replace(regexp_replace(url, '#.*$', ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://', '') AS bare FROM p),
h AS (SELECT *, regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), '^(www|m)\.', '') AS host,
             regexp_replace(bare, '^[^/?]*', '') AS rest FROM k),
u AS (SELECT *, regexp_replace(regexp_replace(regexp_extract(rest, '\?(.*)$', 1), '(^|&)utm_[^&]*', '', 'g'), '^&', '') AS qs
      FROM h),
c AS (SELECT *, host || regexp_replace(regexp_replace(rest, '\?.*$', ''), '/$', '')
             || CASE WHEN qs <> '' THEN '?' || qs ELSE '' END AS url_key FROM u),
r AS (SELECT url_key, page_id * 3600 AS resolved_at, max(page_id * 3) AS resolved_id FROM c GROUP BY ALL),
v AS (SELECT page_id * 3 + 1 AS record_id, url_key, page_id * 3600 + 1800 AS captured_at,
             CASE WHEN page_id % 7 = 0 THEN md5(tag || 'x') ELSE tag END AS etag, NULL AS modified,
             CAST(page_id * 3600 + 1800 AS VARCHAR) AS sent_date FROM c
      UNION ALL
      SELECT page_id * 3 + 2, url_key, page_id * 3600 + 90000, NULL, modified, NULL FROM c),
m AS (SELECT v.*, r.resolved_id, r.resolved_at FROM v ASOF LEFT JOIN r
      ON v.url_key = r.url_key AND v.captured_at > r.resolved_at),
o AS (SELECT m.*, s.html, s.page_id,
             CASE WHEN s.page_id IS NULL THEN 'no_response'
                  WHEN CASE WHEN m.etag IS NOT NULL THEN m.etag = s.tag ELSE m.modified = s.modified END THEN 'resolved'
                  ELSE 'mismatch' END AS outcome
      FROM m LEFT JOIN c AS s ON m.resolved_id = s.page_id * 3)
SELECT record_id, url_key, CAST(captured_at AS BIGINT) AS captured_at, outcome, CAST(resolved_id AS BIGINT) AS resolved_id,
       CAST(resolved_at AS BIGINT) AS resolved_at,
       CASE WHEN outcome = 'resolved' THEN 'text/html' END AS content_type,
       CASE WHEN outcome = 'resolved' THEN coalesce(sent_date, CAST(resolved_at AS VARCHAR)) END AS date_header,
       CASE WHEN outcome = 'resolved' AND etag IS NULL THEN 'max-age=60' END AS cache_control,
       CASE WHEN outcome = 'resolved' THEN CAST(length(html) AS BIGINT) END AS body_chars,
       CASE WHEN outcome = 'resolved' THEN md5(html) END AS body_md5
FROM o"""
