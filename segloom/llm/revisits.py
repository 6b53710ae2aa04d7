"""Resolution of not-modified revisit records.

A revisit carries no body: it is joined, by canonical URL, to the latest earlier full response, its validators are checked
against that response, and the stored headers are updated with those that a 304 may change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segloom.llm.common import cut

# Header fields that a 304 response may carry to update a stored response (RFC 9110, section 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
# Query parameters that do not select content.
TRACKING = r"^(utm_[a-z]+|gclid|fbclid)="


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host, no default port, fragment, tracking parameter or last slash; parameters sorted."""
    plain = F.regexp_replace(url, r"#.*$", "")
    path = F.regexp_replace(plain, r"\?.*$", "")
    head = F.regexp_extract(path, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)", 1)
    host = F.regexp_replace(F.regexp_replace(F.lower(head), r"^(http://.*):80$", "$1"), r"^(https://.*):443$", "$1")
    rest = F.regexp_replace(F.substring(path, F.length(head) + 1, F.length(path)), r"/+$", "")
    query = F.regexp_extract(plain, r"\?(.*)$", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.concat(host, rest, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def header_text(headers: Column) -> Column:
    """Headers as name=value lines joined by semicolons, by name."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")


def merged(stored: Column, update: Column) -> Column:
    """Stored headers with the permitted ones of the update in their place."""
    new = F.map_filter(update, lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.array_contains(F.map_keys(new), k)), new)


def resolve(records: DataFrame, span: int = 4096) -> DataFrame:
    """Every record with what it resolves to.

    records: record_id long, url string, ts long, kind string (response or revisit), etag string, last_modified string, headers
    map<string,string>, names in lower case; other columns are kept. Adds canonical_url, response_id (of the latest response of
    that URL at or before ts; a response before a revisit of the same ts, then the larger record_id), outcome and merged_headers.
    outcome: response for a response; for a revisit resolved, no_response (nothing earlier), or mismatch (an ETag that differs by weak
    comparison, or, without ETags on both sides, a Last-Modified that differs); no_validator if no validator stands on both sides. merged_headers
    is null unless resolved. A null url is matched with nothing. A null ts stands before all others.

    A hot URL is split: the time line is cut in spans of `span` units, each (URL, span) looks for its response inside, and what
    it lacks comes from the last response of an earlier span, of which there is one row for each span at most.
    """
    extra = [c for c in records.columns if c not in ("canonical_url", "response_id", "outcome", "merged_headers")]
    rows = records.select(*extra).withColumn("canonical_url", canonical_url(F.col("url"))).withColumn("_at", F.coalesce(F.col("ts"), F.lit(-(2**62))))
    rows = rows.withColumn("_span", F.floor(F.col("_at") / F.lit(span))).withColumn("_order", F.when(F.col("kind") == "response", 0).otherwise(1))
    found = F.when((F.col("kind") == "response") & F.col("url").isNotNull(), F.struct(F.col("_at").alias("at"), "record_id", "etag", "last_modified", "headers"))
    order = [F.col("_at"), F.col("_order"), F.col("record_id").asc_nulls_first()]
    inside = Window.partitionBy("canonical_url", "_span").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    near = rows.withColumn("_in", F.last(found, ignorenulls=True).over(inside))
    ends = rows.where((F.col("kind") == "response") & F.col("url").isNotNull()).groupBy("canonical_url", "_span").agg(F.max(F.struct(F.col("_at").alias("at"), F.coalesce("record_id", F.lit(-(2**62))).alias("tie"), F.struct(F.col("_at").alias("at"), "record_id", "etag", "last_modified", F.map_entries("headers").alias("headers")).alias("r"))).alias("m"))
    carried = Window.partitionBy("canonical_url").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    wanted = rows.select("canonical_url", "_span").where("canonical_url is not null").distinct()
    r = F.col("m.r")
    back = F.when(F.col("m").isNotNull(), F.struct(r["at"].alias("at"), r["record_id"].alias("record_id"), r["etag"].alias("etag"), r["last_modified"].alias("last_modified"), F.map_from_entries(r["headers"]).alias("headers")))
    carry = wanted.join(ends, ["canonical_url", "_span"], "left").withColumn("_before", F.last(back, ignorenulls=True).over(carried)).drop("m")
    out = near.join(carry, ["canonical_url", "_span"], "left").withColumn("_r", F.coalesce("_in", "_before"))
    opaque = lambda c: F.regexp_replace(c, "^W/", "")  # noqa: E731  # weak comparison looks at the opaque part alone (RFC 9110, 8.8.3.2)
    tags, dates = F.col("etag").isNotNull() & F.col("_r.etag").isNotNull(), F.col("last_modified").isNotNull() & F.col("_r.last_modified").isNotNull()
    outcome = (
        F.when(F.col("kind") == "response", "response")
        .when(F.col("_r").isNull(), "no_response")
        .when(tags, F.when(opaque("etag") == opaque("_r.etag"), "resolved").otherwise("mismatch"))
        .when(dates, F.when(F.col("last_modified") == F.col("_r.last_modified"), "resolved").otherwise("mismatch"))
        .otherwise("no_validator")
    )
    none = F.create_map().cast("map<string,string>")
    out = out.withColumn("outcome", outcome).withColumn("response_id", F.when(F.col("url").isNotNull(), F.col("_r.record_id")))
    out = out.withColumn("merged_headers", F.when(F.col("outcome") == "resolved", merged(F.coalesce("_r.headers", none), F.coalesce("headers", none))))
    return out.select(*extra, "canonical_url", "response_id", "outcome", "merged_headers")


def records_of(pages: DataFrame, delay: int = 10_000) -> DataFrame:
    """Crawl records of a page table: each page is a full response at 2 * page_id, and `delay` pages later its URL is asked for
    again with that response's ETag and answered 304 by a revisit record. Record ids: 2 * page_id, and one more for the revisit.

    A page captured anew between the two makes the revisit a mismatch, as its validator is that of the older body.
    """
    tag = F.md5(F.coalesce("html", F.lit("")))
    common = [F.col("url"), tag.alias("etag"), F.lit(None).cast("string").alias("last_modified"), F.sha2(F.coalesce("html", F.lit("")), 256).alias("body")]
    at = F.col("page_id") * 2
    stored = F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("content-length"), F.octet_length(F.coalesce("html", F.lit(""))).cast("string"), F.lit("etag"), tag, F.lit("date"), F.coalesce(at.cast("string"), F.lit("")))
    fresh = F.create_map(F.lit("etag"), tag, F.lit("date"), F.coalesce((at + 2 * delay + 1).cast("string"), F.lit("")), F.lit("cache-control"), F.lit("max-age=60"), F.lit("set-cookie"), F.lit("a=b"))
    responses = pages.select(at.alias("record_id"), at.alias("ts"), F.lit("response").alias("kind"), *common, stored.alias("headers"))
    revisits = pages.select((at + 1).alias("record_id"), (at + 2 * delay + 1).alias("ts"), F.lit("revisit").alias("kind"), *common, fresh.alias("headers"))
    return responses.unionByName(revisits)


def op3(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    out = resolve(cut(records_of(pages), "records"))
    return out.select("record_id", "kind", "canonical_url", "response_id", "outcome", header_text(F.col("merged_headers")).alias("headers"), F.when(F.col("kind") == "response", F.col("body")).alias("body"))


#: The same rows by one window over each whole URL.
OP3_SQL = r"""
WITH u AS (SELECT page_id, url, md5(coalesce(html, '')) AS tag, sha256(coalesce(html, '')) AS body, strlen(coalesce(html, '')) AS n,
                  regexp_replace(url, '#.*$', '') AS plain FROM pages),
v AS (SELECT *, regexp_replace(plain, '\?.*$', '') AS path, regexp_extract(plain, '\?(.*)$', 1) AS query FROM u),
w AS (SELECT *, regexp_extract(path, '^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)', 1) AS head,
             array_to_string(list_sort(list_filter(string_split(query, '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|gclid|fbclid)='))), '&') AS kept FROM v),
c AS (SELECT page_id, tag, body, n, regexp_replace(regexp_replace(lower(head), '^(http://.*):80$', '\1'), '^(https://.*):443$', '\1')
             || regexp_replace(substr(path, length(head) + 1), '/+$', '') || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END AS canonical_url FROM w),
r AS (SELECT 2 * page_id AS record_id, 2 * page_id AS ts, 'response' AS kind, * FROM c
      UNION ALL SELECT 2 * page_id + 1, 2 * page_id + 20001, 'revisit', * FROM c),
f AS (SELECT *, CASE WHEN canonical_url IS NOT NULL THEN last_value(CASE WHEN kind = 'response' THEN {'id': record_id, 'tag': tag, 'n': n, 'ts': ts} END IGNORE NULLS)
             OVER (PARTITION BY canonical_url ORDER BY ts, kind, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS m FROM r),
g AS (SELECT *, CASE WHEN kind = 'response' THEN 'response' WHEN m IS NULL THEN 'no_response' WHEN tag = m.tag THEN 'resolved' ELSE 'mismatch' END AS outcome FROM f)
SELECT record_id, kind, canonical_url, m.id AS response_id, outcome,
       CASE WHEN outcome = 'resolved' THEN 'cache-control=max-age=60;content-length=' || m.n || ';content-type=text/html;date=' || ts || ';etag=' || tag END AS headers,
       CASE WHEN kind = 'response' THEN body END AS body FROM g
"""
