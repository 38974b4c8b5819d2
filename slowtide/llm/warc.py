"""Not-modified revisits of a crawl, resolved to the full response they stand for.

A revisit says that a page had not changed since it was last fetched. It is joined, as of its time, with the latest
strictly earlier full response of the same canonical URL; its validators must agree with that response's (entity
tags by weak comparison, else modification dates, else payload digests), and the header fields that a not-modified
answer may update are laid over the stored ones.

The as-of join sorts slim rows (no payloads) by URL and time into range slices, so a URL that holds a third of all
captures spreads over many slices; what came before a slice comes from a table of at most one row per slice.
Payloads are joined afterwards by the record the revisit was resolved to (`with_payload`).

Outcomes: `full` for a full response; `resolved`; `mismatch` (validators differ); `unvalidated` (no validator in
common; headers are not merged); `no_earlier` (no earlier full response). Edge cases: a capture without URL or time
neither resolves nor serves; at one time revisits come before responses, and of several responses the one with the
largest record id is the latest. Repeated rows each keep a row. Empty tables give empty ones. Null headers are
no headers. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slowtide.llm.common import pick
from slowtide.session import materialize

#: Fields that a 304 answer may update in the stored response.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
COLUMNS = ["record_id", "url", "captured_at", "kind", "etag", "last_modified", "digest", "headers"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical(url: Column) -> Column:
    """Scheme and host in lower case, no default port, fragment or tracking parameters; parameters sorted."""
    scheme = F.translate(F.regexp_extract(url, r"^([^:/?#]+)://", 1), UPPER, LOWER)
    host = F.translate(F.regexp_extract(url, r"^[^:/?#]+://([^/?#]*)", 1), UPPER, LOWER)
    host = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    path = F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1)
    params = F.filter(F.split(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), "&"), lambda p: (p != "") & ~p.startswith("utm_"))
    query = F.array_join(F.array_sort(params), "&")
    whole = F.concat(scheme, F.lit("://"), host, F.when(path == "", "/").otherwise(path), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
    return F.when(scheme != "", whole).otherwise(F.regexp_extract(url, "^[^#]*", 0))


def _strong(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def agreement(now: str, then: str) -> Column:
    """True or false by the first validator that both have; null if there is none."""
    a, b = (lambda c: F.col(f"{now}.{c}")), (lambda c: F.col(f"{then}.{c}"))
    return F.coalesce(_strong(a("etag")) == _strong(b("etag")), a("last_modified") == b("last_modified"), a("digest") == b("digest"))


def merged(stored: Column, update: Column) -> Column:
    """The stored fields with the permitted ones of the update laid over them."""
    none = F.create_map().cast("map<string,string>")
    stored, update = F.coalesce(stored, none), F.coalesce(update, none)
    allowed = F.map_filter(update, lambda k, _: F.lower(k).isin(PERMITTED))
    names = F.transform(F.map_keys(allowed), F.lower)
    return F.map_concat(F.map_filter(stored, lambda k, _: ~F.array_contains(names, F.lower(k))), allowed)


def resolve(captures: DataFrame) -> DataFrame:
    """record_id, url (canonical), captured_at, kind, outcome, resolved_id, digest and headers of every capture."""
    rows = pick(captures, *COLUMNS).withColumn("url", canonical(F.col("url")))
    full = F.col("kind") == "response"
    rows = rows.withColumn("full", F.coalesce(full, F.lit(False)))
    order = [F.col("captured_at"), F.col("full"), F.col("record_id").asc_nulls_first()]
    keyed = rows.filter("url is not null and captured_at is not null")
    cut = materialize(keyed.repartitionByRange("url", *order).withColumn("slice", F.spark_partition_id()), "captures")
    served = F.when(F.col("full"), F.struct("record_id", "captured_at", "etag", "last_modified", "digest", "headers"))
    inside = Window.partitionBy("slice", "url").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # the last response of each slice that a URL continues from
    ends = cut.groupBy("url", "slice").agg(F.max_by(served, F.when(F.col("full"), F.struct("captured_at", "record_id"))).alias("end"))
    earlier = Window.partitionBy("url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select("url", "slice", F.last("end", ignorenulls=True).over(earlier).alias("carried")).filter("carried is not null")
    found = cut.withColumn("stored", F.last(served, ignorenulls=True).over(inside)).join(F.broadcast(carry), ["url", "slice"], "left")
    found = found.withColumn("stored", F.coalesce("stored", "carried")).drop("slice", "carried")
    apart = rows.filter("url is null or captured_at is null").withColumn("stored", F.lit(None).cast(found.schema["stored"].dataType))
    both = found.unionByName(apart).withColumn("own", F.struct("etag", "last_modified", "digest"))
    agree = agreement("own", "stored")
    outcome = (
        F.when(F.col("full"), "full").when(F.col("stored").isNull(), "no_earlier").when(agree, "resolved").when(agree.isNull(), "unvalidated").otherwise("mismatch")
    )
    resolved = F.col("outcome") == "resolved"
    return both.withColumn("outcome", outcome).select(
        "record_id", "url", "captured_at", "kind", "outcome",
        F.when(resolved, F.col("stored.record_id")).otherwise(F.when(F.col("full"), F.col("record_id"))).alias("resolved_id"),
        F.when(resolved, F.col("stored.digest")).otherwise(F.col("digest")).alias("digest"),
        F.when(resolved, merged(F.col("stored.headers"), F.col("headers"))).otherwise(F.col("headers")).alias("headers"),
    )


def with_payload(resolved: DataFrame, payloads: DataFrame) -> DataFrame:
    """Adds the payload (record_id, payload) of the record each capture stands for, or null."""
    bodies = pick(payloads, "record_id", "payload").withColumnRenamed("record_id", "body_id")
    return resolved.join(bodies, F.col("resolved_id") == F.col("body_id"), "left").drop("body_id")


def captures_of(pages: DataFrame) -> DataFrame:
    """A crawl derived from the pages: each page, for a third of them a later revisit, and a capture of the host's
    front page with every page (a response for every seventh, else a revisit)."""
    p = pick(pages, "page_id", "url", "html").select("page_id", "url", F.md5("html").alias("body"))
    era = F.floor(F.col("page_id") / 1000).cast("string")
    text = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])
    at = F.col("page_id") * 10
    own_tag = text('"', F.substring("body", 1, 12), '"')
    home = F.concat(F.regexp_extract("url", r"^[^:/?#]+://[^/?#]*", 0), F.lit("/"))

    def record(number, url, time, kind, etag, modified, digest, headers):
        named = F.filter(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in headers.items()]), lambda e: e["value"].isNotNull())
        return F.struct(
            (F.col("page_id") * 4 + number).alias("record_id"), url.alias("url"), time.alias("captured_at"), kind.alias("kind"), etag.alias("etag"),
            modified.alias("last_modified"), digest.alias("digest"), F.map_from_entries(named).alias("headers"),
        )

    front = F.col("page_id") % 7 == 0
    front_tag = F.when(F.col("page_id") % 11 == 0, None).otherwise(text('W/"', era, '"'))
    front_date = text("day ", F.floor(F.col("page_id") / 500))
    age = text("max-age=", F.col("page_id") % 60)
    html = F.lit("text/html")
    again_tag = F.when(F.col("page_id") % 5 == 0, F.lit('"stale"')).otherwise(own_tag)
    records = [
        record(0, F.col("url"), at, F.lit("response"), own_tag, F.lit(None).cast("string"), F.col("body"), {"content-type": html, "etag": own_tag, "cache-control": age, "date": at.cast("string")}),
        record(1, home, at + 1, F.when(front, "response").otherwise("revisit"), front_tag, front_date, F.md5(F.concat(home, era)),
               {"content-type": F.when(front, html), "etag": front_tag, "cache-control": age, "date": (at + 1).cast("string"), "set-cookie": text("c=", F.col("page_id"))}),
        record(2, F.concat("url", F.lit("#again")), at + 5, F.lit("revisit"), again_tag, F.lit(None).cast("string"), F.lit(None).cast("string"), {"etag": again_tag, "date": (at + 5).cast("string")}),
    ]
    return p.select("page_id", F.posexplode(F.array(*records)).alias("number", "r")).filter("number <> 2 or coalesce(page_id % 3 = 1, false)").select("r.*")


def op3_warc_revisits(spark, sf_dir: str) -> DataFrame:
    found = resolve(captures_of(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.withColumn("headers", F.array_join(lines, "\n"))


_PERMITTED = ", ".join(f"'{p}'" for p in PERMITTED)
CHECK = rf"""
WITH p AS (
    SELECT page_id, url, md5(html) AS body, CAST(page_id // 1000 AS VARCHAR) AS era, page_id * 10 AS t, 'max-age=' || page_id % 60 AS age,
        '"' || substr(md5(html), 1, 12) || '"' AS tag, regexp_extract(url, '^[^:/?#]+://[^/?#]*') || '/' AS home,
        CASE WHEN page_id % 11 = 0 THEN NULL ELSE 'W/"' || page_id // 1000 || '"' END AS front_tag,
        CASE WHEN page_id % 5 = 0 THEN '"stale"' ELSE '"' || substr(md5(html), 1, 12) || '"' END AS again_tag
    FROM pages
), raw AS (
    SELECT page_id * 4 AS record_id, url, t AS captured_at, 'response' AS kind, tag AS etag, NULL::VARCHAR AS last_modified, body AS digest,
        [('content-type', 'text/html'), ('etag', tag), ('cache-control', age), ('date', t::VARCHAR)] AS h FROM p
    UNION ALL
    SELECT page_id * 4 + 1, home, t + 1, CASE WHEN page_id % 7 = 0 THEN 'response' ELSE 'revisit' END, front_tag, 'day ' || page_id // 500, md5(home || era),
        [('content-type', CASE WHEN page_id % 7 = 0 THEN 'text/html' END), ('etag', front_tag), ('cache-control', age), ('date', (t + 1)::VARCHAR), ('set-cookie', 'c=' || page_id)] FROM p
    UNION ALL
    SELECT page_id * 4 + 2, url || '#again', t + 5, 'revisit', again_tag, NULL, NULL, [('etag', again_tag), ('date', (t + 5)::VARCHAR)] FROM p WHERE page_id % 3 = 1
), cut AS (
    SELECT *, translate(regexp_extract(url, '^([^:/?#]+)://', 1), '{UPPER}', '{LOWER}') AS scheme, translate(regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
        regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1) AS path,
        array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT starts_with(x, 'utm_'))), '&') AS query
    FROM raw
), capture AS (
    SELECT record_id, captured_at, kind, etag, last_modified, digest, list_filter(h, lambda e: e[2] IS NOT NULL) AS h,
        CASE WHEN scheme <> '' THEN scheme || '://' || CASE scheme WHEN 'http' THEN regexp_replace(host, ':80$', '') WHEN 'https' THEN regexp_replace(host, ':443$', '') ELSE host END
            || CASE path WHEN '' THEN '/' ELSE path END || CASE query WHEN '' THEN '' ELSE '?' || query END ELSE regexp_extract(url, '^[^#]*') END AS url
    FROM cut
), response AS (
    SELECT * FROM capture WHERE kind = 'response' QUALIFY row_number() OVER (PARTITION BY url, captured_at ORDER BY record_id DESC) = 1
), joined AS (
    SELECT c.*, r.record_id AS stored_id, r.digest AS stored_digest, r.h AS stored_h,
        coalesce(regexp_replace(c.etag, '^W/', '') = regexp_replace(r.etag, '^W/', ''), c.last_modified = r.last_modified, c.digest = r.digest) AS agree
    FROM capture c ASOF LEFT JOIN response r ON c.url = r.url AND c.captured_at > r.captured_at
), told AS (
    SELECT *, CASE WHEN kind = 'response' THEN 'full' WHEN stored_id IS NULL THEN 'no_earlier' WHEN agree THEN 'resolved' WHEN agree IS NULL THEN 'unvalidated' ELSE 'mismatch' END AS outcome
    FROM joined
), laid AS (
    SELECT *, list_filter(h, lambda e: e[1] IN ({_PERMITTED})) AS allowed FROM told
)
SELECT record_id, url, captured_at, kind, outcome,
    CASE outcome WHEN 'full' THEN record_id WHEN 'resolved' THEN stored_id END AS resolved_id,
    CASE outcome WHEN 'resolved' THEN stored_digest ELSE digest END AS digest,
    array_to_string(list_transform(list_sort(CASE outcome WHEN 'resolved'
        THEN list_concat(list_filter(stored_h, lambda e: NOT list_contains(list_transform(allowed, lambda a: a[1]), e[1])), allowed) ELSE h END), lambda e: e[1] || ': ' || e[2]), chr(10)) AS headers
FROM laid
"""
