"""Not-modified revisits of a web archive resolved to the response they stand for.

A revisit record says that a server answered 304: the payload is the one of an earlier capture.  It is
resolved by an as-of join on the canonical URL: the latest full response captured before it (at equal
times the one with the smaller record id counts as earlier).  Its validators are then checked: ETags by
weak comparison, else Last-Modified, else the payload digest.  Where they agree, the response's headers
are kept and the permitted headers of the 304 put over them.

The as-of join is a carry-forward over the captures of a URL in two levels: inside a window of time, and
over the last response of each window.  A URL with a third of all captures is spread over its windows.
Payloads are not moved: a resolved revisit names its response, and ``restored`` joins the payloads on.

Records with a null URL or time cannot be placed and come back unresolved.  Headers are maps with any
capitals; null maps count as empty.  Repeated records are resolved each for itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Headers of a 304 answer that replace those of the stored response.
PERMITTED = ["age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
#: Query parameters that say where a visitor came from, not what the page is.
TRACKING = r"utm_[a-z]+|ref|fbclid|gclid|sessionid|phpsessid"


def canonical(url: Column) -> Column:
    """The URL without scheme, ``www.`` and port, fragment, tracking parameters and final slash; the host in
    lower case, the other parameters sorted."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1)), r"^www[0-9]*\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(rf"(?i)^({TRACKING})(=|$)")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _lower_keys(headers: Column) -> Column:
    return F.transform_keys(F.coalesce(headers, F.create_map().cast("map<string,string>")), lambda k, _: F.lower(k))


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def resolve(records: DataFrame, window: int = 3_600) -> DataFrame:
    """One row per revisit: record_id, url_key, response_id, outcome, headers, payload_digest.

    ``records`` has record_id, url, time (long), kind ("response" or "revisit"), headers and
    payload_digest.  ``outcome`` is ``resolved``, ``changed`` (the validators differ) or ``missing`` (no earlier
    response); headers and digest are given for resolved revisits only.  ``window`` is in units of
    ``time``; a URL's captures within one window meet in one task.
    """
    made = records.select(
        "record_id",
        canonical(F.col("url")).alias("url_key"),
        F.col("time").cast("long").alias("time"),
        (F.col("kind") == "response").alias("full"),
        _lower_keys(F.col("headers")).alias("headers"),
        "payload_digest",
    ).withColumn("lane", F.floor(F.col("time") / window))
    placed = made.filter("url_key IS NOT NULL AND time IS NOT NULL")
    response = F.when(F.col("full"), F.struct("record_id", "headers", "payload_digest"))
    before = Window.partitionBy("url_key", "lane").orderBy("time", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    inner = placed.withColumn("near", F.last(response, ignorenulls=True).over(before)).filter("NOT full")
    lanes = placed.filter("full").groupBy("url_key", "lane").agg(
        F.max_by(response, F.struct("time", "record_id")).alias("last")
    )
    # lanes with revisits take part too, with nothing of their own to carry
    asked = inner.filter("near IS NULL").select("url_key", "lane").distinct()
    earlier = Window.partitionBy("url_key").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        lanes.join(asked.withColumn("asked", F.lit(True)), ["url_key", "lane"], "full")
        .withColumn("far", F.last("last", ignorenulls=True).over(earlier))
        .filter("asked")
        .select("url_key", "lane", "far")
    )
    found = inner.join(carried, ["url_key", "lane"], "left").withColumn("match", F.coalesce("near", "far")).drop("near", "far", "lane")
    lost = made.filter("NOT full AND (url_key IS NULL OR time IS NULL)").drop("lane")
    found = found.unionByName(lost, allowMissingColumns=True)

    old, new = F.col("match.headers"), F.col("headers")
    by_tag = new["etag"].isNotNull() & old["etag"].isNotNull()
    by_time = new["last-modified"].isNotNull() & old["last-modified"].isNotNull()
    agrees = (
        F.when(by_tag, _weak(new["etag"]) == _weak(old["etag"]))
        .when(by_time, new["last-modified"] == old["last-modified"])
        .otherwise(F.col("payload_digest").isNull() | (F.col("payload_digest") == F.col("match.payload_digest")))
    )
    outcome = (
        F.when(F.col("match").isNull(), "missing").when(F.coalesce(agrees, F.lit(False)), "resolved").otherwise("changed")
    )
    permitted = F.map_filter("headers", lambda k, _: k.isin(PERMITTED))
    merged = F.map_concat(F.map_filter("match.headers", lambda k, _: ~F.map_contains_key(permitted, k)), permitted)
    resolved = F.col("outcome") == "resolved"
    return found.withColumn("outcome", outcome).select(
        "record_id",
        "url_key",
        F.when(F.col("outcome") != "missing", F.col("match.record_id")).alias("response_id"),
        "outcome",
        F.when(resolved, merged).alias("headers"),
        F.when(resolved, F.col("match.payload_digest")).alias("payload_digest"),
    )


def restored(found: DataFrame, payloads: DataFrame) -> DataFrame:
    """Resolved revisits with their ``payload``, from (record_id, payload) of the responses."""
    stored = payloads.select(F.col("record_id").alias("response_id"), "payload")
    return found.filter("outcome = 'resolved'").join(stored, "response_id")
