"""Not-modified revisits of a web archive, resolved against the captures they refer to.

A revisit record (HTTP 304) holds no payload: it says that the page was as at an earlier
capture. It is joined, as of its time and by canonical URL, to the latest earlier full
response; its validators are checked against that response's, and the headers that a 304
may update are merged into the stored ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delayscope.llm.common import stored

# Parts of a URL, session and campaign parameters, default ports.
URL = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?([^/?#]*)([^?#]*)[?]?([^#]*)"
IGNORED_PARAMETER = r"^(utm_[^=]*|ref|sessionid)(=|$)"
# Headers about the message or the stored body, which a 304 never updates.
NOT_MERGED = (
    "connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade",
)


def canonical_url(url: Column) -> Column:
    """Host in lower case without www and default port, path without end slashes, the
    parameters that matter in order; no scheme, no fragment. Null and empty stay empty."""
    url = F.trim(F.coalesce(url, F.lit("")))
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(url, URL, 1)), r"^www[0-9]*[.]", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(url, URL, 2), r"/+$", "")
    parts = F.filter(F.split(F.regexp_extract(url, URL, 3), "&"), lambda p: (p != "") & ~p.rlike(IGNORED_PARAMETER))
    query = F.array_join(F.array_sort(parts), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def _opaque(tag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(tag, r"^W/", "")


def _header(headers: Column, name: str) -> Column:
    return F.try_element_at(headers, F.lit(name))


def merge_headers(stored_headers: Column, update: Column) -> Column:
    """The stored headers, updated by those of the 304 that may: sorted (name, value) entries."""
    allowed = F.map_filter(F.coalesce(update, F.create_map().cast("map<string,string>")), lambda k, v: ~k.isin(*NOT_MERGED) & v.isNotNull())
    kept = F.map_filter(F.coalesce(stored_headers, F.create_map().cast("map<string,string>")), lambda k, v: ~F.map_contains_key(allowed, k))
    return F.array_sort(F.map_entries(F.map_concat(kept, allowed)))


def as_of(events: DataFrame, carried: Column) -> DataFrame:
    """Rows of (key, at, id, ...) plus ``before``: ``carried`` of the latest earlier row of
    the same key where it is not null.

    Rows are dealt by ranges of (key, at, id), so a key with a third of all rows lies in
    many tasks. Each task fills its own part; what a part ends with is carried to the next
    parts of the same key, of which there are at most two per task.
    """
    dealt = events.withColumn("carried", carried).repartitionByRange("key", "at", "id").withColumn("part", F.spark_partition_id())
    dealt = stored(dealt, "as-of")
    order = [F.col("at"), F.col("id")]
    inside = Window.partitionBy("part", "key").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ends = stored(dealt.groupBy("key", "part").agg(F.max(F.when(F.col("carried").isNotNull(), F.struct("at", "id", "carried"))).alias("last")), "ends")
    # Keys that lie in several parts: no more than one starts in each part.
    cut = ends.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    onward = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.join(F.broadcast(cut), "key").select("key", "part", F.last("last", ignorenulls=True).over(onward)["carried"].alias("from_before"))
    filled = dealt.withColumn("here", F.last("carried", ignorenulls=True).over(inside))
    return filled.join(F.broadcast(starts), ["key", "part"], "left").withColumn("before", F.coalesce("here", "from_before")).drop("here", "from_before", "part", "carried")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit: record_id, response_id, outcome, payload_digest, headers.

    ``records`` has record_id, kind ('response' or 'revisit'), url, at (time), status,
    headers (map, names in lower case) and payload_digest. A full response is one of status
    200. "Earlier" is by (at, record_id). The outcome is ``resolved`` where the entity tag
    (weakly compared), else Last-Modified, else the payload digest that the revisit gives
    equals the response's, or it gives none; ``validator_mismatch`` where it differs;
    ``no_response`` without an earlier full response. Digest and merged headers (sorted
    name, value entries) are null unless resolved.

    Revisits without url share the empty URL; without time they come before all others, and
    equal times are ordered by record_id. Rows that repeat are resolved each. No payload is
    moved: results name the record that holds it. An empty table gives an empty result;
    other columns are not read.
    """
    full = (F.col("kind") == "response") & (F.col("status") == 200)
    response = F.struct(F.col("id").alias("response_id"), F.col("headers").alias("entries"), F.col("payload_digest").alias("digest"))
    events = records.filter((F.col("kind") == "revisit") | full).select(
        canonical_url(F.col("url")).alias("key"), "at", F.col("record_id").alias("id"), "kind", "status",
        # As entries: maps have no order, and the carried struct needs one.
        F.map_entries("headers").alias("headers"), "payload_digest",
    )
    joined = as_of(events, F.when(F.col("kind") == "response", response)).filter("kind = 'revisit'")
    own, other = F.map_from_entries("headers"), F.map_from_entries("before.entries")
    tag, date = _header(own, "etag"), _header(own, "last-modified")
    same = (
        F.when(tag.isNotNull(), _opaque(tag).eqNullSafe(_opaque(_header(other, "etag"))))
        .when(date.isNotNull(), date.eqNullSafe(_header(other, "last-modified")))
        .when(F.col("payload_digest").isNotNull(), F.col("payload_digest").eqNullSafe(F.col("before.digest")))
        .otherwise(True)
    )
    outcome = F.when(F.col("before").isNull(), "no_response").when(F.coalesce(same, F.lit(False)), "resolved").otherwise("validator_mismatch")
    judged = joined.withColumn("outcome", outcome)
    resolved = F.col("outcome") == "resolved"
    return judged.select(
        F.col("id").alias("record_id"), F.col("key").alias("canonical_url"), F.col("before.response_id").alias("response_id"), "outcome",
        F.when(resolved, F.col("before.digest")).alias("payload_digest"), F.when(resolved, merge_headers(other, own)).alias("headers"),
    )
