"""Not-modified revisits of a web archive: as-of join to the latest earlier full response.

Records have ``record_id``, ``kind`` ("response" or "revisit"), ``url``, ``date``, ``status``,
``headers`` (map of lower-case names) and, for responses, the payload's ``payload_digest`` and
``payload_length``. A revisit (an answer 304) takes over the payload of the latest response with
status 200 that has the same canonical URL and an earlier date (ties between responses: the
greater record id). The validators are checked: an ETag that both have must be equal (weak
comparison); if there is no ETag on both, a Last-Modified that both have must be equal; without
either the revisit is unverified. The resolved headers are the response's, with the permitted
ones replaced by the revisit's.

The join is a running "last" over the moments (URL and date) of the records, each with its last
response. A URL may hold a third of all records, so the moments are sorted by URL and date over
all tasks and cut into chunks where the partitions end: the last response of each chunk is taken
first (map-side), a running last over the chunks of a URL (at most ``chunks`` rows) carries it on,
and a window inside each (URL, chunk) does the rest. Chunks hold about as many moments each,
whatever the dates are. Responses travel as their row's number; headers are joined at the end.

Edge cases: null URLs and dates never match; a null URL's revisit is "no response"; empty tables
give no rows; repeated records are resolved each, one row for each row of a revisit, and of
responses of one date and id the one of the greatest digest counts; null headers count as empty; other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyweave.llm.common import materialise

# Header fields that a 304 answer may update (RFC 9110, 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
# Query parameters that name a visit, not a page.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "ref",
            "fbclid", "gclid")


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host without "www." and default ports, no fragment, no tracking
    parameters, the rest of the query in order, no trailing slash."""
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    head = F.lower(F.regexp_extract(plain, "^([A-Za-z][A-Za-z0-9+.-]*://)?([^/?]*)", 0))
    rest = F.substring(plain, F.length(head) + 1, F.length(plain))
    head = F.regexp_replace(head, "^https?://", "")
    head = F.regexp_replace(F.regexp_replace(head, "^www\\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_replace(rest, "\\?.*$", ""), "/+$", "")
    query = F.regexp_extract(rest, "\\?(.*)$", 1)
    params = F.array_sort(F.filter(
        F.split(query, "&"),
        lambda p: (p != "") & ~F.split(p, "=")[0].isin(*TRACKING)))
    return F.concat(head, path, F.when(F.size(params) > 0, F.concat(
        F.lit("?"), F.array_join(params, "&"))).otherwise(""))


def resolve_revisits(records: DataFrame, *, chunks: int | None = None) -> DataFrame:
    """One row per revisit: record_id, canonical_url, date, outcome ("resolved", "unverified",
    "changed" or "no response"), source_id, source_date, payload_digest, payload_length and
    headers (merged). The last four are null unless resolved or unverified.

    ``chunks``: into how many ranges the moments are cut (default: the session's shuffle
    partitions).
    """
    r = materialise(records.select(
        "record_id", "kind", canonical_url(F.col("url")).alias("canonical_url"), "date", "status",
        F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"),
        "payload_digest", "payload_length", F.monotonically_increasing_id().alias("row")),
        "warc-records")
    known = r.where(F.col("canonical_url").isNotNull() & F.col("date").isNotNull())
    full = (F.col("kind") == "response") & (F.col("status") == 200)
    source = F.struct("date", "record_id", "payload_digest", "row")
    moments = known.groupBy("canonical_url", "date").agg(
        F.max(F.when(full, source)).alias("source"), F.max(F.col("kind") == "revisit").alias("asks"))
    order = [F.asc("canonical_url"), F.asc("date")]
    moments = moments.repartitionByRange(chunks, *order) if chunks else \
        moments.repartitionByRange(*order)
    moments = materialise(moments.withColumn("chunk", F.spark_partition_id()), "warc-moments")
    # the last response of each chunk, and what the chunks before a chunk hand on
    by_chunk = moments.groupBy("canonical_url", "chunk").agg(F.max("source").alias("last"))
    before = (Window.unboundedPreceding, -1)  # rows of earlier dates only: dates differ here
    carried = by_chunk.select("canonical_url", "chunk", F.max("last").over(
        Window.partitionBy("canonical_url").orderBy("chunk").rowsBetween(*before)).alias("carried"))
    inside = Window.partitionBy("canonical_url", "chunk").orderBy("date").rowsBetween(*before)
    found = moments.withColumn("inside", F.max("source").over(inside)).where("asks").join(
        carried, ["canonical_url", "chunk"], "left").select(
        F.col("canonical_url").alias("f_url"), F.col("date").alias("f_date"),
        F.coalesce("inside", "carried")["row"].alias("source_row"))
    found = materialise(found, "warc-found")
    revisits = r.where(F.col("kind") == "revisit").select(
        "record_id", "canonical_url", "date", F.col("headers").alias("own"))
    responses = r.where(full).select(
        F.col("row").alias("r_row"), F.col("record_id").alias("source_id"),
        F.col("date").alias("source_date"), F.col("headers").alias("theirs"), "payload_digest",
        "payload_length")
    j = revisits.join(found, (F.col("canonical_url") == F.col("f_url"))
                      & (F.col("date") == F.col("f_date")), "left").join(
        responses, F.col("source_row") == F.col("r_row"), "left")
    tag = lambda c: F.regexp_replace(F.col(c)["etag"], "^W/", "")
    tags = tag("own").isNotNull() & tag("theirs").isNotNull()
    own_mod, their_mod = F.col("own")["last-modified"], F.col("theirs")["last-modified"]
    mods = own_mod.isNotNull() & their_mod.isNotNull()
    outcome = (F.when(F.col("r_row").isNull(), "no response")
               .when(tags, F.when(tag("own") == tag("theirs"), "resolved").otherwise("changed"))
               .when(mods, F.when(own_mod == their_mod, "resolved").otherwise("changed"))
               .otherwise("unverified"))
    good = F.col("outcome").isin("resolved", "unverified")
    fresh = F.map_filter("own", lambda k, v: k.isin(*PERMITTED))
    kept = F.map_filter("theirs", lambda k, v: ~F.array_contains(F.map_keys(fresh), k))
    return j.withColumn("outcome", outcome).select(
        "record_id", "canonical_url", "date", "outcome",
        *[F.when(good, F.col(c)).alias(c) for c in ("source_id", "source_date", "payload_digest",
                                                    "payload_length")],
        F.when(good, F.map_concat(kept, fresh)).alias("headers"))


def page_records(pages: DataFrame) -> DataFrame:
    """Archive records of a crawl of ``pages``, which Spark derives from the table.

    Each page is fetched once in full and asked for again later. Fetch times, validators and
    headers follow from the page's id, URL and content: some answers have no ETag, some have
    neither validator, and a page whose URL was fetched anew in between has changed.
    """
    size, letters = F.octet_length("html"), F.length("url")
    day = lambda n: F.timestamp_seconds(F.lit(1_700_000_000) + n)
    # fetches spread over a day, and revisits follow within two days
    first = F.pmod(F.col("page_id") * 7919, F.lit(100_000))
    again = first + 1 + F.pmod(F.coalesce(size, F.lit(0)) * 31, F.lit(172_800))
    etag = F.concat(F.lit('"'), F.md5(F.col("html").cast("binary")), F.lit('"'))
    modified = (F.lit(1_699_000_000) + size).cast("string")
    has_tag, has_date = F.pmod(letters, F.lit(4)) != 0, F.pmod(letters, F.lit(3)) != 0
    base = F.map_filter(F.create_map(
        F.lit("etag"), F.when(has_tag, etag),
        F.lit("last-modified"), F.when(has_date, modified)), lambda k, v: v.isNotNull())

    def record(kind, number, seconds, status, extra):
        return F.struct(
            (F.col("page_id") * 2 + number).alias("record_id"), F.lit(kind).alias("kind"),
            F.col("url").alias("url"), day(seconds).alias("date"), F.lit(status).alias("status"),
            F.map_concat(base, extra).alias("headers"),
            F.when(F.lit(kind == "response"), F.md5(F.col("html").cast("binary")))
            .alias("payload_digest"),
            F.when(F.lit(kind == "response"), size.cast("long"))
            .alias("payload_length"))

    page = F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("cache-control"),
                        F.lit("max-age=60"))
    fresh = F.create_map(F.lit("content-length"), F.lit("0"), F.lit("cache-control"),
                         F.concat(F.lit("max-age="), F.coalesce(letters, F.lit(0)).cast("string")))
    both = F.array(record("response", 0, first, 200, page), record("revisit", 1, again, 304, fresh))
    return pages.select("page_id", "url", "html").select(F.explode(both).alias("x")).select("x.*")
