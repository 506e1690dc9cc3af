"""WARC not-modified revisits: each is resolved to the latest earlier full response of its canonical URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, rank_globally

BLOCK = 50_000  # records of one URL that one window reads; longer histories are cut, and each cut gets what precedes it

#: Fields of a 304 response that update the stored one; those that describe the body never do.
PERMITTED_HEADERS = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "server", "set-cookie", "vary"]

#: Parameters that don't change what a URL returns.
TRACKING = r"^(utm_[a-z]+|fbclid|gclid|ref|sessionid)(=|$)"


def canonical_url(url: Column) -> Column:
    """host/path?query: without scheme, www, default port, fragment, closing slashes and tracking parameters.

    The host is lower-cased (A-Z), parameters are sorted. Null stays null.
    """
    rest = F.split_part(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), F.lit("#"), F.lit(1))
    address = F.split_part(rest, F.lit("?"), F.lit(1))
    host = F.split_part(address, F.lit("/"), F.lit(1))
    path = F.regexp_replace(F.substring(address, F.length(host) + 1, F.length(address)), "/+$", "")
    bare = F.regexp_replace(F.regexp_replace(ascii_lower(host), r":(80|443)$", ""), r"^www\.", "")
    query = F.substring(rest, F.length(address) + 2, F.length(rest))
    params = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(bare, path, F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(""))


def _agree(response: str, revisit: Column) -> Column:
    """True or false by the first kind of validator that both have (etag, last_modified, digest); null if none."""
    weak = lambda c: F.regexp_replace(c, "^W/", "")
    old = lambda name: F.col(f"{response}.{name}")
    return F.coalesce(
        weak(old("etag")) == weak(revisit["etag"]), old("last_modified") == revisit["last_modified"], old("digest") == revisit["digest"]
    )


def _by_lower_name(headers: Column) -> Column:
    """Headers by lower-cased name; of several whose names differ in capitals only, the one whose name sorts last counts."""
    entries = F.array_sort(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))))
    named = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))

    def kept(entries: Column) -> Column:
        later = lambda e, i: F.exists(F.slice(entries, i + 2, F.size(entries)), lambda x: x["key"] == e["key"])
        return F.filter(entries, lambda e, i: ~later(e, i))

    return F.map_from_entries(kept(named))


def resolve(records: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per revisit: (id, canonical_url, status, refers_to, payload_length, headers).

    records: (id, url, ts long, kind, etag, last_modified, digest, payload_length long, headers map); kind is
    'response' or 'revisit', other kinds and null are left out. refers_to is the response of the same canonical URL with
    the greatest ts below the revisit's, among equals the greatest id. status: 'resolved' if the first validator that both
    records have agrees (weak etags as strong ones), 'mismatch' if it doesn't, 'unverifiable' if they share none,
    'missing' without an earlier response; a null url or ts is 'missing'. headers: for a resolved revisit those of the
    response with the revisit's permitted fields put over them, else null; names are lower-cased, and of names that differ in
    capitals only the one that sorts last counts (etag over ETag). Repeated revisits are
    resolved each. Other columns may stand in records and are not read.

    The as-of join is a last-value window over both kinds in one order. A URL's history is cut into blocks of a global
    rank, and what each block starts from is the last response of the URL's blocks before it, so that a URL with a third
    of all records is spread over many tasks. Bodies are not moved: refers_to says where they are.
    """
    names = ("etag", "last_modified", "digest", "payload_length", "headers")
    lean = records.where(F.col("kind").isin("response", "revisit")).select(
        "id", canonical_url(F.col("url")).alias("canonical_url"), F.col("ts").cast("long").alias("ts"),
        (F.col("kind") == "response").alias("full"), *names,
    )
    usable = F.col("canonical_url").isNotNull() & F.col("ts").isNotNull()
    ranked = rank_globally(lean.where(usable), "canonical_url", "ts", "full", "id")
    ranked = ranked.withColumn("block", F.floor(F.col("rank") / block))
    response = F.when(F.col("full"), F.struct("id", *names))
    before = Window.partitionBy("canonical_url", "block").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    seen = ranked.withColumn("response", F.last(response, ignorenulls=True).over(before)).where(~F.col("full"))
    closing = ranked.where("full").groupBy("canonical_url", "block").agg(F.max_by(F.struct("id", *names), "rank").alias("closing"))
    blocks = ranked.select("canonical_url", "block").distinct().join(closing, ["canonical_url", "block"], "left")
    earlier = Window.partitionBy("canonical_url").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opening = blocks.withColumn("opening", F.last("closing", ignorenulls=True).over(earlier)).where("opening is not null")
    seen = seen.join(opening.select("canonical_url", "block", "opening"), ["canonical_url", "block"], "left")
    seen = seen.withColumn("response", F.coalesce("response", "opening"))
    unusable = lean.where(~usable & ~F.col("full")).select("id", "canonical_url", *names, F.lit(None).cast(seen.schema["response"].dataType).alias("response"))
    rows = seen.select("id", "canonical_url", *names, "response").union(unusable)
    revisit = F.struct(*names)
    agree = _agree("response", revisit)
    status = (
        F.when(F.col("response").isNull(), "missing").when(agree.isNull(), "unverifiable").when(agree, "resolved").otherwise("mismatch")
    )
    old, new = _by_lower_name(F.col("response.headers")), _by_lower_name(F.col("headers"))
    updates = F.map_filter(new, lambda k, _: k.isin(PERMITTED_HEADERS))
    kept = F.map_filter(old, lambda k, _: ~F.map_contains_key(updates, k))
    merged = F.map_concat(kept, updates)
    return rows.select(
        "id", "canonical_url", status.alias("status"), F.col("response.id").alias("refers_to"),
        F.col("response.payload_length").alias("payload_length"), F.when(status == "resolved", merged).alias("headers"),
    )
