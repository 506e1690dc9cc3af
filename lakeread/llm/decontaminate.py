"""Benchmark decontamination by winnowing, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialize, text_key, without

WINDOW = 10  # words that are shared at least; an item of fewer is one window
GRAM = 5  # words of a k-gram
BROADCAST_ROWS = 500_000  # more windows than these, or longer ones than these bytes, are joined by shuffle
BROADCAST_BYTES = 64 << 20
#: Runs of anything but 0-9, A-Z, a-z and non-ASCII signs.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words in their own case; none for null."""
    return F.coalesce(F.array_remove(F.split(text, SEPARATORS), ""), F.array().cast("array<string>"))


def _minima(texts: DataFrame, widths: list[int]) -> DataFrame:
    """Adds minima_<width>, the least k-gram hash of every window of so many words, to rows that have `words`; null where they are fewer.

    Windows hold width - k + 1 k-grams, so a span of width words that two texts share has the same minimum in both. Words
    are hashed once for all widths, k-grams once for all widths that have the same k. Each step is a column of its own,
    since Spark does not make again what is used more than once.
    """
    size = F.size("words")
    hashed = texts.withColumn("hashes", F.when(size >= min(widths), F.transform("words", lambda w: F.xxhash64(F.lower(w)))))

    def grams(k: int) -> Column:
        gram = lambda i: F.xxhash64(*(F.get("hashes", i + j) for j in range(k)))
        return F.when(F.size("hashes") >= k, F.transform(F.sequence(F.lit(0), F.size("hashes") - k), gram))

    def minima(width: int) -> Column:
        k = min(GRAM, width)
        name, each = f"grams_{k}", width - k + 1
        least = lambda i: F.least(*(F.get(name, i + j) for j in range(each))) if each > 1 else F.get(name, i)
        return F.when(F.size(name) >= each, F.transform(F.sequence(F.lit(0), F.size(name) - each), least))

    ks = sorted({min(GRAM, w) for w in widths})
    hashed = hashed.withColumns({f"grams_{k}": grams(k) for k in ks}).drop("hashes")
    return hashed.withColumns({f"minima_{w}": minima(w) for w in widths}).drop(*(f"grams_{k}" for k in ks))


def _fingerprints(texts: DataFrame, widths: list[int], *keep: str) -> DataFrame:
    """(*keep, width, fp, first, last): runs of windows, by their first words' places, that have the same minimum."""

    def starts(width: int) -> Column:
        least = f"minima_{width}"
        new = lambda i: (i == 0) | (F.get(least, i) != F.get(least, i - 1))
        return F.filter(F.sequence(F.lit(0), F.size(least) - 1), new)

    def runs(width: int) -> Column:
        least, begin = f"minima_{width}", f"starts_{width}"
        run = lambda s, i: F.struct(
            F.lit(width).alias("width"), F.get(least, s).alias("fp"), s.alias("first"), (F.coalesce(F.get(begin, i + 1), F.size(least)) - 1).alias("last")
        )
        return F.coalesce(F.transform(begin, run), F.array().cast("array<struct<width:int,fp:bigint,first:int,last:int>>"))

    rows = _minima(texts, widths)
    rows = rows.withColumns({f"starts_{w}": F.when(F.size(f"minima_{w}") > 0, starts(w)) for w in widths})
    return rows.select(*keep, F.explode(F.concat(*map(runs, widths))).alias("run")).select(*keep, "run.*")


def _item_windows(benchmark: DataFrame) -> DataFrame:
    """(width, window, items): every distinct window as text, with the sorted ids of the items that hold it, none for null ids."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(ascii_lower(F.col("text"))).alias("words")).where(F.size("words") > 0)
    items = items.withColumn("width", F.least(F.size("words"), F.lit(WINDOW)))
    cut = F.transform(
        F.sequence(F.lit(0), F.size("words") - F.col("width")),
        lambda i: F.array_join(F.slice("words", i + 1, F.col("width")), " "),
    )
    windows = items.select("item_id", "width", F.explode(cut).alias("window"))
    return windows.groupBy("width", "window").agg(F.sort_array(F.collect_set("item_id")).alias("items"))


def hit_windows(docs: DataFrame, benchmark: DataFrame, *keys: str) -> DataFrame:
    """(*keys, first, width, items): every place of a document where a window of items occurs, and these items; docs has `words`.

    Documents and items are winnowed in windows of 10 words, and of less if there are short items, in one pass for all
    widths: the least 5-gram hash of every window is its fingerprint, runs of windows with one fingerprint are one row.
    Fingerprints are joined, hits are extended to all windows of their runs, and these are compared with the items'
    windows as text. A window that many items share is one row with all of them. The items' side is broadcast only if its
    counted rows and bytes are under a bound; a larger one is joined by shuffle, where AQE splits hot fingerprints, with
    only the words of the run at hand.
    """
    windows = materialize(_item_windows(benchmark), "windows")
    size = F.octet_length("window") + F.aggregate("items", F.lit(0), lambda n, x: n + F.octet_length(x) + 8)
    counts = windows.groupBy("width").agg(F.count("*"), F.sum(size)).collect()  # a row per width: ten at most
    if not counts:
        return docs.limit(0).select(*keys, F.lit(0).alias("first"), F.lit(0).alias("width"), F.array().cast("array<string>").alias("items"))
    widths = sorted(r[0] for r in counts)
    small = sum(r[1] for r in counts) <= BROADCAST_ROWS and sum(r[2] for r in counts) <= BROADCAST_BYTES
    hint = F.broadcast if small else lambda df: df
    prints = None
    for width in widths:
        own = _minima(windows.where(F.col("width") == width).select(words_of(F.col("window")).alias("words")), [width])
        own = own.select(F.lit(width).alias("width"), F.get(f"minima_{width}", F.lit(0)).alias("fp"))
        prints = own if prints is None else prints.union(own)
    runs = _fingerprints(docs, widths, *keys, "words")
    near = F.slice("words", F.col("first") + 1, F.col("last") - F.col("first") + F.col("width"))
    if not small:
        runs = runs.withColumn("words", near)
        near = F.col("words")
    hits = runs.join(hint(prints.distinct()), ["width", "fp"], "left_semi").select(*keys, "width", "first", "last", near.alias("near"))
    lowered = hits.withColumn("near", F.transform("near", ascii_lower))
    cut = F.transform(
        F.sequence(F.lit(0), F.col("last") - F.col("first")),
        lambda i: F.array_join(F.slice("near", i + 1, F.col("width")), " "),
    )
    texts = lowered.select(*keys, "width", "first", F.posexplode(cut).alias("at", "window"))
    texts = texts.select(*keys, (F.col("first") + F.col("at")).alias("first"), "width", "window")
    return texts.join(hint(windows), ["width", "window"]).select(*keys, "first", "width", "items")


def _covered(windows: Column) -> Column:
    """How many places the sorted (first, width) windows cover together."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(acc: Column, x: Column) -> Column:
        end = x["first"] + x["width"]
        new = F.greatest(end - F.greatest(acc["end"], x["first"]), F.lit(0))
        return F.struct(F.greatest(end, acc["end"]).alias("end"), (acc["n"] + new).alias("n"))

    return F.aggregate(windows, start, add, lambda acc: acc["n"])


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of docs: (doc_id, n_words, n_hit, n_items, items_sha256, contaminated).

    Words are runs of 0-9, a-z and non-ASCII signs after lower-casing A-Z. A word is hit if it is inside any occurrence
    of 10 consecutive words of an item, or of a whole item of fewer words. n_items counts the items with occurring
    windows; items_sha256 is of their ids, sorted as strings and joined by commas (of nothing, if there are none).
    Null and empty texts and items have no words and match nothing. Items with a null id hit words but aren't counted;
    repeated items count once. Repeated documents, and those with a null id, get a row each. Other columns are not read.
    """
    return _judged(docs, benchmark).drop("key")


def _judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """contamination(), with the text_key() of each row."""
    keyed = docs.select("doc_id", text_key("text").alias("key"), "text")
    worded = keyed.select("doc_id", "key", words_of(F.col("text")).alias("words"))
    hits = hit_windows(worded, benchmark, "doc_id", "key").groupBy("doc_id", "key").agg(
        F.sort_array(F.collect_set(F.struct("first", "width"))).alias("windows"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    hits = hits.select(
        F.col("doc_id").alias("_id"), F.col("key").alias("_hash"), _covered(F.col("windows")).alias("hit"), "items"
    )
    counted = keyed.select("doc_id", "key", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    rows = counted.join(hits, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_hash")), "left")
    ids = F.coalesce(F.concat_ws(",", "items"), F.lit(""))
    n_hit = F.coalesce("hit", F.lit(0)).cast("long")
    return rows.select(
        "doc_id", "key", "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs without any hit word, with all their columns.

    Each row is judged by its own text, so rows with a null id or with an id that others have too stay or go by it alone;
    repeated rows stay or go together. Null and empty texts have no words and stay. No benchmark, no loss.
    """
    worded = docs.select(F.col("doc_id").alias("id"), text_key("text").alias("key"), words_of(F.col("text")).alias("words"))
    return without(docs, hit_windows(worded, benchmark, "id", "key"))
