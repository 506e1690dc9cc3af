"""Stupid-backoff language-model scores: n-gram count tables, joined back to every document's n-grams."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize

ORDER = 2
BACKOFF = 0.4
HOLDERS = 2  # documents that must hold an n-gram of two words and more, so that it counts as seen: the scored one and another
PARTITION = 4_000_000  # n-grams that a task counts
VOCABULARY = 1_000_000  # so many words, the most frequent, are broadcast; rarer ones are joined by shuffle
PASSES = 3  # over the documents, each for some of the n-grams, so that a third of the rows is on disk at a time
ONE_PASS = 10_000_000  # words of documents that are taken in one pass
SLICE_BITS = 11
SLICE, SLICE_BYTES = 1 << SLICE_BITS, 2_000_000  # documents, and bytes of texts, that are split at a time
MIX = np.uint64(0x9E3779B97F4A7C15)


def _encoded(docs: DataFrame) -> DataFrame:
    """(key, text): what tells rows apart that differ in id or text, and the text as bytes."""
    return docs.select(_key("doc_id", "text"), F.col("text").cast("binary").alias("text"))


def _key(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.col(doc_id).isNull(), text).alias("key")


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of SLICE rows and SLICE_BYTES of text at most, or of one row."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        most = SLICE_BYTES + (sizes[start - 1] if start else 0)
        end = min(start + SLICE, max(start + 1, int(np.searchsorted(sizes, most, "right"))))
        yield batch.slice(start, end - start)
        start = end


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, at, ends): the hashes of the different words, which of them each text's words are, and where each text's words end."""
    kind = pa.large_string() if pa.types.is_large_binary(texts.type) else pa.string()
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, b"").view(kind)))  # bytes alone, so any will do
    words = split.flatten()
    some = pc.greater(pc.binary_length(words), 0)  # blanks at a text's start or end give empty words
    before = np.concatenate(([0], np.cumsum(some.to_numpy(zero_copy_only=False))))
    coded = words.filter(some).dictionary_encode()
    different = coded.dictionary.view(texts.type).to_numpy(zero_copy_only=False)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in different), np.uint64, len(different))
    return hashes, coded.indices.to_numpy(), before[split.offsets.to_numpy()[1:]]


def _counted(docs: DataFrame) -> DataFrame:
    """(*_pieces(1), k): the words of many documents at a time and how often each occurs there."""
    names = _pieces(1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                hashes, at, _ = _words(part.column("text"))
                counts = np.bincount(at, minlength=len(hashes)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], [*names, "k"])

    return _encoded(docs).mapInArrow(count, T.StructType([T.StructField(c, T.LongType(), False) for c in (*names, "k")]))


def _pieces(n: int) -> list[str]:
    """The columns of an n-gram: the hashes of its words, so that its parts need no table of their own."""
    return [f"g{i}" for i in range(n)]


def _exploded(docs: DataFrame, n: int, starts: bool = False, turn: int = 0, passes: int = 1) -> DataFrame:
    """(*_pieces(n), key, k): the different n-grams of each document and how often each occurs; or only the one it starts with.

    Of several passes each has the n-grams of its own range of a hash.
    """
    names = _pieces(n)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                texts = part.column("text")
                if starts:
                    texts = pa.array([b" ".join((t or b"").split(None, n)[:n]) for t in texts.to_numpy(zero_copy_only=False)], texts.type)
                hashes, at, ends = _words(texts)
                words, sizes = hashes[at], np.diff(ends, prepend=0)
                owner = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
                if starts:
                    chosen = (ends - sizes)[sizes >= n]
                else:
                    chosen = np.flatnonzero(owner[n - 1 :] == owner[: len(owner) - n + 1]) if len(owner) >= n else np.empty(0, np.int64)
                mixed = np.zeros(len(chosen), np.uint64)
                for i in range(n):
                    mixed = (mixed ^ words[chosen + i]) * MIX
                    mixed ^= mixed >> np.uint64(32)
                if passes > 1:
                    mine = mixed % np.uint64(passes) == turn
                    chosen, mixed = chosen[mine], mixed[mine]
                of = owner[chosen]
                order = np.argsort((of << np.uint64(64 - SLICE_BITS)) | (mixed >> np.uint64(SLICE_BITS)))  # puts equal ones of a document together
                chosen, of = chosen[order], of[order]
                grams = np.stack([words[chosen + i] for i in range(n)])
                other = (grams[:, 1:] != grams[:, :-1]).any(axis=0) | (of[1:] != of[:-1])
                new = np.flatnonzero(np.concatenate((np.ones(min(len(of), 1), bool), other)))
                keys = part.column("key").to_numpy()[of[new].astype(np.int64)]
                counts = np.diff(np.append(new, len(of))).astype(np.int32)
                found = pa.RecordBatch.from_arrays([*map(pa.array, grams[:, new].view(np.int64)), pa.array(keys), pa.array(counts)], [*names, "key", "k"])
                for s in range(0, found.num_rows, 200_000):
                    yield found.slice(s, 200_000)

    schema = T.StructType([T.StructField(c, T.LongType(), False) for c in (*names, "key")] + [T.StructField("k", T.IntegerType(), False)])
    return _encoded(docs).mapInArrow(explode, schema)


def _values(grams: DataFrame, lower: DataFrame, n: int, backoff: float, hint: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(*_pieces(n), n, value) of n-grams with n and holders: the logarithm of what an occurrence scores.

    lower: the same of (n-1)-grams. A seen n-gram scores its count over that of its first n - 1 words, one that no other
    document holds the score of its last n - 1 words times backoff.
    """
    names, shorter = _pieces(n), _pieces(n - 1)
    first = hint(lower.select(*(F.col(c).alias(f"a{c}") for c in shorter), F.col("n").alias("before")))
    last = hint(lower.select(*(F.col(c).alias(f"b{c}") for c in shorter), F.col("value").alias("less")))
    rows = grams.join(first, [F.col(x) == F.col(f"a{c}") for x, c in zip(names[:-1], shorter)])
    rows = rows.join(last, [F.col(x) == F.col(f"b{c}") for x, c in zip(names[1:], shorter)])
    seen = F.log(F.col("n") / F.col("before"))
    value = F.when(F.col("holders") >= HOLDERS, seen).otherwise(F.lit(float(np.log(backoff))) + F.col("less"))
    return rows.select(*names, "n", value.alias("value"))


def _frequent(sizes: dict[int, int], most: int) -> int:
    """The least power of two so that at most `most` words occur as often or more. sizes: number of words by bits of their count."""
    return 1 << next(b for b in range(65) if sum(size for bits, size in sizes.items() if bits > b) <= most)


def _terms(lower: DataFrame, n: int) -> DataFrame:
    """(*less, over, below): what _rest() needs of the (n-1)-grams in lower, under the names of _sums()."""
    names = [F.col(c).alias(f"l{c}") for c in _pieces(n - 1)]
    return lower.select(*names, (-F.log("n")).alias("over"), F.col("value").alias("below"))


def _rest() -> Column:
    return F.when(F.col("seen"), F.col("over")).otherwise(F.col("below"))


@contextmanager
def _freed(spark: SparkSession) -> Iterator[None]:
    """What is run inside leaves no shuffle files: they go when a query ends, not when the driver's memory is next cleared."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _sums(dealt: DataFrame, common: DataFrame, n: int, backoff: float) -> DataFrame:
    """(key, seen, *less, score, tokens) of the dealt n-grams of documents: what they score by document.

    A seen n-gram scores its count over that of its first n - 1 words, one that no other document holds the score of its
    last n - 1 words times backoff: one (n-1)-gram has to be looked up for either. What isn't in common is left out of the
    score, and the row names it in less; else less is null.
    """
    names = _pieces(n)
    less = [f"l{c}" for c in names[:-1]]
    # The count reads all columns that the join reads, else they would be dealt twice.
    counts = dealt.groupBy(*names).agg(F.sum("k").alias("n"), F.count(F.when(F.col("k") > 0, F.col("key"))).alias("holders"))
    seen = F.col("holders") >= HOLDERS
    parts = [F.when(seen, F.col(a)).otherwise(F.col(b)).alias(c) for a, b, c in zip(names[:-1], names[1:], less)]
    sure = F.when(seen, F.log("n")).otherwise(F.lit(float(np.log(backoff))))
    table = counts.select(*names, seen.alias("seen"), sure.alias("sure"), *parts)
    table = table.join(F.broadcast(_terms(common, n)), less, "left").withColumn("rest", _rest())
    rows = dealt.join(table.hint("shuffle_hash"), names)  # Spark judges rows by the texts that they are exploded from
    left_out = F.col("rest").isNull()
    score = F.sum(F.col("k") * (F.col("sure") + F.coalesce("rest", F.lit(0.0))))
    by = [F.when(left_out, F.col(c)).alias(c) for c in ("seen", *less)]
    return rows.groupBy("key", *by).agg(score.alias("score"), F.sum("k").alias("tokens"))
def scores(
    docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF, partition: int = PARTITION, vocabulary: int = VOCABULARY,
    passes: int = PASSES, one_pass: int = ONE_PASS,
) -> DataFrame:
    """One row per row of docs: (doc_id, n_tokens, log_score, mean_log_score).

    Words are runs without ASCII blanks, A-Z lower-cased. Counts are of all documents, and n-grams don't cross from one
    to the next. A word scores count(n-gram) / count(its first n - 1 words) for the longest n up to order whose n-gram is
    seen, times backoff for each step down from the longest that fits in the text before it; a single word scores count /
    all words. An n-gram is seen if another document holds it too: by its own n-grams alone each text would be perfectly
    likely, and never back off. log_score is the sum of natural logarithms, mean_log_score the sum by word, null for texts
    without words (null, empty, blank), whose log_score is 0. Repeated rows are documents like others and are scored each;
    ids may be null and of any type. An empty table gives no rows. Words are told apart by hashes of 64 bits. Other
    columns are not read.

    What an n-gram scores does not depend on the document. So documents are exploded to rows of their different n-grams,
    dealt once by hash; each partition counts its n-grams, and joins what they score to the rows that it has. A row is one
    document's n-gram, however often it occurs there, so no n-gram has more rows than there are documents. The most
    frequent `vocabulary` of the shorter n-grams are broadcast to the table of n-grams; the rows of the others are summed
    by document and shorter n-gram, and these sums are joined. More than one_pass words are exploded in several passes
    over the documents, each for the n-grams of its range of a hash, and a pass's rows go before the next one begins.
    """
    spark = docs.sparkSession
    with _freed(spark):
        words = materialize(_counted(docs).groupBy(*_pieces(1)).agg(F.sum("k").alias("n")), "words")
        bits = words.groupBy(F.length(F.bin("n")).alias("bits")).agg(F.count("*").alias("size"), F.sum("n").alias("n")).collect()  # 63 rows at most
    size, tokens = sum(r["size"] for r in bits), sum(r["n"] for r in bits)
    known = words.withColumn("value", F.log(F.col("n") / F.lit(float(tokens or 1))))
    hint = F.broadcast if size <= vocabulary else lambda df: df
    passes = passes if tokens > one_pass else 1
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), tokens // partition)
    found = []
    for n in range(1, order):
        rows = _exploded(docs, n, starts=True)
        if n > 1:
            names = _pieces(n)
            dealt = _exploded(docs, n).repartition(parts, *names)
            counts = dealt.groupBy(*names).agg(F.sum("k").alias("n"), F.count("*").alias("holders"))
            with _freed(spark):
                known, hint = materialize(_values(counts, known, n, backoff, hint), "grams"), lambda df: df
        found.append(rows.join(hint(known), _pieces(n)))
    if order == 1:
        found.append(_exploded(docs, 1).join(hint(known), _pieces(1)))
    found = [f.select("key", (F.col("k") * F.col("value")).alias("score"), F.col("k").cast("long").alias("tokens")) for f in found]
    if order > 1:
        if order > 2:
            with _freed(spark):
                bits = known.groupBy(F.length(F.bin("n")).alias("bits")).agg(F.count("*").alias("size")).collect()
        least = _frequent({r["bits"]: r["size"] for r in bits}, vocabulary)
        common = known.where(F.col("n") >= least)
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), tokens // partition // passes)
        sums = []
        for turn in range(passes):
            dealt = _exploded(docs, order, turn=turn, passes=passes).repartition(parts, *_pieces(order))
            part = _sums(dealt, common, order, backoff)
            if passes > 1 or least > 1:
                with _freed(spark):
                    part = materialize(part, "sums")
            sums.append(part)
        rows = reduce(DataFrame.union, sums)
        found.append(rows.select("key", "score", "tokens"))
        if least > 1:
            less = [f"l{c}" for c in _pieces(order - 1)]
            rows = rows.where(F.col("seen").isNotNull()).join(_terms(known, order), less)
            found.append(rows.select("key", (F.col("tokens") * _rest()).alias("score"), F.lit(0).cast("long").alias("tokens")))
    sums = reduce(DataFrame.union, found).groupBy("key").agg(F.sum("score").alias("score"), F.sum("tokens").alias("tokens"))
    rows = docs.select("doc_id", _key("doc_id", "text"))
    copies = rows.groupBy("key").agg(F.count("*").alias("copies"))
    sums = sums.join(copies, "key").select("key", (F.col("score") / F.col("copies")).alias("score"), (F.col("tokens") / F.col("copies")).cast("long").alias("n"))
    n, score = F.coalesce("n", F.lit(0)).cast("long"), F.coalesce("score", F.lit(0.0))
    return rows.join(sums, "key", "left").select(
        "doc_id", n.alias("n_tokens"), score.alias("log_score"), F.when(n > 0, score / n).alias("mean_log_score")
    )
