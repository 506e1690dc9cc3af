"""Mixing sources to target weights: capped water-filling, and seeded whole and fractional repetitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, rank_globally

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = 42
BUCKETS_HEX = 3  # a source's documents are put in order by 16 ** 3 hash buckets, then within each


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, weight, target) from rows (source, size).

    Sources by code point, null last, take the weights in turn. They share the sum of all sizes by weight, no more than
    max_epochs times their own size each; what is cut off is shared by weight among the rest until none is above. A
    source is cut off the earlier the less its cap is for its weight. So with sources in that order, the level (words for
    a weight of 1) is what the caps before one leave of the total, over the weights from it on, at the place where that
    is greatest: one running sum over the table of sources. Sources of size 0, and all of them if all are, get 0.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("_null", F.col("source").isNull())
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = rank_globally(sources, "_null", "source").select("source", "source_size", turn.cast("double").alias("weight"))
    ranked = materialize(ranked.withColumn("cap", (F.col("source_size") * max_epochs).cast("double")), "sources")
    total, weight = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(float(total or 0)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    free = F.lit(float(weight or 1)) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = ranked.select((left / free).alias("level")).agg(F.max("level")).first()[0] or 0.0
    return ranked.withColumn("target", F.round(F.least("cap", F.col("weight") * level), 6)).drop("cap")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """One row per row of docs: (doc_id, size, source_size, target, taken, repetitions).

    size: words (runs without ASCII blanks) of the text, 0 for null. A document is taken floor(target / source_size)
    whole times, and once more if it comes early enough in its source's seeded order (the md5 of seed and doc_id, then
    size): documents are added in that order while their middle word is within what the whole repetitions leave of the
    target. A source's taken words so differ from its target by half a document at most. Repeated rows are documents of
    their own; a row with a null doc_id has its place by a hash of its text. An empty table gives no rows. Other columns are not read.

    The order's running sums are taken in two steps, over a source's hash buckets and within each, so no source, however
    large, is summed in one task.
    """
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    unnamed = F.concat(F.lit("null:"), F.md5(F.coalesce("text", F.lit(""))))  # so that rows without an id have places of their own
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), unnamed)))
    sizes = docs.select(
        "doc_id", "source", F.coalesce(words, F.lit(0)).cast("long").alias("size"), order.alias("order")
    )
    sizes = materialize(sizes.withColumn("bucket", F.substring("order", 1, BUCKETS_HEX)), "sizes")
    targets = source_targets(sizes, weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    buckets = sizes.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("before", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)))
    b = buckets.alias("b").join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
    b = b.select("b.source", "bucket", "before", "source_size", "target", "whole", "rest")
    rows = sizes.alias("d").join(b.alias("b"), F.col("d.source").eqNullSafe(F.col("b.source")) & (F.col("d.bucket") == F.col("b.bucket")))
    rows = rows.select("doc_id", "size", "order", "d.source", "d.bucket", "before", "source_size", "target", "whole", "rest")
    within = Window.partitionBy("source", "bucket").orderBy("order", "size", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0)) + F.col("size") / 2
    repetitions = F.least(F.col("whole") + (middle <= F.col("rest")).cast("long"), F.lit(max_epochs)).cast("long")
    return rows.withColumn("repetitions", repetitions).select(
        "doc_id", "size", "source_size", "target", (F.col("repetitions") * F.col("size")).alias("taken"), "repetitions"
    )
