"""URL filter: host and path rules first, then gradient-boosted trees on lexical features; DataFrame functions only."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialize

#: Rule -> verdict.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
TREES, DEPTH, STEP, SEED = 20, 4, 0.3, 11
TRAINING_ROWS = 200_000  # about as many labelled URLs, chosen by hash, train the trees
SMOOTHING = 2.0  # pseudo-counts of a suffix's share
SUFFIXES = 100_000  # a table of more suffixes is joined by shuffle
FOLDS = 5  # a training row's suffix statistics are of the labelled URLs of the other folds
HELD_OUT = 0  # of pmod(xxhash64(url), 10): URLs that train nothing and are in no statistics, so that the trees can be judged
FEATURES = (
    "length", "host_length", "path_length", "depth", "digit_ratio", "entropy", "parameters", "labels", "hyphens", "secure", "suffix_share", "suffix_seen",
)


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null and without ://."""
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; empty for null and without ://."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def rule_of(host: Column, path: Column, rules: dict[str, str] = RULES) -> Column:
    """The longest rule that fits: its host or a subdomain of it, and a path that starts with its own; else null."""
    fits = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, _, rest = rule.partition("/")
        fit = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        fits = F.when(fit, F.lit(rule)).otherwise(fits)
    return fits


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _lexical(urls: DataFrame) -> DataFrame:
    """Adds the features that a URL has by itself; those of null and empty URLs are 0."""
    url = F.coalesce("url", F.lit(""))
    size = F.length(url).cast("double")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    signs = F.split(url, "")
    share = lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / size
    bits = F.aggregate(F.array_distinct(F.filter(signs, lambda c: c != "")), F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c)))
    named = {
        "length": size, "host_length": F.length("host").cast("double"), "path_length": F.length("path").cast("double"),
        "depth": _count(F.col("path"), "/[^/]+"), "digit_ratio": F.when(size > 0, _count(url, "[0-9]") / size).otherwise(0.0),
        "entropy": F.when(size > 0, bits).otherwise(0.0), "parameters": _count(query, "[^&]+"),
        "labels": _count(F.col("host"), "[^.]+"), "hyphens": _count(url, "-"), "secure": url.startswith("https:").cast("double"),
    }
    return urls.withColumns(named).withColumn("suffix", F.regexp_extract("host", r"([^.]*)$", 1))


def _held_out(url: Column) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(10)) == HELD_OUT


def judge(pages: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """One row per row of pages: (page_id, host, path, rule, verdict, score).

    verdict is the rule's where one fits, else 'block' if the trees' score (0 to 1) is 0.5 or more. The URLs that rules
    fit are the labelled ones: they train the trees (a documented number of them, chosen by hash) and give the suffix
    statistics (all of them): the smoothed share of blocked URLs by last label of the host, and how many there are; in
    training those of the other folds alone, so that no label is an input of its own row. One labelled URL in ten, by
    hash, is held out of both. If only one verdict occurs among them, it is everyone's; if there are none, 'allow'. Null URLs and those without
    :// have an empty host and path. Repeated rows are judged alike. Other columns are not read.
    """
    urls = pages.select("page_id", "url")
    urls = urls.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    urls = urls.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    ruled = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        ruled = F.when(F.col("rule") == rule, verdict).otherwise(ruled)
    urls = materialize(_lexical(urls.withColumn("ruled", ruled)), "urls")
    known = urls.where("ruled is not null").withColumn("label", (F.col("ruled") == "block").cast("double"))
    rows, blocked = known.agg(F.count("*"), F.sum("label")).first()
    shown = ("page_id", "host", "path", "rule")
    if not rows or blocked in (0, rows):
        one = "block" if rows and blocked else "allow"
        return urls.select(*shown, F.coalesce("ruled", F.lit(one)).alias("verdict"), F.lit(float(one == "block")).alias("score"))
    prior = blocked / rows
    label, fold = (F.col("ruled") == "block").cast("double"), F.floor(F.pmod(F.xxhash64("url"), F.lit(10 * FOLDS)) / 10).cast("int")
    known = known.where(~_held_out(F.col("url")))
    by_fold = materialize(known.groupBy("suffix", fold.alias("fold")).agg(F.count("*").alias("n"), F.sum("label").alias("bad")), "suffixes")
    total = by_fold.groupBy("suffix").agg(F.sum("n").alias("all"), F.sum("bad").alias("all_bad"))
    folds = F.explode(F.sequence(F.lit(0), F.lit(FOLDS))).alias("fold")  # the last one, which holds no URL, is left out of nothing
    suffixes = total.select("*", folds).join(by_fold, ["suffix", "fold"], "left").fillna(0)
    bad, n = F.col("all_bad") - F.col("bad"), F.col("all") - F.col("n")
    suffixes = materialize(
        suffixes.select("suffix", "fold", ((bad + SMOOTHING * prior) / (n + SMOOTHING)).alias("suffix_share"), F.log1p(n.cast("double")).alias("suffix_seen")), "shares"
    )
    if suffixes.count() <= SUFFIXES:
        suffixes = F.broadcast(suffixes)

    def featured(urls: DataFrame) -> DataFrame:
        joined = urls.join(suffixes, ["suffix", "fold"], "left").fillna({"suffix_share": prior, "suffix_seen": 0.0})
        return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(joined)

    chosen = F.pmod(F.xxhash64("url", "page_id"), F.lit(1 << 20)) < min(1.0, TRAINING_ROWS / rows) * (1 << 20)
    training = urls.where(F.col("ruled").isNotNull() & chosen & ~_held_out(F.col("url"))).withColumns({"fold": fold, "label": label})
    training = featured(training).select("features", "label")
    if training.groupBy("label").count().count() < 2:  # all URLs of a verdict are held out
        return urls.select(*shown, F.coalesce("ruled", F.lit("block" if prior >= 0.5 else "allow")).alias("verdict"), F.lit(prior).alias("score"))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED, cacheNodeIds=False, checkpointInterval=-1)
    scored = trees.fit(training).transform(featured(urls.withColumn("fold", F.lit(FOLDS)))).withColumn("score", vector_to_array("probability")[1])
    learned = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select(*shown, F.coalesce("ruled", learned).alias("verdict"), "score")
