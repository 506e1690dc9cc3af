"""SimHash near-duplicates: fingerprints, an index by positional bytes with count filtering, and components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations
from math import acos, ceil, log, log2, pi, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import IDS, materialize, only_first, quoted, text_key, without
from .components import connected_components

SEED = 42
SHINGLE = 3
BYTES = 8
MAX_BITS = 3
LIST = 2_048  # entries of the index that one task holds against one another; longer lists are cut
SALTS = 32  # tasks that the members of one large component are named in

COPY_SHINGLE = 5
COPY_SIMILARITY = 0.8
COPY_MISSED = 0.1  # chance at most that a pair just at the similarity is no candidate
COPY_NEIGHBOURS = 2  # that follow a text in a list and are compared first; then all others that these don't link already
MARKS = 6  # numbers of 64 bits of the wide fingerprint that are compared where two texts meet


def _shingles(text: bytes | None, width: int) -> tuple[bytes, np.ndarray]:
    """The words joined by blanks, A-Z lower-cased, and the XXH64 of all shingles, repeats included; none of no words."""
    words = (text or b"").lower().split()  # of bytes: A-Z alone, and the six ASCII blanks
    joined = b" ".join(words)
    if not words:
        return joined, np.empty(0, np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    return joined, np.array([digest(joined[s:e], SEED) for s, e in spans], dtype="<u8")


def _majority(hashes: np.ndarray, spread: int = 1) -> np.ndarray:
    """Bits (64 x spread) that are set in over half of the hashes; each hash is spread to so many words by mixing it anew."""
    ones = np.zeros(64 * spread, dtype=np.int64)
    odd = np.random.default_rng(SEED).integers(1, 1 << 63, spread, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for at in range(0, len(hashes), 255):  # so many ones fit a byte
        block = hashes[at : at + 255, None]
        if spread > 1:
            block = (block ^ (block >> np.uint64(31))) * odd
            block ^= block >> np.uint64(29)
        bits = np.unpackbits(np.ascontiguousarray(block).view(np.uint8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return 2 * ones > len(hashes)


def _fingerprint(text: bytes | None) -> int:
    return int(np.packbits(_majority(_shingles(text, SHINGLE)[1]), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp bigint): the 64-bit SimHash of each whole text.

    A-Z is lower-cased, words are runs without ASCII blanks, shingles are three words joined by a space, each hashed by
    XXH64 with seed 42; repeats count. Fewer words make one shingle; null, empty and blank texts get 0. Other columns of
    docs are not read.
    """
    ids = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("binary").alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([_fingerprint(x.as_py()) for x in batch.column(1)], dtype="<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["id", "fp"])

    return ids.mapInArrow(hashed, ids.select("id", F.lit(0).cast("long").alias("fp")).schema)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _shared_bytes(a: Column, b: Column) -> Column:
    """The tally of a pair: how many of the eight positional bytes two fingerprints share."""
    x = a.bitwiseXOR(b)
    return sum(((x.bitwiseAND(F.lit(_signed(255 << 8 * i)))) == 0).cast("int") for i in range(BYTES))


def _long_lists(lists: DataFrame) -> DataFrame:
    """(place, piece, blocks) of the lists (place, piece, ...) of more than LIST nodes, and into how many blocks each is cut."""
    long = lists.groupBy("place", "piece").agg(F.count("*").alias("n")).where(F.col("n") > LIST)
    return materialize(long.withColumn("blocks", F.ceil(F.col("n") / LIST).cast("int")).drop("n"), "lists")


def _cut(lists: DataFrame, long: DataFrame) -> DataFrame:
    """lists with `blocks` and `block`, by a hash of the node; null and 0 for lists that are not long."""
    hinted = F.broadcast(long) if long.count() <= IDS else long
    block = F.coalesce(F.pmod(F.xxhash64("node", "place"), "blocks"), F.lit(0)).cast("int")
    return lists.join(hinted, ["place", "piece"], "left").withColumn("block", block)


Side = Callable[[str], Column]  # from names to the columns of one node of a pair


def meetings(listed: DataFrame, test: Callable[[Side, Side], Column]) -> DataFrame:
    """(a, b): pairs of nodes, a < b, that have a piece in common in some place and pass the test; a row for each such place.

    listed: (node long, pieces array<long>) and what the test reads, each node once; test(l, r) gets a function from names
    to columns for either node. The index lists, for each place and piece, the nodes that have it. A list of more than
    LIST nodes is cut into blocks by a hash of the node, and pairs of blocks are joined by themselves, so no list, however
    long, is joined in one task; none is dropped. The test is part of the join, so pairs that fail it are never rows. The
    joins are hinted: Spark judges the lists by the size of the table that they are exploded from, and may broadcast them.
    """
    lists = listed.select(*(c for c in listed.columns if c != "pieces"), F.posexplode("pieces").alias("place", "piece"))
    return _pairs(*_sides(lists, _long_lists(lists)), test)


def _sides(lists: DataFrame, long: DataFrame) -> tuple[DataFrame, DataFrame, Column]:
    """The lists (node, place, piece, ...) as l and as r, and when two entries meet: each pair of a list once, its lists' blocks by pairs."""
    on, across, left, right = ["place", "piece"], F.lit(False), lists, lists
    if not long.isEmpty():
        cut = _cut(lists, long)
        last = F.coalesce(F.col("blocks"), F.lit(1)) - 1
        left = cut.withColumns({"i": F.col("block"), "j": F.explode(F.sequence("block", last))})
        right = cut.withColumns({"j": F.col("block"), "i": F.explode(F.sequence(F.lit(0), F.col("block")))})
        on, across = [*on, "i", "j"], F.col("l.i") < F.col("l.j")
    same = reduce(Column.__and__, (_l(c) == _r(c) for c in on))
    return left.alias("l"), right.alias("r"), same & (across | (_l("node") < _r("node")))


def _l(name: str) -> Column:
    return F.col(f"l.{name}")


def _r(name: str) -> Column:
    return F.col(f"r.{name}")


def _pairs(left: DataFrame, right: DataFrame, meet: Column, test: Callable[[Side, Side], Column]) -> DataFrame:
    pairs = left.join(right.hint("merge"), meet & test(_l, _r))
    return pairs.select(F.least(_l("node"), _r("node")).alias("a"), F.greatest(_l("node"), _r("node")).alias("b"))


def _met(left: DataFrame, right: DataFrame, meet: Column, test: Callable[[Side, Side], Column], columns: list[str]) -> DataFrame:
    """The entries (columns) that meet any other that passes the test: a row for each entry, not for each pair."""
    one = left.join(right.hint("merge"), meet & test(_l, _r), "left_semi").select(*map(_l, columns))
    return one.union(right.join(left.hint("merge"), meet & test(_l, _r), "left_semi").select(*map(_r, columns))).distinct()


def fingerprint_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): all pairs of distinct fingerprints (column fp) that differ in at most max_bits (0 to 4) bits.

    Differing bits spoil at most max_bits of the eight positional bytes, so a pair shares at least 8 - max_bits of them,
    and 7 - max_bits of the first seven. A list for one byte would hold 1/256 of the corpus, so the index is keyed by that
    many of the first seven at once (35 keys of four bytes for three bits): no pair can miss all of its keys. Pairs that
    meet are tallied by shared bytes, dropped under 8 - max_bits, and verified bit by bit. Tally and test are made where
    a pair meets: grouping all meetings would put out all pairs of each list. Repeats from several keys are merged.
    """
    masks = [_signed(sum(255 << 8 * i for i in places)) for places in combinations(range(BYTES - 1), BYTES - 1 - max_bits)]
    listed = distinct.select(F.col("fp").alias("node"), F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in masks)).alias("pieces"))

    def near(l: Side, r: Side) -> Column:
        differing = F.bit_count(l("node").bitwiseXOR(r("node")))
        return (_shared_bytes(l("node"), r("node")) >= BYTES - max_bits) & (differing <= max_bits)

    return meetings(listed, near).distinct()


def _ends(pairs: DataFrame) -> DataFrame:
    """(node): a row for each end of each pair."""
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))


def _named(distinct: DataFrame, links: DataFrame) -> DataFrame:
    """(node, first) of distinct (node, least): the least of each node's component."""
    grouped = materialize(connected_components(links), "grouped")
    linked = distinct.join(grouped, "node").withColumn("salt", F.pmod("node", F.lit(SALTS)))
    first = linked.groupBy("component").agg(F.min("least").alias("first"))
    first = first.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    named = linked.join(first.hint("merge"), ["component", "salt"]).select("node", "first")
    return named.union(distinct.join(grouped, "node", "left_anti").select("node", F.col("least").alias("first")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of docs: (id_col, fingerprint, component_id, n_links).

    fingerprint: 16 lower-case hex digits. component_id: the smallest id that can be reached over links of at most
    max_bits differing bits, itself included; ids may be of any type that has an order. n_links: other distinct
    fingerprints linked to the row's own. Rows with equal fingerprints are merged before the search, so copies are never
    paired. A null id gets a row and is never a component's id, unless all of its component's ids are null (then null). An
    empty table gives no rows; columns of docs besides the two are ignored and may have any name.
    """
    fps = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = materialize(fps.groupBy(F.col("fp").alias("node")).agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("least")), "distinct")
    links = materialize(fingerprint_links(distinct.select(F.col("node").alias("fp")), max_bits), "links")
    degree = _ends(links).groupBy("node").agg(F.count("*").alias("n_links"))
    # Written down, so that the rows are joined to a table as it is: Spark can split what many copies have in common.
    named = materialize(_named(distinct, links).join(degree, "node", "left").withColumnRenamed("node", "fp"), "named")
    return fps.join(named, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def _differing(similarity: float) -> float:
    """The chance that a bit differs between sets of that Jaccard similarity J and about one size: their cosine is 2 J / (1 + J)."""
    return acos(2 * similarity / (1 + similarity)) / pi


def _pieces_for(rows: int, similarity: float, missed: float = COPY_MISSED) -> tuple[int, int]:
    """(bits, pieces): how many bits a piece has, and how many pieces a fingerprint, for so many texts.

    Pieces have as many bits as a number up to rows, so that a list holds about one text by chance (26 at most: beyond
    10**8 texts lists get longer, not pieces more). There are so many that a pair at the similarity shares none of them
    with a chance of `missed` at most.
    """
    bits = min(26, max(12, ceil(log2(max(rows, 2)))))
    return bits, ceil(log(missed) / log(1 - (1 - _differing(similarity)) ** bits))


def _signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int, bits: int, pieces: int) -> DataFrame:
    """(id, key, node, marks, pieces): each row's text_key(), a hash of its words, MARKS numbers of its wide fingerprint, and all its pieces.

    The fingerprint is of the set of shingles, as the similarity is: a shingle counts once, however often it is repeated.
    """
    ids = docs.select(F.col(quoted(id_col)).alias("id"), text_key(text_col).alias("key"), F.col(quoted(text_col)).cast("binary").alias("text"))
    spread, place = max(MARKS, -(-bits * pieces // 64)), 1 << np.arange(bits, dtype=np.int64)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, marks, found = [], [], []
            for text in batch.column(2):
                joined, hashes = _shingles(text.as_py(), shingle)
                ones = _majority(np.unique(hashes), spread)
                nodes.append(_signed(xxhash.xxh64_intdigest(joined, SEED)))
                marks.append(np.packbits(ones[: 64 * MARKS], bitorder="little").view("<i8"))
                found.append(ones[: bits * pieces].reshape(pieces, bits) @ place)
            numbers = [pa.array(x, pa.list_(pa.int64())) for x in (marks, found)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), *numbers], ["id", "key", "node", "marks", "pieces"])

    numbers = F.array().cast("array<bigint>")
    made = ids.select("id", "key", F.lit(0).cast("long").alias("node"), numbers.alias("marks"), numbers.alias("pieces"))
    return ids.mapInArrow(signed, made.schema)


def _shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles array<int>): the distinct shingles of texts (node, text), each as 32 bits of its hash."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(_shingles(x.as_py(), shingle)[1].astype(np.uint32)).view(np.int32) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int32()))], ["node", "shingles"])

    return texts.select("node", F.col("text").cast("binary").alias("text")).mapInArrow(hashed, "node long, shingles array<int>")


def _differ(x: Side, y: Side) -> Column:
    """How many of the 64 * MARKS bits in m0, m1, ... differ."""
    return reduce(Column.__add__, (F.bit_count(x(f"m{i}").bitwiseXOR(y(f"m{i}"))) for i in range(MARKS)))


def _neighbours(listed: DataFrame, bits: int, most: int) -> DataFrame:
    """(a, b): nodes that follow one another in a list, ordered by the pieces that come next, and whose marks are near.

    So the likest nodes of a list are neighbours; marks are compared before a pair is a row.
    """
    after = lambda i, k: F.coalesce(F.get("pieces", i + k), F.get("pieces", i + k - F.size("pieces")))
    entries = F.transform("pieces", lambda x, i: F.struct(i.alias("place"), x.alias("piece"), (F.shiftleft(after(i, 1), min(bits, 31)) + after(i, 2)).alias("after")))
    marks = [f"m{i}" for i in range(MARKS)]
    lists = listed.select("node", *marks, F.explode(entries).alias("entry")).select("node", *marks, "entry.*")
    order = Window.partitionBy("place", "piece", "block").orderBy("after", "node")
    nexts = [F.lead(F.struct("node", *marks), k).over(order).alias(f"next{k}") for k in range(1, COPY_NEIGHBOURS + 1)]
    rows = _cut(lists, _long_lists(lists)).select("node", *marks, *nexts)
    near = [F.when(_differ(F.col, lambda m, k=k: F.col(f"next{k}.{m}")) <= most, F.col(f"next{k}.node")) for k in range(1, COPY_NEIGHBOURS + 1)]
    pairs = rows.select("node", F.explode(F.array_compact(F.array(*near))).alias("next"))
    return pairs.select(F.least("node", "next").alias("a"), F.greatest("node", "next").alias("b")).distinct()


def _others(listed: DataFrame, grouped: DataFrame, most: int, sets_of: Callable[[DataFrame], DataFrame], alike: Callable[[Column, Column], Column]) -> DataFrame:
    """(a, b): all pairs of nodes in a list that grouped (node, component) does not link, whose marks are near and whose sets are alike.

    Lists of COPY_NEIGHBOURS + 1 nodes at most were compared in full as neighbours, and lists of one component need no
    link; of all other lists, however long, every pair of different components meets. A crowd of half-alike texts has as
    many such pairs as the square of its size, so they are not put out as candidates: first entries that meet any are
    found, a row for each entry, then these meet again with their sets, and only links are rows.
    """
    of = listed.join(grouped, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lists = of.select("node", "component", F.posexplode("pieces").alias("place", "piece"))
    stats = lists.groupBy("place", "piece").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = materialize(stats.where((F.col("n") > COPY_NEIGHBOURS + 1) & (F.col("low") < F.col("high"))).select("place", "piece"), "mixed")
    hinted = F.broadcast(mixed) if mixed.count() <= IDS else mixed
    chosen = materialize(lists.join(hinted, ["place", "piece"]).join(listed.drop("pieces"), "node"), "lists")

    def near(l: Side, r: Side) -> Column:
        return (l("component") != r("component")) & (_differ(l, r) <= most)

    entries = materialize(_met(*_sides(chosen, _long_lists(chosen)), near, chosen.columns), "entries")
    long = _long_lists(entries)
    whole = entries.join(sets_of(entries.select("node").distinct()), "node")
    return _pairs(*_sides(whole, long), lambda l, r: near(l, r) & alike(l("shingles"), r("shingles"))).distinct()


def _sets(docs: DataFrame, keys: DataFrame, nodes: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """(node, shingles) of the nodes; keys: (node, key) of all nodes' texts. Only texts of these nodes are moved."""
    wanted = materialize(keys.join(nodes, "node"), "wanted")
    hint = F.broadcast if wanted.count() <= IDS else lambda df: df
    texts = docs.select(text_key(text_col).alias("key"), F.col(quoted(text_col)).alias("text")).join(hint(wanted), "key")
    # Copies of one text are one row before texts are hashed: any of them holds the same words.
    return materialize(_shingle_sets(texts.groupBy("node").agg(F.any_value("text").alias("text")), shingle), "shingles")


def copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = COPY_SHINGLE, similarity: float = COPY_SIMILARITY
) -> DataFrame:
    """(id, key, first): for each row of docs the least (none, id, key) of its group of near copies; key is text_key().

    Texts are near copies if the sets of their shingles (five words, A-Z lower-cased) have a Jaccard similarity of at least
    0.8; groups are what hangs together by that. Texts of the same words are one before the search; those without words
    are copies of one another. SimHash fingerprints wide enough for that similarity are indexed by their pieces; pairs that
    share a piece, and whose first 384 bits don't differ in far more bits than such copies do, are compared by their whole
    sets. A pair at the similarity itself is found with a chance of about 0.9 or more, nearer
    ones with a greater one; the widths follow the number of rows, so the chance is the same at every size.

    A group of n different near copies has n * n pairs. So each list, in the order of the pieces that come next, is first
    compared with the following COPY_NEIGHBOURS of each entry, the likest ones, which links most of a group. Then all
    pairs of a list, of every length, that are not in one group yet are compared too. No list is cut short: a pair is left
    out only if its texts are in one group already, where its link changes nothing. Only texts of candidates are moved.
    """
    bits, pieces = _pieces_for(docs.count(), similarity)
    q, n = _differing(similarity), 64 * MARKS
    most = ceil(n * q + 4 * sqrt(n * q * (1 - q)))
    rows = materialize(_signatures(docs, id_col, text_col, shingle, bits, pieces), "signatures")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    distinct = rows.groupBy("node").agg(F.min(order).alias("least"), F.any_value("marks").alias("marks"), F.any_value("pieces").alias("pieces"))
    distinct = materialize(distinct.select("node", "least", "pieces", *(F.get("marks", F.lit(i)).alias(f"m{i}") for i in range(MARKS))), "distinct")
    listed, keys = distinct.drop("least"), distinct.select("node", F.col("least.key").alias("key"))

    sets_of = lambda nodes: _sets(docs, keys, nodes, text_col, shingle)

    def alike(x: Column, y: Column) -> Column:
        shared = F.size(F.array_intersect(x, y))
        return shared >= similarity * (F.size(x) + F.size(y) - shared)

    pairs = materialize(_neighbours(listed, bits, most), "candidates")
    sets = sets_of(_ends(pairs).distinct())
    near = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    near = near.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    links = near.where(alike(F.col("x"), F.col("y"))).select("a", "b")
    grouped = materialize(connected_components(links), "grouped")
    more = materialize(_others(listed, grouped, most, sets_of, alike), "links")
    links = grouped.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)
    named = materialize(_named(distinct.select("node", "least"), links), "named")
    return rows.select("id", "key", "node").join(named, "node").select("id", "key", "first")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = COPY_SHINGLE, similarity: float = COPY_SIMILARITY) -> DataFrame:
    """One row of each group of copies() stays, with all its columns: that of the least id, then the least text_key().

    Rows are told apart by id and text, so different texts that share an id, or have none, are judged each for itself; a
    null id comes after all others. Of rows that repeat both, the least by a hash of all columns stays. Null, empty and
    blank texts are one group. Very long texts are taken whole. An empty table gives no rows.
    """
    rows = materialize(copies(docs, id_col, text_col, shingle, similarity), "copies")
    of = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    kept = only_first(docs, rows.where(of.eqNullSafe(F.col("first"))).groupBy("id", "key").count().where("count > 1"), id_col, text_col)
    return without(kept, rows.where(~of.eqNullSafe(F.col("first"))), id_col, text_col)
