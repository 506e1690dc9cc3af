"""Embedding near-duplicates by sorted projection passes, block against block where these are crowded, components, and exact
link counts within components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, quoted, rank_globally
from .components import connected_components

COSINE = 0.98
PASSES = 12  # at least; more for labels of many vectors
BITS = 62  # of a pass's signature
NEIGHBOURS = 32  # that follow a vector in a pass's order and are compared with it
BLOCK = 8_192  # vectors that one task compares with their neighbours
MEMBERS = 8_192  # vectors of components that are held at once while links are counted
MISSED = 0.01  # vectors whose links all passes would miss with a greater chance are crowded
SAME = 1 - np.arccos(COSINE) / np.pi  # chance that a random hyperplane does not part the ends of the widest link
SEED = 7


def _matrix(vectors: pd.Series) -> np.ndarray:
    """Unit rows in double precision; scaled first, so that no square overflows."""
    m = np.stack(vectors.to_numpy()).astype(np.float64)
    m /= np.abs(m).max(axis=1)[:, None]
    return m / np.linalg.norm(m, axis=1)[:, None]


def _prepared(vectors: DataFrame, id_col: str) -> DataFrame:
    """(id, label, embedding), where the embedding of a vector that can't link is null."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists("embedding", lambda x: x != 0)
    fit = F.col(quoted(id_col)).isNotNull() & F.col("label").isNotNull() & ~bad & ~zero
    return vectors.select(F.col(quoted(id_col)).cast("long").alias("id"), "label", F.when(fit, F.col("embedding")).alias("embedding"))


def _passes(vectors: int) -> int:
    """So many that evenly spread vectors of one label are not crowded."""
    prefix = max(0.0, np.log2(max(vectors, 1) / NEIGHBOURS)) + 1
    return max(PASSES, int(np.ceil(np.log(MISSED / 2) / np.log1p(-(SAME**prefix)))))


def _signatures(passes: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """For each pass, the signs of BITS random projections concatenated to one number; vectors of any length."""

    def signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, part in batch.groupby(batch["embedding"].map(len)):
                planes = np.random.default_rng((SEED, size)).standard_normal((size, passes * BITS))
                signs = (_matrix(part["embedding"]) @ planes >= 0).reshape(len(part), passes, BITS)
                keys = signs @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                yield part[["uid", "label"]].assign(size=size, keys=list(keys))

    return signed


def _forest(links: np.ndarray) -> np.ndarray:
    """Links (n x 2) that hold the same nodes together, at most one for each node: to the smallest that it reaches."""
    nodes, ends = np.unique(links, return_inverse=True)
    a, b = ends.reshape(-1, 2).T
    least = np.arange(len(nodes))
    while True:
        before = least.copy()
        both = np.minimum(least[a], least[b])
        np.minimum.at(least, a, both)
        np.minimum.at(least, b, both)
        least = least[least]
        if (least == before).all():
            hung = least != np.arange(len(nodes))
            return np.stack([nodes[least[hung]], nodes[hung]], axis=1)


def _log_miss(keys: np.ndarray) -> np.ndarray:
    """For vectors in a pass's order, the logarithm of the greatest chance that the pass misses a link of theirs.

    A pair that shares more bits than the vector NEIGHBOURS places away is among the neighbours.
    """
    shared = np.full(len(keys), -1)
    if len(keys) > NEIGHBOURS:
        across = BITS - np.frexp((keys[NEIGHBOURS:] ^ keys[:-NEIGHBOURS]).astype(np.float64))[1]
        shared[NEIGHBOURS:] = across
        shared[:-NEIGHBOURS] = np.maximum(shared[:-NEIGHBOURS], across)
    return np.log(np.maximum(1 - SAME ** (shared + 1.0), 1e-9))


def _neighbours(group: pd.DataFrame) -> pd.DataFrame:
    """What the linked pairs among the neighbours of one block hold together, and the _log_miss of the block's own vectors."""
    group = group.sort_values("rank", ignore_index=True)
    lists = group.groupby(["pass", "label", "size"], sort=False).ngroup().to_numpy()
    nodes, again, links = group["node"].to_numpy(), group["again"].to_numpy(), [np.empty((0, 2), np.int64)]
    keys, missed = group["key"].to_numpy(), np.zeros(len(group))
    for part in np.split(np.arange(len(lists)), np.flatnonzero(np.diff(lists)) + 1):
        m, own, fresh = _matrix(group["embedding"].iloc[part]), nodes[part], ~again[part]
        missed[part] = _log_miss(keys[part])
        for d in range(1, min(NEIGHBOURS, len(part) - 1) + 1):
            near = (np.einsum("ij,ij->i", m[:-d], m[d:]) >= COSINE) & fresh[d:] & (own[:-d] != own[d:])
            links.append(np.stack([own[:-d][near], own[d:][near]], axis=1))
    found = _forest(np.concatenate(links))
    links = pd.DataFrame({"a": found[:, 0], "b": found[:, 1]}, dtype="Int64")
    return pd.concat([links, pd.DataFrame({"uid": group["uid"][~again].astype("Int64"), "missed": missed[~again]})])[["a", "b", "uid", "missed"]]


def _crossed(group: pd.DataFrame) -> pd.DataFrame:
    """What the linked pairs of the vectors of one block, or of two blocks, hold together."""
    out = [np.empty((0, 2), np.int64)]
    alone = bool(group["i"].iloc[0] == group["j"].iloc[0])
    for _, g in group.groupby(["label", "size"]):
        left = g if alone else g[g["part"] == g["i"]]
        right = g if alone else g[g["part"] == g["j"]]
        if not len(left) or not len(right):
            continue
        names, roots = np.unique(g["node"]), np.arange(g["node"].nunique())
        at, to = np.searchsorted(names, left["node"]), np.searchsorted(names, right["node"])
        l, m, links = _matrix(left["embedding"]), _matrix(right["embedding"]).T, np.empty((0, 2), np.int64)
        for s in range(0, len(left), 256):
            near = l[s : s + 256] @ m >= COSINE
            near &= roots[at[s : s + 256]][:, None] != roots[to][None]  # what hangs together needs no more links
            x, y = np.nonzero(near)
            if len(x):
                links = _forest(np.concatenate([links, np.stack([at[s + x], to[y]], axis=1)]))
                roots[links[:, 1]] = links[:, 0]
        out.append(names[links])
    found = np.concatenate(out)
    return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})


def _crowded_links(distinct: DataFrame, crowded: DataFrame) -> DataFrame:
    """(a, b): what all pairs of crowded vectors (uid) of a label hold together, block against block as in _counted."""
    members = distinct.join(crowded, "uid").select("label", F.size("embedding").alias("size"), "uid")
    ranked = rank_globally(members, "label", "size", "uid").withColumn("part", F.floor(F.col("rank") / BLOCK)).drop("rank")
    spans = ranked.groupBy("label", "size").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    met = F.transform(F.sequence("low", "high"), lambda x: F.struct(F.least("part", x).alias("i"), F.greatest("part", x).alias("j")))
    places = ranked.join(spans, ["label", "size"]).select("uid", "size", "part", F.explode(met).alias("met"))
    dealt = places.join(distinct.hint("merge"), "uid").select("label", "size", "uid", "node", "embedding", "part", "met.i", "met.j")
    return dealt.groupBy("i", "j").applyInPandas(_crossed, "a long, b long")


def component_links(distinct: DataFrame) -> DataFrame:
    """(a, b): what the verified pairs of distinct vectors (uid, label, embedding, node) hold together.

    A pass orders the vectors of a label by the concatenation of its random hashes, of which near vectors share a long
    beginning; every vector is compared with the NEIGHBOURS after it. Passes are ordered together by one range exchange
    and cut into blocks of equal length by rank, so that no label, however large, makes a task larger than others; the
    last vectors of a block are sent to the next one too, so that no neighbours are missed at a cut. A block puts out a
    forest of its verified pairs, at most a link for each vector: a dense group would have NEIGHBOURS times as many.

    Where many vectors share long beginnings without being links, the passes would miss links: how far a vector's
    neighbours reach in each pass gives the chance of it, and vectors for which it is above MISSED are compared with all
    others of that kind in their label. A link with one end that is not crowded is found from that end.
    """
    label = distinct.schema["label"].dataType.simpleString()
    largest = distinct.groupBy("label", F.size("embedding")).count().agg(F.max("count")).first()[0] or 0
    keyed = distinct.select("uid", "label", "embedding").mapInPandas(_signatures(_passes(largest)), f"uid long, label {label}, size int, keys array<long>")
    ranked = rank_globally(keyed.select("uid", "label", "size", F.posexplode("keys").alias("pass", "key")), "pass", "label", "size", "key", "uid")
    block, late = F.floor(F.col("rank") / BLOCK), F.col("rank") % BLOCK >= BLOCK - NEIGHBOURS
    places = ranked.withColumn("block", F.explode(F.when(late, F.array(block, block + 1)).otherwise(F.array(block))))
    places = places.withColumn("again", block < F.col("block"))  # sent from the block before
    dealt = places.join(distinct.select("uid", "node", "embedding"), "uid")
    found = materialize(dealt.groupBy("block").applyInPandas(_neighbours, "a long, b long, uid long, missed double"), "neighbours")
    missed = found.where("uid is not null").groupBy("uid").agg(F.sum("missed").alias("missed"))
    crowded = materialize(missed.where(F.col("missed") > float(np.log(MISSED))).select("uid"), "crowded")
    links = found.where("a is not null").select("a", "b")
    return (links if crowded.isEmpty() else links.union(_crowded_links(distinct, crowded))).distinct()


def _counts(group: pd.DataFrame) -> pd.DataFrame:
    """For the vectors of one block, or of two blocks, the rows they link to there."""
    out = [pd.DataFrame({"node": pd.Series(dtype="int64"), "n": pd.Series(dtype="int64")})]
    alone = bool(group["i"].iloc[0] == group["j"].iloc[0])
    for _, g in group.groupby(["component", "label", group["embedding"].map(len)]):
        left = g if alone else g[g["part"] == g["i"]]
        right = g if alone else g[g["part"] == g["j"]]
        if not len(left) or not len(right):
            continue
        m, links = _matrix(right["embedding"]), np.zeros(len(right), np.int64)
        for s in range(0, len(left), 256):
            some = left.iloc[s : s + 256]
            near = _matrix(some["embedding"]) @ m.T >= COSINE
            near &= some["uid"].to_numpy()[:, None] != right["uid"].to_numpy()[None]
            out.append(pd.DataFrame({"node": some["node"], "n": near @ right["copies"].to_numpy()}))
            links += some["copies"].to_numpy() @ near
        if not alone:
            out.append(pd.DataFrame({"node": right["node"], "n": links}))
    return pd.concat(out).groupby("node", as_index=False)["n"].sum()


def _counted(distinct: DataFrame, components: DataFrame) -> DataFrame:
    """(node, n_links): for members of components, the rows they link to, copies of their own vector left out.

    Members are ranked by component and cut into blocks of MEMBERS; a component in one block is counted there, a longer
    one has a task for each pair of its blocks. Tasks put out one partial count for each vector, never the pairs.
    """
    members = distinct.join(components, "node")
    ranked = rank_globally(members.select("component", "label", "uid"), "component", "label", "uid")
    ranked = ranked.withColumn("part", F.floor(F.col("rank") / MEMBERS)).drop("rank")
    spans = ranked.groupBy("component", "label").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    met = F.transform(F.sequence("low", "high"), lambda x: F.struct(F.least("part", x).alias("i"), F.greatest("part", x).alias("j")))
    places = ranked.join(spans, ["component", "label"]).select("uid", "component", "part", F.explode(met).alias("met"))
    # Hinted, since Spark takes places for as small as the table that they are exploded from.
    dealt = places.join(distinct.hint("merge"), "uid").select("component", "label", "uid", "node", "copies", "embedding", "part", "met.i", "met.j")
    partial = dealt.groupBy("i", "j").applyInPandas(_counts, "node long, n long")
    return partial.groupBy("node").agg(F.sum("n").alias("n_links"))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """One row per row of vectors: (id_col, n_links, component_id, kept).

    Vectors link if their labels are equal and not null and their cosine, in double precision, is 0.98 or more. Null and
    zero vectors, those with null or non-finite components, and those with a null label or id link with nothing. Vectors
    of different length don't link. Exact copies are merged before the search and link with each other. component_id: the
    smallest id reachable over links, itself included; kept: it is the row's own. Ids may be of any type that has an order.
    Rows that repeat an id are rows of
    their own; where their vectors differ, they are one node and share its links. Other columns are not read.

    The passes find a link between components with a chance of 1 - MISSED or more, except between crowded vectors, which are
    all compared; within a component every link is counted.
    """
    if not isinstance(vectors.schema[id_col].dataType, T.IntegralType):
        return _by_number(vectors, id_col)
    rows = materialize(_prepared(vectors, id_col), "vectors")
    merged = rows.where("embedding is not null").groupBy("label", "embedding").agg(F.min("id").alias("node"), F.count("*").alias("copies"))
    distinct = materialize(merged.withColumn("uid", F.monotonically_increasing_id()), "distinct")
    components = materialize(connected_components(materialize(component_links(distinct), "links")), "components")
    known = distinct.join(components, "node", "left").join(_counted(distinct, components), "node", "left").select(
        "label", "embedding", F.coalesce("component", "node").alias("component"),
        (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("links"),
    )
    found = rows.join(known, ["label", "embedding"], "left")
    return found.select(
        F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"), F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(False)).alias("kept"),
    )


def _by_number(vectors: DataFrame, id_col: str) -> DataFrame:
    """near_duplicates() of vectors whose ids are no integers: these are numbered in their order, and put back at the end."""
    lean = vectors.select(F.col(quoted(id_col)).alias("name"), "label", "embedding")
    names = materialize(rank_globally(lean.select("name").where("name is not null").distinct(), "name", name="id"), "names")
    found = near_duplicates(lean.join(names, "name", "left").select("id", "label", "embedding"), "id")
    own, first = names.select("id", F.col("name").alias(id_col)), names.select(F.col("id").alias("component_id"), F.col("name").alias("first"))
    rows = found.join(own, "id", "left").join(first, "component_id", "left")
    return rows.select(quoted(id_col), "n_links", F.col("first").alias("component_id"), "kept")
