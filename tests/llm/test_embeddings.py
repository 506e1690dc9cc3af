import math
from pathlib import Path

import numpy as np
import pytest
from lakeread.llm import embeddings


def brute(rows):
    """vec_id -> (links, component) of (vec_id, embedding, label) rows with unique ids."""
    ok = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    unit = {i: np.array(v, float) / np.abs(v).max() for i, v, label in rows if label is not None and ok(v)}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    label = {i: l for i, _, l in rows}
    links = {i: {j for j in unit if j != i and label[i] == label[j] and len(v) == len(unit[j]) and v @ unit[j] >= 0.98} for i, v in unit.items()}
    out = {}
    for i, _, _ in rows:
        group, todo = {i}, [i]
        while todo:
            new = links.get(todo.pop(), set()) - group
            group |= new
            todo += new
        out[i] = (len(links.get(i, ())), min(group))
    return out


def compare(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_duplicates(df.withColumn("node", df["label"])).collect()}
    want = brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], l) for i, v, l in rows])
    assert got.keys() == want.keys()
    return got, want


def test_links_and_components_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "MEMBERS", 16)  # so that components are longer than a block
    monkeypatch.setattr(embeddings, "BLOCK", 100)
    rng, rows = np.random.default_rng(4), []
    for centre in rng.standard_normal((12, 16)):
        for _ in range(int(rng.integers(2, 60))):
            rows.append((len(rows), (centre + rng.standard_normal(16) * rng.choice([0.01, 0.1, 0.14])).tolist(), int(rng.integers(0, 2))))
    rows += [(len(rows) + k, rows[3][1], rows[3][2]) for k in range(40)]  # exact copies
    at = len(rows)
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0], [2.0], [1e38] * 16, [1e-38] * 16]
    rows += [(at + k, v, 1) for k, v in enumerate(odd)] + [(at + 20, rows[3][1], None), (at + 21, rows[3][1], None)]
    got, want = compare(spark, rows)
    assert sum(got[i] == want[i] for i in want) >= 0.97 * len(want)
    assert all(got[i][0] <= want[i][0] for i in want)
    for i in range(at, at + 22):
        if i in want:
            assert got[i] == want[i]


def test_empty_and_repeated_ids(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert embeddings.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    rows = spark.createDataFrame([(5, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (7, [1.0, 0.01], 1)], schema)
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_duplicates(rows).collect())
    assert got == [(0, 0, None, False), (5, 2, 5, True), (5, 2, 5, True), (7, 2, 5, False)]


def true_links(m, step=1000):
    """(a, b) of all pairs with cosine 0.98 or more among unit vectors, a < b, by brute force in blocks."""
    out = []
    for s in range(0, len(m), step):
        x, y = np.nonzero(m[s : s + step] @ m.T >= 0.98)
        out.append(np.stack([x + s, y], axis=1)[x + s < y])
    return np.concatenate(out)


def pass_recall(spark, df, ids, pairs):
    """The share of linked pairs whose ends hang together by what the passes found, and n_links of each vector."""
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(df).collect()}
    together = sum(got[ids[a]]["component_id"] == got[ids[b]]["component_id"] for a, b in pairs)
    return together / max(1, len(pairs)), {i: r["n_links"] for i, r in got.items()}


@pytest.mark.parametrize("spread", [0.02, 0.06, 0.1])
def test_recall_on_generated_clusters(spark, spread):
    """Clusters of 2 to 60 vectors in two labels, many pairs just above and below the threshold."""
    rng, m, labels = np.random.default_rng(int(spread * 100)), [], []
    for centre in rng.standard_normal((120, 32)):
        for _ in range(int(rng.integers(2, 60))):
            m.append(centre + rng.standard_normal(32) * spread * rng.choice([0.5, 1.0, 1.4]))
            labels.append(int(rng.integers(0, 2)))
    m = np.array(m, np.float32).astype(float)
    df = spark.createDataFrame([(i, v.tolist(), labels[i]) for i, v in enumerate(m)], "vec_id long, embedding array<float>, label int").repartition(8)
    unit, labels = m / np.linalg.norm(m, axis=1)[:, None], np.array(labels)
    pairs = np.concatenate([np.flatnonzero(labels == k)[true_links(unit[labels == k])] for k in (0, 1)])
    recall, links = pass_recall(spark, df, range(len(m)), pairs)
    print(spread, len(pairs), recall)
    assert len(pairs) > 100 and recall >= 0.99
    assert sum(links.values()) >= 0.99 * 2 * len(pairs)


def test_ids_of_any_type(spark):
    rows = [("b", [1.0, 0.0], 1), ("a-1", [1.0, 0.01], 1), ("c", [0.0, 1.0], 1), (None, [1.0, 0.0], 1), ("d", None, 1)]
    got = {r["vec_id"]: tuple(r)[1:] for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id string, embedding array<float>, label int")).collect()}
    assert got == {"b": (1, "a-1", False), "a-1": (1, "a-1", True), "c": (0, "c", True), None: (0, None, False), "d": (0, "d", True)}


@pytest.mark.parametrize("table", ["check_s", "check_h"])
def test_recall_on_clustered_vectors(spark, table):
    """Links found against brute force over every row of a label, in blocks; the tables are not on every machine."""
    path = Path(f"/root/testdata/{table}/embeddings.parquet")
    if not path.exists():
        pytest.skip("the clustered tables are not here")
    df = spark.read.parquet(str(path))
    rows = df.select("vec_id", "embedding", "label").toPandas()
    ids, pairs = rows["vec_id"].to_numpy(), []
    for _, g in rows.groupby("label"):
        m = np.stack(g["embedding"].to_numpy()).astype(float)
        pairs.append(g.index.to_numpy()[true_links(m / np.linalg.norm(m, axis=1)[:, None])])
    recall, links = pass_recall(spark, df, ids, np.concatenate(pairs))
    print(table, len(np.concatenate(pairs)), recall)
    assert recall >= 0.95 and sum(links.values()) >= 0.95 * 2 * sum(map(len, pairs))


def test_links_in_a_dense_label_are_found(spark):
    """Vectors about 0.95 alike are no links, but share long beginnings of their signatures; each planted pair is a link."""
    rng, n, pairs = np.random.default_rng(8), 20_000, 200
    unit = lambda m: m / np.linalg.norm(m, axis=1)[:, None]
    spread = unit(rng.standard_normal((n, 64))) * np.sqrt(1 / 0.95 - 1)
    m = unit(unit(rng.standard_normal((1, 64))) + spread)
    m[n - pairs :] = unit(m[:pairs] + unit(rng.standard_normal((pairs, 64))) * 0.185)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(m)], "vec_id long, embedding array<float>, label int").repartition(8)
    got = {r["vec_id"]: r["n_links"] for r in embeddings.near_duplicates(df).collect()}
    links = np.concatenate([(m[s : s + 1000].astype(np.float32) @ m.T.astype(np.float32) >= 0.98).sum(axis=1) - 1 for s in range(0, n, 1000)])
    print(sum(got.values()), links.sum())
    assert links.sum() >= pairs
    assert sum(got.values()) >= 0.9 * links.sum()
