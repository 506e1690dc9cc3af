"""Quality: attention-based multiple-instance learning over passages, trained in numpy.

Every passage of a text is encoded; a gated attention learned from document labels weighs the passages; the weighted
sum of their codes is scored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Adagrad, WordTable, held_out, labelled_rows, score_rows, trained

ROWS = 1 << 15
DIM = 16
CODE = 16
GATE = 8
PASSAGE = 64  # words
PER_CLASS = 2500  # bound of the training sample: so many labelled documents of either class
EPOCHS = 5
THRESHOLD = 0.3
SEED = 29
BLOCK = 1 << 17  # words that are looked up at once
_RUN = re.compile(r"(.)\1+")
REPEATED = ROWS  # row of the table


def _shape(word: str) -> str:
    """Letters as a, digits as 9, runs of a sign shortened to one; words of capitals only are marked."""
    signs = "".join("a" if c.isalpha() else "9" if c.isdigit() else c for c in word)
    return ("^" if word.isupper() and len(word) > 1 else "") + _RUN.sub(r"\1", signs)[:8]


class Vocabulary(WordTable):
    width = 2

    def numbers(self, word: bytes) -> tuple[int, int]:
        shape = _shape(word.decode(errors="replace"))
        return crc32(word.lower()) % ROWS, crc32(b"#" + shape.encode()) % ROWS

    def rows(self, of: np.ndarray) -> np.ndarray:
        """The hashed rows of the embedding table of each word and of its shape."""
        return self.at(of)


def _rows(text: bytes | None, vocabulary: Vocabulary) -> np.ndarray:
    return np.fromiter(map(vocabulary.__getitem__, (text or b"").split()), dtype=np.int64)


def _repeats(rows: np.ndarray) -> np.ndarray:
    """1 where a word is the one before it."""
    return np.concatenate(([0], rows[1:] == rows[:-1])) if len(rows) else np.zeros(0)


def _softmax_by(scores: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    e = np.exp(scores - np.repeat(np.maximum.reduceat(scores, starts), sizes))
    return e / np.repeat(np.add.reduceat(e, starts), sizes)


@dataclass
class AttentionMil:
    table: np.ndarray  # (ROWS + 1) x DIM, the last for repeated words
    weights: dict[str, np.ndarray]
    bias: float

    def means(self, docs: Iterable[np.ndarray], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
        """Mean embeddings of all passages, and how many passages each text has (one, of zeros, if it has no words)."""
        sizes, out, block, words = [], [], [], 0

        def flush() -> None:
            rows = np.concatenate(block)
            used, inverse = np.unique(rows, return_inverse=True)
            vectors = self.table[vocabulary.rows(used)].sum(axis=1)
            starts = np.concatenate([s + np.arange(0, len(d), PASSAGE) for s, d in zip(np.cumsum([0] + [len(d) for d in block[:-1]]), block)])
            repeats = np.concatenate([_repeats(d) for d in block])
            sums = np.add.reduceat(vectors[inverse.ravel()], starts, axis=0) + np.add.reduceat(repeats, starts)[:, None] * self.table[REPEATED]
            out.append(sums / np.diff(np.append(starts, len(rows)))[:, None])

        for doc in docs:
            sizes.append(max(1, -(-len(doc) // PASSAGE)))
            for s in range(0, len(doc), BLOCK):
                block.append(doc[s : s + BLOCK])
                words += len(block[-1])
                if words > BLOCK:
                    flush()
                    block, words = [], 0
            if not len(doc):
                if block:
                    flush()
                    block, words = [], 0
                out.append(np.zeros((1, DIM), np.float32))
        if block:
            flush()
        return (np.concatenate(out) if out else np.zeros((0, DIM), np.float32)), np.array(sizes, dtype=np.int64)

    def forward(self, mean: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        code = np.tanh(mean @ w["encode"] + w["encode_bias"])
        gate_t, gate_s = np.tanh(code @ w["v"]), 1 / (1 + np.exp(-np.clip(code @ w["u"], -30, 30)))
        attention = _softmax_by((gate_t * gate_s) @ w["attend"], starts, sizes)
        pooled = np.add.reduceat(code * attention[:, None], starts, axis=0)
        p = 1 / (1 + np.exp(-np.clip(pooled @ w["out"] + self.bias, -30, 30)))
        return {"starts": starts, "code": code, "t": gate_t, "s": gate_s, "attention": attention, "pooled": pooled, "p": p}

    def scores(self, texts: Iterable[bytes | None], vocabulary: Vocabulary) -> np.ndarray:
        vocabulary.trim()
        mean, sizes = self.means((_rows(t, vocabulary) for t in texts), vocabulary)
        return self.forward(mean, sizes)["p"].astype(np.float64) if len(sizes) else np.empty(0)


def _train_batch(model: AttentionMil, opt: Adagrad, docs: list[np.ndarray], vocabulary: Vocabulary, y: np.ndarray) -> None:
    w = model.weights
    mean, sizes = model.means(docs, vocabulary)
    f = model.forward(mean, sizes)
    g = ((f["p"] - y) / len(y)).astype(np.float32)
    g_pooled = np.repeat(np.outer(g, w["out"]), sizes, axis=0)
    attention, code = f["attention"], f["code"]
    g_code = g_pooled * attention[:, None]
    g_att = (g_pooled * code).sum(axis=1)
    inner = np.add.reduceat(g_att * attention, f["starts"])
    g_e = attention * (g_att - np.repeat(inner, sizes))
    g_gate = np.outer(g_e, w["attend"])
    g_t, g_s = g_gate * f["s"] * (1 - f["t"] ** 2), g_gate * f["t"] * f["s"] * (1 - f["s"])
    g_code += g_t @ w["v"].T + g_s @ w["u"].T
    g_pre = g_code * (1 - code**2)
    g_mean = g_pre @ w["encode"].T
    grads = {
        "out": f["pooled"].T @ g, "attend": (f["t"] * f["s"]).T @ g_e, "v": code.T @ g_t, "u": code.T @ g_s,
        "encode": mean.T @ g_pre, "encode_bias": g_pre.sum(axis=0),
    }
    for key, grad in grads.items():
        opt.step(key, w[key], grad)
    model.bias -= 0.1 * float(g.sum())
    # Each word of a passage has an equal part in the passage's mean.
    rows, owner, repeated, at = [], [], [], 0
    for d in docs:
        n = max(1, -(-len(d) // PASSAGE))
        rows.append(d)
        owner.append(at + np.arange(len(d)) // PASSAGE)
        repeated.append(_repeats(d))
        at += n
    rows, owner, repeated = np.concatenate(rows), np.concatenate(owner), np.concatenate(repeated)
    if not len(rows):
        return
    each = g_mean / np.bincount(owner, minlength=len(g_mean)).clip(1)[:, None]
    used, inverse = np.unique(rows, return_inverse=True)
    pairs = inverse.ravel().astype(np.int64) * len(each) + owner
    pair, times = np.unique(pairs, return_counts=True)
    word_grads = np.zeros((len(used), DIM), np.float32)
    np.add.at(word_grads, pair // len(each), each[pair % len(each)] * times[:, None])
    ids = vocabulary.rows(used)
    unique, place = np.unique(ids.ravel(), return_inverse=True)
    grad = np.zeros((len(unique), DIM), np.float32)
    np.add.at(grad, place.ravel(), np.repeat(word_grads, 2, axis=0))
    opt.step("table", model.table, grad, unique)
    times = np.bincount(owner, weights=repeated, minlength=len(each))
    opt.step("repeated", model.table[REPEATED], (each * times[:, None]).sum(axis=0))


def train(sample: list[tuple[int, bytes, int]], seed: int = SEED) -> AttentionMil:
    """sample: (id, text, label) rows. With no rows, or with one label only, the model scores all texts alike."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    model = AttentionMil(
        draw(ROWS + 1, DIM, scale=0.3),
        {
            "encode": draw(DIM, CODE, scale=0.5), "encode_bias": np.zeros(CODE, np.float32), "v": draw(CODE, GATE, scale=0.3),
            "u": draw(CODE, GATE, scale=0.3), "attend": draw(GATE, scale=0.3), "out": draw(CODE, scale=0.3),
        },
        0.0,
    )
    y = np.array([s[2] for s in sample], dtype=np.float32)
    if len(set(y.tolist())) < 2:
        model.weights["out"][:] = 0
        model.bias = -4.0 if len(y) and y[0] == 0 else 4.0
        return model
    vocabulary = Vocabulary()
    docs = [_rows(s[1], vocabulary) for s in sample]
    opt = Adagrad(0.05)
    for _ in range(EPOCHS if len(docs) > 1000 else 6 * EPOCHS):
        for batch in np.array_split(rng.permutation(len(docs)), max(1, len(docs) // 32)):
            _train_batch(model, opt, [docs[i] for i in batch], vocabulary, y[batch])
    return model


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> AttentionMil:
    """Trains on at most per_class labelled documents of either class; held-out ids are never seen."""
    encoded = lambda sample: [(i, text.encode(errors="replace"), y) for i, text, y in sample]
    return trained(labelled_rows(docs, labels, "quality", per_class), lambda sample: train(encoded(sample)))


def score(docs: DataFrame, model: AttentionMil) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row: predicted is 1 from a score of 0.3 on.

    Whole texts are scored, null ones as empty (one passage without words). Only the text is an input; other columns are
    not read. An empty table gives no rows.
    """
    ids = docs.select("doc_id", "text")
    return _scored(ids, model).select(
        F.col("row.doc_id").alias("doc_id"),
        F.coalesce(held_out("row.doc_id"), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep(docs: DataFrame, model: AttentionMil) -> DataFrame:
    """The rows of docs that score() predicts good, with all their columns, whatever their names.

    Each row is judged by its own text: null and empty ones as a text without words, repeated rows and ids alike. Very
    long texts are scored whole. An empty table gives no rows.
    """
    return _scored(docs, model).where(F.col("score") >= THRESHOLD).select("row.*")


def _scored(docs: DataFrame, model: AttentionMil) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scorer():
        vocabulary = Vocabulary()
        return lambda texts: shared.value.scores(texts, vocabulary)

    return score_rows(docs, F.col("text").cast("binary"), scorer)
