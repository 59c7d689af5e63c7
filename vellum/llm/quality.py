"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages (windows of bytes). Each passage is encoded from its byte and byte-pair frequencies and
the repetition among its words; gated
attention weights, learned from document labels alone, combine the passages; the score is the logistic output of the
weighted representation. Trained in numpy on every passage of a bounded sample of labelled documents, applied to every
passage of every document. The driver holds the passages of the sample, so its memory follows the sample and the length of
its texts, not the corpus.

Null and empty texts are one empty passage and get that passage's score. Repeated rows give repeated results, an empty
table gives no rows, other columns are ignored. Without labels of both kinds the score is the share of label 1 (0.5 if
there are no labels at all).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import byte_windows, kept_rows, text_slices, texts

PAIRS = 512
SHAPE = 3


@dataclass(frozen=True)
class QualityConfig:
    """passage: bytes of a passage. sample: labelled documents of each class, at most."""

    passage: int = 512
    hidden: int = 32
    attention: int = 16
    sample: int = 2048
    epochs: int = 30
    batch: int = 64
    rate: float = 0.005
    seed: int = 11


def features(windows: np.ndarray, used: np.ndarray, at_once: int = 1024) -> np.ndarray:
    """The features of all passages, a bounded number of them at once."""
    out = np.empty((len(windows), 256 + PAIRS + SHAPE), dtype=np.float32)
    for i in range(0, len(windows), at_once):
        out[i : i + at_once] = few_features(windows[i : i + at_once], used[i : i + at_once])
    return out


def few_features(windows: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Of each passage the square roots of the shares of its bytes and hashed byte pairs, and the shape of its words."""
    n, width = windows.shape
    rows = np.arange(n, dtype=np.int64)[:, None]
    inside = np.arange(width) < used[:, None]
    singles = np.bincount((rows * 256 + windows)[inside], minlength=n * 256).reshape(n, 256)
    pair = (windows[:, :-1].astype(np.int64) * 40503 + windows[:, 1:].astype(np.int64) * 30011 >> 3) % PAIRS
    pairs = np.bincount((rows * PAIRS + pair)[inside[:, 1:]], minlength=n * PAIRS).reshape(n, PAIRS)
    f = np.concatenate([singles, pairs], axis=1).astype(np.float32) / np.maximum(used, 1)[:, None]
    return np.concatenate([np.sqrt(f), [shape(w[:u].tobytes()) for w, u in zip(windows, used.tolist(), strict=True)]], axis=1, dtype=np.float32)


def shape(passage: bytes) -> tuple[float, float, float]:
    """Share of words that repeat the word before, share of different words, length."""
    words = passage.split()
    if not words:
        return 0.0, 0.0, 0.0
    return sum(map(eq, words, words[1:])) / len(words), len(set(words)) / len(words), float(np.log2(1 + len(passage))) / 10


class GatedMil:
    """Encoder, gated attention and output layer."""

    def __init__(self, config: QualityConfig, prior: float = 0.5):
        rng = np.random.default_rng(config.seed)
        self.config, self.prior, self.trained = config, prior, False
        d, h, a = 256 + PAIRS + SHAPE, config.hidden, config.attention
        self.p = {
            "W": rng.normal(0, 1.0, (d, h)).astype(np.float32) * 0.3,
            "b": np.zeros(h, np.float32),
            "V": rng.normal(0, 1 / np.sqrt(h), (h, a)).astype(np.float32),
            "U": rng.normal(0, 1 / np.sqrt(h), (h, a)).astype(np.float32),
            "w": rng.normal(0, 1 / np.sqrt(a), a).astype(np.float32),
            "c": rng.normal(0, 1 / np.sqrt(h), h).astype(np.float32),
            "d": np.zeros(1, np.float32),
        }

    def forward(self, f: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        """Representation, attention and probability of bags of ``counts`` passages each."""
        p, starts = self.p, np.concatenate([[0], np.cumsum(counts)[:-1]])
        bag = np.repeat(np.arange(len(counts)), counts)
        h = np.tanh(f @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        s = (t * g) @ p["w"]
        e = np.exp(s - np.maximum.reduceat(s, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "y": y, "bag": bag, "starts": starts}

    def gradients(self, f: np.ndarray, counts: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross entropy."""
        p, r = self.p, self.forward(f, counts)
        dy = (r["y"] - target) / len(target)
        dz = dy[:, None] * p["c"]
        dzb = dz[r["bag"]]
        da = (dzb * r["h"]).sum(axis=1)
        ds = r["a"] * (da - np.add.reduceat(r["a"] * da, r["starts"])[r["bag"]])
        dtg = ds[:, None] * p["w"]
        dt = dtg * r["g"] * (1 - r["t"] ** 2)
        dg = dtg * r["t"] * r["g"] * (1 - r["g"])
        dh = (r["a"][:, None] * dzb + dt @ p["V"].T + dg @ p["U"].T) * (1 - r["h"] ** 2)
        return {
            "W": f.T @ dh, "b": dh.sum(axis=0), "V": r["h"].T @ dt, "U": r["h"].T @ dg,
            "w": (r["t"] * r["g"]).T @ ds, "c": r["z"].T @ dy, "d": dy.sum(keepdims=True),
        }

    def train(self, f: np.ndarray, counts: np.ndarray, target: np.ndarray) -> None:
        """Adam over shuffled batches of bags."""
        config, rng = self.config, np.random.default_rng(self.config.seed + 1)
        starts = np.concatenate([[0], np.cumsum(counts)])
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step = 0
        for epoch in range(config.epochs):
            order, rate = rng.permutation(len(counts)), config.rate * (1 - epoch / config.epochs)
            for i in range(0, len(order), config.batch):
                bags, step = order[i : i + config.batch], step + 1
                rows = np.concatenate([np.arange(starts[x], starts[x + 1]) for x in bags])
                for k, g in self.gradients(f[rows], counts[bags], target[bags]).items():
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.001 * (g * g - v[k])
                    self.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        self.trained = True

    def score(self, docs: list[str]) -> np.ndarray:
        """Probability of label 1 of each whole text."""
        if not self.trained:
            return np.full(len(docs), self.prior)
        windows, used, counts = byte_windows([t.encode() for t in docs], self.config.passage, 0)
        return self.forward(features(windows, used), counts)["y"].astype(np.float64)


def fit_quality(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", config: QualityConfig | None = None, where: Column | None = None
) -> GatedMil:
    """Train on the labelled documents that ``where`` (over the label rows) selects; a document labelled both ways is left out."""
    config = config or QualityConfig()
    chosen = labels.filter(where) if where is not None else labels
    clean = (
        chosen.select(F.col("doc_id").alias("id"), F.col(label_col).cast("int").alias("label"))
        .filter("id IS NOT NULL AND label IN (0, 1)")
        .groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("top")).filter("label = top")
    )
    by_hash = F.xxhash64("id")
    few = [clean.filter(F.col("label") == y).select("id", "label").orderBy(by_hash, "id").limit(config.sample) for y in (0, 1)]
    sample = few[0].union(few[1])  # 2 x sample rows at most, so it can be broadcast
    width = config.passage

    rows = texts(docs).join(F.broadcast(sample), "id").select("id", F.encode("text", "UTF-8").alias("raw"), "label").collect()
    rows.sort(key=lambda r: (r["id"], bytes(r["raw"])))
    target = np.array([r["label"] for r in rows], dtype=np.float32)
    model = GatedMil(config, float(target.mean()) if len(target) else 0.5)
    if 0 < target.sum() < len(target):
        raw = [bytes(r["raw"]) for r in rows]
        del rows
        windows, used, counts = byte_windows(raw, width, 0)
        del raw
        model.train(features(windows, used), counts, target)
    return model


def score_quality(docs: DataFrame, model: GatedMil, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every whole text."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, rows in text_slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.schema.field("id").type), pa.array(shared.value.score(rows), pa.float64())], ["doc_id", "score"]
                )

    return texts(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, score double")


def keep_good(docs: DataFrame, model: GatedMil, least: float, text_col: str = "text") -> DataFrame:
    """The documents with at least this score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return kept_rows(docs, lambda rows: (shared.value.score(rows) >= least).tolist(), text_col)
