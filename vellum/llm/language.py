"""Language identification with a byte convolutional network.

Multi-width filters over byte embeddings, maximum over the positions of a fixed-length window, softmax; trained in numpy
on all windows of a bounded sample of labelled documents, which the driver holds. A document's score is the geometric mean of its windows' probabilities,
weighted by their bytes, so that the whole text counts.

Null, empty and letterless texts are ``und`` with score 0. Repeated rows give repeated results, an empty table gives no
rows, other columns are ignored. Without any labelled document everything is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import byte_windows, kept_rows, text_slices, texts

UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class LanguageConfig:
    """window: bytes of a window. sample: labelled documents used for training, at most."""

    window: int = 256
    embedding: int = 8
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 12
    sample: int = 2048
    epochs: int = 6
    batch: int = 64
    rate: float = 0.01
    seed: int = 7


class ByteCnn:
    """The network's weights, its training and its application to windows of bytes."""

    def __init__(self, labels: list[str], config: LanguageConfig):
        rng = np.random.default_rng(config.seed)
        self.labels, self.config = labels, config
        d, k, n = config.embedding, max(config.widths), config.filters
        self.pad = k - 1
        mask = np.zeros((k, d, len(config.widths), n), dtype=np.float32)
        for i, width in enumerate(config.widths):
            mask[:width, :, i] = 1  # a narrow filter sees only its first bytes
        self.mask = mask.reshape(k * d, -1)
        self.p = {
            "E": rng.normal(0, 0.5, (256, d)).astype(np.float32),
            "W": rng.normal(0, 1 / np.sqrt(k * d), (k * d, self.mask.shape[1])).astype(np.float32) * self.mask,
            "b": np.zeros(self.mask.shape[1], dtype=np.float32),
            "U": rng.normal(0, 0.1, (self.mask.shape[1], len(labels))).astype(np.float32),
            "c": np.zeros(len(labels), dtype=np.float32),
        }

    def columns(self, windows: np.ndarray) -> np.ndarray:
        """For each position of each window the embeddings of the bytes that the widest filter sees."""
        embedded = self.p["E"][windows]
        n, length, d = embedded.shape
        k = self.pad + 1
        s = embedded.strides
        return np.lib.stride_tricks.as_strided(embedded, (n, length - self.pad, k * d), (s[0], s[1], s[2]))

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Convolutions before pooling, and the pooled, rectified values."""
        cols = self.columns(windows)
        n, length, width = cols.shape
        conv = (cols.reshape(n * length, width) @ self.p["W"]).reshape(n, length, -1)
        return conv, np.maximum(conv.max(axis=1) + self.p["b"], 0)

    def log_probabilities(self, windows: np.ndarray, at_once: int = 128) -> np.ndarray:
        """Log probability of each label for each window."""
        out = np.empty((len(windows), len(self.labels)), dtype=np.float32)
        for i in range(0, len(windows), at_once):
            logits = self.pooled(windows[i : i + at_once])[1] @ self.p["U"] + self.p["c"]
            logits -= logits.max(axis=1, keepdims=True)
            out[i : i + at_once] = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
        return out

    def gradients(self, windows: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the cross entropy; through the maximum they reach one position of each filter."""
        conv, pooled = self.pooled(windows)
        logits = pooled @ self.p["U"] + self.p["c"]
        q = np.exp(logits - logits.max(axis=1, keepdims=True))
        q /= q.sum(axis=1, keepdims=True)
        q[np.arange(len(q)), target] -= 1
        q /= len(q)
        back = (q @ self.p["U"].T) * (pooled > 0)
        at = conv.argmax(axis=1)  # window x filter
        n, f = at.shape
        k, d = self.pad + 1, self.config.embedding
        seen = windows[np.arange(n)[:, None, None], at[:, :, None] + np.arange(k)]  # bytes under each best position
        cols = self.p["E"][seen].reshape(n, f, k * d)
        gw = np.einsum("nf,nfk->kf", back, cols) * self.mask
        ge = np.zeros_like(self.p["E"])
        through = (back[:, :, None] * self.p["W"].T[None]).reshape(n * f * k, d)
        np.add.at(ge, seen.reshape(-1), through)
        return {"E": ge, "W": gw, "b": back.sum(axis=0), "U": pooled.T @ q, "c": q.sum(axis=0)}

    def train(self, windows: np.ndarray, target: np.ndarray) -> None:
        """Adam over shuffled batches, each label drawn equally often."""
        config, rng = self.config, np.random.default_rng(self.config.seed + 1)
        share = 1 / np.bincount(target, minlength=len(self.labels)).clip(1)[target]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step = 0
        for epoch in range(config.epochs):
            order = rng.choice(len(windows), len(windows), p=share / share.sum())
            rate = config.rate * (1 - epoch / config.epochs)
            for i in range(0, len(order), config.batch):
                rows, step = order[i : i + config.batch], step + 1
                for k, g in self.gradients(windows[rows], target[rows]).items():
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.001 * (g * g - v[k])
                    self.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)

    def predict(self, docs: list[str]) -> tuple[list[str], list[float]]:
        """Label and score of each whole text."""
        encoded = [t.encode() if LETTER.search(t) else b"" for t in docs]
        windows, used, counts = byte_windows(encoded, self.config.window, self.pad)
        total = np.add.reduceat(
            self.log_probabilities(windows) * used[:, None], np.concatenate([[0], np.cumsum(counts)[:-1]]), axis=0
        )
        mean = total / np.array([max(1, len(b)) for b in encoded])[:, None]
        q = np.exp(mean - mean.max(axis=1, keepdims=True))
        q /= q.sum(axis=1, keepdims=True)
        best = q.argmax(axis=1)
        return (
            [self.labels[i] if b else UNKNOWN for i, b in zip(best, encoded, strict=True)],
            [float(q[r, i]) if b else 0.0 for r, (i, b) in enumerate(zip(best, encoded, strict=True))],
        )


def keep_recognised(docs: DataFrame, model: ByteCnn | None, least: float, text_col: str = "text") -> DataFrame:
    """The documents whose language is recognised with at least this score; none without a model."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judged(rows: list[str]) -> list[bool]:
        if shared.value is None:
            return [False] * len(rows)
        labels, scores = shared.value.predict(rows)
        return [label != UNKNOWN and score >= least for label, score in zip(labels, scores, strict=True)]

    return kept_rows(docs, judged, text_col)


def training_windows(labelled: DataFrame, config: LanguageConfig) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """A bounded sample of labelled documents, equally many of each label as far as there are, cut to windows."""
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return np.zeros((0, 1), np.uint8), np.zeros(0, np.int64), []
    wanted = config.sample / len(counts)
    share = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, wanted / n))])
    spot = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / (1 << 30)
    few = labelled.filter(spot < share[F.col("label")]).orderBy(F.xxhash64("id", F.lit(1)), "id").limit(config.sample)
    rows = few.select("label", F.encode("text", "UTF-8").alias("raw")).collect()
    rows = sorted((r["label"], bytes(r["raw"])) for r in rows)
    names = sorted(counts)
    data, _, n = byte_windows([raw for _, raw in rows], config.window, max(config.widths) - 1)
    return data, np.repeat(np.array([names.index(label) for label, _ in rows], dtype=np.int64), n), names


def fit_language(
    docs: DataFrame, label_col: str = "lang", config: LanguageConfig | None = None, where: Column | None = None
) -> ByteCnn | None:
    """Train on the documents that ``where`` selects and that carry a label; None if there is none."""
    config = config or LanguageConfig()
    chosen = docs.filter(where) if where is not None else docs
    labelled = chosen.select(
        F.col("doc_id").alias("id"), F.col("text").alias("text"), F.col(label_col).cast("string").alias("label")
    ).filter("text IS NOT NULL AND label IS NOT NULL AND text RLIKE '\\\\p{L}'")
    windows, target, names = training_windows(labelled, config)
    if not names:
        return None
    model = ByteCnn(names, config)
    model.train(windows, target)
    return model


def identify_language(docs: DataFrame, model: ByteCnn | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand weights, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            for ids, rows in text_slices(batch):
                labels, scores = net.predict(rows) if net else ([UNKNOWN] * len(rows), [0.0] * len(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.schema.field("id").type), pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                    ["doc_id", "lang_pred", "score"],
                )

    return texts(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
