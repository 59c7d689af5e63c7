"""Language-model scores by the likelihood of subword lattices.

The vocabulary is an existing one of scored pieces. Its scores are negated merge ranks, which Zipf's law turns into first
weights of the pieces; the corpus then refits them: each piece gets the expected number of its uses over all segmentations of
all distinct training words (forward and backward sums). Pieces are byte strings and every single byte is one, so each text has
segmentations. The score of a word is the log sum over all its segmentations, computed by the forward recursion in log
space: alpha(j) = log sum over pieces w[i:j] of exp(alpha(i) + log p(w[i:j])).

A word of the lattice begins with a space and the next space, or the end, closes it, so the words of the model are
independent and their probabilities, with that of the end, add up to one. One more arc spans each whole word seen in
training: (c - d) / N, where N counts the training tokens. The discounts, d for each of the V distinct tokens, are what the
pieces get: their arcs weigh d V / N, so the sum stays one, and d = n1 / (n1 + 2 n2) from the tokens seen once and twice.

Work is done once per distinct word, not per use: documents are cut into chunks of bounded size, each stored as its
distinct words and the documents' counts of them; the words of all chunks are aggregated, scored, and sent back to the
chunks that hold them.

Null texts count as empty: one token, the end. Repeated rows count and are scored once each. Without training documents
N and V are 0, the base score is 0 (log10 1) and the score that of the first weights. Other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import text_slices, texts, write_shared

LN10 = log(10)
#: Bytes of a word whose probability is far from the smallest double; expected uses below LEAST are left out.
SHORT, LEAST = 24, 1e-6


@dataclass(frozen=True)
class LatticeConfig:
    """chunk: bytes of text of a chunk. stored: chunks in a file at most. rounds: refits of the pieces' weights. scale: parts into which an expected use is rounded."""

    chunk: int = 8 << 20
    rounds: int = 1
    smoothing: float = 0.1
    scale: int = 1 << 16
    stored: int = 2


def read_pieces(model: str) -> dict[bytes, float]:
    """Piece bytes and scores of a sentencepiece model; word starts are spaces, byte pieces their byte, control pieces left out.

    Pieces that a lower-cased word cannot contain are left out.
    """
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces: dict[bytes, float] = {}
    for i in range(processor.get_piece_size()):
        name = processor.id_to_piece(i)
        if processor.is_control(i) or processor.is_unknown(i):
            continue
        data = bytes([int(name[3:5], 16)]) if processor.is_byte(i) else name.replace("▁", " ").encode()
        if b" " in data[1:] or data != data.lower() or data != b" " and data.strip() != data.lstrip(b" "):
            continue
        pieces[data] = max(processor.get_score(i), pieces.get(data, -1e9))
    for b in range(256):
        pieces.setdefault(bytes([b]), -float(processor.get_piece_size()))
    return pieces


class Lattice:
    """Pieces with log weights, and sums over all segmentations of a word."""

    def __init__(self, names: list[bytes], weights: np.ndarray, end: float):
        self.names, self.end = names, end  # end: log probability of the end at a word's place
        table: dict[bytes, float | None] = {}
        for name in names:
            for i in range(1, len(name)):
                table.setdefault(name[:i], None)  # a prefix: look on
        for name, weight in zip(names, np.log(weights).tolist(), strict=True):
            table[name] = weight
        self.table = table
        self.shares = {name: weight if weight is None else exp(weight) for name, weight in table.items()}
        self.index = {name: i for i, name in enumerate(names)}

    def arcs(self, word: bytes) -> list[list[tuple[int, float]]]:
        """For each start the (end, log weight) of the pieces there."""
        table, n, out = self.table, len(word), []
        for i in range(n):
            here = []
            for j in range(i + 1, n + 1):
                weight = table.get(word[i:j], 0.0)
                if weight is None:
                    continue
                if weight == 0.0:
                    break
                here.append((j, weight))
            out.append(here)
        return out

    @staticmethod
    def forward(arcs: list[list[tuple[int, float]]]) -> list[float]:
        """Log sums over the segmentations up to each place."""
        n = len(arcs)
        coming: list[list[float]] = [[] for _ in range(n + 1)]
        alpha = [0.0] * (n + 1)
        for i in range(n):
            if i:
                terms = coming[i]
                if not terms:
                    alpha[i] = -1e300
                    continue
                if len(terms) == 1:
                    alpha[i] = terms[0]
                else:
                    top = max(terms)
                    alpha[i] = top + log(sum([exp(t - top) for t in terms]))
            base = alpha[i]
            for j, weight in arcs[i]:
                coming[j].append(base + weight)
        if n:
            terms = coming[n]
            top = max(terms)
            alpha[n] = top + log(sum([exp(t - top) for t in terms]))
        return alpha

    def log_probability(self, word: bytes) -> float:
        """Log of the sum over all segmentations of a word, with the space before it."""
        return self.forward(self.arcs(b" " + word))[-1]

    def uses(self, word: bytes) -> Iterator[tuple[int, float]]:
        """(piece, expected uses) over all segmentations of a word."""
        data = b" " + word
        if len(data) <= SHORT:
            yield from self.short_uses(data)
            return
        arcs = self.arcs(data)
        alpha = self.forward(arcs)
        total, n = alpha[-1], len(data)
        beta = [0.0] * (n + 1)
        for i in range(n - 1, -1, -1):
            terms = [weight + beta[j] for j, weight in arcs[i]]
            top = max(terms)
            beta[i] = top + log(sum([exp(t - top) for t in terms]))
            for j, weight in arcs[i]:
                share = exp(alpha[i] + weight + beta[j] - total)
                if share > LEAST:
                    yield self.index[data[i:j]], share

    def short_uses(self, data: bytes) -> Iterator[tuple[int, float]]:
        """The same without logarithms, for a word too short for its probability to vanish."""
        get, n = self.shares.get, len(data)
        alpha = [0.0] * (n + 1)
        alpha[0] = 1.0
        arcs = []
        for i in range(n):
            base = alpha[i]
            for j in range(i + 1, n + 1):
                name = data[i:j]
                share = get(name, 0.0)
                if share:
                    alpha[j] += base * share
                    arcs.append((i, j, name, share))
                elif share is not None:
                    break
        beta = [0.0] * (n + 1)
        beta[n] = 1 / alpha[n]
        index = self.index
        for i, j, name, share in reversed(arcs):
            back = share * beta[j]
            beta[i] += back
            used = alpha[i] * back
            if used > LEAST:
                yield index[name], used


def first_lattice(pieces: dict[bytes, float], per_end: float) -> Lattice:
    """Weights by Zipf's law over the scores' ranks; ``per_end`` words are expected before an end."""
    names = sorted(pieces)
    return fitted(names, np.array([1 / (10 - pieces[n]) for n in names]), per_end)


def fitted(names: list[bytes], mass: np.ndarray, per_end: float) -> Lattice:
    """The lattice of pieces with these masses; given a word's place, all words and the end have probability one."""
    starts = np.array([n.startswith(b" ") for n in names])
    opening, inner = mass[starts].sum(), mass[~starts].sum()
    # a piece process of word-opening pieces, inner pieces and the end, whose mass is opening / per_end
    closing = opening * (1 + 1 / per_end)
    weights = mass / (closing + inner)
    return Lattice(names, weights, log(1 / per_end / (1 + 1 / per_end)))


def chunked(docs: DataFrame, config: LatticeConfig) -> DataFrame:
    """Chunks of documents: (chunk, words, counts, ids, train, sizes, gaps, uses).

    ``words`` are the chunk's distinct words and ``counts`` their uses in training documents; document d has ``sizes[d]``
    distinct words, whose ascending places are written as ``gaps``, with their ``uses``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            train = batch.column("train").to_pylist()
            row = 0
            for ids, rows in text_slices(batch, config.chunk):
                known: dict[bytes, int] = {}
                sizes, places, uses = [], [], []
                for text in rows:
                    at, n = np.unique([known.setdefault(w, len(known)) for w in text.encode().lower().split()] or np.zeros(0, np.int64), return_counts=True)
                    sizes.append(len(at))
                    places.append(np.diff(at, prepend=0))
                    uses.append(n)
                counts = np.zeros(len(known), dtype=np.int64)
                for i, (gaps, n) in enumerate(zip(places, uses, strict=True)):
                    if train[row + i]:
                        counts[np.cumsum(gaps, dtype=np.int64)] += n
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk], pa.int64()),
                        pa.array([list(known)], pa.list_(pa.binary())),
                        pa.array([counts], pa.list_(pa.int64())),
                        pa.array([ids], pa.list_(batch.schema.field("id").type)),
                        pa.array([train[row : row + len(ids)]], pa.list_(pa.bool_())),
                        pa.array([sizes], pa.list_(pa.int32())),
                        pa.array([np.concatenate(places).astype(np.int32)], pa.list_(pa.int32())),
                        pa.array([np.concatenate(uses).astype(np.int32)], pa.list_(pa.int32())),
                    ],
                    ["chunk", "words", "counts", "ids", "train", "sizes", "gaps", "uses"],
                )
                chunk += 1
                row += len(ids)

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(
        run,
        f"chunk long, words array<binary>, counts array<long>, ids array<{kind}>, train array<boolean>, sizes array<int>, "
        "gaps array<int>, uses array<int>",
    )


def refit(vocabulary: DataFrame, lattice: Lattice, per_end: float, config: LatticeConfig) -> Lattice:
    """The pieces' weights from their expected uses in all distinct training words; rounded uses add up alike in any order."""
    shared = vocabulary.sparkSession.sparkContext.broadcast(lattice)  # as many pieces as the vocabulary file has

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        total = [0] * len(model.names)
        for batch in batches:
            for word in batch.column("word").to_pylist():
                for piece, share in model.uses(word):
                    total[piece] += int(share * config.scale + 0.5)
        at = [i for i, n in enumerate(total) if n]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([total[i] for i in at], pa.int64())], ["piece", "n"])

    used = vocabulary.filter("c > 0").select("word").mapInArrow(run, "piece int, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()
    mass = np.full(len(lattice.names), config.smoothing)
    for row in used:
        mass[row["piece"]] += row["n"] / config.scale
    return fitted(lattice.names, mass, per_end)


def lattice_scores(
    docs: DataFrame, model: str, train: Column, id_col: str = "doc_id", text_col: str = "text", config: LatticeConfig | None = None
) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every whole text; ``train`` selects what is learned from."""
    config = config or LatticeConfig()
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    chunks = write_shared(chunked(rows, config), "chunks", config.stored)
    entries = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "e"))
    vocabulary = entries.select(F.col("e.words").alias("word"), F.col("e.counts").alias("c")).groupBy("word").agg(F.sum("c").alias("c"))
    vocabulary = write_shared(vocabulary, "vocabulary")
    words, distinct, once, twice = vocabulary.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)
    ).first()
    ends = chunks.select(F.sum(F.size(F.filter("train", lambda x: x)))).first()[0] or 0
    total, known = words + ends, distinct + (ends > 0)
    discount = once / (once + 2 * twice) if once and twice else 0.5
    per_end = max(words, 1) / max(ends, 1)
    lattice = first_lattice(read_pieces(model), per_end)
    for _ in range(config.rounds if words else 0):
        lattice = refit(vocabulary, lattice, per_end, config)

    shared = spark.sparkContext.broadcast(lattice)
    arc = log(discount * known / total) if total else 0.0

    def with_whole(c: int, pieces: float) -> float:
        """Log of the sum over the arc of the whole word and the paths over pieces."""
        p = arc + pieces
        if not c:
            return p
        q = log((c - discount) / total)
        return max(p, q) + log(1 + exp(-abs(p - q)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for word, c in zip(batch.column("word").to_pylist(), batch.column("c").to_pylist(), strict=True):
                scores.append(with_whole(c, shared.value.log_probability(word)) / LN10)
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), pa.array(scores, pa.float64())], ["word", "c", "score"])

    scored = write_shared(vocabulary.mapInArrow(score, "word binary, c long, score double"), "scored")
    back = entries.select("chunk", "place", F.col("e.words").alias("word")).join(scored, "word").select(F.col("chunk").alias("of_chunk"), "place", "c", "score")
    stored = chunks.select("chunk", "ids", "sizes", "gaps", "uses")

    end_known = int(ends > 0)
    end_base = np.log10((ends + 1) / (total + known + 1))
    end_score = with_whole(ends, lattice.end) / LN10

    def sums(left: pa.Table, right: pa.Table) -> pa.Table:
        place = right.column("place").to_numpy()
        c = np.zeros(len(place), dtype=np.float64)
        s = np.zeros(len(place), dtype=np.float64)
        c[place] = right.column("c").to_numpy()
        s[place] = right.column("score").to_numpy()
        base = np.log10((c + 1) / (total + known + 1))
        sizes, gaps, uses = (left.column(x).combine_chunks().flatten().to_numpy() for x in ("sizes", "gaps", "uses"))
        ids = left.column("ids").combine_chunks().flatten()
        at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        places = np.cumsum(gaps, dtype=np.int64)  # each document's gaps add up from zero
        places -= np.repeat(np.concatenate([[0], places])[at[:-1]], sizes)

        def added(values: np.ndarray) -> np.ndarray:
            return np.array([values[a:b].sum() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)])

        return pa.table(
            {
                "doc_id": ids,
                "n_tokens": pa.array(added(uses) + 1, pa.int64()),
                "n_known": pa.array(added(uses * (c[places] > 0)) + end_known, pa.int64()),
                "train_tokens": pa.array(np.full(len(ids), total), pa.int64()),
                "base_score": pa.array(added(base[places] * uses) + end_base, pa.float64()),
                "score": pa.array(added(s[places] * uses) + end_score, pa.float64()),
            }
        )

    kind = rows.schema["id"].dataType.simpleString()
    return stored.groupBy("chunk").cogroup(back.groupBy("of_chunk")).applyInArrow(
        sums, f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
