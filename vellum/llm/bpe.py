"""Byte-level BPE encoding and decoding in linear time.

Bytes are mapped to Latin-1 characters, so that the trie of an Aho-Corasick automaton over the vocabulary finds how far tokens
reach from a place of a string. A string is encoded from the left by its longest matching token; the next token must be compatible with the one before, that
is, merging the bytes of the two must give back exactly these two tokens. Where no token is compatible, the last choice goes
back to its next shorter token, and a position that failed is not tried again. As an encoding is the one that merging gives
if and only if all neighbours are compatible, the result equals the merges'; compatibility is memoised by token pair. It is found
without merging: the tokens next to the border grow in the order of their ranks, and the pair is incompatible if the two of
some moment would merge before either grows.

The text is split by the vocabulary's pattern first. Words that are tokens themselves are encoded as such. Encodings of
words are kept in a table of bounded size in each Python worker, which never changes a result.

Null and empty texts have no ids. Repeated rows give repeated results; other columns are ignored; an empty table gives no
rows. Any string that UTF-8 can write is encoded and decoded without loss.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from vellum.llm.common import text_slices, texts

KEPT_WORDS = 400_000
KEPT_PAIRS = 1_000_000
NEVER = 1 << 40


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class ByteBpe:
    """Encoder and decoder for one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.bytes = ranks, {v: k for k, v in ranks.items()}
        self.sizes = {v: len(k) for k, v in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.automaton = ahocorasick.Automaton()
        for token in ranks:
            self.automaton.add_word(token.decode("latin-1"), len(token))
        self.longest = max(map(len, ranks), default=0)
        # of each token the longest shorter one that it begins with, of each beginning of a token the longest token in it
        self.shorter: dict[int, int | None] = {}
        self.deepest: dict[bytes, int | None] = {}
        for token, rank in sorted(ranks.items()):
            inside = None
            for i in range(1, len(token)):
                inside = ranks.get(token[:i], inside)
                self.deepest[token[:i]] = inside
            self.deepest[token], self.shorter[rank] = rank, inside
        self.pairs: dict[int, bool] = {}
        self.edges: tuple[dict[int, list[int]], dict[int, list[int]]] = ({}, {})
        self.pieces: dict[str, tuple[int, str, bytes]] = {}
        self.older: dict[str, tuple[int, str, bytes]] = {}
        self.words: dict[str, tuple[int, str, bytes]] = {}

    def merge(self, data: bytes, stop: int = 1) -> list[int]:
        """The merges themselves, on the few bytes of a token, until ``stop`` parts are left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > stop:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
            if rank == NEVER:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def edge(self, token: int, side: int) -> list[int]:
        """The tokens at the left (0) or right (1) end of a token while its bytes merge, smallest first."""
        known = self.edges[side].get(token)
        if known is None:
            halves = self.merge(self.bytes[token], stop=2)
            known = [token] if len(halves) < 2 else [*self.edge(halves[-side], side), token]
            self.edges[side][token] = known
        return known

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of two tokens gives these two again."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.meet(self.edge(left, 1), self.edge(right, 0))
        return known

    def meet(self, left: list[int], right: list[int]) -> bool:
        """Whether two growing edges never merge with each other. Of equal merges the left one comes first."""
        i = j = 0
        while True:
            across = self.ranks.get(self.bytes[left[i]] + self.bytes[right[j]], NEVER)
            grow_left = left[i + 1] if i + 1 < len(left) else NEVER
            grow_right = right[j + 1] if j + 1 < len(right) else NEVER
            if across < grow_left and across <= grow_right and across != NEVER:
                return False
            if grow_left == grow_right == NEVER:
                return True
            if grow_left <= grow_right:
                i += 1
            else:
                j += 1

    def encode_piece(self, data: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        own = self.ranks.get(data)
        if own is not None:
            return [own]
        text, n, longest = data.decode("latin-1"), len(data), self.longest
        reach, deepest, shorter, sizes, known = self.automaton.longest_prefix, self.deepest, self.shorter, self.sizes, self.pairs
        failed: set[tuple[int, int]] = set()
        ids: list[int] = []
        at, last = 0, -1
        token = deepest[data[: reach(text[:longest])]]
        while True:
            while token is not None:
                if last < 0 or (known.get(last << 32 | token) or self.compatible(last, token)):
                    if not failed or (token, at + sizes[token]) not in failed:
                        break
                token = shorter[token]
            if token is not None:
                ids.append(token)
                last = token
                at += sizes[token]
                if at == n:
                    return ids
                token = deepest[data[at : at + reach(text[at : at + longest])]]
            else:  # nothing fits after the last token: take the next shorter one in its place
                ids.pop()
                failed.add((last, at))
                at -= sizes[last]
                token, last = shorter[last], ids[-1] if ids else -1

    def piece(self, piece: str) -> tuple[int, str, bytes]:
        """Of one match of the pattern: number of ids, the ids as text with a space after each, the decoded bytes."""
        known = self.pieces.get(piece)
        if known is None:
            known = self.older.get(piece)
            if known is not None:
                self.pieces[piece] = known
                return known
            if len(self.pieces) >= KEPT_WORDS:  # what the last generation did not use is forgotten
                self.older, self.pieces = self.pieces, {}
            ids = self.encode_piece(piece.encode())
            known = (len(ids), "".join([f"{i} " for i in ids]), b"".join([self.bytes[i] for i in ids]))
            if len(piece) < 64:
                self.pieces[piece] = known
        return known

    def word(self, word: str) -> tuple[int, str, bytes]:
        """The same of a run without clean breaks."""
        known = self.words.get(word) or self.pieces.get(word)
        if known is None:
            parts = [self.piece(p) for p in self.pattern.findall(word)]
            if len(parts) == 1:
                return parts[0]
            known = (sum([p[0] for p in parts]), "".join([p[1] for p in parts]), b"".join([p[2] for p in parts]))
            if len(word) < 24:
                if len(self.words) >= KEPT_WORDS:
                    self.words.clear()
                self.words[word] = known
        return known

    def encode(self, text: str) -> list[int]:
        """Ids of a text."""
        return [int(i) for w in clean_words(text) for i in self.word(w)[1].split()]

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of ids."""
        return b"".join([self.bytes[i] for i in ids])


DOUBLE_SPACE = re.compile(r"\s\s")


def clean_words(text: str) -> list[str]:
    """Cut a text before each single space, where no match of the pattern can reach across.

    A text with white space side by side stays whole, as a match may span it.
    """
    if DOUBLE_SPACE.search(text):
        return [text]
    first, *rest = text.split(" ")
    return [first, *[" " + w for w in rest]]


ENCODERS: dict[tuple[str, str], ByteBpe] = {}


def encoder(path: str, pattern: str) -> ByteBpe:
    """The encoder of a rank file, built once in a Python process."""
    if (path, pattern) not in ENCODERS:
        ENCODERS[path, pattern] = ByteBpe(read_ranks(path), pattern)
    return ENCODERS[path, pattern]


def bpe_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, pattern)
        for batch in batches:
            for ids, rows in text_slices(batch):
                n, of_ids, of_bytes = [], [], []
                for text in rows:
                    known = [bpe.word(w) for w in clean_words(text)]
                    n.append(sum([k[0] for k in known]))
                    of_ids.append(hashlib.sha256("".join([k[1] for k in known])[:-1].encode()).hexdigest())
                    of_bytes.append(hashlib.sha256(b"".join([k[2] for k in known])).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.schema.field("id").type), pa.array(n, pa.int64()), pa.array(of_ids), pa.array(of_bytes)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return texts(docs, id_col, text_col).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def bpe_ids(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every whole text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, pattern)
        for batch in batches:
            for ids, rows in text_slices(batch):
                out = pa.array([bpe.encode(t) for t in rows], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field("id").type), out], ["doc_id", "ids"])

    return texts(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def bpe_text(ids: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, data): the bytes of (doc_id, ids)."""
    kind = ids.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, pattern)
        for batch in batches:
            data = [bpe.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "data"])

    return ids.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, data binary")
