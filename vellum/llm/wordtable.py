"""Words of a corpus with their token ids, each asked of a tokenizer once while it stays in the table."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from vellum.llm.bpe import DOUBLE_SPACE

#: Words that a table keeps before the older half is forgotten, and the longest word that is kept.
KEPT, LONGEST = 300_000, 48


def byte_level() -> dict[str, int]:
    """The byte of each character in a byte-level vocabulary: printable ones stand for themselves, others follow from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Grown:
    """An array that grows at its end."""

    def __init__(self, kind: type):
        self.held, self.n = np.empty(1 << 12, dtype=kind), 0

    def add(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.held):
            self.held = np.concatenate([self.held[: self.n], np.empty(max(self.n, len(values)), dtype=self.held.dtype)])
        self.held[self.n : self.n + len(values)] = values
        self.n += len(values)

    @property
    def data(self) -> np.ndarray:
        return self.held[: self.n]


class Words:
    """Numbered words: where each one's ids end in a row of ids, for every side, and whether the ids are the space and the word."""

    def __init__(self, sides: int) -> None:
        self.number: dict[str, int] = {}
        self.right = Grown(np.bool_)
        self.ids, self.ends = [Grown(np.int32) for _ in range(sides)], [Grown(np.int64) for _ in range(sides)]

    def add(self, words: list[str], ids: list[np.ndarray], sizes: list[np.ndarray], right: np.ndarray) -> np.ndarray:
        """The numbers of new words, of which short ones can be found again."""
        first = self.right.n
        for side in range(len(self.ids)):
            self.ends[side].add(self.ids[side].n + np.cumsum(sizes[side]))
            self.ids[side].add(ids[side])
        self.right.add(right)
        short = zip(words, range(first, self.right.n), strict=True)
        self.number.update(short if max(map(len, words), default=0) <= LONGEST else [x for x in short if len(x[0]) <= LONGEST])
        return np.arange(first, self.right.n)

    def sizes(self, side: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of words begin, and how many they are."""
        ends = self.ends[side].data
        starts = np.where(numbers > 0, ends[numbers - 1], 0)
        return starts, ends[numbers] - starts

    def of(self, side: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words in a row, and how many each has."""
        starts, n = self.sizes(side, numbers)
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[side].data[np.arange(total) + np.repeat(starts - ends + n, n)], n


#: Kinds of bytes for cuts inside words: ASCII letters, other ASCII bytes, the apostrophe (which may begin a contraction); the rest has none.
LETTER, SIGN, APOSTROPHE = 1, 2, 3
KINDS = np.array([0 if b >= 0x80 or b == 0x20 else APOSTROPHE if b == 0x27 else LETTER if chr(b).isalpha() else SIGN for b in range(256)], dtype=np.uint8)
#: White space of ASCII.
BLANK = np.array([b < 0x80 and chr(b).isspace() for b in range(256)])


def blanks_meet(docs: list[str], encoded: list[bytes]) -> np.ndarray:
    """Which texts begin with white space or have white space side by side."""
    found = np.array([t[:1].isspace() for t in docs], dtype=bool)
    raw = np.frombuffer(b"a".join([b"", *encoded]), dtype=np.uint8)  # a letter before each text
    ends = np.cumsum([1 + len(x) for x in encoded])
    after, before = raw[1:], raw[:-1]
    # other white space has two bytes that begin with C2, or three that begin with E1, E2 or E3
    wide = ((before - 0xE1).astype(np.uint8) <= 2) | ((before == 0xC2) & ((after == 0x85) | (after == 0xA0)))
    for i in np.unique(np.searchsorted(ends, np.flatnonzero(wide), side="right")).tolist():
        found[i] |= DOUBLE_SPACE.search(docs[i]) is not None
    blank = BLANK[raw]
    found[np.searchsorted(ends, np.flatnonzero(blank[1:] & blank[:-1]), side="right")] = True
    return found


def unit_starts(raw: np.ndarray, fine: bool) -> np.ndarray:
    """Where units of a text begin: at spaces and, if ``fine``, where ASCII letters begin after or end before other ASCII signs."""
    starts = raw == 0x20
    if fine and len(raw):
        kind = KINDS[raw]
        before, after = kind[:-1], kind[1:]
        starts[1:] |= ((before == LETTER) & (after > LETTER)) | ((before == SIGN) & (after == LETTER))
    return starts


class WordTokens:
    """Ids of units of texts on every side, asked once for each distinct unit while it stays in the table.

    A unit is a space and a word, or the first word of a text. With ``spaced`` a space stands before every text too.
    A side has ``encode`` (ids of texts) and ``bytes`` (of each id). No token of a side may hold a space after another character.
    With ``fine`` words are cut where letters meet other signs, which is only right for sides that never
    join those, nor white space with what follows it.
    """

    def __init__(self, sides: Sequence, spaced: bool = True, fine: bool = False):
        self.sides, self.spaced, self.fine, self.kept = tuple(sides), spaced, fine, KEPT
        self.sizes = [np.array([len(x) for x in side.bytes], dtype=np.int64) for side in self.sides]
        self.words, self.older = Words(len(self.sides)), Words(len(self.sides))

    def alone(self, units: list[str]) -> np.ndarray:
        """Add units encoded each on its own."""
        ids, sizes, right = [], [], np.ones(len(units), dtype=bool)
        for side in self.sides:
            found = side.encode(units)
            right &= [b"".join([side.bytes[t] for t in x]) == u.encode() for u, x in zip(units, found, strict=True)]
            sizes.append(np.array([len(x) for x in found], dtype=np.int64))
            ids.append(np.array([t for x in found for t in x], dtype=np.int32))
        return self.words.add(units, ids, sizes, right)

    def joined(self, units: list[str], between: str) -> np.ndarray:
        """Add units that neither end with white space nor hold a space inside, encoded as one text and cut where each begins and ends."""
        text = between.join(units)
        raw = text.encode()
        length = np.array([len(u) if u.isascii() else len(u.encode()) for u in units])
        ends = np.cumsum(length + len(between)) - len(between)
        ids, counts = [], []
        for side, sizes in zip(self.sides, self.sizes, strict=True):
            found = side.encode([text])[0]
            given, found = b"".join(map(side.bytes.__getitem__, found)), np.array(found, dtype=np.int32)
            if given != raw:
                return self.alone(units)  # one of them is not its tokens' bytes
            borders = np.concatenate([[0], np.cumsum(sizes[found])])
            first, last = np.searchsorted(borders, ends - length), np.searchsorted(borders, ends)
            if not (np.array_equal(borders[first], ends - length) and np.array_equal(borders[last], ends)):
                return self.alone(units)  # a token reaches over a border
            if between:
                inside = np.zeros(len(found) + 1, dtype=np.int8)
                np.add.at(inside, first, 1)
                np.add.at(inside, last, -1)
                found = found[np.cumsum(inside[:-1]) > 0]
            ids.append(found)
            counts.append(last - first)
        return self.words.add(units, ids, counts, np.ones(len(units), dtype=bool))

    def numbers(self, wanted: list[str]) -> np.ndarray:
        """Each unit's number in the table; units that are not in it are added."""
        if len(self.words.number) > self.kept or self.words.ids[0].n > 32 * self.kept:
            self.older, self.words = self.words, Words(len(self.sides))
        out = np.fromiter(map(self.words.number.get, wanted, repeat(-1)), dtype=np.int64, count=len(wanted))
        new = np.flatnonzero(out < 0)
        units = list(map(wanted.__getitem__, new.tolist()))
        if self.older.number:
            before = np.fromiter(map(self.older.number.get, units, repeat(-1)), dtype=np.int64, count=len(units))
            held = before >= 0
            if held.any():
                kept, known = new[held], before[held]
                found = [self.older.of(side, known) for side in range(len(self.sides))]
                right = self.older.right.data[known]
                out[kept] = self.words.add([wanted[i] for i in kept.tolist()], [x for x, _ in found], [n for _, n in found], right)
                new = new[~held]
                units = list(map(wanted.__getitem__, new.tolist()))
        # 0: on its own, 1: begins with its only space, 2: has no space; a line feed may stand between such units if ``fine``
        kind = np.array(
            [0 if not u or len(u) > LONGEST or u[-1].isspace() or u.rfind(" ") > 0 else 1 if u[0] == " " and not u[1].isspace() else 2 if self.fine and not u[0].isspace() else 0 for u in units],
            dtype=np.int8,
        )
        for this, encode in ((1, lambda x: self.joined(x, "")), (2, lambda x: self.joined(x, "\n")), (0, self.alone)):
            some = np.flatnonzero(kind == this)
            some = np.array(sorted(some.tolist(), key=units.__getitem__), dtype=np.int64)  # like ones after another are encoded faster
            for lo in range(0, len(some), 512):
                part = some[lo : lo + 512]
                out[new[part]] = encode([units[i] for i in part.tolist()])
        return out

    def encode(self, docs: list[str], whole: Sequence[bool] | None = None) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Ids of all texts in a row and the number of tokens of each text, for every side; which texts are their tokens' bytes.

        A text with white space side by side, or marked in ``whole``, is one unit.
        """
        encoded = [t.encode() for t in docs]
        odd = blanks_meet(docs, encoded)
        whole = odd if whole is None else odd | np.array(whole, dtype=bool)
        mark = " " if self.spaced else ""
        parts = [b"" if w or not x else mark.encode() + x for w, x in zip(whole.tolist(), encoded, strict=True)]
        raw = np.frombuffer(b"".join(parts), dtype=np.uint8)
        begin = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
        del encoded, parts
        starts = np.append(unit_starts(raw, self.fine), True)
        starts[begin] = True
        at = np.flatnonzero(starts)
        counts = np.diff(np.searchsorted(at, begin))
        units = pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(raw)])
        coded = pc.dictionary_encode(units)
        wanted = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # strings at once, not one scalar each
        number = self.numbers([*wanted, *[mark + docs[i] for i in np.flatnonzero(whole).tolist()]])
        # the units of each text: its words, or itself
        counts[whole] = 1
        of = np.repeat(np.arange(len(docs)), counts)
        if whole.any():
            itself = whole[of]
            at = np.empty(len(of), dtype=np.int64)
            at[~itself] = coded.indices.to_numpy()
            at[itself] = len(wanted) + np.arange(int(itself.sum()))
            at = number[at]
        else:
            at = number[coded.indices.to_numpy()]
        ids, tokens_of = [], []
        for side in range(len(self.sides)):
            found, n = self.words.of(side, at)
            ids.append(found)
            tokens_of.append(np.bincount(of, weights=n, minlength=len(docs)).astype(np.int64))
        right = np.bincount(of, weights=~self.words.right.data[at], minlength=len(docs)) == 0
        return ids, tokens_of, right
