"""Removal of repeated byte strings by merging Burrows-Wheeler transforms of shards.

Every byte that a ``length``-byte string covers which also starts in a document with a smaller id is removed; strings are
judged on the input, and no match crosses documents.

1. The key of a string is the smallest hash of the ``gram``-byte strings inside it. Neighbouring strings with one key travel
   together as one run, and equal strings have equal keys, so all places of a string meet in one bucket of keys.
2. Packs of texts send their distinct keys; a key that only one document holds needs no more work.
3. Packs send the distinct runs of the other keys, each with its smallest document id. Of a key with very many runs each
   string is sent on its own, dealt by its own hash.
4. A bucket cuts its runs into shards, builds the Burrows-Wheeler transform of each, and merges them: an interleave says
   from which shard each row of the merged order comes, and every refinement deals it by the symbols before the rows, which
   sorts it by so many symbols more and splits its blocks where prefixes differ. After ``length`` symbols a block is an
   interval of strings with a common prefix, and its smallest document id is the first holder of that string. No suffix is
   compared with one of another shard.
5. Packs get back which parts of their runs start in an earlier document, and mark, cut and digest their texts.

Documents without id come after all others and do not remove each other's bytes, and neither do rows with one id. Null
texts are empty. Equal texts are the ordinary case; a text of any length is whole in one pack. An empty table gives no
rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm import packs
from vellum.llm.common import write_shared
from vellum.llm.packs import Pack, U, mix

#: The place of documents without id: after all others.
LAST = np.iinfo(np.int64).max


@dataclass(frozen=True)
class SuffixConfig:
    """length: bytes of a repeated string. gram: bytes of a key's string, 8 to length. hot: runs of a key beyond which its
    strings are dealt one by one. pack, bucket, group, shard: bytes of texts seen at once, keys compared in one group, bytes
    of text for each group of runs, symbols of a transform."""

    length: int = 50
    gram: int = 20
    hot: int = 1 << 16
    pack: int = 4 << 20
    bucket: int = 1 << 20
    group: int = 1 << 19
    shard: int = 1 << 18


# -- runs of strings with one key ------------------------------------------------------------------------------------


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes that begin at each place, as one number; ``data`` needs eight spare bytes at its end."""
    return np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))


def offsets(n: int) -> list[int]:
    """Where eights begin that together cover n bytes, n at least 8."""
    return [*range(0, n - 8, 8), n - 8]


def hashed(data: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n bytes from each place on."""
    view, count = eights(data), len(data) - n + 1
    out = np.zeros(count, dtype=U)
    for at in offsets(n):
        out = (out ^ view[at : at + count]) * U(0x9E3779B97F4A7C15)
        out ^= out >> U(29)
    return mix(out)


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of ``width`` neighbours, from each place on."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (width - span)], values[width - span :]) if span < width else values


SLICE = 1 << 17


@dataclass
class Runs:
    """Strings that begin at ``start`` .. ``start + count - 1`` and share ``key``; ``doc`` is the text's number in the pack."""

    start: np.ndarray
    count: np.ndarray
    key: np.ndarray
    doc: np.ndarray

    def where(self, mask: np.ndarray) -> Runs:
        return Runs(self.start[mask], self.count[mask], self.key[mask], self.doc[mask])


def runs(pack: Pack, config: SuffixConfig) -> Runs:
    """All strings of a pack's texts, neighbours with one key as one run of at most ``4 * length`` strings."""
    length, n = config.length, len(pack.data)
    places = max(0, n - length + 1)
    found = []
    ends = pack.starts + pack.sizes
    for lo in range(0, places, SLICE):
        hi = min(places, lo + SLICE)
        data = pack.data[lo : hi + length - 1]
        key = smallest(hashed(data, config.gram), length - config.gram + 1)
        new = np.ones(hi - lo, dtype=bool)
        new[1:] = key[1:] != key[:-1]
        first, last = np.searchsorted(ends, [lo, hi + length], side="right")
        valid = np.ones(hi - lo, dtype=bool)
        for s, e in zip(pack.starts[first : last + 1].tolist(), ends[first : last + 1].tolist(), strict=True):
            valid[max(0, max(s, e - length + 1) - lo) : max(0, e - lo)] = False  # strings that would reach the next text
            if lo <= s < hi:
                new[s - lo] = True
        at = np.flatnonzero(new & valid)
        stop = np.flatnonzero(new | ~valid)
        end = np.append(stop, hi - lo)[np.searchsorted(stop, at, side="right")]
        found.append((at + lo, end - at, mix(key[at])))  # the smallest of hashes are small: mixed again, they fall evenly
    start, count, key = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
    parts = -(-count // (4 * length))
    if (parts > 1).any():
        number = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        start, left, key = np.repeat(start, parts) + number * 4 * length, np.repeat(count, parts) - number * 4 * length, np.repeat(key, parts)
        count = np.minimum(left, 4 * length)
    doc = np.searchsorted(pack.starts, start, side="right") - 1
    return Runs(start, count, key.astype(U), doc)


def ids_of(pack: Pack) -> np.ndarray:
    return np.array([LAST if k is None else k for k in pack.keys], dtype=np.int64)


def distinct_keys(found: Runs) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sorted keys, runs of each, whether two texts of the pack hold it, order of the runs by key)."""
    order = np.argsort(found.key)
    key, doc = found.key[order], found.doc[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(new)
    if not len(first):
        return key, np.zeros(0, np.int64), np.zeros(0, bool), order
    many = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
    return key[first], np.diff(np.append(first, len(key))), many, order


def chosen(pack: Pack, found: Runs, answers: list | None, buckets: int, config: SuffixConfig) -> Runs:
    """The runs whose key is held by two documents anywhere; strings of hot keys one by one, keyed by their own hash."""
    keys, n, many, order = distinct_keys(found)
    shared, hot = packs.received(answers, keys, buckets, 2)
    shared |= many
    of_run = np.empty((2, len(order)), dtype=bool)
    of_run[:, order] = np.repeat([shared, hot], n, axis=1)
    plain, split = found.where(of_run[0] & ~of_run[1]), found.where(of_run[0] & of_run[1])
    if not len(split.start):
        return plain
    at = np.repeat(split.start, split.count)
    at += np.arange(len(at)) - np.repeat(np.cumsum(split.count) - split.count, split.count)
    single = Runs(at, np.ones(len(at), np.int64), strings_hash(pack.data, at, np.full(len(at), config.length)), np.repeat(split.doc, split.count))
    return Runs(*(np.concatenate([getattr(plain, c), getattr(single, c)]) for c in ("start", "count", "key", "doc")))


def words_of(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Eights that together are each string: (which strings, their next eight bytes)."""
    view = eights(data)
    at, rows = 0, np.arange(len(start))
    while len(rows):
        yield rows, view[start[rows] + np.minimum(at, size[rows] - 8)]
        at += 8
        rows = rows[size[rows] > at]


def strings_hash(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    out = size.astype(U)
    for rows, word in words_of(data, start, size):
        x = (out[rows] ^ word) * U(0xD6E8FEB86659FD93)
        out[rows] = x ^ (x >> U(31))
    return mix(out)


def collapsed(data: np.ndarray, start: np.ndarray, size: np.ndarray, key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal strings as one: (one place of each, its smallest document, the number of each string's own), sorted by key."""
    prints = strings_hash(data, start, size)
    order = np.lexsort((prints, key))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (key[order[1:]] != key[order[:-1]]) | (prints[order[1:]] != prints[order[:-1]])
    number = np.cumsum(new) - 1
    leader = order[np.flatnonzero(new)][number] if len(order) else order
    wrong = size[order] != size[leader]
    rows = np.flatnonzero(~wrong)
    for (part, x), (_, y) in zip(words_of(data, start[order[rows]], size[order[rows]]), words_of(data, start[leader[rows]], size[leader[rows]]), strict=True):
        wrong[rows[part]] |= x != y
    if wrong.any():  # of strings that only share a hash, each other one stands alone
        new |= wrong
        new[1:] |= wrong[:-1]
        number = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    least = np.minimum.reduceat(doc[order], first) if len(first) else doc
    own = np.empty(len(order), dtype=np.int64)
    own[order] = number
    return order[first], least, own


def spare(data: np.ndarray) -> np.ndarray:
    """A copy with eight spare bytes at the end."""
    return np.concatenate([data, np.zeros(8, np.uint8)])


# -- transforms of shards and their merge ----------------------------------------------------------------------------


def suffix_order(codes: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Places of a shard sorted by suffix. ``room`` counts the symbols before a string's end, whose code is 0; equal suffixes
    are ordered by place."""
    n = len(codes)
    bits = max(1, (n - 1).bit_length())
    symbol = max(1, int(codes.max(initial=0)).bit_length())
    h = max(1, (64 - bits) // symbol)
    padded = np.concatenate([codes, np.zeros(h, codes.dtype)]).astype(U)
    word = np.zeros(n, dtype=U)
    for j in range(h):
        word = (word << U(symbol)) | np.where(room >= j, padded[j : j + n], U(0))
    here = np.arange(n, dtype=U)
    mask = U((1 << bits) - 1)
    joined = np.sort((word << U(bits)) | here)
    order = (joined & mask).astype(np.int64)
    new = np.ones(n, dtype=bool)
    value = joined >> U(bits)
    new[1:] = (value[1:] != value[:-1]) | (room[order[1:]] < h)
    while True:
        rank = np.empty(n, dtype=np.int64)
        number = np.cumsum(new) - 1
        rank[order] = number
        alone = new & np.append(new[1:], True)
        slots = np.flatnonzero(~alone)
        if not len(slots):
            return order
        todo = np.sort(order[slots])
        after = np.where(room[todo] >= h, rank[np.minimum(todo + h, n - 1)] + 1, 0)
        joined = np.sort((rank[todo].astype(U) << U(2 * bits + 1)) | (after.astype(U) << U(bits)) | todo.astype(U))
        order[slots] = (joined & mask).astype(np.int64)
        h *= 2
        value = joined >> U(bits)
        # of a group the first row keeps its border, the others get one where they differ now
        split = np.ones(len(slots), dtype=bool)
        split[1:] = (value[1:] != value[:-1]) | (room[order[slots[1:]]] < h)
        new[slots] |= split


def step_codes(codes: np.ndarray, room: np.ndarray, alphabet: int, step: int) -> np.ndarray | None:
    """Dense numbers of the next ``step`` symbols at each place, a string's end cutting them off; None if there are too many."""
    n = len(codes)
    if alphabet**step > 1 << 24:
        return None
    wide = np.concatenate([codes, np.zeros(step, codes.dtype)]).astype(np.int32)
    value = np.zeros(n, dtype=np.int32)
    for j in range(step):
        value = value * alphabet + np.where(room >= j, wide[j : j + n], 0)
    present = np.zeros(alphabet**step, dtype=bool)
    present[value] = True
    found = np.flatnonzero(present)
    if len(found) > 1 << 16:
        return None
    del present
    dense = np.zeros(alphabet**step, dtype=np.uint16)
    dense[found] = np.arange(len(found))
    return dense[value]


@dataclass
class Shard:
    """A shard's transform, row by row in the order of its suffixes: ``order`` is where a row's suffix begins, ``before[step]``
    the ``step`` symbols before it as one number, ``to[step]`` the row of the suffix that begins with them, -1 if the string has
    not so many."""

    order: np.ndarray
    before: dict[int, np.ndarray]
    to: dict[int, np.ndarray]


def transform(codes: np.ndarray, room: np.ndarray, behind: np.ndarray, steps: dict[int, np.ndarray]) -> Shard:
    """The transform of one shard; ``behind`` counts a string's symbols before each place, ``steps`` has the codes of the next symbols."""
    order = suffix_order(codes, room)
    rank = np.empty(len(order), dtype=np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    before, to = {}, {}
    for step, code in steps.items():
        earlier = np.where(behind[order] >= step, order - step, -1)
        before[step] = code[earlier]
        to[step] = np.where(earlier >= 0, rank[earlier], -1).astype(np.int32)
    return Shard(order, before, to)


def merged(shards: list[Shard], steps: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Merge transforms: (rows in the order of their next ``sum(steps)`` symbols, number of the block of equal ones of each).

    Rows are numbered through all shards. The interleave, the order in which the shards' rows follow each other, starts as
    one shard after the other. A refinement by ``step`` symbols reads the rows in the present order and hands each to the
    suffix that begins with the symbols before it, behind all that these symbols got before. That sorts by ``step`` symbols
    more: rows of one block with the same symbols share a block again, others are divided, which is where the common
    prefix of neighbours ends. The rows of one shard never change their order. A row alone in its block shares its
    prefix with none, and neither do the suffixes it would be handed to, so it leaves the merge.
    """
    sizes = [len(s.order) for s in shards]
    base = np.cumsum([0, *sizes])
    rows = np.arange(base[-1], dtype=np.int32)
    block = np.zeros(len(rows), dtype=np.int32)
    joined = {}
    for step in set(steps):
        to = [np.where(s.to[step] >= 0, s.to[step] + lo, -1).astype(np.int32) for s, lo in zip(shards, base[:-1].tolist(), strict=True)]
        joined[step] = (np.concatenate([s.before[step] for s in shards]), np.concatenate(to))
    for step in steps:
        before, to = joined[step]
        target = to[rows]
        code = before[rows]
        there = target >= 0
        if not there.all():
            target, code, block = target[there], code[there], block[there]
        dealt = np.argsort(code, kind="stable")
        code, block = code[dealt], block[dealt]
        new = np.ones(len(code) + 1, dtype=bool)
        new[1:-1] = (code[1:] != code[:-1]) | (block[1:] != block[:-1])
        shared = np.flatnonzero(~(new[:-1] & new[1:]))
        rows = target[dealt[shared]]
        block = np.cumsum(new[shared], dtype=np.int32)
    return rows, block


def first_holders(data: np.ndarray, sizes: np.ndarray, docs: np.ndarray, config: SuffixConfig) -> np.ndarray:
    """The smallest document that holds the string at each place of some texts, which stand one after another.

    ``docs`` has the document of each text. At places where no whole string begins that is the result.
    """
    length = config.length
    if not len(sizes):
        return np.zeros(0, np.int64)
    # every text gets an end symbol
    ends = np.cumsum(sizes + 1) - 1
    n = int(ends[-1]) + 1
    text = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + 1)
    present = np.bincount(data, minlength=256) > 0
    alphabet = int(present.sum()) + 1
    codes = np.zeros(n, dtype=np.uint8 if alphabet <= 256 else np.uint16)
    inside = np.ones(n, dtype=bool)
    inside[ends] = False
    codes[inside] = (np.cumsum(present).astype(codes.dtype))[data]
    here = np.arange(n, dtype=np.int32)
    room = ends.astype(np.int32)[text] - here
    behind = here - (ends - sizes).astype(np.int32)[text]
    coded = {}
    for step in (4, 3, 2, 1):
        found = step_codes(codes, room, alphabet, step)
        if found is not None:
            rest = length % step
            coded[step] = found
            if rest:
                coded[rest] = step_codes(codes, room, alphabet, rest)
            steps = [step] * (length // step) + [rest] * bool(rest)
            break
    borders = [0]
    for _, hi in packs.slices((sizes + 1).tolist(), config.shard):
        borders.append(int(ends[hi - 1]) + 1)
    shards = [
        transform(codes[lo:hi], room[lo:hi], behind[lo:hi], {s: c[lo:hi] for s, c in coded.items()})
        for lo, hi in zip(borders[:-1], borders[1:], strict=True)
    ]
    del codes, room, behind, coded
    rows, block = merged(shards, steps)
    out = docs[text]
    if len(rows):
        places = np.concatenate([s.order + lo for s, lo in zip(shards, borders[:-1], strict=True)])[rows]
        first = np.flatnonzero(np.diff(block, prepend=-1))
        least = np.minimum.reduceat(out[places], first)
        out[places] = np.repeat(least, np.diff(np.append(first, len(places))))
    return out[inside]


# -- the whole job -------------------------------------------------------------------------------------------------

RUNS = "bucket int, pack long, keys binary, sizes binary, docs binary, data binary"
#: A part of a run: the run's number, the first string and the one after the last, the first holder.
PART = np.dtype([("run", "<u4"), ("lo", "<u2"), ("hi", "<u2"), ("doc", "<i8")])


def flat_places(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, .. of each range, one after another."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - ends + size, size)


def sent_runs(pack: Pack, found: Runs, groups: int, config: SuffixConfig) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """The distinct runs of a pack by bucket: the rows to send, one place, smallest document and own number of the runs, and
    (bucket, first, end) of what each bucket got."""
    data, size = spare(pack.data), found.count + config.length - 1
    place, least, own = collapsed(data, found.start, size, found.key, ids_of(pack)[found.doc])
    full, at = packs.cuts(found.key[place], groups)
    start, size = found.start[place], size[place]
    rows = list(zip(full.tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True))
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(full),
            pa.array(np.full(len(full), pack.number, dtype=np.int64)),
            pa.array([found.key[place[lo:hi]].astype(np.uint32).tobytes() for _, lo, hi in rows], pa.binary()),
            pa.array([size[lo:hi].astype(np.uint16).tobytes() for _, lo, hi in rows], pa.binary()),
            pa.array([least[lo:hi].tobytes() for _, lo, hi in rows], pa.binary()),
            pa.array([data[flat_places(start[lo:hi], size[lo:hi])].tobytes() for _, lo, hi in rows], pa.binary()),
        ],
        ["bucket", "pack", "keys", "sizes", "docs", "data"],
    )
    return batch, least, own, place, rows


def answered(group: pa.Table, config: SuffixConfig) -> pa.Table:
    """For each pack's runs in a bucket the parts that an earlier document holds than the pack's first one."""
    sizes = np.frombuffer(b"".join(group.column("sizes").to_pylist()), dtype=np.uint16).astype(np.int64)
    docs = np.frombuffer(b"".join(group.column("docs").to_pylist()), dtype=np.int64)
    data = np.frombuffer(b"".join([*group.column("data").to_pylist(), bytes(8)]), dtype=np.uint8)
    number = [len(x) // 8 for x in group.column("docs").to_pylist()]
    keys = np.frombuffer(b"".join(group.column("keys").to_pylist()), dtype=np.uint32)
    start = np.cumsum(sizes) - sizes
    place, least, own = collapsed(data, start, sizes, keys, docs)
    # the distinct runs by key; one that is alone with its key shares no string with another run and has nothing to merge with
    new = np.ones(len(place) + 1, dtype=bool)
    new[1:-1] = keys[place[1:]] != keys[place[:-1]]
    alone = new[:-1] & new[1:]
    size = sizes[place]
    begins = np.cumsum(size) - size
    holder = np.repeat(least, size)
    several = np.flatnonzero(~alone)
    at = flat_places(begins[several], size[several])
    text = data[flat_places(start[place[several]], size[several])]
    holder[at] = first_holders(text, size[several], least[several], config)
    # the strings of every run, with their first holder
    strings = sizes - config.length + 1
    at = flat_places(begins[own], strings)
    run = np.repeat(np.arange(len(sizes)), strings)
    first = holder[at]
    new = np.ones(len(run), dtype=bool)
    new[1:] = (run[1:] != run[:-1]) | (first[1:] != first[:-1])
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(run))
    before = first[lo] < docs[run[lo]]
    lo, hi = lo[before], hi[before]
    string_start = np.cumsum(strings) - strings
    parts = np.empty(len(lo), dtype=PART)
    parts["doc"] = first[lo]
    of = run[lo]
    parts["lo"], parts["hi"] = lo - string_start[of], hi - string_start[of]
    row_start = np.cumsum([0, *number])
    parts["run"] = of - row_start[np.searchsorted(row_start, of, side="right") - 1]
    borders = np.searchsorted(of, row_start).tolist()
    blobs = [parts[lo:hi].tobytes() for lo, hi in zip(borders[:-1], borders[1:], strict=True)]
    table = pa.table({"pack": group.column("pack"), "bucket": group.column("bucket"), "parts": pa.array(blobs, pa.binary())})
    return table.filter(pa.array([len(b) > 0 for b in blobs], pa.bool_()))


def removed(pack: Pack, found: Runs, row: dict, groups: int, config: SuffixConfig) -> np.ndarray:
    """Which bytes of a pack go."""
    _, least, own, place, rows = sent_runs(pack, found, groups, config)
    begin, end = np.zeros(len(pack.data) + 1, np.int32), np.zeros(len(pack.data) + 1, np.int32)

    def cover(start: np.ndarray, stop: np.ndarray) -> None:
        np.add.at(begin, start, 1)
        np.add.at(end, stop, 1)

    mine = ids_of(pack)[found.doc]
    whole = least[own] < mine  # an earlier document of this pack holds the whole run
    cover(found.start[whole], found.start[whole] + found.count[whole] + config.length - 1)
    first = {b: lo for b, lo, _ in rows}
    parts = [np.frombuffer(a["parts"], dtype=PART) for a in row["parts"] or []]
    if parts:
        run = np.concatenate([p["run"].astype(np.int64) + first[a["bucket"]] for p, a in zip(parts, row["parts"], strict=True)])
        part = np.concatenate(parts)
        order = np.argsort(run, kind="stable")
        run, part = run[order], part[order]
        n = np.bincount(run, minlength=len(place))
        base = np.cumsum(n) - n
        # every occurrence of a run has the run's parts
        times = n[own]
        of = np.repeat(np.arange(len(own)), times)
        p = flat_places(base[own], times)
        of, p = of[part["doc"][p] < mine[of]], p[part["doc"][p] < mine[of]]
        cover(found.start[of] + part["lo"][p], found.start[of] + part["hi"][p].astype(np.int64) + config.length - 1)
    return np.cumsum(begin - end)[:-1] > 0


def cut_texts(pack: Pack, gone: np.ndarray) -> Iterator[tuple[int, bytes, list[tuple[int, int]]]]:
    """(text's number, remaining bytes, removed spans) of each text."""
    raw = pack.data.tobytes()
    edge = gone.copy()
    edge[1:] = gone[1:] & ~gone[:-1]
    heads = pack.starts[pack.sizes > 0]
    edge[heads] = gone[heads]
    starts = np.flatnonzero(edge)
    stop = ~gone
    stop[heads] = True
    stops = np.append(np.flatnonzero(stop), len(gone))
    ends = stops[np.searchsorted(stops, starts, side="right")]
    spans = list(zip(starts.tolist(), ends.tolist(), strict=True))
    at = 0
    for i, (s, n) in enumerate(zip(pack.starts.tolist(), pack.sizes.tolist(), strict=True)):
        mine, kept, last = [], [], s
        while at < len(spans) and spans[at][0] < s + n:
            lo, hi = spans[at]
            kept.append(raw[last:lo])
            mine.append((lo - s, hi - s))
            last, at = hi, at + 1
        kept.append(raw[last : s + n])
        yield i, b"".join(kept), mine


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: SuffixConfig | None = None) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): the removed byte ranges of every document and the bytes that remain."""
    config = config or SuffixConfig()
    stored = packs.make_packs(docs, F.col(id_col).cast("long"), config.pack, text_col)
    size = packs.total_bytes(stored)
    buckets = max(1, -(-size // 16 // config.bucket))
    groups = max(1, -(-size // config.group))

    def send_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack, _ in packs.unpacked(batches):
            keys, n, _, _ = distinct_keys(runs(pack, config))
            yield packs.sent(pack.number, keys, n, buckets)

    def send_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack, row in packs.unpacked(batches):
            found = chosen(pack, runs(pack, config), row["answers"], buckets, config)
            if len(found.start):
                yield sent_runs(pack, found, groups, config)[0]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack, row in packs.unpacked(batches):
            found = chosen(pack, runs(pack, config), row["answers"], buckets, config)
            gone = removed(pack, found, row, groups, config)
            out = [(pack.keys[i], int(pack.sizes[i]), spans, kept) for i, kept, spans in cut_texts(pack, gone)]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "n_bytes", "spans", "kept"])

    hot = config.hot
    answers = write_shared(packs.marked(stored.mapInArrow(send_keys, packs.SENT), lambda total, n: [n > 1, total > hot]), "shared")
    known = stored.join(answers, "pack", "left")
    dealt = known.mapInArrow(send_runs, RUNS)
    parts = dealt.groupBy("bucket").applyInArrow(lambda group: answered(group, config), "pack long, bucket int, parts binary")
    parts = write_shared(parts.groupBy("pack").agg(F.collect_list(F.struct("bucket", "parts")).alias("parts")), "parts")
    return known.join(parts, "pack", "left").mapInArrow(finish, "doc_id long, n_bytes long, spans array<array<long>>, kept binary")


def repeat_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: SuffixConfig | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    return repeated_spans(docs, id_col, text_col, config).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
