"""Abstract and text expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The stop words left out of the index.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it", "no", "not", "of", "on", "or",
    "such", "that", "the", "their", "then", "there", "these", "they", "this", "to", "was", "will", "with",
)

# Fixed value: longer runs of letters and digits are cut into tokens of this length.
MAX_TOKEN_LENGTH = 127


def _let(value: Column, body) -> Column:
    """Bind ``value`` once, so that lambdas inside ``body`` do not evaluate it per element."""
    return F.transform(F.array(value), body)[0]


#: Places are held as position x 2^32 + number of the key, so that they sort as plain numbers.
KEY_BITS = 32


def _places(index: Column) -> Column:
    """Every counted position of an inverted index with the number of its key, ascending."""

    def of_key(positions: Column, k: Column) -> Column:
        return F.transform(positions, lambda p: F.shiftleft(p.cast("bigint"), KEY_BITS).bitwiseOR(k.cast("bigint")))

    return F.sort_array(F.flatten(F.transform(F.map_values(index), of_key)))


def _position(place: Column) -> Column:
    return F.shiftright(place, KEY_BITS).cast("int")


def _key(keys: Column, place: Column) -> Column:
    return F.get(keys, place.bitwiseAND(F.lit((1 << KEY_BITS) - 1)).cast("int"))


def _blank_to_null(c: Column) -> Column:
    return _let(c, lambda value: F.when(value.rlike(r"\S"), value))


def rebuild_positional(index: Column) -> Column:
    """Text of an inverted index, one slot per counted position.

    Positions past the number of slots are dropped, a later key takes over a slot in use, and an unused slot
    is an empty string between two spaces.
    """

    def render(s: Column, keys: Column) -> Column:
        n = F.size(s)
        # the usual case: every slot is used exactly once, so the i-th place is at position i
        words = F.transform(s, lambda x, i: F.when(_position(x) == i, _key(keys, x)))
        full = _let(words, lambda w: F.when(F.size(F.array_compact(w)) == n, F.array_join(w, " ")))
        usual = F.when(n > 0, full)
        return F.coalesce(usual, _let(_kept(s, n), lambda k: fill(k, keys, n)))

    def _kept(s: Column, n: Column) -> Column:
        return F.filter(
            s,
            lambda x, i: (_position(x) >= 0)
            & (_position(x) < n)
            & ((i == n - 1) | (_position(F.get(s, i + 1)) != _position(x))),
        )

    def fill(k: Column, keys: Column, n: Column) -> Column:
        spaced = F.transform(
            k,
            lambda x, i: F.concat(
                F.repeat(F.lit(" "), _position(x) - F.when(i == 0, F.lit(0)).otherwise(_position(F.get(k, i - 1)))),
                _key(keys, x),
            ),
        )
        tail = F.repeat(F.lit(" "), n - 1 - _position(F.get(k, F.size(k) - 1)))
        return F.when(F.size(k) > 0, F.concat(F.array_join(spaced, ""), tail))

    return _blank_to_null(_let(F.map_keys(index), lambda keys: _let(_places(index), lambda s: render(s, keys))))


def rebuild_sorted(index: Column) -> Column:
    """Text of an inverted index with all tokens in position order and no gaps. Tokens are taken as they are."""
    words = _let(F.map_keys(index), lambda keys: F.transform(_places(index), lambda x: _key(keys, x)))
    return F.array_join(words, " ")


def title_abstract(title: Column, abstract: Column) -> Column:
    """Title and abstract with a space between; NULL only when both are."""
    joined = F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(abstract, F.lit("")))
    return F.when(title.isNotNull() | abstract.isNotNull(), joined)


def at_least(abstract: Column, length: int = 25) -> Column:
    """The abstract when it is long enough to be one."""
    return F.when(F.length(abstract) >= length, abstract)


def clean_list(items: Column, strip=None) -> Column:
    """Text array without commas and quotes; empty elements go, an empty array becomes NULL."""

    def clean(item: Column) -> Column:
        bare = F.translate(item, ",\"'", "")
        return bare if strip is None else strip(bare)

    kept = F.filter(F.transform(items, clean), lambda item: F.length(item) > 0)
    return F.when(F.size(kept) > 0, kept)


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order."""
    pattern = F.lit(r"[\p{L}\p{N}]{1,%d}" % MAX_TOKEN_LENGTH)
    return F.regexp_extract_all(F.lower(text), pattern, F.lit(0))


def positions_by_item(items: Column) -> Column:
    """A list of words as a list of (term, positions), each term once; NULL for an empty list.

    The words are sorted with their places and cut where the word changes, all inside the row: grouping the words
    of a text needs no shuffle, since the text is already in one place.
    """

    def cut(s: Column) -> Column:
        n = F.size(s)
        starts = F.filter(
            F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(s, i)["t"] != F.get(s, i - 1)["t"])
        )

        def runs(places: Column) -> Column:
            return _let(
                starts,
                lambda b: F.transform(
                    b,
                    lambda start, j: F.struct(
                        F.get(s, start)["t"].alias("term"),
                        F.slice(places, start + 1, F.coalesce(F.get(b, j + 1), n) - start).alias("positions"),
                    ),
                ),
            )

        return F.when(n > 0, _let(s["p"], runs))

    return _let(F.sort_array(F.transform(items, lambda t, i: F.struct(t.alias("t"), i.alias("p")))), cut)


# Double consonants left by a suffix, of which one goes.
DOUBLED = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")


def light_stem(term: Column) -> Column:
    """A small English suffix rule set, for matching stemmed against unstemmed. Not a full stemmer."""
    stem = F.regexp_replace(term, "(sses)$", "ss")
    stem = F.regexp_replace(stem, "(ies)$", "i")
    stem = F.regexp_replace(stem, "([^s])s$", "$1")
    bare = F.regexp_replace(stem, "([aeiouy].*)(ing|ed)$", "$1")
    doubled = (bare != stem) & F.right(bare, F.lit(2)).isin(*DOUBLED)
    return F.when(doubled, F.substring(bare, F.lit(1), F.length(bare) - 1)).otherwise(bare)  # running, runn, run


def highlight(text: Column, terms: list[str], before: str = "<b>", after: str = "</b>") -> Column:
    """Mark whole-word matches of ``terms``, ignoring case; nothing in a term or marker is taken as a pattern."""
    words = "|".join(re.sub(r"([^\w\s])", r"\\\1", t) for t in sorted(terms, key=len, reverse=True))
    pattern = rf"(?iu)(?<![\p{{L}}\p{{N}}_])({words})(?![\p{{L}}\p{{N}}_])"
    marks = [re.sub(r"([\\$])", r"\\\1", mark) for mark in (before, after)]
    return F.regexp_replace(text, pattern, f"{marks[0]}$1{marks[1]}")
