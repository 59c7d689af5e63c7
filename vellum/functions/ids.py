"""Identifier clean-up as column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# URL prefixes removed from identifiers.
URL_PREFIXES = (
    "https://openalex.org/",
    "https://orcid.org/",
    "https://doi.org/",
    "https://www.wikidata.org/wiki/",
    "https://ror.org/",
)

# Fixed value: length of the catalogue's URL prefix.
CATALOGUE_PREFIX_LENGTH = 21

# The identifier kinds used for matching, in matching order.
ID_COLUMNS = (
    "doi",
    "openalex_id",
    "item_id",
    "pubmed_id",
    "s2_id",
    "scopus_id",
    "wos_id",
    "dimensions_id",
)

# Greek and Cyrillic letters in ASCII. Capitals take a capital first letter.
GREEK = dict(zip("αβγδεζηθικλμνξοπρςστυφχψω", "a b g d e z e th i k l m n x o p r s s t u ph kh ps o".split(), strict=True))
CYRILLIC = dict(
    zip(
        "абвгдеёжзийклмнопрстуфхцчшщъыьэюя",
        "a b v g d e io zh z i i k l m n o p r s t u f kh ts ch sh shch ' y ' e iu ia".split(),
        strict=True,
    )
)

# Letters whose ASCII form is not their Unicode decomposition.
SPECIAL_FOLDS = {
    "ß": "ss",
    "æ": "ae",
    "Æ": "AE",
    "œ": "oe",
    "Œ": "OE",
    "þ": "th",
    "Þ": "Th",
    "ø": "o",
    "Ø": "O",
    "đ": "d",
    "Đ": "D",
    "ð": "d",
    "Ð": "D",
    "ł": "l",
    "Ł": "L",
    "ı": "i",
    "–": "-",
    "—": "--",
    "‘": "'",
    "’": "'",
    "“": '"',
    "”": '"',
}


def strip_url(c: Column) -> Column:
    """Remove every known URL prefix, wherever it occurs."""
    pattern = "|".join(p.replace(".", r"\.") for p in URL_PREFIXES)
    return F.regexp_replace(c, pattern, "")


def strip_id(c: Column) -> Column:
    """Drop the catalogue prefix by length; values too short to carry it become NULL."""
    tail = F.substring(c, CATALOGUE_PREFIX_LENGTH + 1, 2**31 - 1)
    return F.when(F.length(c) >= CATALOGUE_PREFIX_LENGTH, tail)


def remove_prefix(c: Column, prefix: str = URL_PREFIXES[0]) -> Column:
    """Drop ``prefix`` only where the value starts with it."""
    return F.when(c.startswith(prefix), F.substring(c, len(prefix) + 1, 2**31 - 1)).otherwise(c)


def parse_id(c: Column, prefix: str) -> Column:
    """The integer behind ``prefix``; NULL when there is nothing behind it."""
    return F.when(F.length(c) > len(prefix), F.substring(c, len(prefix) + 1, 2**31 - 1).try_cast("bigint"))


def _folds() -> dict[str, str]:
    """Every letter of the Latin, Greek and Cyrillic blocks that has an ASCII form, and that form."""
    known = dict(SPECIAL_FOLDS)
    for table in (GREEK, CYRILLIC):
        for char, fold in table.items():
            known[char] = fold
            if len(char.upper()) == 1 and char != "ς":
                known[char.upper()] = fold.capitalize()
    # Latin letters with marks, Greek with accents, Cyrillic, and the additional blocks of the first two
    for first, last in ((0xC0, 0x24F), (0x386, 0x3FF), (0x400, 0x45F), (0x1E00, 0x1FFF)):
        for code in range(first, last + 1):
            char = chr(code)
            base = unicodedata.normalize("NFKD", char)[0]
            if char not in known and base != char and (base.isascii() or base in known):
                known[char] = base if base.isascii() else known[base]
    return known


def _script(char: str) -> str:
    """The block a letter belongs to, for finding out which replacements a value can need."""
    return "Greek" if "\u0370" <= char <= "\u03ff" or "\u1f00" <= char <= "\u1fff" else "Cyrillic" if "\u0400" <= char <= "\u04ff" else "other"


def fold_ascii(c: Column) -> Column:
    """Latin, Greek and Cyrillic letters to ASCII. Other scripts stay as they are.

    One translation turns every letter into its ASCII letter, or into one letter that stands for all with the same longer form; those few
    are then replaced one by one, and only in values that have a letter of their script.
    """
    folds = _folds()
    stands: dict[str, str] = {}  # for a longer form in a script, the letter that stands for it
    table = {}
    for char, fold in folds.items():
        table[char] = fold if len(fold) == 1 else stands.setdefault(f"{_script(char)} {fold}", char)
    table = {char: to for char, to in table.items() if char != to}

    def several(script: str):
        mine = {char: key.partition(" ")[2] for key, char in stands.items() if key.startswith(script)}

        def of(text: Column) -> Column:
            replaced = text
            for char, fold in mine.items():
                replaced = F.replace(replaced, F.lit(char), F.lit(fold))
            return F.when(text.rlike(f"[{''.join(mine)}]"), replaced).otherwise(text)

        return of

    def marks(text: Column) -> Column:
        return F.when(_is_ascii(text), text).otherwise(F.regexp_replace(text, r"\p{Mn}+", ""))

    def folded(text: Column) -> Column:
        steps = F.translate(text, "".join(table), "".join(table.values()))
        for step in (several("other"), several("Greek"), several("Cyrillic"), marks):
            steps = _let(steps, step)
        return F.when(_is_ascii(text), text).otherwise(steps)  # nearly all identifiers are ASCII already

    return _let(c, folded)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a value, so that it is worked out once however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def _is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


# Fixed value: white space around a value.
BLANKS = " \t\n\x0b\f\r"

# The characters that a source does not take in a DOI.
RESERVED = r'[%:="+;\[\]\\]'


def clean_doi(c: Column) -> Column:
    """DOI as sent to a source: no query part, no reserved characters, ASCII, single slashes."""
    trimmed = F.trim(c, F.lit(BLANKS))
    stripped = F.regexp_replace(trimmed, rf"\?[^\n]*|{RESERVED}", "")
    return F.replace(fold_ascii(stripped), F.lit("//"), F.lit("/"))


def doi_key(c: Column) -> Column:
    """DOI as a join key."""
    return F.lower(strip_url(c))
