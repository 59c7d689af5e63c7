"""The published English Snowball stemmer (Porter2) as column expressions.

Meant for the distinct terms of a dictionary, not for every word of a text. The regions R1 and R2 are two numbers found once for
each word; every step looks at the end of the word and at where its suffix begins. Words are lower-case letters; others
pass through with the same rules.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the published algorithm.
VOWELS = "aeiouy"
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
BEFORE_LI = "cdeghkmnrt"
R1_BEGINNINGS = ("gener", "commun", "arsen")
WHOLE_WORDS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli",
    "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
KEPT_AFTER_PLURALS = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")
STEP_2 = {
    "ization": "ize", "ational": "ate", "fulness": "ful", "ousness": "ous", "iveness": "ive", "tional": "tion", "biliti": "ble",
    "lessli": "less", "entli": "ent", "ation": "ate", "alism": "al", "aliti": "al", "ousli": "ous", "iviti": "ive", "fulli": "ful",
    "enci": "ence", "anci": "ance", "abli": "able", "izer": "ize", "ator": "ate", "alli": "al", "bli": "ble", "ogi": "og", "li": "",
}
STEP_3 = {
    "ational": "ate", "tional": "tion", "alize": "al", "icate": "ic", "iciti": "ic", "ative": "", "ical": "ic", "ness": "", "ful": "",
}
STEP_4 = (
    "ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion", "al", "er", "ic",
)


def _let(value: Column, body) -> Column:
    """Bind a value once."""
    return F.transform(F.array(value), body)[0]


def _less(word: Column, n: int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)


def _suffix(word: Column, suffixes) -> Column:
    """The longest of the suffixes at the end of the word, or an empty string."""
    longest = sorted(suffixes, key=lambda s: (-len(s), s))
    return F.regexp_extract(word, f"({'|'.join(longest)})$", 1)


def _begin(word: Column, suffix: Column) -> Column:
    return F.length(word) - F.length(suffix)


def _marked(word: Column) -> Column:
    """A y that begins the word or follows a vowel is a consonant, written Y."""
    first = F.regexp_replace(word, "^y", "Y")
    return F.regexp_replace(first, f"([{VOWELS}])y", "$1Y")


def _region(text: Column) -> Column:
    """The length up to and with the first consonant after a vowel, of the whole text if there is none."""
    found = F.length(F.regexp_extract(text, f"^.*?[{VOWELS}][^{VOWELS}]", 0))
    return F.when(found > 0, found).otherwise(F.length(text))


def _regions(word: Column) -> Column:
    """R1 and R2 as numbers of letters before them."""
    special = F.length(F.regexp_extract(word, f"^({'|'.join(R1_BEGINNINGS)})", 1))
    r1 = F.when(special > 0, special).otherwise(_region(word))
    return _let(r1, lambda n: F.struct(n.alias("r1"), (n + _region(F.substring(word, n + 1, F.length(word)))).alias("r2")))


def _short_end(word: Column) -> Column:
    """Whether the word ends in a short syllable."""
    return word.rlike(f"(^[{VOWELS}][^{VOWELS}]|[^{VOWELS}][{VOWELS}][^{VOWELS}wxY])$")


def _plural(word: Column) -> Column:
    """Step 1a."""
    return (
        F.when(word.endswith("sses"), _less(word, 2))
        .when(word.rlike("ie[ds]$"), F.when(F.length(word) > 4, _less(word, 2)).otherwise(_less(word, 1)))
        .when(word.rlike("(us|ss)$"), word)
        .when(word.rlike(f"[{VOWELS}].+s$"), _less(word, 1))
        .otherwise(word)
    )


def _participle(word: Column, r1: Column) -> Column:
    """Step 1b."""

    def mended(stem: Column) -> Column:
        return (
            F.when(stem.rlike("(at|bl|iz)$"), F.concat(stem, F.lit("e")))
            .when(F.right(stem, F.lit(2)).isin(*DOUBLES), _less(stem, 1))
            .when((r1 >= F.length(stem)) & _short_end(stem), F.concat(stem, F.lit("e")))
            .otherwise(stem)
        )

    def by_suffix(s: Column) -> Column:
        stem = F.substring(word, F.lit(1), _begin(word, s))
        ee = F.when(_begin(word, s) >= r1, F.concat(stem, F.lit("ee"))).otherwise(word)
        rest = F.when(stem.rlike(f"[{VOWELS}]"), _let(stem, mended)).otherwise(word)
        return F.when(s == "", word).when(s.startswith("eed"), ee).otherwise(rest)

    return _let(_suffix(word, ("eed", "eedly", "ed", "edly", "ing", "ingly")), by_suffix)


def _final_y(word: Column) -> Column:
    """Step 1c."""
    return F.regexp_replace(word, f"^(.+[^{VOWELS}])[yY]$", "$1i")


def _replaced(word: Column, suffix: Column, table: dict[str, str]) -> Column:
    """The word with its suffix, one of the table's, replaced."""
    to = F.lit("")
    for s, t in table.items():
        to = F.when(suffix == s, F.lit(t)).otherwise(to)
    return F.concat(F.substring(word, F.lit(1), _begin(word, suffix)), to)


def _step_2(word: Column, r1: Column) -> Column:
    def by_suffix(s: Column) -> Column:
        before = F.substring(word, _begin(word, s), F.lit(1))
        fits = (s != "") & (_begin(word, s) >= r1)
        fits = fits & ((s != "ogi") | (before == "l")) & ((s != "li") | (F.instr(F.lit(BEFORE_LI), before) > 0) & (before != ""))
        return F.when(fits, _replaced(word, s, STEP_2)).otherwise(word)

    return _let(_suffix(word, STEP_2), by_suffix)


def _step_3(word: Column, r1: Column, r2: Column) -> Column:
    def by_suffix(s: Column) -> Column:
        at = _begin(word, s)
        fits = (s != "") & (at >= r1) & ((s != "ative") | (at >= r2))
        return F.when(fits, _replaced(word, s, STEP_3)).otherwise(word)

    return _let(_suffix(word, STEP_3), by_suffix)


def _step_4(word: Column, r2: Column) -> Column:
    def by_suffix(s: Column) -> Column:
        at = _begin(word, s)
        fits = (s != "") & (at >= r2) & ((s != "ion") | F.substring(word, at, F.lit(1)).isin("s", "t"))
        return F.when(fits, F.substring(word, F.lit(1), at)).otherwise(word)

    return _let(_suffix(word, STEP_4), by_suffix)


def _step_5(word: Column, r1: Column, r2: Column) -> Column:
    at = F.length(word) - 1
    stem = _less(word, 1)
    drop_e = word.endswith("e") & ((at >= r2) | ((at >= r1) & ~_short_end(stem)))
    drop_l = word.endswith("ll") & (at >= r2)
    return F.when(drop_e | drop_l, stem).otherwise(word)


def english_stem(term: Column) -> Column:
    """The stem of a lower-case word; words of one or two letters and the listed ones have their own."""

    def steps(word: Column) -> Column:
        def with_regions(r: Column) -> Column:
            def after_plurals(p: Column) -> Column:
                stem = _let(p, lambda x: _participle(x, r["r1"]))
                stem = _let(stem, _final_y)
                stem = _let(stem, lambda x: _step_2(x, r["r1"]))
                stem = _let(stem, lambda x: _step_3(x, r["r1"], r["r2"]))
                stem = _let(stem, lambda x: _step_4(x, r["r2"]))
                stem = _let(stem, lambda x: _step_5(x, r["r1"], r["r2"]))
                return F.when(p.isin(*KEPT_AFTER_PLURALS), p).otherwise(F.translate(stem, "Y", "y"))

            return _let(_plural(word), after_plurals)

        return _let(_regions(word), with_regions)

    own = F.lit(None).cast("string")
    for word, stem in WHOLE_WORDS.items():
        own = F.when(term == word, F.lit(stem)).otherwise(own)
    return F.when(F.length(term) <= 2, term).otherwise(F.coalesce(own, _let(_marked(term), steps)))
