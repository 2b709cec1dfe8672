"""English stemming (the published Snowball "English" rules) as column expressions.

A word goes through its steps inside one lambda; every intermediate value is bound once, so nothing is computed twice, and
tokens never leave the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the published algorithm: irregular words, words left alone after step 1a, suffix tables.
_IRREGULAR = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl",
    "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos", "bias": "bias",
    "andes": "andes",
}
_LEFT_AFTER_1A = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")
_STEP_1B = ("eed", "eedly", "ed", "edly", "ing", "ingly")
_STEP_2 = {
    "ational": "ate", "fulness": "ful", "iveness": "ive", "ization": "ize", "ousness": "ous", "biliti": "ble",
    "lessli": "less", "tional": "tion", "alism": "al", "aliti": "al", "ation": "ate", "entli": "ent", "fulli": "ful",
    "iviti": "ive", "ousli": "ous", "abli": "able", "alli": "al", "anci": "ance", "ator": "ate", "enci": "ence",
    "izer": "ize", "bli": "ble", "ogi": "og", "li": "",
}
_STEP_3 = {
    "ational": "ate", "tional": "tion", "alize": "al", "ative": "", "icate": "ic", "iciti": "ic", "ical": "ic",
    "ness": "", "ful": "",
}
_STEP_4 = tuple("ement able ance ence ible ment ant ate ent ion ism iti ive ize ous al er ic".split())

_SHORT_SYLLABLE = r"(?:[^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])\z"
_VOWEL = "[aeiouy]"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _table(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def _cut(word: Column, n: int | Column) -> Column:
    """The word without its last ``n`` characters."""
    return F.substring(word, F.lit(1), F.length(word) - n)


def _suffix(word: Column, suffixes) -> Column:
    """The longest of the suffixes that the word has, or the empty string: the leftmost match up to the end."""
    return F.regexp_extract(word, f"(?:{'|'.join(suffixes)})\\z", 0)


def _region(word: Column, pattern: str) -> Column:
    """Length of what ``pattern`` matches at the beginning, or of the whole word."""
    found = F.length(F.regexp_extract(word, f"(?s)^(?:{pattern})", 0))
    return F.when(found > 0, found).otherwise(F.length(word))


def _plural(word: Column) -> Column:
    has = lambda *ends: F.regexp_like(word, F.lit(f"(?:{'|'.join(ends)})\\z"))
    return (
        F.when(has("sses"), _cut(word, 2))
        .when(has("ied", "ies"), F.when(F.length(word) > 4, _cut(word, 2)).otherwise(_cut(word, 1)))
        .when(has("s") & ~has("us", "ss") & F.regexp_like(_cut(word, 2), F.lit(_VOWEL)), _cut(word, 1))
        .otherwise(word)
    )


def _past_or_gerund(word: Column, r1: Column) -> Column:
    def cut(suffix: Column, base: Column) -> Column:
        ends = lambda pattern: F.regexp_like(base, F.lit(pattern))
        return (
            F.when(suffix == "", word)
            .when(F.startswith(suffix, F.lit("eed")), F.when(F.length(base) >= r1, F.concat(base, F.lit("ee"))).otherwise(word))
            .when(~ends(_VOWEL), word)
            .when(ends(r"(?:at|bl|iz)\z"), F.concat(base, F.lit("e")))
            .when(ends(r"(?:bb|dd|ff|gg|mm|nn|pp|rr|tt)\z"), _cut(base, 1))
            .when((F.length(base) <= r1) & ends(_SHORT_SYLLABLE), F.concat(base, F.lit("e")))
            .otherwise(base)
        )

    return _let(_suffix(word, _STEP_1B), lambda s: _let(_cut(word, F.length(s)), lambda base: cut(s, base)))


def _replaced(word: Column, suffixes, allowed: Callable[[Column, Column], Column], new: Callable[[Column], Column]) -> Column:
    """Replace the longest suffix if ``allowed(suffix, base)``."""

    def body(suffix: Column, base: Column) -> Column:
        return F.when((suffix != "") & allowed(suffix, base), F.concat(base, new(suffix))).otherwise(word)

    return _let(_suffix(word, suffixes), lambda s: _let(_cut(word, F.length(s)), lambda base: body(s, base)))


def _last_letter(word: Column, r1: Column, r2: Column) -> Column:
    cut = F.length(word) - 1
    short = F.regexp_like(_cut(word, 1), F.lit(_SHORT_SYLLABLE))
    drop = F.when(F.endswith(word, F.lit("e")), (cut >= r2) | ((cut >= r1) & ~short)).otherwise(
        F.endswith(word, F.lit("ll")) & (cut >= r2)
    )
    return F.when(drop, _cut(word, 1)).otherwise(word)


def _after_plural(word: Column, r1: Column, r2: Column) -> Column:
    ends = lambda base, letters: F.regexp_like(base, F.lit(f"[{letters}]\\z"))
    steps = (
        lambda w: _past_or_gerund(w, r1),
        lambda w: F.regexp_replace(w, r"(?s)(.[^aeiouy])[yY]\z", "$1i"),
        lambda w: _replaced(
            w,
            _STEP_2,
            lambda s, b: (F.length(b) >= r1) & ((s != "ogi") | ends(b, "l")) & ((s != "li") | ends(b, "cdeghkmnrt")),
            lambda s: F.element_at(_table(_STEP_2), s),
        ),
        lambda w: _replaced(
            w, _STEP_3, lambda s, b: F.length(b) >= F.when(s == "ative", r2).otherwise(r1), lambda s: F.element_at(_table(_STEP_3), s)
        ),
        lambda w: _replaced(w, _STEP_4, lambda s, b: (F.length(b) >= r2) & ((s != "ion") | ends(b, "st")), lambda s: F.lit("")),
        lambda w: _last_letter(w, r1, r2),
        lambda w: F.replace(w, F.lit("Y"), F.lit("y")),
    )

    def run(value: Column, left) -> Column:
        return _let(left[0](value), lambda w: run(w, left[1:])) if left else value

    return run(word, steps)


def stem_word(word: Column) -> Column:
    """Stem of a lower-case word."""

    def regular(w: Column) -> Column:
        marked = F.regexp_replace(F.regexp_replace(w, "^'", ""), "(^|[aeiouy])y", "$1Y")
        return _let(marked, lambda m: _let(_region(m, "gener|commun|arsen|.*?[aeiouy][^aeiouy]"), lambda r1: regions(m, r1)))

    def regions(m: Column, r1: Column) -> Column:
        rest = F.substring(m, r1 + 1, F.length(m))
        return _let(r1 + _region(rest, ".*?[aeiouy][^aeiouy]"), lambda r2: steps(m, r1, r2))

    def steps(m: Column, r1: Column, r2: Column) -> Column:
        bare = F.regexp_replace(m, r"(?:'s'|'s?)\z", "")
        singular = lambda b: _let(_plural(b), lambda w: F.when(w.isin(*_LEFT_AFTER_1A), w).otherwise(_after_plural(w, r1, r2)))
        return _let(bare, singular)

    def stem(w: Column) -> Column:
        return F.when(F.length(w) <= 2, w).otherwise(F.coalesce(F.try_element_at(_table(_IRREGULAR), w), regular(w)))

    return _let(F.regexp_replace(word, "[’‘‛]", "'"), stem)


def stems_slot(word: Column, slots: int | Column) -> Column:
    """Place of a word in a table of known stems."""
    return F.pmod(F.hash(word), slots if isinstance(slots, Column) else F.lit(slots))


def stem_tokens(tokens: Column, known: Column | None = None) -> Column:
    """Stem every token of the token arrays; words in ``known`` (see ``operators.stems``) are looked up."""
    if known is None:
        return F.transform(tokens, stem_word)

    def looked_up(table: Column) -> Column:
        stem = lambda w: F.try_element_at(F.get(table, stems_slot(w, F.size(table))), w)
        return F.transform(tokens, lambda w: F.coalesce(stem(w), stem_word(w)))

    return _let(known, looked_up)
