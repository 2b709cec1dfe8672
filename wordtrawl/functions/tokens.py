"""Tokenisers and token-array columns.

A tokeniser maps a text column to an ``ARRAY<STRING>`` column of normalised tokens. Everything stays in one row: no
tokeniser shuffles, and positions are array offsets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordtrawl.functions.sentences import KEPT_PERIOD, keep_abbreviations
from wordtrawl.functions.stemming import stem_tokens
from wordtrawl.functions.stopwords import STOP_WORDS, is_common

# What counts as a word for the regex tokeniser, and (second pattern) a word or else one ASCII separator
# other than the space.
WORD_PATTERN = r"[a-zA-Z0-9@#*&']+"
WORD_OR_SEPARATOR_PATTERN = WORD_PATTERN + r"|[\x00-\x1f\x21-\x7f]"

# A token is kept if it has one ASCII letter or one decimal digit of any script.
_ALPHANUMERIC = r"[a-zA-Z\p{Nd}]"

# Word-boundary conventions of Treebank-style tokenisation as (pattern, replacement) steps that put spaces where a
# word ends. The patterns use no look-around. A sentence ends at . with closing quotes before white space and a
# capital or digit (run twice, because neighbouring matches share that capital) or at the end of the text.
_CLOSERS = r"[\])}>\"'»”’]*"
_SENTENCE_END = (rf"([^.\s])\.({_CLOSERS}\s+[\"'(\[{{<«“‘]*[\p{{Lu}}\p{{Nd}}])", r"$1 . $2")
TREEBANK_STEPS = (
    (r"([«»“”„‘’]|`+)", " $1 "),
    _SENTENCE_END,
    _SENTENCE_END,
    (rf"([^.\s])\.({_CLOSERS}\s*)$", r"$1 . $2"),
    (r"([:,])([^\p{Nd}])", r" $1 $2"),
    (r"(\.\.+)", " $1 "),
    (r"([;@#$%&?!*\[\](){}<>])", " $1 "),
    (r"--", " -- "),
    (r"(\"|'')", " $1 "),
    (r"([^'])' ", "$1 ' "),
    (r"\s+", " "),
    (r"(?i)([^' ])('s|'m|'d|') ", "$1 $2 "),
    (r"([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ", "$1 $2 "),
    (r"(?i)\b(can)(not)\b", "$1 $2"),
    (r"(?i)\b(d)('ye)\b", "$1 $2"),
    (r"(?i)\b(gim|lem)(me)\b", "$1 $2"),
    (r"(?i)\b(gon|wan)(na)\b", "$1 $2"),
    (r"(?i)\b(got)(ta)\b", "$1 $2"),
    (r"(?i)\b(more)('n)\b", "$1 $2"),
    (r"(?i)( )('t)(is|was)\b", "$1$2 $3"),
)


def keep_alnum(tokens: Column) -> Column:
    """Drop tokens without any ASCII letter or decimal digit."""
    return F.filter(tokens, lambda t: F.rlike(t, F.lit(_ALPHANUMERIC)))


def lower_tokens(tokens: Column) -> Column:
    """Lower-case tokens; done after splitting, since lower-casing can change what splits."""
    return F.transform(tokens, F.lower)


def remove_stop_words(tokens: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """Drop stop words, keeping the order of the rest."""
    words = list(stop_words)
    return F.filter(tokens, lambda t: ~is_common(t, words))


def regex_tokenize(text: Column, include_separator: bool = False) -> Column:
    """Every run of word characters, lower-cased; optionally also the ASCII characters in between, in order."""
    pattern = WORD_OR_SEPARATOR_PATTERN if include_separator else WORD_PATTERN
    return lower_tokens(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def word_tokenize(text: Column, abbreviations: Iterable[str] | Column = ()) -> Column:
    """Treebank-style split of a text into words and punctuation, case kept.

    ``abbreviations``, lower-case literals or an array column, keep their period within the text.
    """
    some = isinstance(abbreviations, Column) or (abbreviations := list(abbreviations))
    spaced = F.concat(F.lit(" "), F.regexp_replace(text, r"[\s\p{Z}]+", " "), F.lit(" "))
    if some:
        spaced = keep_abbreviations(spaced, abbreviations)
    for pattern, replacement in TREEBANK_STEPS:
        spaced = F.regexp_replace(spaced, pattern, replacement)
    if some:
        spaced = F.replace(spaced, F.lit(KEPT_PERIOD), F.lit("."))
    return F.filter(F.split(spaced, r"\s+"), lambda t: t != "")


def treebank_tokenize(text: Column, abbreviations: Iterable[str] | Column = ()) -> Column:
    """``word_tokenize``, then the alphanumeric filter and lower-casing: the chain of both pages and queries."""
    return lower_tokens(keep_alnum(word_tokenize(text, abbreviations)))


TOKENIZERS: dict[str, Callable[[Column], Column]] = {"regex": regex_tokenize, "treebank": treebank_tokenize}


def tokenize(
    text: Column,
    tokenizer: str = "treebank",
    stem: bool = False,
    drop_stop_words: bool = False,
    stop_words: Iterable[str] = STOP_WORDS,
    abbreviations: Iterable[str] | Column = (),
) -> Column:
    """The full token chain with its options. Null text has no tokens.

    ``abbreviations`` are for ``treebank`` (see ``operators.sentences``); the regex tokeniser has no periods to keep.

    Stop words are tested on the final form of a token, so after stemming when both options are on.
    """
    if tokenizer not in TOKENIZERS:
        raise ValueError(f"unknown tokenizer {tokenizer!r}; choose from {sorted(TOKENIZERS)}")
    fitted = {"abbreviations": abbreviations} if tokenizer == "treebank" else {}
    tokens = TOKENIZERS[tokenizer](F.coalesce(text, F.lit("")), **fitted)
    if stem:
        tokens = stem_tokens(tokens)
    if drop_stop_words:
        tokens = remove_stop_words(tokens, stop_words)
    return tokens


def bigrams(tokens: Column) -> Column:
    """Adjacent token pairs as structs (t1, t2); the array offset is the position of the left token."""
    pairs = F.greatest(F.size(tokens) - 1, F.lit(0))
    lefts = F.slice(tokens, F.lit(1), pairs)
    rights = F.slice(tokens, F.lit(2), pairs)
    return F.arrays_zip(lefts.alias("t1"), rights.alias("t2"))
