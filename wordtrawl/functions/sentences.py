"""Abbreviations: words whose period does not end a sentence."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the published measure (Kiss and Strunk 2006): how sure an abbreviation is to have its period, and the
# score from which a word is one.
CERTAINTY = 0.99
LEAST_SCORE = 0.3

#: Letters, also with single periods between them, and the periods behind.
WORD = r"\p{L}+(?:\.\p{L}+)*\.*"
_LAST_WORD = r"(?:^|[^\p{L}])(\p{L}+(?:\.\p{L}+)*)\.\z"
_CLOSERS = r"[\])}>\"'»”’]*"

#: Stands for the period of an abbreviation while sentence ends are looked for; a noncharacter, which text does not use.
KEPT_PERIOD = "\ufdd0"


def words_with_periods(text: Column) -> Column:
    """Every word of the text, lower-cased, with the periods behind it."""
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lower)


def abbreviation_score(word: Column, with_period: Column, without_period: Column, share: float) -> Column:
    """How much more likely a word always has its period than has it by chance, weighted by its form.

    ``share`` is the share of all words that have a period. The log-likelihood ratio of the counts is lowered by the number of
    letters and by every occurrence without a period, and raised by periods inside the word. Where no word or every word has one, all score 0.
    """
    if not 0 < share < 1:
        return F.lit(0.0)
    chance = with_period * math.log(share) + without_period * math.log(1 - share)
    sure = with_period * math.log(CERTAINTY) + without_period * math.log(1 - CERTAINTY)
    inner = F.length(word) - F.length(F.replace(word, F.lit("."), F.lit("")))
    letters = (F.length(word) - inner).cast("double")
    weight = F.exp(-letters) * (inner + 1) * F.pow(letters, -without_period.cast("double"))
    return 2 * (sure - chance) * weight


def keep_abbreviations(spaced: Column, words: Iterable[str] | Column) -> Column:
    """Put ``KEPT_PERIOD`` for the period of the given words, which are literals or an array column.

    ``spaced`` is a text with single blanks; a ``KEPT_PERIOD`` in it counts as a blank. A text's last word gives up its period, as at the end of any sentence.
    """

    def known(word: Column) -> Column:
        return F.array_contains(words, word) if isinstance(words, Column) else word.isin(*words)

    def kept(piece: Column) -> Column:
        word = F.lower(F.regexp_extract(piece, _LAST_WORD, 1))
        cut = F.concat(F.substring(piece, F.lit(1), F.length(piece) - 1), F.lit(KEPT_PERIOD))
        return F.when(F.endswith(piece, F.lit(".")) & F.coalesce(known(word), F.lit(False)), cut).otherwise(piece)

    plain = F.replace(spaced, F.lit(KEPT_PERIOD), F.lit(" "))
    marked = F.array_join(F.transform(F.split(plain, " "), kept), " ")
    return F.regexp_replace(marked, rf"{KEPT_PERIOD}({_CLOSERS}\s*)\z", ".$1")
