"""The default stop list and the predicate over it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 127 English stop words of the default list. They must stay as they are, because the bigram
# discount and the term budget depend on them.
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself
    it its itself they them their theirs themselves what which who whom this that these those am is are was were be
    been being have has had having do does did doing a an the and but if or because as until while of at by for with
    about against between into through during before after above below to from up down in out on off over under again
    further then once here there when where why how all any both each few more most other some such no nor not only
    own same so than too very s t can will just don should now
    """.split()
)


def is_common(term: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """True where ``term`` is on the stop list (the list is a literal, so the test runs as a hash lookup)."""
    words = list(stop_words)
    return term.isin(words) if words else F.lit(False)
