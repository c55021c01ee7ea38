"""Tokenising text with array expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Common English function words removed before topic modelling. Contractions
# written with an apostrophe are left out, as the alphabetic test drops them anyway.
STOPWORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom "
    "this that these those am is are was were be been being have has had having do does did "
    "doing a an the and but if or because as until while of at by for with about against between "
    "into through during before after above below to from up down in out on off over under again "
    "further then once here there when where why how all any both each few more most other some "
    "such no nor not only own same so than too very s t can will just don should now d ll m o re "
    "ve y ain aren couldn didn doesn hadn hasn haven isn ma mightn mustn needn shan shouldn wasn "
    "weren won wouldn"
).split()


def tokenize(
    text: Column,
    stopwords: Sequence[str] = STOPWORDS,
    min_length: int = 4,
    separators: str = r"[\s;,#]",
) -> Column:
    """Lower-cased alphabetic words of at least ``min_length`` letters, in order."""
    words = F.split(F.lower(F.trim(text)), separators)
    stop = [w for w in stopwords if len(w) >= min_length]
    keep = lambda w: (F.length(w) >= min_length) & ~w.isin(*stop) & w.rlike(r"^\p{L}+$")
    return F.filter(words, keep)
