"""Text to tokens, as column functions."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadsheet.functions.stopwords import ENGLISH, as_tokens

# Limits of the English tokeniser.
MAX_CHARS = 20    # a longer token is dropped
MAX_DIGITS = 4    # a token with more digits is dropped
MAX_REPEATS = 3   # a token with more equal characters in a row is dropped

RUN = "[a-z0-9]+"


@dataclass(frozen=True)
class Limits:
    """What a token may be; ``None`` is no limit. The defaults are those of the tokeniser."""

    chars: int | None = MAX_CHARS
    digits: int | None = MAX_DIGITS
    repeats: int | None = MAX_REPEATS


NO_LIMITS = Limits(None, None, None)

# The two characters outside ASCII whose lower case holds an ASCII letter. They separate
# tokens like any other character outside ASCII, so they go before lower-casing.
_FALSE_LETTERS = ("\u0130", "\u212a")  # capital I with dot, Kelvin sign


def tokenize(text: Column, limits: Limits = Limits()) -> Column:
    """The tokens of a text in order, repeats kept; of a null text, none. Tokens beyond the
    limits are dropped."""
    for letter in _FALSE_LETTERS:
        text = F.replace(text, F.lit(letter), F.lit(" "))
    runs = F.regexp_extract_all(F.lower(text), F.lit(RUN), F.lit(0))
    runs = F.coalesce(runs, F.array().cast("array<string>"))
    return runs if limits == NO_LIMITS else F.filter(runs, lambda token: _kept(token, limits))


def _kept(token: Column, limits: Limits) -> Column:
    """Whether a run of letters and digits is a token. No pattern can match a run that is no
    longer than the least of the limits, so patterns are tried on longer ones only."""
    patterns = []
    if limits.repeats is not None:
        patterns.append(rf"(.)\1{{{limits.repeats}}}")
    if limits.digits is not None:
        patterns.append(rf"[0-9](?:[a-z]*[0-9]){{{limits.digits}}}")
    kept = F.lit(True) if limits.chars is None else F.length(token) <= limits.chars
    if patterns:
        least = min(n for n in (limits.repeats, limits.digits) if n is not None)
        kept = kept & ((F.length(token) <= least) | ~token.rlike("|".join(patterns)))
    return kept


def remove_stopwords(tokens: Column, stopwords: Iterable[str] = ENGLISH) -> Column:
    """The tokens that are not stop words, order and repeats kept."""
    words = as_tokens(stopwords)
    if not words:
        return tokens
    return F.filter(tokens, lambda token: ~token.isin(words))
