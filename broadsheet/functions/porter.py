"""Porter stemming (M. F. Porter, "An algorithm for suffix stripping", 1980).

A word is ``[C](VC)^m[V]`` for runs ``C`` of consonants and ``V`` of vowels; a "y" is a
vowel after a consonant. Written as a regular expression this is unambiguous once a
leading "y", a consonant, is set apart as "Y".
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_C = "[^aeiou][^aeiouy]*"
_V = "[aeiouy][aeiou]*"
_VOWEL = "[aeiouy]"

M_OVER_0 = f"^(?:{_C})?{_V}{_C}"
M_IS_1 = f"^(?:{_C})?{_V}{_C}(?:{_V})?$"
M_OVER_1 = f"^(?:{_C})?{_V}{_C}{_V}{_C}"

# A word of measure 1 that ends consonant, vowel, consonant, the last not w, x or y.
SHORT = f"^{_C}[aeiouy][^aeiouwxy]"

# A double consonant other than l, s and z. A "yy" is one after a consonant or "vowel y".
DOUBLE = r"(?:([^aeiouylsz])\1|(?:[^aeiouy]|[aeiou]y)yy)"

# The suffix tables of the paper.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "",
    "ness": "",
}
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)


def ending(suffixes) -> str:
    """A pattern whose group 1 is the longest of the suffixes at the end of a word."""
    return "(" + "|".join(suffixes) + ")$"


def _without(word: Column, letters: Column | int) -> Column:
    return F.left(word, F.length(word) - letters)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _plural(word: Column) -> Column:
    return F.regexp_replace(word, "(?<=ss|i)es$|(?<=[^s])s$", "")


def _past_or_gerund(word: Column) -> Column:
    """Step 1b up to the removal; "#" marks a word that lost -ed or -ing."""
    return (
        F.when(
            word.endswith("eed"),
            F.when(_without(word, 3).rlike(M_OVER_0), _without(word, 1)).otherwise(word),
        )
        .when(word.rlike(f"{_VOWEL}.*(?:ed|ing)$"), F.regexp_replace(word, "(?:ed|ing)$", "#"))
        .otherwise(word)
    )


def _repair(word: Column) -> Column:
    """Step 1b after the removal."""
    return (
        F.when(~word.endswith("#"), word)
        .when(word.rlike(f"(?:at|bl|iz|{SHORT})#$"), F.concat(_without(word, 1), F.lit("e")))
        .when(word.rlike(f"{DOUBLE}#$"), _without(word, 2))
        .otherwise(_without(word, 1))
    )


def _final_y(word: Column) -> Column:
    return F.when(
        word.rlike(f"{_VOWEL}.*y$"), F.concat(_without(word, 1), F.lit("i"))
    ).otherwise(word)


def _suffix_step(suffixes, change: Callable[[Column, Column, Column], Column]):
    """A step on the longest of the suffixes; ``change`` gets word, suffix and the rest."""

    def step(word: Column) -> Column:
        return _let(
            F.regexp_extract(word, ending(suffixes), 1),
            lambda suffix: F.when(suffix == "", word).otherwise(
                change(word, suffix, _without(word, F.length(suffix)))
            ),
        )

    return step


def _replace_from(table: dict[str, str]):
    def change(word: Column, suffix: Column, rest: Column) -> Column:
        entries = [F.lit(part) for item in table.items() for part in item]
        new = F.create_map(*entries)[suffix]
        return F.when(rest.rlike(M_OVER_0), F.concat(rest, new)).otherwise(word)

    return _suffix_step(table, change)


def _remove_residual(word: Column, suffix: Column, rest: Column) -> Column:
    removable = rest.rlike(M_OVER_1) & ((suffix != "ion") | rest.rlike("[st]$"))
    return F.when(removable, rest).otherwise(word)


def _final_e(word: Column) -> Column:
    rest = _without(word, 1)
    removable = rest.rlike(M_OVER_1) | (rest.rlike(M_IS_1) & ~rest.rlike(f"{SHORT}$"))
    return F.when(word.endswith("e") & removable, rest).otherwise(word)


def _final_ll(word: Column) -> Column:
    return F.when(
        word.endswith("ll") & word.rlike(M_OVER_1), _without(word, 1)
    ).otherwise(word)


_STEPS = (
    _plural, _past_or_gerund, _repair, _final_y,
    _replace_from(STEP_2), _replace_from(STEP_3),
    _suffix_step(STEP_4, _remove_residual),
    _final_e, _final_ll,
)


def stem(token: Column) -> Column:
    """The Porter stem of a token. Tokens of one or two letters stay as they are.

    Each step maps an array of one word, so that its input is computed once although the
    step reads it several times.
    """
    word = F.array(F.regexp_replace(token, "^y", "Y"))
    for step in _STEPS:
        word = F.transform(word, step)
    whole = F.length(token) <= 2
    return F.when(whole, token).otherwise(F.regexp_replace(word[0], "^Y", "y"))


def starts(term: Column, letters: int = 3) -> Column:
    """Beginnings, of so many ``letters`` at most, one of which every token with this stem has.

    The rules take letters off the end of a word or change its last letter, so that a stem
    has all its letters but the last from the token. ("-bility" becomes "-ble", but never keeps
    that "e".) In one of two letters, a last "i" may have been a "y".
    """
    length = F.length(term)
    either = F.array(term, F.concat(F.left(term, F.lit(1)), F.lit("y")))
    same = F.when(length <= 2, F.lit(2)).otherwise(F.least(length - 1, F.lit(letters)))
    return F.when((length == 2) & term.endswith("i"), either).otherwise(
        F.array(F.left(term, same))
    )
