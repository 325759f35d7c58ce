"""How different two titles are, as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _longer(a: Column, b: Column) -> Column:
    return F.greatest(F.length(a), F.length(b))


def title_distance(a: Column, b: Column) -> Column:
    """Edit distance over the longer length: 0 for equal titles, 1 for all different.

    Two empty titles have no longer length; their distance is NaN.
    """
    longer = _longer(a, b)
    return F.when(longer == 0, F.lit(float("nan"))).otherwise(F.levenshtein(a, b) / longer)


# Titles of more letters than this have their letters counted, in these classes; all other
# letters make one more.
LONG_TITLE = 128
CLASSES = ("eE", "tT", "aA", "oO", "iI", "nN", "sS", "rR", "hH", "lL", "dDuU", "cCmM", " ")


def letters(title: Column) -> Column:
    """How many letters of each class a long title has; null for a short one."""
    counts = [F.length(title) - F.length(F.translate(title, group, "")) for group in CLASSES]
    rest = F.length(F.translate(title, "".join(CLASSES), ""))
    return F.when(F.length(title) > LONG_TITLE, F.array(*counts, rest))


def least_distance(a_letters: Column, b_letters: Column) -> Column:
    """A number of edits that two titles need at least, from what ``letters`` says of them: an
    edit takes at most one letter from a class and adds at most one to another. Null unless
    both are long."""
    over, under = (
        F.aggregate(F.zip_with(x, y, lambda m, n: F.greatest(m - n, F.lit(0))), F.lit(0), lambda t, m: t + m)
        for x, y in ((a_letters, b_letters), (b_letters, a_letters)))
    return F.greatest(over, under)


# Letters of a piece at least; the pieces of longer titles grow with the root of their length, as
# finding a piece costs as much as what is before it.
PIECE = 24


def most_distance(a: Column, b: Column, enough: float) -> Column:
    """A number of edits that two titles need at most: both are cut into as many pieces, and piece
    by piece is a way from one to the other. Pieces are compared until what has been saved so far
    brings the number below ``enough`` times the longer length; the rest counts in full. It takes
    time in proportion to the length, or to its power of 1.5 for the longest, not to its square."""
    def cut(length: Column, n: Column, i: Column) -> Column:
        return F.floor(i * length / n).cast("int")

    def bound(s: Column) -> Column:
        longer = F.greatest(s["a"], s["b"])

        def step(left: Column, i: Column) -> Column:
            def piece(title: Column, length: Column) -> Column:
                return title.substr(cut(length, s["n"], i) + 1,
                                    cut(length, s["n"], i + 1) - cut(length, s["n"], i))

            own = cut(longer, s["n"], i + 1) - cut(longer, s["n"], i)
            edits = F.levenshtein(piece(a, s["a"]), piece(b, s["b"]))
            return F.when(left < longer * enough, left).otherwise(left + edits - own)

        return F.aggregate(F.sequence(F.lit(0), s["n"] - 1), longer, step)

    longer = _longer(a, b)
    n = F.ceil(longer / (PIECE + F.floor(F.sqrt(longer) / 3))).cast("int")
    # Lengths are found once: an array of one row, mapped.
    lengths = F.struct(F.length(a).alias("a"), F.length(b).alias("b"), F.greatest(n, F.lit(1)).alias("n"))
    return F.transform(F.array(lengths), bound)[0]


def told_apart(a: Column, b: Column, min_distance: float, a_letters: Column | None = None,
               b_letters: Column | None = None) -> Column:
    """Whether lengths, or classes of letters, say that two titles keep ``min_distance``."""
    longer = F.nullif(_longer(a, b), F.lit(0))
    apart = F.abs(F.length(a) - F.length(b)) / longer >= min_distance
    if a_letters is None or b_letters is None:
        return apart
    return apart | F.coalesce(least_distance(a_letters, b_letters) / longer >= min_distance, F.lit(False))


def too_near(a: Column, b: Column, min_distance: float, a_letters: Column | None = None,
             b_letters: Column | None = None) -> Column:
    """Whether two titles are closer than ``min_distance``.

    The edit distance is at least the difference of the lengths, and at least what ``letters``
    differ by, so titles that these keep apart are not compared letter by letter; nor are
    equal ones, and those that are near by ``most_distance``.
    """
    if min_distance <= 0:
        return F.lit(False)
    longer = F.nullif(_longer(a, b), F.lit(0))
    apart = told_apart(a, b, min_distance, a_letters, b_letters)
    near = ~apart & ((a == b) | (most_distance(a, b, min_distance) / longer < min_distance)
                     | (F.levenshtein(a, b) / longer < min_distance))
    return F.coalesce(near, F.lit(False))
