import math
import random

import pytest
from plain_model import dph, edit_distance
from pyspark.sql import functions as F

from broadsheet.functions.distance import (
    LONG_TITLE, least_distance, letters, title_distance, told_apart, too_near,
)
from broadsheet.functions.dph import F_MAX, dph_score

COLUMNS = "tf long, corpus_tf long, length int, avg_length double, n_docs long"


@pytest.mark.parametrize("row", [
    (1, 1, 10, 12.5, 100), (3, 7, 40, 33.3, 100), (2, 100, 40, 33.3, 100),  # factor 1
    (2, 101, 40, 33.3, 100), (1, 150, 10, 12.5, 100),                       # factor 0
    (5, 5, 5, 10.0, 50), (1, 1, 1, 1.0, 1),                                 # tf = length
    (1, 90, 10, 1.0, 100),                                                  # negative
    (40000, 40000, 50000, 10.0, 90000),
])
def test_dph(spark, row):
    df = spark.createDataFrame([row], COLUMNS)
    score = dph_score(*[F.col(c) for c in ("tf", "corpus_tf", "length", "avg_length", "n_docs")])
    value = df.select(score).first()[0]
    assert math.isfinite(value)
    assert value == pytest.approx(dph(*row), rel=1e-12)


def test_dph_signs(spark):
    assert dph(2, 101, 40, 33.3, 100) == 0.0
    assert dph(1, 90, 10, 1.0, 100) < 0


@pytest.mark.parametrize("a, b, expected", [
    ("abcd", "abcd", 0.0), ("abcd", "abxy", 0.5), ("abcd", "abcx", 0.25), ("ABCD", "abcd", 1.0),
    ("été", "ete", 2 / 3), ("", "ab", 1.0), ("a", "abcdefgh", 7 / 8),
])
def test_title_distance(spark, a, b, expected):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    row = df.select(
        title_distance(F.col("a"), F.col("b")), too_near(F.col("a"), F.col("b"), 0.5)).first()
    assert row[0] == pytest.approx(expected) == edit_distance(a, b) / max(len(a), len(b))
    assert row[1] == (expected < 0.5)


def test_distance_of_empty_titles_has_no_value(spark):
    df = spark.createDataFrame([("", "")], "a string, b string")
    assert math.isnan(df.select(title_distance(F.col("a"), F.col("b"))).first()[0])
    assert df.select(too_near(F.col("a"), F.col("b"), 0.5)).first()[0] is False


def test_letters_of_long_titles_are_a_lower_bound(spark):
    rng = random.Random(6)
    pairs = []
    for _ in range(60):
        a = rng.choices("etaoin shrdlu ABCéß9\U0001f600", k=rng.randint(LONG_TITLE + 1, 200))
        b = list(a)
        for _ in range(rng.choice([0, 5, 60, 120])):
            b[rng.randrange(len(b))] = rng.choice("etaoin xyzÉ")
        pairs.append(("".join(a), "".join(b)[rng.choice([0, 3]):]))
    pairs += [("e" * 200, "t" * 200), ("short", "e" * 200)]
    df = spark.createDataFrame(pairs, "a string, b string").withColumn("x", letters(F.col("a"))).withColumn(
        "y", letters(F.col("b")))
    a, b, x, y = (F.col(c) for c in "abxy")
    rows = df.select("a", "b", least_distance(x, y).alias("least"), F.levenshtein("a", "b").alias("edits"),
                     too_near(a, b, 0.4, x, y).alias("near"), too_near(a, b, 0.4).alias("plain"),
                     told_apart(a, b, 0.4, x, y).alias("apart")).collect()
    for row in rows:
        assert row.least is None or row.least <= row.edits
        assert row.near == row.plain
        assert not (row.apart and row.near)
    assert sum(r.apart for r in rows) >= 2 and any(r.near for r in rows)
    assert [r.least for r in rows[-2:]] == [200, None]


def test_titles_of_30000_letters_are_mostly_told_apart_by_their_letters(spark):
    """Ten of them, each of letters of its own and one near copy: one pair has to be compared."""
    titles = [c * 30_000 for c in "etaoinsrh"] + ["e" * 29_000 + "x" * 1_000]
    df = spark.createDataFrame(list(enumerate(titles)), "i int, t string").withColumn("x", letters(F.col("t")))
    a, b = df.toDF("i", "a", "x"), df.toDF("j", "b", "y")
    pairs = a.join(b, F.col("i") < F.col("j"))
    full = pairs.where(~told_apart(F.col("a"), F.col("b"), 0.5, F.col("x"), F.col("y")))
    assert [tuple(r) for r in full.select("i", "j").collect()] == [(0, 9)]
    near = pairs.where(too_near(F.col("a"), F.col("b"), 0.5, F.col("x"), F.col("y")))
    assert [tuple(r) for r in near.select("i", "j").collect()] == [(0, 9)]


def test_the_share_of_a_document_of_one_term_is_fixed():
    assert F_MAX == 0.99999
