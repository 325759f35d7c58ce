import random

import pytest
from plain_model import STOP, stem as plain_stem, tokens as plain_tokens
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from broadsheet.functions.porter import STEP_2, STEP_3, STEP_4, starts, stem
from broadsheet.functions.stopwords import ENGLISH, as_tokens
from broadsheet.functions.tokens import remove_stopwords, tokenize
from broadsheet.operators.terms import count_tokens, keep_possible_tokens, term_starts, text_to_terms


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "x string").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize("text, expected", [
    ("Rain, rain: GO away!", ["rain", "rain", "go", "away"]),
    ("café naïve", ["caf", "na", "ve"]),
    ("a" * 3 + " " + "b" * 4, ["aaa"]),
    ("xaaaab xaaab", ["xaaab"]),
    ("1234 12345 a1b2c3d4 a1b2c3d4e5", ["1234", "a1b2c3d4"]),
    ("abcdefghijklmnopqrst abcdefghijklmnopqrstu", ["abcdefghijklmnopqrst"]),
    ("ab" * 5000 + " end", ["end"]),
    ("<p>Rain</p>", ["p", "rain", "p"]),
    ("İstanbul Kelvin", ["stanbul", "elvin"]),
    ("", []), (None, []),
])
def test_tokens(spark, text, expected):
    assert one(spark, tokenize, text) == expected
    assert plain_tokens(text) == expected


def test_tokens_of_random_text(spark):
    rng = random.Random(1)
    texts = [
        "".join(rng.choices("aab1122  -éZ", k=rng.randint(0, 200))) for _ in range(500)
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "x string").select(
        "x", tokenize(F.col("x")).alias("tokens")
    ).collect()
    assert all(row.tokens == plain_tokens(row.x) for row in rows)


def test_stopwords_are_sparks(spark):
    assert sorted(ENGLISH) == sorted(StopWordsRemover.loadDefaultStopWords("english"))
    assert {"don", "t", "ll", "the"} <= set(as_tokens(ENGLISH))


def test_stopwords_go_and_can_be_replaced(spark):
    assert one(spark, lambda x: remove_stopwords(tokenize(x)), "The rain, don't you know") == [
        "rain", "know"]
    assert one(spark, lambda x: remove_stopwords(tokenize(x), ["rain"]), "The rain") == ["the"]
    assert one(spark, lambda x: remove_stopwords(tokenize(x), []), "The rain") == ["the", "rain"]


# The examples of the paper, taken through all steps.
PAPER = """
caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre
plastered plaster bled bled motoring motor sing sing conflated conflat troubled troubl
sized size hopping hop tanned tan falling fall hissing hiss fizzed fizz failing fail
filing file happy happi sky sky relational relat conditional condit rational ration
valenci valenc hesitanci hesit digitizer digit conformabli conform radicalli radic
differentli differ vileli vile analogousli analog vietnamization vietnam predication predic
operator oper feudalism feudal decisiveness decis hopefulness hope callousness callous
formaliti formal sensitiviti sensit sensibiliti sensibl triplicate triplic formative form
formalize formal electriciti electr electrical electr hopeful hope goodness good
revival reviv allowance allow inference infer airliner airlin gyroscopic gyroscop
adjustable adjust defensible defens irritant irrit replacement replac adjustment adjust
dependent depend adoption adopt homologou homolog communism commun activate activ
angulariti angular homologous homolog effective effect bowdlerize bowdler probate probat
rate rate cease ceas controll control roll roll generalizations gener oscillators oscil
as as is is y y yy yy
""".split()


def stems(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "token string")
    return {r.token: r.stem for r in df.select("token", stem(F.col("token")).alias("stem")).collect()}


def test_porter_on_the_papers_examples(spark):
    expected = dict(zip(PAPER[::2], PAPER[1::2]))
    assert stems(spark, expected) == expected
    assert {w: plain_stem(w) for w in expected} == expected


def made_up_words(n):
    rng = random.Random(7)
    endings = [*STEP_2, *STEP_3, *STEP_4, "ed", "ing", "eed", "s", "sses", "ies", "y", "e", "ll",
               "ated", "bling", "izing", "yed", ""]
    words = set()
    while len(words) < n:
        root = "".join(rng.choices("aeioubcdlrstyyz9", k=rng.randint(0, 5)))
        words.add((root + rng.choice(endings) + rng.choice(["", "", "s", "ly", "ing"]))[:20])
    short = {a + b + e for a in "aeiobyt1" for b in "aeiobyt1" for e in ["", "s", "ed", "ing"]}
    return sorted(words - {""} | short)


def test_porter_on_made_up_words(spark):
    words = made_up_words(6000)
    assert stems(spark, words) == {w: plain_stem(w) for w in words}


def test_a_token_starts_like_its_stem(spark):
    words = made_up_words(20000)
    df = spark.createDataFrame([(w, plain_stem(w)) for w in words], "token string, stem string")
    found = F.exists(starts(F.col("stem")), lambda s: F.startswith("token", s))
    assert df.where(~found).count() == 0


def test_only_tokens_that_cannot_match_are_left_out(spark):
    df = spark.createDataFrame(
        [(["rain", "raining", "ran", "sun", "say", "sai", "it"],)], "tokens array<string>"
    )
    assert keep_possible_tokens(df, ["rai", "sa"]).first()[0] == [
        "rain", "raining", "say", "sai"]
    assert keep_possible_tokens(df, []).first()[0] == []


def test_text_to_terms_keeps_order_and_repeats(spark):
    df = spark.createDataFrame([(1, "The floods, flooding; a flood"), (2, "the")], "id int, t string")
    found = text_to_terms(df, "id", "t")
    # Only counts of tokens are shuffled, for the table of frequent ones.
    assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    rows = found.orderBy("id", "pos").collect()
    rare = text_to_terms(df, "id", "t", frequent=1).orderBy("id", "pos").collect()
    assert rare == rows
    assert [tuple(r) for r in rows] == [(1, 0, "flood"), (1, 1, "flood"), (1, 2, "flood")]
    assert "the" in STOP


def test_tokens_are_counted_in_their_row(spark):
    rows = [(0, ["b", "a", "b", "b", "c", "a"]), (1, []), (2, ["x"]), (3, ["y", "y"])]
    df = count_tokens(spark.createDataFrame(rows, "doc_id int, tokens array<string>"))
    found = {r.doc_id: [tuple(t) for t in r.tokens] for r in df.collect()}
    assert found == {0: [("a", 2), ("b", 3), ("c", 1)], 1: [], 2: [("x", 1)], 3: [("y", 2)]}
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("letters", [4, 5, 19])
def test_a_token_has_all_letters_of_its_stem_but_the_last(spark, letters):
    words = made_up_words(20000)
    df = spark.createDataFrame([(w, plain_stem(w)) for w in words], "token string, stem string")
    found = F.exists(starts(F.col("stem"), letters), lambda s: F.startswith("token", s))
    assert df.where(~found).count() == 0


def test_beginnings_are_as_long_as_their_number_allows(spark):
    rows = [(1, t, 1, 4) for t in ("rainfal", "rainbow", "raincoat", "sun")]
    df = spark.createDataFrame(rows, "query_id long, term string, qn long, n_terms long")
    assert term_starts(df)[1] == ["rainb", "rainc", "rainf", "su"]
    assert term_starts(df, most=3)[1] == ["rain", "su"]
    assert term_starts(df, most=1)[1] == ["rai", "su"]
    assert term_starts(df.where("false")) == (0, [])
