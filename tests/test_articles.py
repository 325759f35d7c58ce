import pytest
from pyspark.sql import functions as F

from broadsheet.operators.articles import (
    article_tokens, articles_with_title, index_text, index_texts, lead_paragraphs)

SCHEMA = "doc_id long, title string, contents array<struct<content string, subtype string>>"


def article(spark, title, contents):
    return spark.createDataFrame([(1, title, contents)], SCHEMA)


@pytest.mark.parametrize("title, kept", [(None, 0), ("", 0), (" ", 1), ("Rain", 1)])
def test_titles(spark, title, kept):
    assert articles_with_title(article(spark, title, [])).count() == kept


@pytest.mark.parametrize("n", [0, 4, 5, 6])
def test_first_five_paragraphs_in_order(spark, n):
    contents = []
    for i in range(n):
        contents += [(f"p{i}", "paragraph"), (f"x{i}", "Paragraph"), (f"y{i}", None)]
    df = article(spark, "t", contents)
    assert df.select(lead_paragraphs(F.col("contents"))).first()[0] == [
        f"p{i}" for i in range(min(n, 5))]


def test_paragraph_without_text_reads_null(spark):
    df = article(spark, "Rain", [(None, "paragraph"), ("", "paragraph"), ("sun", "paragraph")])
    text = df.select(index_text(F.col("title"), F.col("contents"))).first()[0]
    assert text == "Rain null  sun"
    assert article_tokens(index_texts(df)).first()["tokens"] == ["rain", "null", "sun"]


@pytest.mark.parametrize("contents", [None, [], [None]])
def test_no_paragraphs(spark, contents):
    df = article(spark, "Rain", contents)
    assert df.select(index_text(F.col("title"), F.col("contents"))).first()[0] == "Rain"


def test_length_counts_what_is_left_and_may_be_zero(spark):
    df = article(spark, "The rain", [("is here today", "paragraph")])
    row = article_tokens(index_texts(df)).first()
    assert (row.length, row.tokens) == (2, ["rain", "today"])
    assert article_tokens(index_texts(article(spark, "The", []))).first()["length"] == 0


def test_a_columnar_source_reads_two_fields_of_the_items(spark, tmp_path):
    from broadsheet.schema import ARTICLE
    path = str(tmp_path / "articles")
    spark.createDataFrame([], ARTICLE).withColumn("doc_id", F.col("id")).write.parquet(path)
    tokens = article_tokens(index_texts(spark.read.parquet(path)))
    plan = tokens._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert "contents:array<struct<content:string,subtype:string>>" in schema
    assert "author" not in schema
    assert "IsNotNull(title)" in plan.split("PushedFilters: ")[1].splitlines()[0]
