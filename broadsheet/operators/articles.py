"""From articles to the tokens that are ranked on.

Articles are rows with a ``doc_id``, a ``title`` and ``contents``. A ``doc_id`` is unique
and may be of any type that can be ordered.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.stopwords import ENGLISH
from broadsheet.functions.tokens import Limits, remove_stopwords, tokenize

# The part of an article that is indexed.
PARAGRAPH = "paragraph"
LEAD_PARAGRAPHS = 5


def articles_with_title(articles: DataFrame) -> DataFrame:
    """Articles whose title is neither null nor empty; a blank one counts as a title."""
    return articles.where(F.col("title").isNotNull() & (F.col("title") != ""))


def one_per_id(articles: DataFrame) -> DataFrame:
    """One article of each ``doc_id``: of several, the least by its other columns, so that
    the same one is taken whenever the rows are read. Copies are merged before they are
    shuffled. The shuffle is of whole articles; sources with unique ids do not need it."""
    rest = [c for c in articles.columns if c != "doc_id"]
    least = articles.groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("article"))
    return least.select("doc_id", "article.*").select(*articles.columns)


def lead_paragraphs(contents: Column) -> Column:
    """The texts of the first five paragraphs; a paragraph without text reads "null".

    Of the items, only two fields are named, so that a columnar source reads no others.
    """
    paragraphs = F.zip_with(
        contents["content"],
        contents["subtype"],
        lambda content, subtype: F.when(
            subtype.eqNullSafe(PARAGRAPH), F.coalesce(content, F.lit("null"))
        ),
    )
    leads = F.slice(F.filter(paragraphs, F.isnotnull), 1, LEAD_PARAGRAPHS)
    return F.coalesce(leads, F.array().cast("array<string>"))


def index_text(title: Column, contents: Column) -> Column:
    """The title and the lead paragraphs, one space between them."""
    return F.array_join(F.concat(F.array(title), lead_paragraphs(contents)), " ")


# The file that a row comes from, as Spark's file sources say it.
FILE = "_metadata.file_path"


def from_files(articles: DataFrame) -> bool:
    """Whether the rows can say which file they come from: those of a file source can, through
    any selections and filters, others not."""
    try:
        articles.select(FILE)
    except AnalysisException:
        return False
    return True


def index_texts(articles: DataFrame, with_file: bool = False) -> DataFrame:
    """``(doc_id, title, index_text)`` of the articles that have a title, and their ``file``."""
    text = index_text(F.col("title"), F.col("contents"))
    file = [F.col(FILE).alias("file")] if with_file else []
    return articles_with_title(articles).select("doc_id", "title", text.alias("index_text"), *file)


def article_tokens(texts: DataFrame, stopwords: Iterable[str] = ENGLISH,
                   limits: Limits = Limits()) -> DataFrame:
    """``(doc_id, title, length, tokens)`` of index texts, and what else they have.

    The tokens are not stemmed. A stemmer drops no token, so their number already is the
    length of the document.
    """
    tokens = remove_stopwords(tokenize(F.col("index_text"), limits), stopwords)
    kept = [c for c in texts.columns if c != "index_text"]
    return texts.select(*kept, tokens.alias("tokens")).select(
        *kept, F.size("tokens").alias("length"), "tokens"
    )
