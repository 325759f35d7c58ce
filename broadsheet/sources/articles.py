"""Article lines (one JSON document each) to typed rows."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.cluster import new_folder
from broadsheet.schema import (
    ARTICLE, ARTICLE_FIELDS, ARTICLE_LINE, ARTICLE_SHAPE, CONTENT_FIELDS, MALFORMED, TEXT_FIELDS,
)
from broadsheet.sources.lines import scan_lines

MODES = ("failfast", "permissive", "drop")


def _unknown_fields(line: Column) -> Column:
    known = F.array(*[F.lit(name) for name in ARTICLE_FIELDS])
    return F.array_except(F.json_object_keys(line), known)


# A field with an object or an array in it, other than `contents` with an array. Objects and
# arrays have no other place in a line where a field name stands before them.
_OTHER_STRUCTURE = r"""(?<!["']contents)["']\s*:\s*[\[{]|["']contents["']\s*:\s*\{"""


def _structure_as_text(line: Column) -> Column:
    """Whether a text field of a line, or of a content item, holds an object or an array.
    Numbers and booleans count as text."""

    def structured(value: Column) -> Column:
        return F.coalesce(F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)"), F.lit(False))

    shape = F.from_json(line, ARTICLE_SHAPE)
    in_items = F.exists(shape["contents"], lambda item: reduce(
        or_, [structured(item[name]) for name in CONTENT_FIELDS]))
    return reduce(or_, [structured(shape[name]) for name in TEXT_FIELDS]) | F.coalesce(
        in_items, F.lit(False))


def _date(text: Column) -> Column:
    """A whole or decimal number as a long; 0 where the article has none."""
    return F.coalesce(text.try_cast("decimal(38,6)").try_cast("bigint"), F.lit(0).cast("bigint"))


def check_article_lines(lines: DataFrame) -> DataFrame:
    """Parse each line: ``value``, the ``article`` struct, and ``problem``.

    ``problem`` is null for a good line, else "malformed line" (no JSON object, or a field
    of the wrong type), or "unknown field" for a top-level field that articles do not
    have. Unknown fields of content items are ignored.
    """
    parsed = lines.select(
        "value",
        F.from_json(
            "value", ARTICLE_LINE,
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED},
        ).alias("article"),
        _unknown_fields(F.col("value")).alias("unknown"),
        # Few lines have a place for such a structure; only those are parsed for it.
        F.when(F.col("value").rlike(_OTHER_STRUCTURE), _structure_as_text(F.col("value")))
        .otherwise(F.lit(False)).alias("structured"),
    )
    date = F.col("article.published_date")
    malformed = (
        F.col("article").isNull()
        | F.col(f"article.{MALFORMED}").isNotNull()
        | F.col("unknown").isNull()
        | F.col("structured")
        | (date.isNotNull() & date.try_cast("decimal(38,6)").isNull())
    )
    fields = [
        (_date(date) if name == "published_date" else F.col(f"article.{name}")).alias(name)
        for name in ARTICLE_FIELDS
    ]
    return parsed.select(
        "value",
        F.struct(*fields).cast(ARTICLE).alias("article"),
        F.when(malformed, F.lit("malformed line"))
        .when(F.size("unknown") > 0, F.lit("unknown field"))
        .alias("problem"),
        "unknown",
    )


def parse_articles(lines: DataFrame, mode: str = "failfast") -> DataFrame:
    """Article lines as rows of the article schema.

    ``failfast`` makes the job fail at a bad line. ``drop`` and ``permissive`` leave bad
    lines out; ``bad_article_lines`` returns them, and ``sort_article_lines`` both in one pass.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    checked = check_article_lines(lines)
    if mode == "failfast":
        message = F.concat(F.col("problem"), F.lit(": "), F.substring("value", 1, 200))
        keep = F.when(F.col("problem").isNull(), F.lit(True)).otherwise(
            F.raise_error(message).cast("boolean")
        )
    else:
        keep = F.col("problem").isNull()
    return checked.where(keep).select("article.*")


def bad_article_lines(lines: DataFrame) -> DataFrame:
    """The lines that are no articles: ``value``, ``problem`` and ``unknown`` fields."""
    checked = check_article_lines(lines).where(F.col("problem").isNotNull())
    return checked.select("value", "problem", "unknown")


def sort_article_lines(lines: DataFrame, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The articles, and the bad lines with their ``problem`` and ``unknown`` fields, out of one
    pass over the lines.

    Each line is read and checked once and written, good ones as articles, bad ones as they
    are, into a part of ``folder`` of its own (a new one in the shared folder, unless it is
    given). What is returned reads one part each.
    """
    spark = lines.sparkSession
    folder = folder or new_folder(spark, "article-lines")
    good = F.col("problem").isNull()
    checked = check_article_lines(lines).select(
        F.when(good, F.lit("article")).otherwise(F.lit("bad")).alias("kind"),
        F.when(good, F.col("article")).alias("article"),
        *[F.when(~good, F.col(name)).alias(name) for name in ("value", "unknown")], "problem")
    checked.write.partitionBy("kind").parquet(folder)
    written = spark.read.schema(checked.schema).parquet(folder)
    return (written.where("kind = 'article'").select("article.*"),
            written.where("kind = 'bad'").select("value", "problem", "unknown"))


def read_articles(spark: SparkSession, path: str | list[str], mode: str = "failfast",
                  bad: str | None = None) -> DataFrame:
    """The articles of a JSON-lines file. In the mode ``permissive``, with a new folder ``bad``,
    lines are sorted into it: the bad ones are then a Parquet table under ``kind=bad``."""
    if bad is not None:
        if mode != "permissive":
            raise ValueError("only the mode permissive keeps bad lines")
        return sort_article_lines(scan_lines(spark, path), bad)[0]
    return parse_articles(scan_lines(spark, path), mode)
