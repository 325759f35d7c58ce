"""Schemas of the inputs."""

from pyspark.sql import types as T

# The field names of an article file, which must be read as written.
CONTENT_FIELDS = (
    "content", "subtype", "type", "mime",
    "fullcaption", "imageURL", "imageHeight", "imageWidth", "blurb",
    "role", "name", "bio", "kicker",
)
ARTICLE_FIELDS = (
    "id", "article_url", "title", "author", "published_date", "contents", "type", "source",
)

CONTENT_ITEM = T.StructType([T.StructField(name, T.StringType()) for name in CONTENT_FIELDS])


def _article_struct(date_type: T.DataType) -> T.StructType:
    special = {"published_date": date_type, "contents": T.ArrayType(CONTENT_ITEM)}
    return T.StructType(
        [T.StructField(name, special.get(name, T.StringType())) for name in ARTICLE_FIELDS]
    )


ARTICLE = _article_struct(T.LongType())

# The text fields as whatever they are in a line, to tell objects and arrays from text.
TEXT_FIELDS = tuple(name for name in ARTICLE_FIELDS if name != "contents")
ARTICLE_SHAPE = T.StructType([
    *[T.StructField(name, T.VariantType()) for name in TEXT_FIELDS],
    T.StructField("contents", T.ArrayType(T.StructType(
        [T.StructField(name, T.VariantType()) for name in CONTENT_FIELDS]))),
])

# As found in a JSON line. The date is read as text first, so that "1325376562000" and
# 1325376562000 give the same number. A line that does not fit goes into the last field.
MALFORMED = "_malformed"
ARTICLE_LINE = T.StructType(
    _article_struct(T.StringType()).fields + [T.StructField(MALFORMED, T.StringType())]
)
