"""Columns for loosely typed JSON: a field may hold a number, a string or nothing.

A field counts as *given* unless it is missing, null, false, an empty string, an empty
container or the number zero. The string ``"0"`` does count as given.

Documents are read with ``from_json`` into text fields. The text alone settles nearly
every field; only where it cannot (``0`` may be a number or a string) is the document
parsed again with its types kept, so the common row is parsed once.
"""

from pyspark.sql import Column, DataFrame, functions as F

# Text that reads as a decimal number, with optional single underscores
# between digits, and the spelled-out specials.
_DIGITS = r"\d+(_\d+)*"
NUMBER_TEXT = (
    rf"^\s*[+-]?(({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?{_DIGITS})?"
    r"|(?i:inf|infinity|nan))\s*$"
)
# Text whose meaning depends on the JSON type it was written with.
UNCLEAR_TEXT = r"^(-?0(\.0*)?([eE][+-]?\d+)?|true|false|\[.*|\{.*)$"

# JSON tokens that do not count as given.
NOT_GIVEN_TOKEN = r"^(null|false|\"\"|\[\]|\{\}|-?0(\.0*)?([eE][+-]?\d+)?)$"

STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def with_object(df: DataFrame, name: str, text: str, fields: str) -> DataFrame:
    """Add struct column ``name``; NULL when ``text`` is not exactly one JSON object.

    The text is wrapped in an array, so anything after the object is an error.
    """
    items = F.from_json(
        F.concat(F.lit("["), F.col(text), F.lit("]")), f"array<struct<{fields}>>", STRICT
    )
    return df.withColumn(name, items).withColumn(
        name, F.when(F.size(name) == 1, F.element_at(name, 1))
    )


def with_given_text(df: DataFrame, name: str, text: str, fields: list[str], plain: list[str] | tuple = ()) -> DataFrame:
    """Add struct column ``name`` with one text per field, NULL where it is not given.

    ``true`` becomes ``1``; other values keep their text. For each of the fields named in ``plain``
    a second one, ``<field>_text``, holds the text as written, whatever it is, and
    ``<field>_absent`` tells a missing field from one that is null.
    """
    df = with_object(df, "_doc", text, ", ".join(f"{f} string" for f in fields))
    doc = F.col("_doc")
    texts = F.array(*[doc[f] for f in fields])
    unclear = F.array_join(texts, "\n").rlike(f"(?m){UNCLEAR_TEXT}")

    tokens = F.transform_values(
        F.from_json(F.col(text), "map<string,variant>"), lambda _, value: F.to_json(value)
    )
    df = df.withColumn("_tokens", F.when(unclear, tokens))

    def settle(value: Column, position: Column) -> Column:
        token = F.col("_tokens")[F.element_at(F.array(*[F.lit(f) for f in fields]), position + 1)]
        return (
            F.when(token.rlike(NOT_GIVEN_TOKEN), None).when(token == "true", "1").otherwise(value)
        )

    df = df.withColumn(
        "_settled", F.when(F.col("_tokens").isNotNull(), F.transform(texts, settle))
    )
    given = [
        F.coalesce(F.col("_settled")[i], F.when(F.col("_tokens").isNull(), F.nullif(doc[f], F.lit(""))))
        for i, f in enumerate(fields)
    ]
    # Only where there is no text does it matter whether the field is there at all.
    keys = F.json_object_keys(text)
    more = [doc[f].alias(f"{f}_text") for f in plain]
    more += [(doc[f].isNull() & ~F.array_contains(keys, f)).alias(f"{f}_absent") for f in plain]
    return df.withColumn(name, F.struct(*[g.alias(f) for g, f in zip(given, fields)], *more)).drop(
        "_doc", "_tokens", "_settled"
    )


def number(text: Column) -> Column:
    """Text as a double; NULL when it does not read as a number."""
    digits = F.replace(F.trim(text), F.lit("_"), F.lit(""))
    return F.when(text.rlike(NUMBER_TEXT), digits).try_cast("double")
