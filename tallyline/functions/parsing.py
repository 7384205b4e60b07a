"""Typed cleaners for untyped catalog text: blank or unreadable text becomes NULL."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms that count as numbers.
INT_TEXT = r"^[+-]?[0-9]+(_[0-9]+)*$"
FLOAT_TEXT = (
    r"^[+-]?([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+(_[0-9]+)*)?$"
)
FLOAT_WORDS = r"(?i)^[+-]?(nan|inf|infinity)$"
EDGE_BLANKS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
EMPTY_JSON = ("[]", "{}", "0", '""', "false", "null")


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, EDGE_BLANKS, "")


def clean_text(c: Column) -> Column:
    return F.nullif(_strip(c), F.lit(""))


def clean_int(c: Column) -> Column:
    """Thousands commas are dropped; anything else that is not a 32-bit integer is NULL."""
    digits = _strip(F.regexp_replace(c, ",", ""))
    return F.when(digits.rlike(INT_TEXT), F.regexp_replace(digits, "_", "").try_cast("int"))


def clean_float(c: Column) -> Column:
    text = _strip(c)
    return F.when(text.rlike(FLOAT_TEXT), F.regexp_replace(text, "_", "").try_cast("double")).when(
        text.rlike(FLOAT_WORDS), text.try_cast("double")
    )


def clean_json(c: Column) -> Column:
    """Normalised JSON text; text that is not exactly one JSON value, and empty values, are NULL.

    The parser stops after the first value of a text, so the text is read as an element of a list with an end mark.
    Of a repeated key the last value counts where spark.sql.variant.allowDuplicateKeys is set, as `build_session`
    does; otherwise such text is invalid.
    """
    own = clean_text(c)
    mark = F.xxhash64(own)
    whole = F.try_parse_json(F.concat(F.lit("["), own, F.lit(',{"end_mark":'), mark.cast("string"), F.lit("}]")))
    one = (F.try_variant_get(whole, "$[1].end_mark", "bigint") == mark) & F.try_variant_get(
        whole, "$[2]", "variant").isNull()
    text = F.to_json(F.when(one, F.try_variant_get(whole, "$[0]", "variant")))
    return F.when(~text.isin(*EMPTY_JSON), text)


def clean_episodes(c: Column) -> Column:
    number = clean_float(c)
    return F.when(number != 0, number.try_cast("int"))


def clean_year(c: Column) -> Column:
    number = clean_float(c)
    return F.when(number != 0, number)


def clean_rating(c: Column) -> Column:
    """Two decimals, half up. The type holds 10.00, the top of the scale."""
    return c.try_cast("decimal(4,2)")
