"""Tolerant typing and cleaning expressions (column -> column).

Every function takes a column name or a ``Column`` and returns a ``Column``
built only from JVM-side Spark SQL functions, so they fuse into whole-stage
codegen and never leave the executor. ANSI mode is on by default in Spark 4,
so raw text is always converted with ``try_cast`` (NULL on bad input), never
a plain ``cast``.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

# The accepted spellings of a tri-state boolean.
TRUE_TOKENS = ("t", "true", "1", "yes", "y")
FALSE_TOKENS = ("f", "false", "0", "no", "n")

# The tokens that count as "yes" for the two-state binary flag.
BINARY_TRUE_TOKENS = ("t", "true", "1", "yes")

# Fixed value: characters that survive money / percent cleaning.
MONEY_STRIP_PATTERN = r"[^0-9.-]"

# Numeric text (optional sign, digits with optional fraction, optional exponent).
# Casts are only attempted on text that matches: a failed cast raises and
# catches an exception per row inside Spark, a regex test does not.
NUMERIC_TEXT = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
FLOAT_SPECIALS = ("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity", "nan")

# Fixed value: first number in a free-text bathroom description ("1.5 baths").
BATHROOM_NUMBER_PATTERN = r"[0-9]+(\.[0-9]+)?"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c: ColumnOrName) -> Column:
    return _col(c).cast("string")


def clean_text(c: ColumnOrName) -> Column:
    """Trim; the empty string becomes NULL."""
    return F.nullif(F.trim(as_text(c)), F.lit(""))


def clean_money(c: ColumnOrName) -> Column:
    """Strip everything but digits, '.' and '-', then parse as double.

    ``'$1,234.00'`` -> 1234.0; ``''`` / ``'N/A'`` / ``'1-2'`` -> NULL.
    """
    stripped = F.regexp_replace(as_text(c), MONEY_STRIP_PATTERN, "")
    return F.when(stripped.rlike(NUMERIC_TEXT), stripped.try_cast("double"))


def clean_percent(c: ColumnOrName) -> Column:
    """``'95%'`` -> 0.95."""
    return clean_money(c) / F.lit(100.0)


def clean_boolean(c: ColumnOrName) -> Column:
    """Tri-state boolean: known true / false spellings, anything else NULL."""
    token = F.lower(F.trim(as_text(c)))
    return (
        F.when(token.isin(*TRUE_TOKENS), F.lit(True))
        .when(token.isin(*FALSE_TOKENS), F.lit(False))
        .otherwise(F.lit(None).cast("boolean"))
    )


def to_binary(c: ColumnOrName) -> Column:
    """Two-state 0/1 flag: true spellings -> 1, everything else (NULL too) -> 0."""
    token = F.lower(F.trim(as_text(c)))
    return F.when(token.isin(*BINARY_TRUE_TOKENS), F.lit(1)).otherwise(F.lit(0))


# a full year-month-day, alone or followed by a time: a bare year or month is no date
DATE_TEXT = r"^\d{1,6}-\d{1,2}-\d{1,2}([ T].*)?$"


def numeric_text_to_double(text: Column) -> Column:
    """try_cast(text AS double), attempted only on numeric-looking or special (inf / nan) text."""
    ok = text.rlike(NUMERIC_TEXT) | F.lower(F.trim(text)).isin(*FLOAT_SPECIALS)
    return F.when(ok, text.try_cast("double"))


def safe_cast(c: ColumnOrName, data_type: str) -> Column:
    """NULL-on-failure cast that also accepts integers written as decimals.

    For integral targets, text such as ``'3.7'`` or ``'2.5'`` is rounded half
    away from zero (``4``, ``3``) instead of being rejected. The rounding goes
    through ``decimal(38, 10)`` and never through double, so ids above 2**53
    keep every digit.
    """
    data_type = data_type.lower()
    if data_type in ("bigint", "long", "int", "integer", "smallint"):
        target = "int" if data_type in ("int", "integer") else ("smallint" if data_type == "smallint" else "bigint")
        text = F.trim(as_text(c))
        as_dec = F.when(text.rlike(NUMERIC_TEXT), text.try_cast("decimal(38,10)"))
        return F.round(as_dec, 0).try_cast(target)
    if data_type == "date":
        text = F.trim(as_text(c))
        return F.when(text.rlike(DATE_TEXT), text.try_cast("date"))
    if data_type == "double":
        return numeric_text_to_double(as_text(c))
    return _col(c).try_cast(data_type)


def round_half_even_int(c: ColumnOrName, data_type: str = "int") -> Column:
    """Numeric -> integral cast rounding half to even (2.5 -> 2, 3.5 -> 4), NULL on overflow."""
    return F.bround(_col(c).cast("double"), 0).try_cast(data_type)


def first_non_null(*cols: ColumnOrName) -> Column:
    return F.coalesce(*[_col(c) for c in cols])


def first_number(c: ColumnOrName, pattern: str = BATHROOM_NUMBER_PATTERN) -> Column:
    """First number in free text as double (whole match, group 0); no match -> NULL."""
    return F.nullif(F.regexp_extract(as_text(c), pattern, 0), F.lit("")).try_cast("double")


def is_finite(c: ColumnOrName) -> Column:
    x = _col(c).cast("double")
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def first_word(c: ColumnOrName) -> Column:
    """First whitespace-separated word of a category (``property_group``)."""
    return F.split(F.trim(as_text(c)), r"\s+").getItem(0)


def resolve_column(df: DataFrame, name: str, default=None, required: bool = True) -> Column:
    """Case-insensitive column lookup with a default for optional columns.

    Returns the matching column; if absent returns ``default`` (a literal or a
    Column) when given or when ``required`` is False; raises otherwise. This is
    resolved on the driver from ``df.columns`` so Catalyst folds the NULL.
    """
    wanted = name.lower()
    for existing in df.columns:
        if existing.lower() == wanted:
            return F.col(f"`{existing}`")
    if default is not None:
        return default if isinstance(default, Column) else F.lit(default)
    if not required:
        return F.lit(None)
    raise ValueError(f"Required source column '{name}' not found; have {df.columns}")


def strict_json(text: Column) -> Column:
    """Whether text can be one strict JSON value. Spark's JSON functions also take single-quoted
    strings and ignore what follows the first value; with its strings emptied, strict JSON has no
    single quote, balanced brackets, and only a comma or another closing bracket after a closing one."""
    bare = F.regexp_replace(text, r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', '""')
    count = lambda mark: F.length(bare) - F.length(F.replace(bare, F.lit(mark), F.lit("")))
    nested = bare.rlike(r"^\s*[\[{]") & bare.rlike(r"[\]}]\s*$") & ~bare.rlike(r"[\]}]\s*[^\s,\]}]")
    scalar = bare.rlike(r'^\s*(?:""|-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null)\s*$')
    return ~bare.contains("'") & ((nested & (count("[") == count("]")) & (count("{") == count("}"))) | scalar)


def count_json_items(c: ColumnOrName, on_invalid: str = "null") -> Column:
    """Number of items in a list held as text (amenities).

    ``on_invalid='null'``: a JSON array gives its length, a JSON object gives
    0, anything else (invalid JSON) gives NULL.
    ``on_invalid='split'``: NULL -> 0; ``''``, ``'[]'``, ``'{}'`` -> 0; valid
    JSON array -> its length, valid JSON object -> 0; otherwise strip the
    brackets and count non-blank comma-separated pieces (``{Wifi,,TV}`` -> 2).
    """
    text = as_text(c)
    # most text that is no JSON shows it in its first visible character, before any pattern reads it
    first = F.substring(F.ltrim(text, F.lit(" \t\r\n")), 1, 1)
    may_be_json = first.isin(list('[{"-0123456789')) | F.btrim(text, F.lit(" \t\r\n")).isin("true", "false", "null")
    # valid JSON that is not an array (an object, a scalar) counts 0 items
    items = F.when(may_be_json, F.when(strict_json(text), F.coalesce(
        F.json_array_length(text), F.when(F.get_json_object(text, "$").isNotNull(), F.lit(0)))))
    if on_invalid == "null":
        return items.cast("int")
    if on_invalid == "split":
        inner = F.btrim(F.trim(text), F.lit("[]{}"))
        # a piece starts at the first character after a comma that is no blank
        return F.coalesce(items, F.regexp_count(inner, F.lit("[^ ,][^,]*")), F.lit(0)).cast("int")
    raise ValueError("on_invalid must be 'null' or 'split'")


def columns_exist(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Names from ``names`` missing from ``df`` (driver-side schema check)."""
    have = set(df.columns)
    return [n for n in names if n not in have]
