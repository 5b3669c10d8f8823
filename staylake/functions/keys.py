"""Surrogate keys and calendar attributes.

Surrogate keys are the md5 hex digest of the natural key parts joined with
``'||'``. NULL in any part gives a NULL key (``concat`` propagates NULL; never
``concat_ws``, which would silently skip it).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from staylake.functions.cleaning import ColumnOrName, _col

# Fixed value: separator between natural-key parts.
KEY_SEPARATOR = "||"


def surrogate_key(*parts: ColumnOrName) -> Column:
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit(KEY_SEPARATOR))
        pieces.append(_col(p).cast("string"))
    return F.md5(F.concat(*pieces)) if len(pieces) > 1 else F.md5(pieces[0])


def date_key(c: ColumnOrName) -> Column:
    """YYYYMMDD integer key of a date (NULL stays NULL), by integer arithmetic
    (no string formatting per row)."""
    d = _col(c).cast("date")
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_attributes(c: ColumnOrName) -> dict[str, Column]:
    """Calendar attributes of a date, ISO week and ISO day-of-week (Mon=1..Sun=7)."""
    d = _col(c).cast("date")
    isodow = F.extract(F.lit("dayofweek_iso"), d)
    return {
        "date_key": date_key(d),
        "date_day": d,
        "year": F.year(d).cast("bigint"),
        "quarter": F.quarter(d).cast("bigint"),
        "month": F.month(d).cast("bigint"),
        "month_name": F.date_format(d, "MMMM"),
        "day": F.dayofmonth(d).cast("bigint"),
        "day_of_week": F.date_format(d, "EEEE"),
        "week_of_year": F.weekofyear(d).cast("bigint"),
        "is_weekend": isodow.isin(6, 7),
    }
