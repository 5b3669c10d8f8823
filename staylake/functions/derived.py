"""Derived listing measures: availability rates, percent rescaling, host tenure."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylake.functions.cleaning import ColumnOrName, _col

# Availability windows (column -> days) and the tenure fallback reference date.
AVAILABILITY_DAYS = {"availability_30": 30, "availability_60": 60, "availability_90": 90, "availability_365": 365}
TENURE_REFERENCE_DATE = "2026-01-01"
DAYS_PER_YEAR = 365.25


def availability_rates(df: DataFrame, days: dict[str, int] = AVAILABILITY_DAYS) -> DataFrame:
    """``{col}_rate = col / days`` for each availability window present."""
    return df.withColumns({f"{c}_rate": F.col(c) / F.lit(float(n)) for c, n in days.items() if c in df.columns})


def rescale_fraction_percent(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Columns whose maximum is <= 1 are fractions: multiply them by 100.

    The maxima are one aggregate row, joined as a proven-size broadcast."""
    cols = list(cols)
    maxima = df.agg(*[F.max(F.col(c).cast("double")).alias(f"_max_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(maxima))
    return j.select(*[F.when(F.col(f"_max_{c}") <= 1, F.col(c).cast("double") * 100.0)
                      .otherwise(F.col(c).cast("double")).alias(c) if c in cols else F.col(c) for c in df.columns])


def tenure_years(since: ColumnOrName, reference: ColumnOrName | None = None,
                 fallback_date: str = TENURE_REFERENCE_DATE) -> Column:
    """(reference - since) in days / 365.25; the fixed date when no reference column is given."""
    ref = _col(reference).cast("date") if reference is not None else F.lit(fallback_date).cast("date")
    return F.datediff(ref, _col(since).cast("date")) / F.lit(DAYS_PER_YEAR)
