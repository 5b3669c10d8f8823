"""Join helpers with validation."""

from __future__ import annotations



from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent (``relationships``)."""
    parent_key = parent_key or child_key
    p = parent.select(F.col(parent_key).alias("_sl_pk"))
    c = child.where(F.col(child_key).isNotNull())
    return c.join(p, c[child_key] == p["_sl_pk"], "left_anti")


def coverage_count(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` that find a partner in ``parent`` (semi join count)."""
    return child.join(parent.select(key), key, "left_semi").agg(F.count(F.lit(1)).alias("matched_rows"))


def duplicated_key_count(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).count().where(F.col("count") > 1).agg(F.count(F.lit(1)).alias("duplicated_keys"))


def one_to_one_left_join(left: DataFrame, right: DataFrame, key: str, validate: bool = True,
                         suffix: str = "_right", require_match: bool = False) -> DataFrame:
    """Left join that must neither drop nor multiply rows; with ``require_match`` a left
    row without a partner (a NULL key has none) is an error too.

    With ``validate`` the right side's key uniqueness is checked first (one
    aggregate, only a count reaches the driver) and the join fails loudly
    instead of fanning out.
    """
    if validate:
        dup = duplicated_key_count(right, key).first()["duplicated_keys"]
        if dup:
            raise ValueError(f"right side has {dup} duplicated '{key}' values; join is not one-to-one")
        dup_l = duplicated_key_count(left, key).first()["duplicated_keys"]
        if dup_l:
            raise ValueError(f"left side has {dup_l} duplicated '{key}' values; join is not one-to-one")
    if require_match:
        unmatched = left.join(right.select(key), key, "left_anti").count()
        if unmatched:
            raise ValueError(f"{unmatched} left rows have no partner on '{key}'")
    renamed = right.select(*[F.col(c).alias(c if c == key or c not in left.columns else c + suffix) for c in right.columns])
    return left.join(renamed, key, "left")
