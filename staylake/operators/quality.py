"""Declarative data-quality expectations.

Each ``check_*`` returns the *violating rows* (empty = pass), like a warehouse
test query. ``run_suite`` evaluates a list of expectations for a table with the
row-level ones (not_null, accepted_values, ranges, column comparisons) fused
into **one** aggregate scan, and the set-level ones (unique, relationships,
row counts, ratios) as one job each, returning one result row per expectation.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Any, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylake.operators.joins import orphans
from staylake.operators.profile import duplicate_keys

# Defaults of the unknown-member check.
UNKNOWN_MEMBER = "UNKNOWN"
DEFAULT_MAX_UNKNOWN_RATIO = 0.01


# ---------------------------------------------------------------- row-level predicates (violation conditions)

def violates_not_null(c: str) -> Column:
    return F.col(c).isNull()


def violates_accepted_values(c: str, values: Sequence) -> Column:
    return F.col(c).isNotNull() & ~F.col(c).isin(*values)


def violates_positive_or_null(c: str) -> Column:
    # the warehouse test flags values below zero only; zero passes
    return F.col(c) < 0


def violates_non_negative(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c) < 0)


def violates_between_or_null(c: str, lo, hi) -> Column:
    return F.col(c).isNotNull() & ((F.col(c) < lo) | (F.col(c) > hi))


def violates_greater_than(c: str, value) -> Column:
    return F.col(c).isNotNull() & (F.col(c) <= value)


def violates_less_than_or_equal_or_null(c: str, right: str) -> Column:
    return F.col(c).isNotNull() & F.col(right).isNotNull() & (F.col(c) > F.col(right))


ROW_LEVEL = {
    "not_null": lambda c, p: violates_not_null(c),
    "accepted_values": lambda c, p: violates_accepted_values(c, p["values"]),
    "positive_or_null": lambda c, p: violates_positive_or_null(c),
    "non_negative": lambda c, p: violates_non_negative(c),
    "between_or_null": lambda c, p: violates_between_or_null(c, p["min_value"], p["max_value"]),
    "greater_than": lambda c, p: violates_greater_than(c, p["value"]),
    "less_than_or_equal_or_null": lambda c, p: violates_less_than_or_equal_or_null(c, p["right_column"]),
}


# ---------------------------------------------------------------- violation-row checks

def check_rows(df: DataFrame, kind: str, column: str, **params) -> DataFrame:
    return df.where(ROW_LEVEL[kind](column, params))


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return check_rows(df, "not_null", column)


def check_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return check_rows(df, "accepted_values", column, values=values)


def check_positive_or_null(df: DataFrame, column: str) -> DataFrame:
    return check_rows(df, "positive_or_null", column)


def check_non_negative(df: DataFrame, column: str) -> DataFrame:
    return check_rows(df, "non_negative", column)


def check_between_or_null(df: DataFrame, column: str, min_value, max_value) -> DataFrame:
    return check_rows(df, "between_or_null", column, min_value=min_value, max_value=max_value)


def check_greater_than(df: DataFrame, column: str, value) -> DataFrame:
    return check_rows(df, "greater_than", column, value=value)


def check_less_than_or_equal_or_null(df: DataFrame, column: str, right_column: str) -> DataFrame:
    return check_rows(df, "less_than_or_equal_or_null", column, right_column=right_column)


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Duplicated non-NULL values with their count."""
    return duplicate_keys(df.where(F.col(column).isNotNull()), [column])


def check_unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return duplicate_keys(df, list(columns))


def check_relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    return orphans(df, parent, column, parent_column)


def check_not_empty(df: DataFrame) -> DataFrame:
    """One row (row_count = 0) when the table is empty."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") == 0)


def check_member_exists(df: DataFrame, conditions: dict[str, Any]) -> DataFrame:
    """One row when no row matches all ``column = value`` conditions."""
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in conditions.items()])
    found = df.where(cond).limit(1).agg(F.count(F.lit(1)).alias("_found"))
    return found.where(F.col("_found") == 0).select(F.lit(1).alias("missing_member"))


def check_row_count_matches(df: DataFrame, other: DataFrame) -> DataFrame:
    a = df.agg(F.count(F.lit(1)).alias("model_row_count"))
    b = other.agg(F.count(F.lit(1)).alias("compare_row_count"))
    return a.crossJoin(b).where(F.col("model_row_count") != F.col("compare_row_count"))


def unknown_member_ratio(fact: DataFrame, dim: DataFrame, key: str = "location_key",
                         member_col: str = "neighbourhood", unknown: str = UNKNOWN_MEMBER) -> DataFrame:
    """(total_rows, unknown_rows, unknown_ratio) of fact rows pointing at the unknown member.

    The fact is counted per key first (combined before the shuffle, so a hot key is one row a
    task), and only these counts meet the dimension.
    """
    d = dim.select(F.col(key).alias("_k"), (F.col(member_col) == F.lit(unknown)).alias("_is_unknown"))
    j = fact.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_c")).join(d, "_k", "inner")
    usage = j.agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("total_rows"),
                  F.coalesce(F.sum(F.when(F.col("_is_unknown"), F.col("_c"))), F.lit(0)).alias("unknown_rows"))
    return usage.withColumn(
        "unknown_ratio",
        F.coalesce(F.col("unknown_rows") * F.lit(1.0) / F.nullif(F.col("total_rows"), F.lit(0)), F.lit(0.0)))


def check_unknown_member_ratio_below(fact: DataFrame, dim: DataFrame, max_ratio: float = DEFAULT_MAX_UNKNOWN_RATIO,
                                     **kw) -> DataFrame:
    r = unknown_member_ratio(fact, dim, **kw).withColumn("max_allowed_ratio", F.lit(float(max_ratio)))
    return r.where(F.col("unknown_ratio") > F.col("max_allowed_ratio"))


def fused_unique_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Duplicated-value counts for several single-column keys in ONE shuffle:
    the key columns are stacked as (column, value-as-text) and grouped once."""
    cols = list(dict.fromkeys(cols))
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in cols])).alias("s")) \
        .select("s.*").where(F.col("v").isNotNull())
    dups = stacked.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1) \
        .groupBy("column_name").agg(F.count(F.lit(1)).alias("violations"))
    spark = df.sparkSession
    names = spark.createDataFrame([(c,) for c in cols], "column_name string")
    return (F.broadcast(names).join(dups, "column_name", "left")
            .select(F.lit("unique").alias("check_name"), "column_name",
                    F.coalesce(F.col("violations"), F.lit(0)).cast("bigint").alias("violations")))


# ---------------------------------------------------------------- suite

@dataclass
class Expectation:
    kind: str
    column: str | None = None
    params: dict[str, Any] = field(default_factory=dict)

    @property
    def name(self) -> str:
        col = self.column if self.column else ",".join(self.params.get("columns", []))
        return f"{self.kind}({col})"


def run_suite(table_name: str, df: DataFrame, expectations: Sequence[Expectation],
              others: dict[str, DataFrame] | None = None) -> DataFrame:
    """One result row per expectation: (check_name, table_name, column_name, violations, status).

    Row-level expectations share a single ``agg(count_if(...))`` scan of ``df``.
    """
    spark = df.sparkSession
    others = others or {}
    row_level = [e for e in expectations if e.kind in ROW_LEVEL]
    results: list[DataFrame] = []
    if row_level:
        wide = df.agg(*[F.count_if(ROW_LEVEL[e.kind](e.column, e.params)).alias(f"v{i}") for i, e in enumerate(row_level)])
        rows = [F.struct(F.lit(e.kind).alias("check_name"), F.lit(e.column).alias("column_name"),
                         F.col(f"v{i}").cast("bigint").alias("violations")) for i, e in enumerate(row_level)]
        results.append(wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*"))
    uniques = [e for e in expectations if e.kind == "unique"]
    if uniques:
        results.append(fused_unique_counts(df, [e.column for e in uniques]))
    for e in expectations:
        if e.kind in ROW_LEVEL or e.kind == "unique":
            continue
        if e.kind == "unique_combination_of_columns":
            v = check_unique_combination(df, e.params["columns"])
        elif e.kind == "relationships":
            v = check_relationships(df, e.column, others[e.params["to"]], e.params["field"])
        elif e.kind == "not_empty":
            v = check_not_empty(df)
        elif e.kind == "row_count_matches":
            v = check_row_count_matches(df, others[e.params["compare_model"]])
        elif e.kind == "member_exists":
            conds = dict(e.params["conditions"])
            if "city" in df.columns and "city" not in conds and e.params.get("city"):
                conds["city"] = e.params["city"]
            v = check_member_exists(df, conds)
        elif e.kind == "unknown_member_ratio_below":
            v = check_unknown_member_ratio_below(df, others[e.params["dimension"]],
                                                 e.params.get("max_ratio", DEFAULT_MAX_UNKNOWN_RATIO))
        else:
            raise ValueError(f"unknown expectation kind {e.kind}")
        col = e.column if e.column else ",".join(e.params.get("columns", [])) or None
        results.append(v.agg(F.count(F.lit(1)).cast("bigint").alias("violations"))
                       .select(F.lit(e.kind).alias("check_name"), F.lit(col).cast("string").alias("column_name"),
                               "violations"))
    out = reduce(lambda a, b: a.unionByName(b), results)
    return out.select("check_name", F.lit(table_name).alias("table_name"), "column_name", "violations",
                      F.when(F.col("violations") == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("status"))


def assert_suite_passes(result: DataFrame) -> None:
    failed = result.where(F.col("status") != "pass").collect()  # one row per expectation at most
    if failed:
        raise AssertionError("data-quality failures: " + "; ".join(
            f"{r.table_name}.{r.check_name}({r.column_name})={r.violations}" for r in failed))
