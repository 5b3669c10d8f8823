"""Ordered keyword rules that map a free-text category to a label.

A rule table is an ordered list of ``(keywords, label)``: the first rule with
a keyword contained in the normalised text wins. Optional exact-match rules are
tried before the substring rules. The whole table folds into one CASE WHEN.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from staylake.functions.cleaning import ColumnOrName, _col

Rule = tuple[Sequence[str], str]

# The warehouse (SQL mart) property grouping, in rule order.
SQL_PROPERTY_EXACT: list[Rule] = [
    (("private room", "entire place", "entire home/apt"), "Unspecified Property Type"),
]
SQL_PROPERTY_RULES: list[Rule] = [
    (("serviced apartment", "aparthotel"), "Serviced Apartment / Aparthotel"),
    (("hostel",), "Hostel"),
    (("guesthouse", "bed and breakfast"), "Guesthouse / B&B"),
    (("boutique hotel", "hotel", "resort", "ryokan", "kezhan"), "Hotel / Resort"),
    (("villa",), "Villa"),
    (("rental unit", "condo", "apartment", "loft"), "Apartment / Condo"),
    (("townhouse", "guest suite", "vacation home", "casa particular", "bungalow", "cottage", "chalet",
      "entire home", "in home", "home/apt"), "House / Home"),
    (("tiny home", "treehouse", "earthen home", "dome", "tower", "lighthouse", "castle", "shipping container",
      "hut", "tent", "cabin", "nature lodge", "farm stay", "barn", "houseboat", "boat", "island", "camper/rv"),
     "Niche / Special Stay"),
]
SQL_PROPERTY_NULL_LABEL = "Unspecified Property Type"
SQL_PROPERTY_DEFAULT = "Unspecified Property Type"

# The modelling (Python) property grouping, in rule order.
PY_PROPERTY_RULES: list[Rule] = [
    (("serviced apartment", "aparthotel"), "Serviced Apartment / Aparthotel"),
    (("hostel",), "Hostel"),
    (("guesthouse", "guest house", "bed and breakfast"), "Guesthouse / B&B"),
    (("hotel", "resort", "ryokan", "kezhan"), "Hotel / Resort"),
    (("villa",), "Villa"),
    (("loft",), "Loft"),
    (("rental unit", "condo", "apartment"), "Apartment / Condo"),
    (("treehouse", "tiny home", "earthen home", "earth home", "dome", "tower", "lighthouse", "castle",
      "shipping container", "container", "hut", "tent"), "Unique Stay"),
    (("cabin", "nature lodge", "farm stay", "barn", "houseboat", "boat", "island", "camper/rv"), "Special Stay"),
    (("townhouse", "guest suite", "vacation home", "casa particular", "bungalow", "cottage", "chalet", "house",
      "home"), "House / Home"),
]
PY_PROPERTY_NULL_LABEL = "Unknown"
PY_PROPERTY_DEFAULT = "Other"


def categorize(
    c: ColumnOrName,
    rules: Sequence[Rule],
    default: str,
    null_label: str | None = None,
    exact: Sequence[Rule] = (),
) -> Column:
    """Map text to the label of the first matching rule (lower-cased, trimmed)."""
    raw = _col(c)
    text = F.lower(F.trim(raw.cast("string")))
    expr = None
    branches: list[tuple[Column, str]] = []
    if null_label is not None:
        branches.append((raw.isNull(), null_label))
    for values, label in exact:
        branches.append((text.isin(*values), label))
    for keywords, label in rules:
        cond = None
        for k in keywords:
            hit = text.contains(k)
            cond = hit if cond is None else (cond | hit)
        branches.append((cond, label))
    for cond, label in branches:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def property_group_sql(c: ColumnOrName) -> Column:
    return categorize(c, SQL_PROPERTY_RULES, SQL_PROPERTY_DEFAULT, SQL_PROPERTY_NULL_LABEL, SQL_PROPERTY_EXACT)


def property_group_py(c: ColumnOrName) -> Column:
    return categorize(c, PY_PROPERTY_RULES, PY_PROPERTY_DEFAULT, PY_PROPERTY_NULL_LABEL)


def rules_to_sql(column_sql: str, rules: Sequence[Rule], default: str, null_label: str | None = None,
                 exact: Sequence[Rule] = ()) -> str:
    """The same rule table rendered as portable SQL CASE text (used by oracles)."""
    t = f"lower(trim(CAST({column_sql} AS VARCHAR)))"
    q = lambda s: "'" + s.replace("'", "''") + "'"
    parts = ["CASE"]
    if null_label is not None:
        parts.append(f" WHEN {column_sql} IS NULL THEN {q(null_label)}")
    for values, label in exact:
        parts.append(f" WHEN {t} IN ({', '.join(q(v) for v in values)}) THEN {q(label)}")
    for keywords, label in rules:
        cond = " OR ".join(f"{t} LIKE {q('%' + k + '%')}" for k in keywords)
        parts.append(f" WHEN {cond} THEN {q(label)}")
    parts.append(f" ELSE {q(default)} END")
    return "".join(parts)
