"""Query catalogue over the driver tables: every operator run on whole tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` is the Spark side; ``ORACLES[name]``
is an independent SQL statement (DuckDB dialect) computing the same result from
the same tables. Floating results are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylake.functions import cleaning as C
from staylake.functions.rules import (PY_PROPERTY_DEFAULT, PY_PROPERTY_NULL_LABEL, PY_PROPERTY_RULES,
                                      SQL_PROPERTY_DEFAULT, SQL_PROPERTY_EXACT, SQL_PROPERTY_NULL_LABEL,
                                      SQL_PROPERTY_RULES, categorize, property_group_py, property_group_sql,
                                      rules_to_sql)
from staylake.operators import dedup, errors, impute, joins, profile, quality, stats, topk
from staylake.operators.ranks import quantiles
from staylake.plans import binding as B
from staylake.plans import features, gold, silver
from staylake.plans import raw as RAW
from staylake.session import cut_lineage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

R = 6  # decimals kept for floating results on both sides


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def T(spark: SparkSession, d: str, name: str) -> DataFrame:
    return B.table(spark, d, name)


def rnd(df: DataFrame, *cols: str) -> DataFrame:
    """Round the given (or all floating) columns to R decimals."""
    targets = cols or [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.round(F.col(c).cast("double"), R) for c in targets})


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# =========================================================== cleaning

@register("clean_money_percent", """
SELECT p_partkey,
  try_cast(nullif(regexp_replace(CAST(p_brand AS VARCHAR), '[^0-9.-]', '', 'g'), '') AS DOUBLE) AS brand_money,
  try_cast(nullif(regexp_replace(CAST(p_brand AS VARCHAR), '[^0-9.-]', '', 'g'), '') AS DOUBLE) / 100.0 AS brand_percent,
  try_cast(nullif(regexp_replace(CAST(p_name AS VARCHAR), '[^0-9.-]', '', 'g'), '') AS DOUBLE) AS name_money
FROM part""")
def _clean_money_percent(spark, d):
    p = T(spark, d, "part")
    return p.select("p_partkey", C.clean_money("p_brand").alias("brand_money"),
                    C.clean_percent("p_brand").alias("brand_percent"), C.clean_money("p_name").alias("name_money"))


@register("clean_money_customer_orders", """
SELECT c_custkey AS k, 'customer' AS src,
  try_cast(nullif(regexp_replace(c_name, '[^0-9.-]', '', 'g'), '') AS DOUBLE) AS money
FROM customer
UNION ALL
SELECT o_orderkey AS k, 'orders' AS src,
  try_cast(nullif(regexp_replace(o_orderpriority, '[^0-9.-]', '', 'g'), '') AS DOUBLE) AS money
FROM orders""")
def _clean_money_co(spark, d):
    c = T(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.lit("customer").alias("src"),
                                       C.clean_money("c_name").alias("money"))
    o = T(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.lit("orders").alias("src"),
                                     C.clean_money("o_orderpriority").alias("money"))
    return c.unionByName(o)


_BOOL_SQL = ("CASE WHEN lower(trim(CAST({x} AS VARCHAR))) IN ('t','true','1','yes','y') THEN true "
             "WHEN lower(trim(CAST({x} AS VARCHAR))) IN ('f','false','0','no','n') THEN false ELSE NULL END")
_BIN_SQL = "CASE WHEN lower(trim(CAST({x} AS VARCHAR))) IN ('t','true','1','yes') THEN 1 ELSE 0 END"


@register("clean_boolean", f"""
SELECT l_orderkey, l_linenumber, l_partkey,
  {_BOOL_SQL.format(x='l_returnflag')} AS returnflag_bool,
  {_BOOL_SQL.format(x='l_linestatus')} AS linestatus_bool,
  {_BIN_SQL.format(x='l_linestatus')} AS linestatus_binary
FROM lineitem""")
def _clean_boolean(spark, d):
    li = T(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     C.clean_boolean("l_returnflag").alias("returnflag_bool"),
                     C.clean_boolean("l_linestatus").alias("linestatus_bool"),
                     C.to_binary("l_linestatus").alias("linestatus_binary"))


@register("clean_boolean_labels", f"""
SELECT doc_id, {_BOOL_SQL.format(x='quality')} AS quality_bool, {_BOOL_SQL.format(x='toxic')} AS toxic_bool,
  {_BIN_SQL.format(x='toxic')} AS toxic_binary
FROM labels""")
def _clean_boolean_labels(spark, d):
    lb = T(spark, d, "labels")
    return lb.select("doc_id", C.clean_boolean("quality").alias("quality_bool"),
                     C.clean_boolean("toxic").alias("toxic_bool"), C.to_binary("toxic").alias("toxic_binary"))


@register("clean_text", """
SELECT doc_id, nullif(trim(CAST(text AS VARCHAR)), '') AS text_clean,
  nullif(trim(CAST(source AS VARCHAR)), '') AS source_clean,
  nullif(trim(CAST(CASE WHEN lang = 'de' THEN '   ' ELSE lang END AS VARCHAR)), '') AS lang_clean
FROM documents""")
def _clean_text(spark, d):
    docs = T(spark, d, "documents")
    return docs.select("doc_id", C.clean_text("text").alias("text_clean"), C.clean_text("source").alias("source_clean"),
                       C.clean_text(F.when(F.col("lang") == "de", F.lit("   ")).otherwise(F.col("lang"))).alias("lang_clean"))


@register("safe_cast_rounding", """
SELECT l_orderkey, l_linenumber, l_partkey,
  try_cast(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS BIGINT) AS price_bigint,
  try_cast(CAST(CAST(l_quantity / 2 AS DECIMAL(10,1)) AS VARCHAR) AS INTEGER) AS half_qty_int,
  try_cast(CAST(CAST(-l_quantity / 2 AS DECIMAL(10,1)) AS VARCHAR) AS INTEGER) AS neg_half_qty_int,
  try_cast(l_quantity / 2 AS INTEGER) AS half_qty_even,
  try_cast(CAST(l_orderkey AS VARCHAR) || 'x' AS BIGINT) AS bad_text,
  try_cast(strftime(l_shipdate, '%Y-%m-%d') AS DATE) AS ship_date,
  try_cast(strftime(l_shipdate, '%d/%m/%Y') AS DATE) AS ship_date_dmy
FROM lineitem""")
def _safe_cast_rounding(spark, d):
    li = T(spark, d, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        C.safe_cast(F.col("l_extendedprice").cast("decimal(12,2)").cast("string"), "bigint").alias("price_bigint"),
        C.safe_cast((F.col("l_quantity") / 2).cast("decimal(10,1)").cast("string"), "int").alias("half_qty_int"),
        C.safe_cast((-F.col("l_quantity") / 2).cast("decimal(10,1)").cast("string"), "int").alias("neg_half_qty_int"),
        C.round_half_even_int(F.col("l_quantity") / 2, "int").alias("half_qty_even"),
        C.safe_cast(F.concat(F.col("l_orderkey").cast("string"), F.lit("x")), "bigint").alias("bad_text"),
        C.safe_cast(F.date_format("l_shipdate", "yyyy-MM-dd"), "date").alias("ship_date"),
        C.safe_cast(F.date_format("l_shipdate", "dd/MM/yyyy"), "date").alias("ship_date_dmy"))


@register("fallback_columns", """
SELECT p_partkey AS P_PARTKEY,
  coalesce(nullif(trim(CAST(NULL AS VARCHAR)), ''), nullif(trim(p_type), '')) AS category,
  coalesce(try_cast(CAST(NULL AS VARCHAR) AS DOUBLE),
           try_cast(regexp_extract(p_brand, '[0-9]+(\\.[0-9]+)?', 0) AS DOUBLE)) AS brand_number,
  try_cast(regexp_extract(p_name || ' 1.5 baths', '[0-9]+(\\.[0-9]+)?', 0) AS DOUBLE) AS text_number
FROM part""")
def _fallback_columns(spark, d):
    # the source arrives with upper-case names and without the optional columns
    raw = T(spark, d, "part")
    up = raw.select(*[F.col(c).alias(c.upper()) for c in raw.columns])
    rc = lambda n, **kw: C.resolve_column(up, n, **kw)
    none = F.lit(None).cast("string")
    return up.select(
        rc("p_partkey").alias("P_PARTKEY"),
        C.first_non_null(C.clean_text(rc("p_container", default=none)), C.clean_text(rc("p_type"))).alias("category"),
        F.coalesce(C.safe_cast(rc("p_bathrooms", default=none), "double"), C.first_number(rc("p_brand"))).alias("brand_number"),
        C.first_number(F.concat(rc("p_name"), F.lit(" 1.5 baths"))).alias("text_number"))


# =========================================================== counts and duplicates

_ALL_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
               "embeddings", "pages", "benchmark", "labels", "conversations"]


@register("row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _ALL_TABLES))
def _row_counts(spark, d):
    return profile.row_counts({t: T(spark, d, t) for t in _ALL_TABLES})


_DUP_COLS = ["l_partkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def _duplicate_keys(spark, d):
    return profile.duplicate_keys(T(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("duplicate_profile", """
SELECT l_orderkey, l_linenumber, count(*) AS duplicate_count,
  count(DISTINCT l_partkey) AS distinct_l_partkey_count, count(DISTINCT l_quantity) AS distinct_l_quantity_count,
  count(DISTINCT l_returnflag) AS distinct_l_returnflag_count, count(DISTINCT l_linestatus) AS distinct_l_linestatus_count,
  count(DISTINCT l_shipdate) AS distinct_l_shipdate_count
FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY 1, 2 HAVING count(*) > 1""")
def _duplicate_profile(spark, d):
    return profile.duplicate_conflicts(T(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], _DUP_COLS)


@register("duplicate_summary", """
WITH per_key AS (
  SELECT count(*) AS n, count(DISTINCT l_partkey) AS part, count(DISTINCT l_quantity) AS quantity,
    count(DISTINCT l_returnflag) AS returnflag, count(DISTINCT l_linestatus) AS linestatus, count(DISTINCT l_shipdate) AS shipdate
  FROM lineitem WHERE l_orderkey + l_linenumber IS NOT NULL GROUP BY l_orderkey, l_linenumber),
repeated AS (FROM per_key WHERE n > 1),
conflicts AS (
  SELECT 'duplicate_keys_with_' || field || '_conflict' AS metric, count(*) FILTER (variants > 1) AS value
  FROM (UNPIVOT repeated ON part, quantity, returnflag, linestatus, shipdate INTO NAME field VALUE variants) GROUP BY field),
totals AS (
  SELECT (SELECT count(*) FROM lineitem) AS total_rows, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_with_valid_key,
    count(*) FILTER (n > 1) AS duplicate_keys, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS rows_in_duplicate_keys
  FROM per_key)
SELECT metric, CAST(value AS VARCHAR) AS value FROM (
  UNPIVOT totals ON COLUMNS(*) INTO NAME metric VALUE value
  UNION ALL BY NAME FROM conflicts
  UNION ALL BY NAME SELECT 'duplicate_keys_with_' || unnest(['part', 'quantity', 'returnflag', 'linestatus', 'shipdate'])
    || '_conflict' AS metric, 0 AS value WHERE NOT EXISTS (FROM repeated))""")
def _duplicate_summary(spark, d):
    return profile.duplicate_summary(T(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], _DUP_COLS,
                                     ["part", "quantity", "returnflag", "linestatus", "shipdate"])


# =========================================================== de-duplication

@register("latest_per_key_events", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id ASC) AS rn
  FROM events WHERE user_id IS NOT NULL) WHERE rn = 1""")
def _latest_events(spark, d):
    return dedup.latest_per_key(T(spark, d, "events"), ["user_id"],
                                [F.col("ts").desc_nulls_last(), F.col("event_id").asc_nulls_last()])


@register("latest_per_key_orders", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey ASC) AS rn
  FROM orders WHERE o_custkey IS NOT NULL) WHERE rn = 1""")
def _latest_orders(spark, d):
    return dedup.latest_per_key(T(spark, d, "orders"), ["o_custkey"],
                                [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").asc_nulls_last()])


_MC_ITEMS = ["l_orderkey", "l_linenumber", "CASE WHEN l_linestatus = 'F' THEN false END AS available",
             "nullif(l_returnflag, 'N') AS flag", "nullif(l_tax, 0.0) AS tax", "l_partkey", "l_suppkey", "l_quantity",
             "l_extendedprice", "l_discount", "l_shipdate"]
_MC_PROJ = ", ".join(_MC_ITEMS)
_MC_REST = ["available", "flag", "tax", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
            "l_shipdate"]


@register("most_complete_per_key", f"""
SELECT {', '.join(['l_orderkey', 'l_linenumber'] + _MC_REST)} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
    CASE WHEN available IS NOT NULL THEN 1 ELSE 0 END DESC,
    CASE WHEN flag IS NOT NULL THEN 1 ELSE 0 END DESC,
    CASE WHEN tax IS NOT NULL THEN 1 ELSE 0 END DESC,
    {', '.join(c + ' ASC NULLS LAST' for c in _MC_REST)}) AS rn
  FROM (SELECT {_MC_PROJ} FROM lineitem) WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL) WHERE rn = 1""")
def _most_complete(spark, d):
    li = T(spark, d, "lineitem").selectExpr(*_MC_ITEMS)
    return dedup.most_complete_per_key(li, ["l_orderkey", "l_linenumber"], ["available", "flag", "tax"])


_CASEFOLD_SRC = "CASE WHEN p_size > 25 THEN upper(p_name) ELSE p_name END"


@register("casefold_dedup", f"""
SELECT min(nb) AS neighbourhood FROM (SELECT nullif(trim({_CASEFOLD_SRC}), '') AS nb FROM part)
WHERE nb IS NOT NULL GROUP BY lower(nb)""")
def _casefold(spark, d):
    p = T(spark, d, "part").select(C.clean_text(F.expr(_CASEFOLD_SRC)).alias("neighbourhood"))
    return dedup.casefold_distinct(p, "neighbourhood")


# =========================================================== star schema

_DATE_ATTR_SQL = """
  CAST(strftime(date_day, '%Y%m%d') AS INTEGER) AS date_key, date_day,
  extract(year FROM date_day) AS year, extract(quarter FROM date_day) AS quarter,
  extract(month FROM date_day) AS month, strftime(date_day, '%B') AS month_name,
  extract(day FROM date_day) AS day, strftime(date_day, '%A') AS day_of_week,
  extract(week FROM date_day) AS week_of_year, extract(isodow FROM date_day) IN (6, 7) AS is_weekend"""


@register("dim_date", f"""
WITH date_values AS (
  SELECT CAST(o_orderdate AS DATE) AS date_day FROM orders WHERE o_orderdate IS NOT NULL
  UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_shipdate IS NOT NULL
  UNION SELECT CAST(ts AS DATE) FROM events WHERE ts IS NOT NULL)
SELECT {_DATE_ATTR_SQL} FROM date_values""")
def _dim_date(spark, d):
    return gold.dim_date([T(spark, d, "orders").select("o_orderdate"), T(spark, d, "lineitem").select("l_shipdate"),
                          T(spark, d, "events").select("ts")])


_DIM_HOST_SQL = f"""
WITH {B.listing_cte()}
SELECT md5(CAST(host_id AS VARCHAR)) AS host_key, host_id, host_name, host_since,
  host_location AS host_reported_location, host_response_time, round(host_response_rate, {R}) AS host_response_rate,
  host_acceptance_rate, host_is_superhost, host_identity_verified, host_listings_count, host_total_listings_count,
  source_last_scraped_date
FROM (SELECT *, last_scraped AS source_last_scraped_date,
        row_number() OVER (PARTITION BY host_id ORDER BY last_scraped DESC NULLS LAST, listing_id) AS rn
      FROM listings WHERE host_id IS NOT NULL) WHERE rn = 1"""


@register("dim_host", _DIM_HOST_SQL)
def _dim_host(spark, d):
    return rnd(gold.dim_host(B.bound_listings(spark, d)), "host_response_rate")


@register("dim_listing", f"""
WITH {B.listing_cte()}
SELECT md5(CAST(listing_id AS VARCHAR)) AS listing_key, listing_id, listing_name, latitude, longitude, property_type,
  room_type, accommodates, bathrooms, bedrooms, beds, minimum_nights AS listing_default_minimum_nights,
  maximum_nights AS listing_default_maximum_nights, instant_bookable
FROM listings""")
def _dim_listing(spark, d):
    return gold.dim_listing(B.bound_listings(spark, d))


_DIM_LOCATION_SQL = f"""
  SELECT md5('{B.CITY}' || '||' || neighbourhood) AS location_key, '{B.CITY}' AS city, neighbourhood
  FROM (SELECT DISTINCT neighbourhood FROM (
          SELECT neighbourhood FROM listings WHERE neighbourhood IS NOT NULL
          UNION ALL SELECT 'UNKNOWN'))"""


@register("dim_location", f"WITH {B.listing_cte()} {_DIM_LOCATION_SQL}")
def _dim_location(spark, d):
    return gold.dim_location(B.bound_listings(spark, d), B.CITY)


def _star_dims_sql() -> str:
    return f"""{B.listing_cte()},
  dim_listing AS (SELECT md5(CAST(listing_id AS VARCHAR)) AS listing_key, listing_id FROM listings),
  dim_host AS (SELECT md5(CAST(host_id AS VARCHAR)) AS host_key, host_id FROM (
      SELECT host_id, row_number() OVER (PARTITION BY host_id ORDER BY last_scraped DESC NULLS LAST, listing_id) AS rn
      FROM listings WHERE host_id IS NOT NULL) WHERE rn = 1),
  dim_location AS ({_DIM_LOCATION_SQL})"""


_FACT_AVAIL_SQL = f"""
WITH {_star_dims_sql()}, {B.calendar_cte()}
SELECT md5(CAST(cal.listing_id AS VARCHAR) || '||' || CAST(cal.calendar_date AS VARCHAR)) AS availability_daily_key,
  ld.listing_key, hd.host_key, loc.location_key,
  CAST(strftime(cal.calendar_date, '%Y%m%d') AS INTEGER) AS calendar_date_key, cal.listing_id, cal.is_available,
  cal.minimum_nights AS calendar_minimum_nights, cal.maximum_nights AS calendar_maximum_nights
FROM calendar AS cal
JOIN listings AS l ON cal.listing_id = l.listing_id
JOIN dim_listing AS ld ON cal.listing_id = ld.listing_id
JOIN dim_host AS hd ON l.host_id = hd.host_id
JOIN dim_location AS loc ON loc.city = '{B.CITY}' AND coalesce(l.neighbourhood, 'UNKNOWN') = loc.neighbourhood"""


def _calendar(spark, d):
    cal = B.bound_calendar(spark, d)
    from staylake.operators.dedup import most_complete_per_key
    return most_complete_per_key(cal, ["listing_id", "calendar_date"],
                                 ["is_available", "minimum_nights", "maximum_nights"],
                                 tie_break=["is_available", "minimum_nights", "maximum_nights"],
                                 cluster_by=["listing_id"])


@register("fact_availability", _FACT_AVAIL_SQL)
def _fact_availability(spark, d):
    return gold.fact_availability_daily(_calendar(spark, d), B.bound_listings(spark, d), B.CITY)


@register("fact_review", f"""
WITH {_star_dims_sql()}, {B.review_cte()}
SELECT md5(CAST(r.review_id AS VARCHAR)) AS review_key, ld.listing_key, hd.host_key, loc.location_key,
  CAST(strftime(r.review_date, '%Y%m%d') AS INTEGER) AS review_date_key, r.review_id, r.listing_id, r.reviewer_id,
  r.has_comment, 1 AS review_count
FROM reviews AS r
JOIN listings AS l ON r.listing_id = l.listing_id
JOIN dim_listing AS ld ON r.listing_id = ld.listing_id
JOIN dim_host AS hd ON l.host_id = hd.host_id
JOIN dim_location AS loc ON loc.city = '{B.CITY}' AND coalesce(l.neighbourhood, 'UNKNOWN') = loc.neighbourhood""")
def _fact_review(spark, d):
    return gold.fact_review(B.bound_reviews(spark, d), B.bound_listings(spark, d), B.CITY)


@register("fact_snapshot", f"""
WITH {_star_dims_sql()}
SELECT md5(CAST(l.listing_id AS VARCHAR) || '||' || CAST(l.last_scraped AS VARCHAR)) AS listing_snapshot_key,
  ld.listing_key, hd.host_key, loc.location_key,
  CAST(strftime(l.last_scraped, '%Y%m%d') AS INTEGER) AS snapshot_date_key,
  CASE WHEN l.last_review IS NOT NULL THEN CAST(strftime(l.last_review, '%Y%m%d') AS INTEGER) END AS last_review_date_key,
  l.listing_id, l.price AS listing_snapshot_price, {', '.join('l.' + c for c in gold.SNAPSHOT_MEASURES)}, 1 AS listing_count
FROM listings AS l
JOIN dim_listing AS ld ON l.listing_id = ld.listing_id
JOIN dim_host AS hd ON l.host_id = hd.host_id
JOIN dim_location AS loc ON loc.city = '{B.CITY}' AND coalesce(l.neighbourhood, 'UNKNOWN') = loc.neighbourhood""")
def _fact_snapshot(spark, d):
    return gold.fact_listing_current_snapshot(B.bound_listings(spark, d), B.CITY)


@register("availability_by_location_year", f"""
WITH q AS ({_FACT_AVAIL_SQL}), {B.listing_cte()}, loc AS ({_DIM_LOCATION_SQL})
SELECT loc.neighbourhood, CAST(q.calendar_date_key / 10000 AS INTEGER) AS year, count(*) AS day_rows,
  CAST(sum(CASE WHEN q.is_available = false THEN 1 ELSE 0 END) AS BIGINT) AS unavailable_days
FROM q JOIN loc ON q.location_key = loc.location_key GROUP BY 1, 2""")
def _availability_by_location_year(spark, d):
    return availability_by_location_year(spark, d)


def availability_by_location_year(spark, d):
    """Flagship: fact rows and unavailable days per neighbourhood and year.

    The fact is aggregated to (location_key, year) BEFORE meeting the location
    dimension: the large side is never shuffled by location_key, only its
    partial aggregates are (aggregate push-down below the join, which Catalyst
    does not do by itself; exact because location_key -> neighbourhood is 1:1).
    """
    listings = B.bound_listings(spark, d)
    fact = gold.fact_availability_daily(_calendar(spark, d), listings, B.CITY)
    per_key = fact.groupBy("location_key", (F.col("calendar_date_key") / 10000).cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("day_rows"),
        F.sum(F.when(F.col("is_available") == F.lit(False), 1).otherwise(0)).cast("bigint").alias("unavailable_days"))
    loc = gold.dim_location(listings, B.CITY)
    return per_key.join(loc, "location_key").select("neighbourhood", "year", "day_rows", "unavailable_days")


# =========================================================== rules, JSON counts

# A rule table for the driver's part names (shows the operator on another schema).
PART_NAME_RULES = [
    (("ring", "bolt", "rod"), "Hardware"),
    (("plate",), "Kitchen"),
    (("widget", "gizmo"), "Gadget"),
]

_SQL_GROUP = rules_to_sql("p_name", SQL_PROPERTY_RULES, SQL_PROPERTY_DEFAULT, SQL_PROPERTY_NULL_LABEL, SQL_PROPERTY_EXACT)
_PY_GROUP = rules_to_sql("p_name", PY_PROPERTY_RULES, PY_PROPERTY_DEFAULT, PY_PROPERTY_NULL_LABEL)
_PART_GROUP = rules_to_sql("p_name", PART_NAME_RULES, "Other", "Unknown")
_TYPE_GROUP = rules_to_sql("p_type", [(("large", "medium"), "Big"), (("small",), "Small")], "Other", None,
                           [(("promo",), "Promo")])
_TYPE_NAME_SQL = "CASE p_type WHEN 'ECONOMY' THEN 'Entire home/apt' WHEN 'PROMO' THEN 'Boutique hotel' " \
                 "WHEN 'SMALL' THEN 'Private room in guest suite' WHEN 'LARGE' THEN 'Tiny home' " \
                 "WHEN 'MEDIUM' THEN 'Entire serviced apartment' ELSE NULL END"


@register("categorize", f"""
SELECT p_partkey, {_SQL_GROUP} AS sql_group, {_PY_GROUP} AS py_group, {_PART_GROUP} AS part_group,
  {_TYPE_GROUP} AS type_group,
  {rules_to_sql('pt', SQL_PROPERTY_RULES, SQL_PROPERTY_DEFAULT, SQL_PROPERTY_NULL_LABEL, SQL_PROPERTY_EXACT)} AS sql_property_group,
  {rules_to_sql('pt', PY_PROPERTY_RULES, PY_PROPERTY_DEFAULT, PY_PROPERTY_NULL_LABEL)} AS py_property_group
FROM (SELECT *, {_TYPE_NAME_SQL} AS pt FROM part)""")
def _categorize(spark, d):
    p = T(spark, d, "part").withColumn("pt", F.expr(_TYPE_NAME_SQL))
    return p.select("p_partkey", property_group_sql("p_name").alias("sql_group"),
                    property_group_py("p_name").alias("py_group"),
                    categorize("p_name", PART_NAME_RULES, "Other", "Unknown").alias("part_group"),
                    categorize("p_type", [(("large", "medium"), "Big"), (("small",), "Small")], "Other", None,
                               [(("promo",), "Promo")]).alias("type_group"),
                    property_group_sql("pt").alias("sql_property_group"),
                    property_group_py("pt").alias("py_property_group"))


@register("categorize_sources", f"""
SELECT doc_id, {rules_to_sql('source', [(('src1',), 'one-ish'), (('src2', 'src3'), 'two-three')], 'other', 'none')} AS source_group
FROM documents""")
def _categorize_sources(spark, d):
    return T(spark, d, "documents").select(
        "doc_id", categorize("source", [(("src1",), "one-ish"), (("src2", "src3"), "two-three")], "other", "none")
        .alias("source_group"))


_SPLIT_SQL = ("CAST(coalesce(try(json_array_length({x})), "
              "len(regexp_extract_all(trim(trim({x}), '[]{{}}'), '[^ ,][^,]*')), 0) AS INTEGER)")
_NULLMODE_SQL = "CAST(CASE WHEN {x} IS NULL THEN NULL ELSE try(json_array_length({x})) END AS INTEGER)"


@register("json_array_count", f"""
WITH src AS (
  SELECT 'part' AS src, p_partkey AS k, CAST(to_json(string_split(p_name, ' ')) AS VARCHAR) AS txt FROM part
  UNION ALL SELECT 'events', event_id, props FROM events
  UNION ALL SELECT 'documents', doc_id, text FROM documents
  UNION ALL SELECT 'amenities', listing_id, amenities FROM ({B.binding_sql(B.PART_LISTING_BINDING, B.PART_LISTING_FROM)}))
SELECT src, k, {_NULLMODE_SQL.format(x='txt')} AS count_null_mode, {_SPLIT_SQL.format(x='txt')} AS count_split_mode
FROM src""")
def _json_array_count(spark, d):
    parts = [
        T(spark, d, "part").select(F.lit("part").alias("src"), F.col("p_partkey").alias("k"),
                                   F.to_json(F.split("p_name", " ")).alias("txt")),
        T(spark, d, "events").select(F.lit("events").alias("src"), F.col("event_id").alias("k"), F.col("props").alias("txt")),
        T(spark, d, "documents").select(F.lit("documents").alias("src"), F.col("doc_id").alias("k"), F.col("text").alias("txt")),
        B.bound_part_listings(spark, d).select(F.lit("amenities").alias("src"), F.col("listing_id").alias("k"),
                                               F.col("amenities").alias("txt")),
    ]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return u.select("src", "k", C.count_json_items("txt", "null").alias("count_null_mode"),
                    C.count_json_items("txt", "split").alias("count_split_mode"))


# =========================================================== imputation, marts

_IMPUTE_SRC = "CASE WHEN p_type = 'PROMO' OR p_size > 45 THEN NULL ELSE p_size END"


@register("impute_group_median", f"""
WITH b AS (SELECT p_partkey, nullif(p_type, 'SMALL') AS p_type, CAST({_IMPUTE_SRC} AS DOUBLE) AS v FROM part)
SELECT p_partkey, p_type, round(coalesce(v, median(v) OVER (PARTITION BY p_type), median(v) OVER ()), {R}) AS v
FROM b""")
def _impute_group_median(spark, d):
    b = T(spark, d, "part").select("p_partkey", F.nullif(F.col("p_type"), F.lit("SMALL")).alias("p_type"),
                                   F.expr(_IMPUTE_SRC).cast("double").alias("v"))
    return rnd(impute.impute_group_median(b, ["v"], ["p_type"]), "v")


_PRICE_MART_SQL = f"""
WITH {B.part_listing_cte()}
SELECT {', '.join(features.PRICE_MART_COLUMNS)},
  CAST(number_of_reviews > 0 AS TINYINT) AS has_reviews,
  {_NULLMODE_SQL.format(x='amenities')} AS amenities_count,
  round(ln(1 + price), {R}) AS log_price
FROM plistings WHERE price IS NOT NULL AND price > 0"""


@register("price_features", _PRICE_MART_SQL)
def _price_features(spark, d):
    return rnd(features.price_model_features(B.bound_part_listings(spark, d)), "log_price")


@register("cluster_features", f"""
WITH {B.part_listing_cte()},
fb AS (
  SELECT listing_id, price, room_type, property_type,
    {rules_to_sql('property_type', SQL_PROPERTY_RULES, SQL_PROPERTY_DEFAULT, SQL_PROPERTY_NULL_LABEL, SQL_PROPERTY_EXACT)} AS property_base_group,
    accommodates, bedrooms, bathrooms, beds, {_SPLIT_SQL.format(x='amenities')} AS amenities_count,
    minimum_nights, greatest(coalesce(minimum_nights, 0), 0) AS mn_clean
  FROM plistings WHERE price IS NOT NULL AND price > 0),
m AS (
  SELECT *, median(bedrooms) OVER (PARTITION BY room_type) AS b1, median(bathrooms) OVER (PARTITION BY room_type) AS b2,
    median(beds) OVER (PARTITION BY room_type) AS b3, median(bedrooms) OVER () AS g1,
    median(bathrooms) OVER () AS g2, median(beds) OVER () AS g3 FROM fb),
i AS (
  SELECT listing_id, price, room_type, property_type, property_base_group, accommodates,
    round(coalesce(bedrooms, b1, g1), {R}) AS bedrooms, round(coalesce(bathrooms, b2, g2), {R}) AS bathrooms,
    round(coalesce(beds, b3, g3), {R}) AS beds, amenities_count, minimum_nights, round(ln(1 + mn_clean), {R}) AS minimum_nights_log
  FROM m)
SELECT * FROM i WHERE listing_id IS NOT NULL AND price IS NOT NULL AND room_type IS NOT NULL
  AND property_base_group IS NOT NULL AND accommodates IS NOT NULL AND bedrooms IS NOT NULL AND bathrooms IS NOT NULL
  AND beds IS NOT NULL AND amenities_count IS NOT NULL AND minimum_nights_log IS NOT NULL""")
def _cluster_features(spark, d):
    return rnd(features.cluster_model_features(B.bound_part_listings(spark, d)),
               "bedrooms", "bathrooms", "beds", "minimum_nights_log")


@register("modelling_frame", f"""
WITH {B.part_listing_cte()}
SELECT listing_id, price, round(ln(1 + price), {R}) AS log_price,
  {rules_to_sql('property_type', PY_PROPERTY_RULES, PY_PROPERTY_DEFAULT, PY_PROPERTY_NULL_LABEL)} AS property_base_group,
  CASE WHEN CAST(number_of_reviews > 0 AS TINYINT) = 0 THEN 0.0 ELSE reviews_per_month END AS reviews_per_month
FROM plistings WHERE price IS NOT NULL AND price > 0""")
def _modelling_frame(spark, d):
    mart = features.price_model_features(B.bound_part_listings(spark, d))
    m = features.modelling_frame(mart)
    return rnd(m.select("listing_id", "price", "log_price", "property_base_group", "reviews_per_month"), "log_price")


# =========================================================== data quality

_ORD_NULLED = ("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
               "nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders")


def _orders_nulled(spark, d):
    return T(spark, d, "orders").withColumn("o_orderpriority", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")))


@register("dq_not_null", f"SELECT * FROM ({_ORD_NULLED}) WHERE o_orderpriority IS NULL")
def _dq_not_null(spark, d):
    return quality.check_not_null(_orders_nulled(spark, d), "o_orderpriority")


@register("dq_unique", """
SELECT o_custkey, count(*) AS row_count FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1""")
def _dq_unique(spark, d):
    return quality.check_unique(T(spark, d, "orders"), "o_custkey")


@register("dq_unique_combination", """
SELECT o_custkey, o_orderstatus, count(*) AS row_count FROM orders GROUP BY 1, 2 HAVING count(*) > 1""")
def _dq_unique_combination(spark, d):
    return quality.check_unique_combination(T(spark, d, "orders"), ["o_custkey", "o_orderstatus"])


@register("dq_accepted_values", "SELECT * FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')")
def _dq_accepted_values(spark, d):
    return quality.check_accepted_values(T(spark, d, "orders"), "o_orderstatus", ["F", "O"])


@register("dq_relationships", """
SELECT o.* FROM orders o WHERE o.o_custkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_nationkey <> 3 AND c.c_custkey = o.o_custkey)""")
def _dq_relationships(spark, d):
    parent = T(spark, d, "customer").where(F.col("c_nationkey") != 3)
    return quality.check_relationships(T(spark, d, "orders"), "o_custkey", parent, "c_custkey")


@register("dq_positive_or_null", "SELECT * FROM customer WHERE c_acctbal < 0")
def _dq_positive_or_null(spark, d):
    return quality.check_positive_or_null(T(spark, d, "customer"), "c_acctbal")


@register("dq_non_negative", "SELECT * FROM supplier WHERE s_acctbal IS NOT NULL AND s_acctbal < 0")
def _dq_non_negative(spark, d):
    return quality.check_non_negative(T(spark, d, "supplier"), "s_acctbal")


@register("dq_between_or_null", """
SELECT * FROM lineitem WHERE l_discount IS NOT NULL AND (l_discount < 0.0 OR l_discount > 0.05)""")
def _dq_between(spark, d):
    return quality.check_between_or_null(T(spark, d, "lineitem"), "l_discount", 0.0, 0.05)


@register("dq_greater_than", "SELECT * FROM part WHERE p_size IS NOT NULL AND p_size <= 5")
def _dq_greater_than(spark, d):
    return quality.check_greater_than(T(spark, d, "part"), "p_size", 5)


@register("dq_less_than_or_equal", """
SELECT * FROM lineitem WHERE l_tax IS NOT NULL AND l_discount IS NOT NULL AND l_tax > l_discount""")
def _dq_le(spark, d):
    return quality.check_less_than_or_equal_or_null(T(spark, d, "lineitem"), "l_tax", "l_discount")


@register("dq_not_empty", """
SELECT 'nation' AS table_name, row_count FROM (SELECT count(*) AS row_count FROM nation) WHERE row_count = 0
UNION ALL
SELECT 'nation_far', row_count FROM (SELECT count(*) AS row_count FROM nation WHERE n_regionkey > 100) WHERE row_count = 0""")
def _dq_not_empty(spark, d):
    n = T(spark, d, "nation")
    a = quality.check_not_empty(n).select(F.lit("nation").alias("table_name"), "row_count")
    b = quality.check_not_empty(n.where(F.col("n_regionkey") > 100)).select(F.lit("nation_far").alias("table_name"), "row_count")
    return a.unionByName(b)


@register("dq_member_exists", f"""
WITH {B.listing_cte()}, loc AS ({_DIM_LOCATION_SQL})
SELECT 'NATION_3' AS member, 1 AS missing_member WHERE NOT EXISTS (SELECT 1 FROM loc WHERE city = '{B.CITY}' AND neighbourhood = 'NATION_3')
UNION ALL
SELECT 'NATION_7', 1 WHERE NOT EXISTS (SELECT 1 FROM loc WHERE city = '{B.CITY}' AND neighbourhood = 'NATION_7')
UNION ALL
SELECT 'UNKNOWN', 1 WHERE NOT EXISTS (SELECT 1 FROM loc WHERE city = '{B.CITY}' AND neighbourhood = 'UNKNOWN')""")
def _dq_member_exists(spark, d):
    loc = gold.dim_location(B.bound_listings(spark, d), B.CITY)
    parts = [quality.check_member_exists(loc, {"city": B.CITY, "neighbourhood": m})
             .select(F.lit(m).alias("member"), "missing_member") for m in ("NATION_3", "NATION_7", "UNKNOWN")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("dq_row_count_matches", """
SELECT a.model_row_count, b.compare_row_count FROM (SELECT count(*) AS model_row_count FROM orders) a
CROSS JOIN (SELECT count(*) AS compare_row_count FROM (SELECT DISTINCT l_orderkey FROM lineitem)) b
WHERE a.model_row_count <> b.compare_row_count""")
def _dq_row_count(spark, d):
    return quality.check_row_count_matches(T(spark, d, "orders"), T(spark, d, "lineitem").select("l_orderkey").distinct())


@register("dq_unknown_ratio", f"""
WITH {B.listing_cte()}, loc AS ({_DIM_LOCATION_SQL}),
fact AS (SELECT md5('{B.CITY}' || '||' || coalesce(neighbourhood, 'UNKNOWN')) AS location_key FROM listings WHERE host_id IS NOT NULL),
u AS (SELECT count(*) AS total_rows, sum(CASE WHEN loc.neighbourhood = 'UNKNOWN' THEN 1 ELSE 0 END) AS unknown_rows
      FROM fact JOIN loc ON fact.location_key = loc.location_key)
SELECT total_rows, CAST(unknown_rows AS BIGINT) AS unknown_rows,
  round(coalesce(unknown_rows * 1.0 / nullif(total_rows, 0), 0.0), {R}) AS unknown_ratio, 0.01 AS max_allowed_ratio
FROM u WHERE coalesce(unknown_rows * 1.0 / nullif(total_rows, 0), 0.0) > 0.01""")
def _dq_unknown_ratio(spark, d):
    listings = B.bound_listings(spark, d)
    fact = gold.fact_listing_current_snapshot(listings, B.CITY)
    loc = gold.dim_location(listings, B.CITY)
    return rnd(quality.check_unknown_member_ratio_below(fact, loc, 0.01), "unknown_ratio")


_SUITE = [
    quality.Expectation("not_null", "o_orderkey"),
    quality.Expectation("not_null", "o_orderpriority"),
    quality.Expectation("accepted_values", "o_orderstatus", {"values": ["F", "O"]}),
    quality.Expectation("positive_or_null", "o_totalprice"),
    quality.Expectation("between_or_null", "o_totalprice", {"min_value": 1000, "max_value": 400000}),
    quality.Expectation("greater_than", "o_totalprice", {"value": 900}),
    quality.Expectation("less_than_or_equal_or_null", "o_custkey", {"right_column": "o_orderkey"}),
    quality.Expectation("unique", "o_orderkey"),
    quality.Expectation("unique", "o_custkey"),
    quality.Expectation("unique_combination_of_columns", None, {"columns": ["o_orderkey", "o_custkey"]}),
    quality.Expectation("relationships", "o_custkey", {"to": "customer", "field": "c_custkey"}),
    quality.Expectation("not_empty"),
    quality.Expectation("row_count_matches", None, {"compare_model": "customer"}),
]


@register("dq_suite", """
WITH o AS (""" + _ORD_NULLED + """), x AS (
  SELECT 'not_null' AS check_name, 'orders' AS table_name, 'o_orderkey' AS column_name, count(*) FILTER (WHERE o_orderkey IS NULL) AS violations FROM o
  UNION ALL SELECT 'not_null', 'orders', 'o_orderpriority', count(*) FILTER (WHERE o_orderpriority IS NULL) FROM o
  UNION ALL SELECT 'accepted_values', 'orders', 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F','O')) FROM o
  UNION ALL SELECT 'positive_or_null', 'orders', 'o_totalprice', count(*) FILTER (WHERE o_totalprice < 0) FROM o
  UNION ALL SELECT 'between_or_null', 'orders', 'o_totalprice', count(*) FILTER (WHERE o_totalprice IS NOT NULL AND (o_totalprice < 1000 OR o_totalprice > 400000)) FROM o
  UNION ALL SELECT 'greater_than', 'orders', 'o_totalprice', count(*) FILTER (WHERE o_totalprice IS NOT NULL AND o_totalprice <= 900) FROM o
  UNION ALL SELECT 'less_than_or_equal_or_null', 'orders', 'o_custkey', count(*) FILTER (WHERE o_custkey IS NOT NULL AND o_orderkey IS NOT NULL AND o_custkey > o_orderkey) FROM o
  UNION ALL SELECT 'unique', 'orders', 'o_orderkey', (SELECT count(*) FROM (SELECT o_orderkey FROM o WHERE o_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1))
  UNION ALL SELECT 'unique', 'orders', 'o_custkey', (SELECT count(*) FROM (SELECT o_custkey FROM o WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1))
  UNION ALL SELECT 'unique_combination_of_columns', 'orders', 'o_orderkey,o_custkey', (SELECT count(*) FROM (SELECT 1 FROM o GROUP BY o_orderkey, o_custkey HAVING count(*) > 1))
  UNION ALL SELECT 'relationships', 'orders', 'o_custkey', (SELECT count(*) FROM o WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL))
  UNION ALL SELECT 'not_empty', 'orders', NULL, (SELECT count(*) FROM (SELECT count(*) AS n FROM o) WHERE n = 0)
  UNION ALL SELECT 'row_count_matches', 'orders', NULL, (SELECT count(*) FROM (SELECT (SELECT count(*) FROM o) AS a, (SELECT count(*) FROM customer) AS b) WHERE a <> b)
)
SELECT check_name, table_name, column_name, CAST(violations AS BIGINT) AS violations,
  CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM x""")
def _dq_suite(spark, d):
    return quality.run_suite("orders", _orders_nulled(spark, d), _SUITE, {"customer": T(spark, d, "customer")})


# =========================================================== profiling

_LI_NULLED_ITEMS = ["l_orderkey", "nullif(l_returnflag, 'N') AS returnflag", "nullif(l_linestatus, 'O') AS linestatus",
                    "nullif(l_tax, 0.0) AS tax", "nullif(l_discount, 0.0) AS discount", "l_quantity", "l_shipdate"]
_LI_NULLED = "SELECT " + ", ".join(_LI_NULLED_ITEMS) + " FROM lineitem"
_LI_PROFILE_COLS = ["l_orderkey", "returnflag", "linestatus", "tax", "discount", "l_quantity", "l_shipdate"]


def _li_nulled(spark, d):
    return T(spark, d, "lineitem").selectExpr(*_LI_NULLED_ITEMS)


@register("missing_rate", f"""
WITH b AS ({_LI_NULLED}),
m AS (SELECT * FROM (SELECT {', '.join(f"avg(CASE WHEN {c} IS NULL{' OR isnan(' + c + ')' if c in ('tax', 'discount', 'l_quantity') else ''} THEN 1.0 ELSE 0.0 END) * 100.0 AS {c}" for c in _LI_PROFILE_COLS)} FROM b)
      UNPIVOT (missing_rate FOR "column" IN ({', '.join(_LI_PROFILE_COLS)})))
SELECT "column", round(missing_rate, {R}) AS missing_rate FROM m WHERE missing_rate > 0""")
def _missing_rate(spark, d):
    return rnd(profile.missing_rate(_li_nulled(spark, d), _LI_PROFILE_COLS), "missing_rate")


_SPARK_TYPES = {"l_orderkey": "bigint", "returnflag": "string", "linestatus": "string", "tax": "double",
                "discount": "double", "l_quantity": "double", "l_shipdate": "timestamp_ntz"}


@register("column_quality", f"""
WITH b AS ({_LI_NULLED})
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{_SPARK_TYPES[c]}' AS dtype, count({c}) AS non_null_count, "
    f"count(*) - count({c}) AS missing_count, round(round((count(*) - count({c})) * 100.0 / count(*), 2), {R}) AS missing_rate, "
    f"count(DISTINCT {c}) AS unique_count FROM b" for c in _LI_PROFILE_COLS))
def _column_quality(spark, d):
    return rnd(profile.column_quality(_li_nulled(spark, d), _LI_PROFILE_COLS), "missing_rate")


_DESC_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("describe", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), {R}) AS mean, round(stddev_samp({c}), {R}) AS std, "
    f"round(min({c}), {R}) AS min, round(quantile_cont({c}, 0.25), {R}) AS p25, round(quantile_cont({c}, 0.5), {R}) AS p50, "
    f"round(quantile_cont({c}, 0.75), {R}) AS p75, round(max({c}), {R}) AS max FROM lineitem" for c in _DESC_COLS))
def _describe(spark, d):
    return rnd(profile.describe(T(spark, d, "lineitem"), _DESC_COLS))


@register("describe_categorical", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", (SELECT count({c}) FROM lineitem) AS count, (SELECT count(DISTINCT {c}) FROM lineitem) AS "unique",
      top, freq FROM (SELECT CAST({c} AS VARCHAR) AS top, count(*) AS freq FROM lineitem WHERE {c} IS NOT NULL
      GROUP BY {c} ORDER BY count(*) DESC, {c} ASC LIMIT 1)""" for c in ["l_returnflag", "l_linestatus", "l_linenumber"]))
def _describe_categorical(spark, d):
    return profile.describe_categorical(T(spark, d, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


@register("grouped_summary", f"""
SELECT l_returnflag, l_linestatus, count(*) AS count, round(avg(l_extendedprice), {R}) AS mean,
  round(median(l_extendedprice), {R}) AS median FROM lineitem GROUP BY 1, 2""")
def _grouped_summary(spark, d):
    return rnd(profile.grouped_summary(T(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice"))


_EVENT_LABELS = ["view", "click", "purchase", "signup", "refund"]


@register("value_share", f"""
WITH c AS (SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1),
t AS (SELECT sum(n) AS total FROM c),
l AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{v}')" for i, v in enumerate(_EVENT_LABELS))}) AS l(o, event_type))
SELECT l.event_type, CAST(coalesce(c.n, 0) AS BIGINT) AS count, round(coalesce(c.n * 1.0 / t.total, 0.0), {R}) AS share
FROM l LEFT JOIN c ON l.event_type = c.event_type CROSS JOIN t""")
def _value_share(spark, d):
    return rnd(profile.value_counts(T(spark, d, "events"), "event_type", _EVENT_LABELS), "share")


_PRICE_EDGES = [0.0, 1000.0, 20000.0, 50000.0, 80000.0, 1e12]
_PRICE_LABELS = ["< 1k", "1k-20k", "20k-50k", "50k-80k", "> 80k"]


def _cut_sql(x: str) -> str:
    parts = ["CASE"]
    for i in range(len(_PRICE_EDGES) - 1):
        lo, hi = _PRICE_EDGES[i], _PRICE_EDGES[i + 1]
        op = ">=" if i == 0 else ">"
        parts.append(f" WHEN {x} {op} {lo} AND {x} <= {hi} THEN '{_PRICE_LABELS[i]}'")
    return "".join(parts) + " END"


@register("cut_bins", f"""
SELECT {_cut_sql('l_extendedprice')} AS price_segment, count(*) AS n FROM lineitem GROUP BY 1""")
def _cut_bins(spark, d):
    li = T(spark, d, "lineitem")
    return li.groupBy(profile.cut("l_extendedprice", _PRICE_EDGES, _PRICE_LABELS).alias("price_segment")) \
             .agg(F.count(F.lit(1)).alias("n"))


@register("pivot_wide", f"""
WITH l AS (SELECT l_returnflag, l_linestatus, avg(l_quantity) AS q FROM lineitem GROUP BY 1, 2)
SELECT l_returnflag, round(max(CASE WHEN l_linestatus = 'F' THEN q END), {R}) AS F,
  round(max(CASE WHEN l_linestatus = 'O' THEN q END), {R}) AS O FROM l GROUP BY 1""")
def _pivot_wide(spark, d):
    long = T(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.avg("l_quantity").alias("q"))
    return rnd(profile.pivot_wide(long, ["l_returnflag"], "l_linestatus", "q", ["F", "O"]))


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


_CT_COUNTS = ", ".join("count(*) FILTER (WHERE o_orderpriority = '%s') AS \"%s\"" % (p, p) for p in _PRIORITIES)
_CT_IN = ", ".join("'%s'" % p for p in _PRIORITIES)
_CT_OUT = ", ".join('round("%s" * 1.0 / tot, %d) AS "%s"' % (p, R, p) for p in _PRIORITIES)


@register("crosstab", f"""
WITH c AS (SELECT o_orderstatus, {_CT_COUNTS},
  count(*) FILTER (WHERE o_orderpriority IN ({_CT_IN})) AS tot FROM orders GROUP BY 1)
SELECT o_orderstatus, {_CT_OUT} FROM c""")
def _crosstab(spark, d):
    return rnd(profile.crosstab_normalized(T(spark, d, "orders"), "o_orderstatus", "o_orderpriority", _PRIORITIES))


@register("quantiles", f"""
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), {R}) AS p25,
  round(quantile_cont(l_extendedprice, 0.5), {R}) AS p50, round(quantile_cont(l_extendedprice, 0.75), {R}) AS p75
FROM lineitem GROUP BY 1
UNION ALL
SELECT NULL, round(quantile_cont(l_extendedprice, 0.25), {R}), round(quantile_cont(l_extendedprice, 0.5), {R}),
  round(quantile_cont(l_extendedprice, 0.75), {R}) FROM lineitem""")
def _quantiles(spark, d):
    li = T(spark, d, "lineitem")
    g = quantiles(li, "l_extendedprice", [0.25, 0.5, 0.75], ["l_returnflag"], ["p25", "p50", "p75"])
    a = quantiles(li, "l_extendedprice", [0.25, 0.5, 0.75], [], ["p25", "p50", "p75"]) \
        .select(F.lit(None).cast("string").alias("l_returnflag"), "p25", "p50", "p75")
    return rnd(g.unionByName(a))


@register("mode_share", f"""
WITH c AS (SELECT p_type, p_brand, count(*) AS n FROM part WHERE p_brand IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY n DESC, p_brand ASC) AS rn FROM c),
s AS (SELECT p_type, count(*) AS tot FROM part GROUP BY 1)
SELECT s.p_type, r.p_brand AS mode, round(r.n * 1.0 / s.tot, {R}) AS mode_share
FROM s LEFT JOIN r ON s.p_type IS NOT DISTINCT FROM r.p_type AND r.rn = 1""")
def _mode_share(spark, d):
    return rnd(profile.mode_share(T(spark, d, "part"), ["p_type"], "p_brand"))


@register("histogram", f"""
WITH r AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT CAST(CASE WHEN r.hi = r.lo THEN 0 ELSE least(floor((l_extendedprice - r.lo) / ((r.hi - r.lo) / 10.0)), 9) END AS INTEGER) AS bin
      FROM lineitem CROSS JOIN r WHERE l_extendedprice IS NOT NULL),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY 1)
SELECT CAST(g.bin AS INTEGER) AS bin, round(r.lo + g.bin * ((r.hi - r.lo) / 10.0), {R}) AS lower,
  round(r.lo + (g.bin + 1) * ((r.hi - r.lo) / 10.0), {R}) AS upper, CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM range(10) g(bin) CROSS JOIN r LEFT JOIN c ON c.bin = g.bin""")
def _histogram(spark, d):
    return rnd(profile.histogram(T(spark, d, "lineitem"), "l_extendedprice", 10))


@register("box_stats", f"""
WITH q AS (SELECT p_type, quantile_cont(p_retailprice, 0.25) AS q1, quantile_cont(p_retailprice, 0.5) AS median,
             quantile_cont(p_retailprice, 0.75) AS q3 FROM part WHERE p_retailprice IS NOT NULL GROUP BY 1),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q),
a AS (SELECT f.p_type, count(*) AS count,
        min(CASE WHEN p.p_retailprice >= f.lower_fence AND p.p_retailprice <= f.upper_fence THEN p.p_retailprice END) AS whisker_low,
        max(CASE WHEN p.p_retailprice >= f.lower_fence AND p.p_retailprice <= f.upper_fence THEN p.p_retailprice END) AS whisker_high,
        count(*) FILTER (WHERE NOT (p.p_retailprice >= f.lower_fence AND p.p_retailprice <= f.upper_fence)) AS outliers
      FROM part p JOIN f ON p.p_type IS NOT DISTINCT FROM f.p_type WHERE p.p_retailprice IS NOT NULL GROUP BY 1)
SELECT f.p_type, round(q1, {R}) AS q1, round(median, {R}) AS median, round(q3, {R}) AS q3, round(iqr, {R}) AS iqr,
  round(lower_fence, {R}) AS lower_fence, round(upper_fence, {R}) AS upper_fence, a.count,
  round(whisker_low, {R}) AS whisker_low, round(whisker_high, {R}) AS whisker_high, a.outliers
FROM f JOIN a ON f.p_type IS NOT DISTINCT FROM a.p_type""")
def _box_stats(spark, d):
    return rnd(profile.box_stats(T(spark, d, "part"), "p_retailprice", ["p_type"]))


@register("co_missing", f"""
WITH b AS ({_LI_NULLED})
SELECT count(*) FILTER (WHERE tax IS NULL AND returnflag IS NULL) AS tax_null_and_flag_null,
  count(*) FILTER (WHERE tax IS NULL AND NOT returnflag IS NULL) AS tax_null_only,
  count(*) FILTER (WHERE NOT tax IS NULL AND returnflag IS NULL) AS flag_null_only,
  count(*) FILTER (WHERE NOT tax IS NULL AND NOT returnflag IS NULL) AS neither FROM b""")
def _co_missing(spark, d):
    b = _li_nulled(spark, d)
    return profile.co_missing(b, F.col("tax").isNull(), F.col("returnflag").isNull(), ("tax_null", "flag_null"))


# =========================================================== statistics

_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("pearson", " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), {R}) AS pearson FROM lineitem"
    for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i + 1:]))
def _pearson(spark, d):
    return rnd(stats.pearson_matrix(T(spark, d, "lineitem"), _CORR_COLS))


@register("spearman", f"""
WITH b AS (SELECT l_returnflag, l_quantity AS x, l_extendedprice AS y FROM lineitem WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL),
r AS (SELECT l_returnflag,
        rank() OVER (PARTITION BY l_returnflag ORDER BY x) + (count(*) OVER (PARTITION BY l_returnflag, x) - 1) / 2.0 AS rx,
        rank() OVER (PARTITION BY l_returnflag ORDER BY y) + (count(*) OVER (PARTITION BY l_returnflag, y) - 1) / 2.0 AS ry FROM b)
SELECT l_returnflag, round(corr(rx, ry), {R}) AS spearman, count(*) AS n FROM r GROUP BY 1""")
def _spearman(spark, d):
    return rnd(stats.spearman(T(spark, d, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"]).drop("p_value"), "spearman")


@register("spearman_global", f"""
WITH b AS (SELECT l_discount AS x, l_extendedprice AS y FROM lineitem WHERE l_discount IS NOT NULL AND l_extendedprice IS NOT NULL),
r AS (SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
             rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM b)
SELECT round(corr(rx, ry), {R}) AS spearman, count(*) AS n FROM r""")
def _spearman_global(spark, d):
    return rnd(stats.spearman(T(spark, d, "lineitem"), "l_discount", "l_extendedprice").drop("p_value"), "spearman")


@register("kruskal", f"""
WITH x AS (SELECT l_linestatus || l_returnflag AS g, l_extendedprice AS v FROM lineitem WHERE l_extendedprice IS NOT NULL),
keep AS (SELECT g FROM x GROUP BY g HAVING count(*) >= 30),
k AS (SELECT x.* FROM x JOIN keep USING (g)),
r AS (SELECT g, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS rk FROM k),
s AS (SELECT g, sum(rk) AS rs, count(*) AS ng FROM r GROUP BY g),
t AS (SELECT sum(CAST(c AS DOUBLE) * c * c - c) AS ties FROM (SELECT count(*) AS c FROM k GROUP BY v)),
agg AS (SELECT sum(rs * rs / ng) AS ssum, sum(ng) AS n, count(*) AS n_groups FROM s)
SELECT round(CASE WHEN n_groups >= 2 THEN (12.0 / (n * (n + 1)) * ssum - 3.0 * (n + 1)) / (1 - ties / (CAST(n AS DOUBLE) * n * n - n)) END, {R}) AS h,
  n_groups, CAST(n AS BIGINT) AS n FROM agg CROSS JOIN t""")
def _kruskal(spark, d):
    li = T(spark, d, "lineitem").withColumn("g", F.concat("l_linestatus", "l_returnflag"))
    return rnd(stats.kruskal_wallis(li, "l_extendedprice", "g", 30).drop("p_value"), "h")


# =========================================================== prediction errors

P = 4  # decimals for price-scale values (exp of a log amplifies float noise)


def _pred_base(spark, d):
    """lineitem with log1p(extendedprice) as actual and its (flag, status) group mean as prediction."""
    li = T(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
        F.nullif(F.col("l_returnflag"), F.lit("R")).alias("grp"),
        F.log(F.lit(1.0) + F.col("l_extendedprice")).alias("actual_log"))
    means = li.groupBy("l_returnflag", "l_linestatus").agg(F.avg("actual_log").alias("predicted_log"))
    return li.join(means, ["l_returnflag", "l_linestatus"])


_PRED_SQL = """pb AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, nullif(l_returnflag, 'R') AS grp,
    ln(1 + l_extendedprice) AS actual_log,
    avg(ln(1 + l_extendedprice)) OVER (PARTITION BY l_returnflag, l_linestatus) AS predicted_log FROM lineitem),
ef AS (
  SELECT *, exp(actual_log) - 1 AS actual_price, greatest(exp(predicted_log) - 1, 0.0) AS predicted_price FROM pb),
e AS (
  SELECT *, actual_price - predicted_price AS residual, abs(actual_price - predicted_price) AS absolute_error,
    CASE WHEN actual_price > 0 THEN abs(actual_price - predicted_price) / actual_price * 100 END AS percentage_error,
    CASE WHEN actual_price - predicted_price >= 0 THEN 'underprediction' ELSE 'overprediction' END AS error_direction
  FROM ef)"""


def _errors(spark, d):
    return errors.error_frame(_pred_base(spark, d), "actual_log", "predicted_log")


@register("regression_metrics", f"""
WITH {_PRED_SQL}
SELECT count(*) AS n, round(sqrt(avg((actual_log - predicted_log) ^ 2)), {R}) AS rmse,
  round(avg(abs(actual_log - predicted_log)), {R}) AS mae,
  round(1 - avg((actual_log - predicted_log) ^ 2) / var_pop(actual_log), {R}) AS r2,
  round(CASE WHEN count(*) <= 3 THEN NULL ELSE 1 - (1 - (1 - avg((actual_log - predicted_log) ^ 2) / var_pop(actual_log)))
        * (count(*) - 1) / (count(*) - 2 - 1) END, {R}) AS adjusted_r2 FROM pb""")
def _regression_metrics(spark, d):
    return rnd(errors.regression_metrics(_pred_base(spark, d), "actual_log", "predicted_log", 2))


@register("error_frame", f"""
WITH {_PRED_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(actual_log, {R}) AS actual_log_price,
  round(predicted_log, {R}) AS predicted_log_price, round(actual_price, {P}) AS actual_price,
  round(predicted_price, {P}) AS predicted_price, round(residual, {P}) AS residual,
  round(absolute_error, {P}) AS absolute_error, round(percentage_error, {P}) AS percentage_error, error_direction FROM e""")
def _error_frame(spark, d):
    e = _errors(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "actual_log_price",
                                 "predicted_log_price", "actual_price", "predicted_price", "residual", "absolute_error",
                                 "percentage_error", "error_direction")
    e = e.withColumns({c: F.round(c, P) for c in ["actual_price", "predicted_price", "residual", "absolute_error",
                                                  "percentage_error"]})
    return rnd(e, "actual_log_price", "predicted_log_price")


@register("error_by_group", f"""
WITH {_PRED_SQL}
SELECT grp, count(*) AS listing_count, round(avg(absolute_error), {P}) AS mae, round(avg(residual), {P}) AS mean_residual,
  round(avg(percentage_error), {P}) AS mean_percentage_error FROM e GROUP BY grp""")
def _error_by_group(spark, d):
    g = errors.error_by_group(_errors(spark, d), "grp")
    return g.withColumns({c: F.round(c, P) for c in ["mae", "mean_residual", "mean_percentage_error"]})


@register("error_group_extended", f"""
WITH {_PRED_SQL}
SELECT l_linestatus, count(*) AS count, round(avg(actual_price), {P}) AS mean_actual,
  round(avg(predicted_price), {P}) AS mean_predicted, round(avg(abs(actual_price - predicted_price)), {P}) AS mae,
  round(avg(actual_price - predicted_price), {P}) AS bias,
  round(avg(abs(actual_price - predicted_price) / greatest(abs(actual_price), 1e-9)), {R}) AS mape,
  round(sqrt(avg((actual_price - predicted_price) ^ 2)), {P}) AS rmse,
  round(median(actual_price), {P}) AS median_actual, round(median(predicted_price), {P}) AS median_predicted,
  round(median(abs(actual_price - predicted_price)), {P}) AS median_ae, count(*) < 30 AS small_sample_flag
FROM e WHERE l_linestatus IS NOT NULL GROUP BY l_linestatus""")
def _error_group_extended(spark, d):
    g = errors.error_by_group_extended(_errors(spark, d), "l_linestatus")
    g = g.withColumns({c: F.round(c, P) for c in ["mean_actual", "mean_predicted", "mae", "bias", "rmse",
                                                  "median_actual", "median_predicted", "median_ae"]})
    return rnd(g, "mape")


@register("error_overall", f"""
WITH {_PRED_SQL}
SELECT round(avg(actual_log - predicted_log), {R}) AS mean_log_residual,
  round(avg(CASE WHEN residual < 0 THEN 1.0 ELSE 0.0 END), {R}) AS overprediction_rate,
  round(avg(CASE WHEN residual > 0 THEN 1.0 ELSE 0.0 END), {R}) AS underprediction_rate FROM e""")
def _error_overall(spark, d):
    return rnd(errors.error_overall(_errors(spark, d), "actual_log_price", "predicted_log_price"))


_TOP_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@register("top_errors", f"""
WITH {_PRED_SQL},
a AS (SELECT 'absolute' AS kind, l_orderkey, l_linenumber, l_partkey, l_suppkey, absolute_error, residual FROM e
      ORDER BY absolute_error DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 20),
o AS (SELECT 'over' AS kind, l_orderkey, l_linenumber, l_partkey, l_suppkey, absolute_error, residual FROM e
      ORDER BY residual ASC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 20),
u AS (SELECT 'under' AS kind, l_orderkey, l_linenumber, l_partkey, l_suppkey, absolute_error, residual FROM e
      ORDER BY residual DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 20)
SELECT kind, l_orderkey, l_linenumber, l_partkey, l_suppkey, round(absolute_error, {P}) AS absolute_error,
  round(residual, {P}) AS residual FROM (SELECT * FROM a UNION ALL SELECT * FROM o UNION ALL SELECT * FROM u)""")
def _top_errors(spark, d):
    e = _errors(spark, d)
    cols = _TOP_KEY + ["absolute_error", "residual"]
    key = [F.col(k) for k in _TOP_KEY]
    a = topk.top_k(e, [F.col("absolute_error").desc()] + key, 20).select(F.lit("absolute").alias("kind"), *cols)
    o = topk.top_k(e, [F.col("residual").asc()] + key, 20).select(F.lit("over").alias("kind"), *cols)
    u = topk.top_k(e, [F.col("residual").desc()] + key, 20).select(F.lit("under").alias("kind"), *cols)
    out = a.unionByName(o).unionByName(u)
    return out.withColumns({"absolute_error": F.round("absolute_error", P), "residual": F.round("residual", P)})


@register("arg_cases", """
SELECT * FROM (
  SELECT 'cheapest' AS case_name, p_partkey FROM part ORDER BY p_retailprice ASC, p_partkey LIMIT 1) UNION ALL
SELECT * FROM (SELECT 'priciest', p_partkey FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 1) UNION ALL
SELECT * FROM (SELECT 'smallest', p_partkey FROM part ORDER BY p_size ASC, p_partkey LIMIT 1) UNION ALL
SELECT * FROM (SELECT 'largest', p_partkey FROM part ORDER BY p_size DESC, p_partkey LIMIT 1)""")
def _arg_cases(spark, d):
    return topk.arg_cases(T(spark, d, "part"), {"cheapest": ("min", "p_retailprice"), "priciest": ("max", "p_retailprice"),
                                                "smallest": ("min", "p_size"), "largest": ("max", "p_size")}, "p_partkey")


@register("top_categories", """
SELECT p.* FROM part p WHERE p.p_brand IN (
  SELECT p_brand FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 5)""")
def _top_categories(spark, d):
    return topk.top_categories(T(spark, d, "part"), "p_brand", 5)


_REGISTRY_ITEMS = ["CAST(o_orderkey AS VARCHAR) AS model_version", "o_orderpriority AS model_task",
                   "CASE o_orderstatus WHEN 'F' THEN 'CHAMPION' WHEN 'O' THEN 'CANDIDATE' ELSE 'ARCHIVED' END AS status",
                   "o_orderdate AS created_at"]


@register("champion_pick", f"""
WITH r AS (SELECT {', '.join(_REGISTRY_ITEMS)} FROM orders)
SELECT * FROM (SELECT * FROM r WHERE status IN ('CHAMPION') ORDER BY CASE WHEN status = 'CHAMPION' THEN 0 ELSE 1 END,
  created_at DESC, model_version DESC LIMIT 1)
UNION ALL
SELECT * FROM (SELECT * FROM r WHERE status IN ('CHAMPION', 'CANDIDATE') AND model_task = '2-HIGH'
  ORDER BY CASE WHEN status = 'CHAMPION' THEN 0 ELSE 1 END, created_at DESC, model_version DESC LIMIT 1)""")
def _champion_pick(spark, d):
    reg = T(spark, d, "orders").selectExpr(*[i.replace("VARCHAR", "STRING") for i in _REGISTRY_ITEMS])
    a = topk.champion_first(reg)
    b = topk.champion_first(reg, task="2-HIGH", allow_candidate=True)
    return a.unionByName(b)


@register("accepted_set", """
WITH r AS (SELECT p_partkey, p_size AS n_features, p_retailprice / 1000.0 AS rmse FROM part),
f AS (SELECT rmse AS full_rmse FROM r ORDER BY n_features DESC, rmse, p_partkey LIMIT 1)
SELECT p_partkey, n_features, rmse FROM r CROSS JOIN f WHERE rmse <= full_rmse * 1.01
ORDER BY n_features, rmse, p_partkey LIMIT 1""")
def _accepted_set(spark, d):
    r = T(spark, d, "part").select("p_partkey", F.col("p_size").alias("n_features"),
                                   (F.col("p_retailprice") / 1000.0).alias("rmse"))
    return topk.smallest_accepted(r, 0.01, key="p_partkey")


@register("bounded_sample", """
SELECT * FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|42'), o_orderkey LIMIT 100""")
def _bounded_sample(spark, d):
    return topk.bounded_sample(T(spark, d, "orders"), "o_orderkey", 100, 42)


# =========================================================== joins

@register("one_to_one_join", """
SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def _one_to_one(spark, d):
    docs = T(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return joins.one_to_one_left_join(docs, T(spark, d, "labels"), "doc_id")


@register("orphan_check", """
SELECT l.* FROM lineitem l WHERE l.l_orderkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderstatus <> 'P' AND o.o_orderkey = l.l_orderkey)""")
def _orphan_check(spark, d):
    parent = T(spark, d, "orders").where(F.col("o_orderstatus") != "P")
    return joins.orphans(T(spark, d, "lineitem"), parent, "l_orderkey", "o_orderkey")


@register("coverage_count", """
SELECT count(*) AS matched_rows FROM lineitem l WHERE EXISTS (
  SELECT 1 FROM orders o WHERE o.o_orderstatus = 'F' AND o.o_orderkey = l.l_orderkey)""")
def _coverage(spark, d):
    parent = T(spark, d, "orders").where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("l_orderkey"))
    return joins.coverage_count(T(spark, d, "lineitem"), parent, "l_orderkey")


# =========================================================== segment profiles and quality

#: Components of an embedding of the driver's table; profiles use all of them.
EMB_DIMS = 64


def _emb_flat(spark, d):
    e = T(spark, d, "embeddings")
    return e.select("vec_id", "label", "embedding",
                    *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(EMB_DIMS)],
                    F.when(F.col("embedding")[1] > 0, F.lit("pos")).otherwise(F.lit("neg")).alias("sign1"),
                    F.when(F.col("embedding")[2] > 0, F.lit("pos")).otherwise(F.lit("neg")).alias("sign2"))


_EMB_FLAT_SQL = ("SELECT vec_id, label, " + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(EMB_DIMS))
                 + ", CASE WHEN embedding[2] > 0 THEN 'pos' ELSE 'neg' END AS sign1"
                 + ", CASE WHEN embedding[3] > 0 THEN 'pos' ELSE 'neg' END AS sign2 FROM embeddings")


def _dominant_sql(col: str) -> str:
    return (f"(SELECT label, {col} AS dominant_{col} FROM (SELECT label, {col}, row_number() OVER (PARTITION BY label "
            f"ORDER BY count(*) DESC, {col}) AS rn FROM f GROUP BY label, {col}) WHERE rn = 1)")


@register("cluster_profile", f"""
WITH f AS ({_EMB_FLAT_SQL}),
b AS (SELECT label, count(*) AS listing_count, round(avg(e0), {R}) AS avg_price,
        {', '.join(f'round(avg(e{i}), {R}) AS avg_e{i}' for i in range(1, EMB_DIMS))}, round(median(e0), {R}) AS median_price
      FROM f GROUP BY label)
SELECT b.*, round(listing_count * 1.0 / sum(listing_count) OVER (), {R}) AS listing_share, d1.dominant_sign1, d2.dominant_sign2
FROM b JOIN {_dominant_sql('sign1')} d1 USING (label) JOIN {_dominant_sql('sign2')} d2 USING (label)""")
def _cluster_profile(spark, d):
    from staylake.ml.segment import segment_profile
    f = _emb_flat(spark, d)
    return rnd(segment_profile(f, "label", "e0", [f"e{i}" for i in range(1, EMB_DIMS)], ["sign1", "sign2"]))


@register("cluster_quality", f"""
WITH l AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings),
c AS (SELECT label, dim, avg(x) AS c FROM l GROUP BY 1, 2),
g AS (SELECT dim, avg(x) AS g FROM l GROUP BY 1),
n AS (SELECT label, count(*) AS n_k FROM embeddings GROUP BY 1),
d AS (SELECT l.vec_id, l.label, sum((x - c) * (x - c)) AS d2 FROM l JOIN c USING (label, dim) GROUP BY 1, 2),
w AS (SELECT sum(d2) AS inertia, count(*) AS n FROM d),
s AS (SELECT label, avg(sqrt(d2)) AS s_k FROM d GROUP BY 1),
bt AS (SELECT sum(b2 * n_k) AS between, count(*) AS k FROM (SELECT label, sum((c - g) * (c - g)) AS b2 FROM c JOIN g USING (dim) GROUP BY 1) JOIN n USING (label)),
sep AS (SELECT a.label AS a, b.label AS b, sqrt(sum((a.c - b.c) * (a.c - b.c))) AS m FROM c a JOIN c b ON a.dim = b.dim AND a.label <> b.label GROUP BY 1, 2),
db AS (SELECT avg(r) AS db FROM (SELECT sep.a, max((sa.s_k + sb.s_k) / m) AS r FROM sep JOIN s sa ON sa.label = sep.a JOIN s sb ON sb.label = sep.b GROUP BY 1))
SELECT round(inertia, {R}) AS inertia, k AS clusters_observed,
  round(CASE WHEN k >= 2 AND k < n THEN (between / (k - 1)) / (inertia / (n - k)) END, {R}) AS calinski_harabasz,
  round(CASE WHEN k >= 2 AND k < n THEN db END, {R}) AS davies_bouldin FROM w CROSS JOIN bt CROSS JOIN db""")
def _cluster_quality(spark, d):
    from staylake.ml.segment import cluster_quality
    return rnd(cluster_quality(T(spark, d, "embeddings"), "vec_id", "embedding", "label"))


@register("zscore_matrix", f"""
WITH p AS (SELECT p_type, avg(p_size) AS p_size, avg(p_retailprice) AS p_retailprice FROM part GROUP BY 1),
s AS (SELECT avg(p_size) AS ms, stddev_pop(p_size) AS ss, avg(p_retailprice) AS mr, stddev_pop(p_retailprice) AS sr FROM p)
SELECT p_type, round(coalesce((p_size - ms) / CASE WHEN ss = 0 THEN 1.0 ELSE ss END, 0.0), {R}) AS p_size,
  round(coalesce((p_retailprice - mr) / CASE WHEN sr = 0 THEN 1.0 ELSE sr END, 0.0), {R}) AS p_retailprice FROM p CROSS JOIN s""")
def _zscore_matrix(spark, d):
    from staylake.ml.prep import zscore_profile
    prof = T(spark, d, "part").groupBy("p_type").agg(F.avg("p_size").alias("p_size"), F.avg("p_retailprice").alias("p_retailprice"))
    return rnd(zscore_profile(prof, ["p_size", "p_retailprice"]))


# =========================================================== preparation (M1-M6)

_HASH_SQL = "('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8))::UBIGINT"


@register("hash_split", f"""
SELECT o_orderkey, ({_HASH_SQL.format(k='o_orderkey')} % 100) < 20 AS is_test,
  CAST({_HASH_SQL.format(k='o_orderkey')} % 5 AS INTEGER) AS fold FROM orders""")
def _hash_split(spark, d):
    from staylake.ml.prep import hash_split, kfold_assign
    o = T(spark, d, "orders").select("o_orderkey")
    return kfold_assign(hash_split(o, "o_orderkey"), "o_orderkey")


@register("standardise", f"""
WITH s AS (SELECT avg(p_size) AS ms, stddev_pop(p_size) AS ss, avg(p_retailprice) AS mr, stddev_pop(p_retailprice) AS sr FROM part)
SELECT p_partkey, round((p_size - ms) / ss, {R}) AS p_size, round((p_retailprice - mr) / sr, {R}) AS p_retailprice
FROM part CROSS JOIN s""")
def _standardise(spark, d):
    from staylake.ml.prep import standardise
    p = T(spark, d, "part").select("p_partkey", F.col("p_size").cast("double"), "p_retailprice")
    return rnd(standardise(p, ["p_size", "p_retailprice"]))


@register("median_fill", f"""
WITH b AS (SELECT p_partkey, CAST({_IMPUTE_SRC} AS DOUBLE) AS v FROM part),
m AS (SELECT median(v) AS mv FROM b WHERE NOT (p_partkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')))
SELECT p_partkey, round(coalesce(v, mv), {R}) AS v FROM b CROSS JOIN m""")
def _median_fill(spark, d):
    from staylake.ml.prep import apply_fill, fit_medians
    b = T(spark, d, "part").select("p_partkey", F.expr(_IMPUTE_SRC).cast("double").alias("v"))
    held = T(spark, d, "orders").where(F.col("o_orderstatus") == "P").select(F.col("o_orderkey").alias("p_partkey"))
    train = b.join(held, "p_partkey", "left_anti")
    return rnd(apply_fill(b, fit_medians(train, ["v"])), "v")


@register("onehot", """
WITH cats AS (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS idx FROM (SELECT DISTINCT p_type FROM part WHERE p_type <> 'PROMO'))
SELECT p.p_partkey, p.p_type, CAST(coalesce(c.idx, -1) AS INTEGER) AS hot_index FROM part p LEFT JOIN cats c ON p.p_type = c.p_type""")
def _onehot(spark, d):
    from staylake.ml.prep import hot_position, onehot_pipeline
    p = T(spark, d, "part").select("p_partkey", "p_type")
    model = onehot_pipeline(["p_type"]).fit(p.where(F.col("p_type") != "PROMO"))
    return model.transform(p).select("p_partkey", "p_type", hot_position("p_type__oh").alias("hot_index"))


@register("infrequent", """
WITH f AS (SELECT p_name FROM part WHERE p_size <= 40 AND p_name IS NOT NULL GROUP BY 1 HAVING count(*) >= 30)
SELECT p.p_partkey, CASE WHEN p.p_name IS NULL THEN NULL WHEN f.p_name IS NULL THEN 'infrequent' ELSE p.p_name END AS p_name
FROM part p LEFT JOIN f ON p.p_name = f.p_name""")
def _infrequent(spark, d):
    from staylake.ml.prep import bucket_infrequent
    p = T(spark, d, "part").select("p_partkey", "p_name", "p_size")
    return bucket_infrequent(p.where(F.col("p_size") <= 40), p, "p_name", 30).select("p_partkey", "p_name")


# =========================================================== models (M7-M29): rows-only checks, no SQL oracle

def _emb_vectors(spark, d):
    from staylake.ml.segment import as_vector
    return as_vector(T(spark, d, "embeddings"), "embedding")


@register("kmeans_segments")
def _kmeans_segments(spark, d):
    """k-means (k=3, best of 10 seeds) on the embeddings, ids named by centroid signature."""
    from staylake.ml import segment as S
    v = _emb_vectors(spark, d)
    model = S.fit_kmeans(v)
    assigned = S.assign(model, v)
    cents = S.centroid_table(model).select("cluster_id", F.col("f0").alias("accommodates"),
                                           F.col("f1").alias("minimum_nights_log"))
    names = S.name_segments(cents, "accommodates", "minimum_nights_log")
    return S.attach_names(assigned, names).select("vec_id", "label", "cluster_id", "cluster_name", "distance_to_centroid")


@register("segment_mart_model")
def _segment_mart_model(spark, d):
    """Segmentation on the cluster mart: one-hot + scaled numerics, k-means, names, profile."""
    from staylake.ml import segment as S
    mart = features.cluster_model_features(B.spread_part_listings(spark, d)).cache()
    model = S.fit_segmentation(mart)
    names = S.name_segments(S.centroid_signature(model, mart), "accommodates", "minimum_nights_log")
    # the profile joins several aggregates of its rows; in such joins a cached mart is not found again and is computed anew
    assigned = cut_lineage(S.segment_assign(model, mart).select("cluster_id", "price", *S.SEGMENT_NUMERIC, *S.SEGMENT_CATEGORICAL))
    mart.unpersist()
    prof = S.segment_profile(assigned, "cluster_id", "price", S.SEGMENT_NUMERIC, S.SEGMENT_CATEGORICAL)
    return prof.join(names, "cluster_id", "left")


@register("elbow")
def _elbow(spark, d):
    from staylake.ml.segment import elbow
    return elbow(_emb_vectors(spark, d), [2, 3, 4, 5, 6], n_init=10)


@register("pca")
def _pca(spark, d):
    from staylake.ml.segment import pca_2d
    return pca_2d(_emb_vectors(spark, d).select("vec_id", "label", "features"))


@register("centroids")
def _centroids(spark, d):
    from staylake.ml import segment as S
    return S.centroid_table(S.fit_kmeans(_emb_vectors(spark, d)))


@register("silhouette", f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda e: CAST(e AS DOUBLE)) AS x FROM embeddings),
p AS (SELECT 'squaredEuclidean' AS distance, vec_id, label, x FROM v
      UNION ALL SELECT 'cosine', vec_id, label, list_transform(x, lambda e: e / sqrt(list_dot_product(x, x))) FROM v),
l AS (SELECT distance, label, unnest(x) AS e, generate_subscripts(x, 1) AS dim FROM p),
t AS (SELECT distance, label, dim, sum(e) AS total FROM l GROUP BY ALL),
k AS (SELECT distance, label, list(total ORDER BY dim) AS total FROM t GROUP BY ALL),
z AS (SELECT distance, label, count(*) AS n, sum(list_dot_product(x, x)) AS squares FROM p GROUP BY ALL),
m AS (SELECT p.distance, p.vec_id, p.label = k.label AS own, z.n,
        CASE WHEN p.distance = 'cosine' THEN 1 - list_dot_product(p.x, k.total) / z.n
        ELSE list_dot_product(p.x, p.x) + (z.squares - 2 * list_dot_product(p.x, k.total)) / z.n END AS mean
      FROM p JOIN k ON k.distance = p.distance JOIN z ON z.distance = k.distance AND z.label = k.label),
ab AS (SELECT distance, vec_id, max(n) FILTER (own) AS n, max(mean * n / greatest(n - 1, 1)) FILTER (own) AS a, min(mean) FILTER (NOT own) AS b
       FROM m GROUP BY ALL)
SELECT distance, round(avg(CASE WHEN n = 1 OR a = b THEN 0 WHEN a < b THEN 1 - a / b ELSE b / a - 1 END), {R}) AS silhouette FROM ab GROUP BY distance""")
def _silhouette(spark, d):
    from staylake.ml.segment import silhouette
    v = _emb_vectors(spark, d).withColumn("label", F.col("label").cast("double"))
    s = silhouette(v, "features", "label")
    c = silhouette(v, "features", "label", "cosine")
    return rnd(spark.createDataFrame([("squaredEuclidean", s), ("cosine", c)], "distance string, silhouette double"))


def _price_frame(spark, d):
    return features.modelling_frame(features.price_model_features(B.spread_part_listings(spark, d)))


def _price_cfg():
    from staylake.ml.price import PriceConfig
    return PriceConfig()


@register("price_model")
def _price_model(spark, d):
    from staylake.ml.price import train_evaluate
    _, metrics, _ = train_evaluate(_price_frame(spark, d), _price_cfg())
    return metrics


@register("price_cv")
def _price_cv(spark, d):
    from staylake.ml.price import cross_validate, cv_summary
    m, _ = cross_validate(_price_frame(spark, d), _price_cfg())
    return cv_summary(m.withColumn("model", F.lit("gbt")))


@register("price_baselines")
def _price_baselines(spark, d):
    from staylake.ml.price import baselines
    return baselines(_price_frame(spark, d), _price_cfg())


@register("price_tuning")
def _price_tuning(spark, d):
    from staylake.ml.price import random_search
    # ten trials; trees small enough for a query, the stop rule after three complete trials
    space = {"stepSize": ("log", 0.01, 0.3), "maxDepth": ("int", 2, 5), "maxIter": [5, 10]}
    return random_search(_price_frame(spark, d), _price_cfg(), space, 10, startup_trials=3)


@register("price_baselines_cv")
def _price_baselines_cv(spark, d):
    """Baseline families ranked by 5-fold CV, with fit and predict seconds and adjusted R^2."""
    from staylake.ml.price import baselines_cv
    return baselines_cv(_price_frame(spark, d), _price_cfg(), params={"gbt": {"maxIter": 10}, "rf": {"numTrees": 10}})


@register("price_importance")
def _price_importance(spark, d):
    from staylake.ml.explain import native_importance
    from staylake.ml.price import train_evaluate
    frame = _price_frame(spark, d)
    cfg = _price_cfg()
    model, _, _ = train_evaluate(frame, cfg)
    return native_importance(model, frame, list(cfg.features))


@register("price_permutation")
def _price_permutation(spark, d):
    from staylake.ml.explain import permutation_importance
    from staylake.ml.price import train_evaluate
    frame = _price_frame(spark, d)
    cfg = _price_cfg()
    model, _, _ = train_evaluate(frame, cfg)
    return permutation_importance(model, frame, list(cfg.features), "listing_id")


@register("price_pdp")
def _price_pdp(spark, d):
    from staylake.ml.explain import partial_dependence
    from staylake.ml.price import train_evaluate
    frame = _price_frame(spark, d)
    model, _, _ = train_evaluate(frame, _price_cfg())
    return partial_dependence(model, frame, "accommodates", [1, 5, 10, 20, 40])


@register("model_roundtrip", f"""
WITH {B.part_listing_cte()}
SELECT count(*) AS rows, 0 AS non_finite, 0 AS negative, 0 AS null_keys, 0 AS duplicate_keys FROM plistings WHERE price > 0""")
def _model_roundtrip(spark, d):
    """Train, register, promote, look up the champion, score the whole table, append once."""
    import uuid as _uuid
    from staylake.ml import registry as REG
    from staylake.plans import jobs
    from staylake.session import ensure_checkpoint_dir
    root = ensure_checkpoint_dir(spark).rstrip("/") + f"/staylake_models_{_uuid.uuid4().hex[:8]}"
    schema = f"staylake_reg_{_uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{root}/db'")
    mart = features.price_model_features(B.spread_part_listings(spark, d))
    version = jobs.run_price_training(spark, mart, root + "/artifacts", schema, _price_cfg())
    REG.promote(spark, schema, "price_prediction", version)
    return jobs.run_price_inference(spark, mart, "batch_" + version, schema)


# =========================================================== silver models on raw text

@register("silver_calendar", RAW.SILVER_CALENDAR_SQL)
def _silver_calendar(spark, d):
    return rnd(silver.silver_calendar(RAW.raw_calendar(spark, d)))


@register("silver_calendar_drops", f"""
SELECT count(*) AS rows_before, (SELECT count(*) FROM ({RAW.SILVER_CALENDAR_SQL})) AS rows_after,
  count(*) - (SELECT count(*) FROM ({RAW.SILVER_CALENDAR_SQL})) AS rows_dropped FROM lineitem""")
def _silver_calendar_drops(spark, d):
    raw = RAW.raw_calendar(spark, d)
    return dedup.dropped_by_dedup(raw, silver.silver_calendar(raw))


@register("silver_reviews", RAW.SILVER_REVIEWS_SQL)
def _silver_reviews(spark, d):
    return silver.silver_reviews(RAW.raw_reviews(spark, d))


@register("silver_neighbourhoods", RAW.SILVER_NEIGHBOURHOODS_SQL)
def _silver_neighbourhoods(spark, d):
    return silver.silver_neighbourhoods(RAW.raw_neighbourhoods(spark, d))


@register("silver_listings", RAW.SILVER_LISTINGS_SQL)
def _silver_listings(spark, d):
    return rnd(silver.silver_listings(RAW.raw_listings(spark, d)))


@register("most_frequent", """
SELECT (SELECT p_type FROM part WHERE p_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, p_type LIMIT 1) AS p_type,
  (SELECT CAST(p_size AS VARCHAR) FROM part WHERE p_size <> 7 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS p_size""")
def _most_frequent(spark, d):
    from staylake.ml.prep import most_frequent
    return most_frequent(T(spark, d, "part").withColumn("p_size", F.nullif(F.col("p_size"), F.lit(7))), ["p_type", "p_size"])


@register("read_required_columns", """
SELECT p_type, count(*) AS parts, sum(p_size) AS sizes FROM part GROUP BY p_type""")
def _read_required_columns(spark, d):
    """Format by suffix, required and available optional columns, first existing table, SQL with a bound parameter."""
    from staylake.sources import io
    part = io.select_available(io.read_any(spark, f"{d}/part.parquet"), ["p_partkey", "p_type"], ["p_size", "p_colour"])
    io.validate_frame(part, ["p_partkey", "p_type", "p_size"], key="p_partkey", finite=["p_size"])
    part.createOrReplaceTempView("staylake_read_part")
    name = io.first_existing_table(spark, ["staylake_no_such_table", "staylake_read_part"])
    return io.run_sql(spark, f"SELECT p_type, count(*) AS parts, sum(p_size) AS sizes FROM {name} WHERE p_partkey >= :low GROUP BY p_type",
                      {"low": 0})


def _own_schema(spark, name: str) -> str:
    """A new database in the shared folder, for a query that writes tables."""
    import uuid as _uuid
    from staylake.session import ensure_checkpoint_dir
    schema = f"staylake_{name}_{_uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{ensure_checkpoint_dir(spark).rstrip('/')}/{schema}'")
    return schema


@register("staged_replace", """
SELECT CAST(o_custkey % 5 AS INTEGER) AS cluster_id, count(*) AS listings, sum(o_orderkey) AS key_sum
FROM orders GROUP BY 1""")
def _staged_replace(spark, d):
    """Publish a group per order, then try to replace it by rows that fail the audit: the first rows stay."""
    from staylake.sources.sinks import replace_staged
    orders = T(spark, d, "orders")
    rows = orders.select("o_orderkey", (F.col("o_custkey") % 5).alias("cluster_id"))
    table, types = _own_schema(spark, "publish") + ".order_groups", {"o_orderkey": "bigint", "cluster_id": "int"}
    rules = dict(expected_rows=orders.count(), ranges={"cluster_id": (0, 4)}, source=orders)
    replace_staged(rows, table, "o_orderkey", types, **rules)
    try:
        replace_staged(rows.withColumn("cluster_id", F.col("cluster_id") + 1), table, "o_orderkey", types, **rules)
    except ValueError:
        pass
    return spark.table(table).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("listings"), F.sum("o_orderkey").alias("key_sum"))


@register("run_appends", """
SELECT event_type AS assignment_run_id, count(*) AS listings, sum(event_id) AS key_sum,
  count(DISTINCT model_version) AS versions, min(model_version) AS model_version
FROM (SELECT event_id, event_type, CASE WHEN event_type = (SELECT min(event_type) FROM events) THEN 'second' ELSE 'first' END AS model_version
      FROM events WHERE event_type IS NOT NULL) GROUP BY 1""")
def _run_appends(spark, d):
    """One run per event type is appended; a retry is rejected, and one run is replaced by a second attempt."""
    from staylake.ml import registry as REG
    schema = _own_schema(spark, "runs")
    REG.ensure_tables(spark, schema, {"gold_listing_segments": REG.RESULT_TABLES["gold_listing_segments"]})
    table = f"{schema}.gold_listing_segments"
    events = T(spark, d, "events").where(F.col("event_type").isNotNull())
    rows = events.select(F.col("event_id").alias("listing_id"), F.lit("first").alias("model_version"),
                         F.col("event_type").alias("assignment_run_id"))
    REG.append_run_once(rows, table, "assignment_run_id", "listing_id")
    again = rows.where(F.col("assignment_run_id") == events.agg(F.min("event_type")).first()[0])
    try:
        REG.append_run_once(again, table, "assignment_run_id", "listing_id")
    except ValueError:
        pass
    REG.append_run_once(again.withColumn("model_version", F.lit("second")), table, "assignment_run_id", "listing_id", "replace")
    return spark.table(table).groupBy("assignment_run_id").agg(
        F.count(F.lit(1)).alias("listings"), F.sum("listing_id").alias("key_sum"),
        F.count_distinct("model_version").alias("versions"), F.min("model_version").alias("model_version"))


# =========================================================== derived measures (B17, B18), segment prices

@register("derived_rates", f"""
WITH m AS (SELECT max(l_discount) AS md, max(l_tax) AS mt FROM lineitem)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
  round(CASE WHEN m.md <= 1 THEN l.l_discount * 100.0 ELSE l.l_discount END, {R}) AS l_discount,
  round(CASE WHEN m.mt <= 1 THEN l.l_tax * 100.0 ELSE l.l_tax END, {R}) AS l_tax,
  round(l.l_quantity / 30.0, {R}) AS availability_30_rate,
  round(datediff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) / 365.25, {R}) AS tenure_years,
  round(datediff('day', CAST(o.o_orderdate AS DATE), DATE '2026-01-01') / 365.25, {R}) AS tenure_fixed
FROM lineitem l CROSS JOIN m JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def _derived_rates(spark, d):
    from staylake.functions.derived import availability_rates, rescale_fraction_percent, tenure_years
    li = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount", "l_tax",
                                        F.col("l_quantity").alias("availability_30"), "l_shipdate")
    o = T(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    x = rescale_fraction_percent(availability_rates(li), ["l_discount", "l_tax"]).join(o, "l_orderkey")
    out = x.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount", "l_tax", "availability_30_rate",
                   tenure_years("o_orderdate", "l_shipdate").alias("tenure_years"),
                   tenure_years("o_orderdate").alias("tenure_fixed"))
    return rnd(out)


@register("segment_price_summary", f"""
SELECT label, round(quantile_cont(e0, 0.25), {R}) AS p25, round(quantile_cont(e0, 0.5), {R}) AS median,
  round(quantile_cont(e0, 0.75), {R}) AS p75, round(avg(e0), {R}) AS mean, count(*) AS n
FROM ({_EMB_FLAT_SQL}) GROUP BY label""")
def _segment_price_summary(spark, d):
    from staylake.ml.segment import segment_price_summary
    return rnd(segment_price_summary(_emb_flat(spark, d), "label", "e0"))


@register("segment_centre", f"""
SELECT label, count(*) AS n, round(quantile_cont(e1, 0.5), {R}) AS e1_median, round(quantile_cont(e2, 0.5), {R}) AS e2_median
FROM ({_EMB_FLAT_SQL}) GROUP BY label""")
def _segment_centre(spark, d):
    from staylake.ml.segment import segment_centre
    return rnd(segment_centre(_emb_flat(spark, d), "label", ["e1", "e2"]))


@register("first_words", f"""
WITH words AS (SELECT coalesce(regexp_extract(p_name, '[^ ]+', 0), 'none') AS word, p_retailprice FROM part),
per_word AS (SELECT word, count(*) AS parts, count(*) FILTER (isfinite(p_retailprice)) AS priced FROM words GROUP BY word)
SELECT word, parts, priced, round(parts / sum(parts) OVER (), {R}) AS share FROM per_word""")
def _first_words(spark, d):
    words = impute.fill_constant(T(spark, d, "part").select(C.first_word("p_name").alias("word"), "p_retailprice"), ["word"], "none")
    per = words.groupBy("word").agg(F.count(F.lit(1)).alias("parts"), F.count_if(C.is_finite("p_retailprice")).alias("priced"))
    return rnd(profile.share_of_total(per, "parts"), "share")


_RANKED = "rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0"


@register("spearman_matrix", "UNION ALL".join(f"""
SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr(ra, rb), {R}) AS spearman, count(*) AS n
FROM (SELECT {_RANKED.format(c=a)} AS ra, {_RANKED.format(c=b)} AS rb FROM lineitem WHERE {a} IS NOT NULL AND {b} IS NOT NULL)
""" for a, b in (("l_quantity", "l_discount"), ("l_quantity", "l_tax"), ("l_discount", "l_tax"))))
def _spearman_matrix(spark, d):
    return rnd(stats.spearman_matrix(T(spark, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"]).drop("p_value"), "spearman")


@register("price_feature_selection")
def _price_feature_selection(spark, d):
    """Top-k feature subsets by importance, CV RMSE each, smallest accepted set."""
    from staylake.ml.explain import native_importance
    from staylake.ml.price import feature_selection, train_evaluate
    frame = _price_frame(spark, d)
    cfg = _price_cfg()
    model, _, _ = train_evaluate(frame, cfg)
    ranked = [r.feature for r in native_importance(model, frame, list(cfg.features)).orderBy("rank").collect()]
    table, chosen = feature_selection(frame, cfg, ranked, (5, 10, 15))
    return table.join(chosen.select("n_features", F.lit(True).alias("chosen")), "n_features", "left") \
        .fillna(False, subset=["chosen"])


@register("segmentation_job")
def _segmentation_job(spark, d):
    """Fit + name + persist + register the segmentation model, then score the whole mart
    through the registry (candidate allowed) with an idempotent append."""
    import uuid as _uuid
    from staylake.plans import jobs
    from staylake.session import ensure_checkpoint_dir
    root = ensure_checkpoint_dir(spark).rstrip("/") + f"/staylake_seg_{_uuid.uuid4().hex[:8]}"
    schema = f"staylake_seg_{_uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{root}/db'")
    mart = features.cluster_model_features(B.spread_part_listings(spark, d)).cache()
    version = jobs.run_segmentation(spark, mart, root + "/artifacts", schema)
    return jobs.run_segment_inference(spark, mart, "batch_" + version, schema, allow_candidate=True)


# =========================================================== validation, ranks, study tables

@register("frame_validation", """
SELECT count(*) AS rows, count(*) FILTER (WHERE o_custkey IS NULL) AS null_keys,
  count(o_custkey) - count(DISTINCT o_custkey) AS duplicate_keys,
  count(*) FILTER (WHERE o_totalprice IS NOT NULL AND (isnan(o_totalprice) OR abs(o_totalprice) = 'inf'::DOUBLE)) AS nonfinite_o_totalprice
FROM orders""")
def _frame_validation(spark, d):
    from staylake.sources.io import validation_counts
    return validation_counts(T(spark, d, "orders"), "o_custkey", ["o_totalprice"])


@register("running_best", f"""
SELECT o_custkey, o_orderkey, o_orderdate, round(o_totalprice, {R}) AS o_totalprice,
  round(min(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), {R}) AS best_so_far FROM orders""")
def _running_best(spark, d):
    from staylake.ml.price import running_best
    o = T(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return rnd(running_best(o, "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice"))


@register("rank_within_group", """
SELECT p_partkey, p_type, p_retailprice,
  row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part""")
def _rank_within_group(spark, d):
    p = T(spark, d, "part").select("p_partkey", "p_type", "p_retailprice")
    return topk.rank_within(p, [F.col("p_retailprice").desc(), F.col("p_partkey")], ["p_type"])


_FOLD_ITEMS = ["o_orderpriority AS model", "o_orderkey AS fold", "o_totalprice / 100000.0 AS rmse",
               "o_totalprice / 200000.0 AS mae", "1.0 - o_totalprice / 600000.0 AS r2",
               "CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'ok' END AS status"]


@register("cv_summary", f"""
SELECT model, round(avg(rmse), {R}) AS rmse_mean, round(avg(mae), {R}) AS mae_mean, round(avg(r2), {R}) AS r2_mean,
  round(stddev_samp(rmse), {R}) AS rmse_std, round(stddev_samp(mae), {R}) AS mae_std, round(stddev_samp(r2), {R}) AS r2_std,
  count(*) AS folds
FROM (SELECT {', '.join(_FOLD_ITEMS)} FROM orders) WHERE status = 'ok' GROUP BY model""")
def _cv_summary(spark, d):
    from staylake.ml.price import cv_summary
    folds = T(spark, d, "orders").selectExpr(*_FOLD_ITEMS)
    return rnd(cv_summary(folds))


@register("metrics_long", f"""
WITH {_PRED_SQL},
m AS (SELECT CAST(count(*) AS DOUBLE) AS n, sqrt(avg((actual_log - predicted_log) ^ 2)) AS rmse,
        avg(abs(actual_log - predicted_log)) AS mae, 1 - avg((actual_log - predicted_log) ^ 2) / var_pop(actual_log) AS r2,
        CASE WHEN count(*) <= 3 THEN NULL ELSE 1 - (1 - (1 - avg((actual_log - predicted_log) ^ 2) / var_pop(actual_log)))
          * (count(*) - 1) / (count(*) - 2 - 1) END AS adjusted_r2 FROM pb)
SELECT 'group_mean_v1' AS model_version, 'price_prediction' AS model_task, 'test' AS dataset_type, metric_name,
  round(metric_value, {R}) AS metric_value, CAST(NULL AS DOUBLE) AS metric_std
FROM m UNPIVOT INCLUDE NULLS (metric_value FOR metric_name IN (n, rmse, mae, r2, adjusted_r2))""")
def _metrics_long(spark, d):
    from staylake.ml.registry import metrics_long
    wide = errors.regression_metrics(_pred_base(spark, d), "actual_log", "predicted_log", 2)
    return rnd(metrics_long(wide, "group_mean_v1", "price_prediction", "test").drop("evaluated_at"), "metric_value")


# =========================================================== fitted models with a closed form
# The model code of the queries above on settings whose fit SQL can state: medians and least squares with one
# feature, k-means on groups far apart, two principal components of two columns.

_LINE_ROWS_SQL = f"""{B.part_listing_cte()},
rows AS (SELECT listing_id, CAST(accommodates AS DOUBLE) AS x, ln(1 + CAST(price AS DOUBLE)) AS y,
           ({_HASH_SQL.format(k='listing_id')} % 100) < 20 AS is_test, CAST({_HASH_SQL.format(k='listing_id')} % 5 AS INTEGER) + 1 AS fold
         FROM plistings WHERE price > 0)"""

_HOLDOUT_SQL = f"""{_LINE_ROWS_SQL},
line AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS base FROM rows WHERE NOT is_test),
pred AS (SELECT listing_id, x, y, base + slope * x AS p FROM rows CROSS JOIN line WHERE is_test)"""

_FOLDS_SQL = f"""{_LINE_ROWS_SQL},
fitted AS (SELECT f.fold, median(t.y) AS med, regr_slope(t.y, t.x) AS slope, regr_intercept(t.y, t.x) AS base
           FROM (SELECT DISTINCT fold FROM rows) f JOIN rows t ON t.fold <> f.fold GROUP BY f.fold),
pred AS (SELECT 'median' AS model, 0 AS width, fold, y, med AS p FROM rows JOIN fitted USING (fold)
         UNION ALL SELECT 'linear', 1, fold, y, base + slope * x FROM rows JOIN fitted USING (fold)),
folds AS (SELECT model, fold, count(*) AS n, sqrt(avg((y - p) ^ 2)) AS rmse, avg(abs(y - p)) AS mae, 1 - avg((y - p) ^ 2) / var_pop(y) AS r2,
            1 - avg((y - p) ^ 2) / var_pop(y) * (count(*) - 1) / (count(*) - width - 1) AS adjusted_r2
          FROM pred GROUP BY model, width, fold)"""


def _line_cfg():
    from staylake.ml.price import PriceConfig
    return PriceConfig(features=("accommodates",), algorithm="linear", params={})


@register("price_fold_metrics", f"""
WITH {_FOLDS_SQL}
SELECT model, fold, n, round(rmse, {R}) AS rmse, round(mae, {R}) AS mae, round(r2, {R}) AS r2, round(adjusted_r2, {R}) AS adjusted_r2, 'ok' AS status FROM folds""")
def _price_fold_metrics(spark, d):
    """Every fold of the 5-fold CV of the median and of least squares on one feature."""
    from staylake.ml.price import cached_folds, cross_validate
    cfg, found = _line_cfg(), []
    folds = cached_folds(_price_frame(spark, d), cfg)
    for algorithm in ("median", "linear"):
        metrics, _ = cross_validate(folds, cfg, algorithm, folds=folds)
        found.append(metrics.select(F.lit(algorithm).alias("model"), "fold", "n", "rmse", "mae", "r2", "adjusted_r2", "status"))
    folds.unpersist()
    return rnd(found[0].unionByName(found[1]))


@register("price_fold_predictions", f"""
WITH {_LINE_ROWS_SQL},
fitted AS (SELECT f.fold, regr_slope(t.y, t.x) AS slope, regr_intercept(t.y, t.x) AS base
           FROM (SELECT DISTINCT fold FROM rows) f JOIN rows t ON t.fold <> f.fold GROUP BY f.fold)
SELECT listing_id, fold, round(y, {R}) AS log_price, round(base + slope * x, {R}) AS predicted_log_price FROM rows JOIN fitted USING (fold)""")
def _price_fold_predictions(spark, d):
    """Out-of-fold predictions: each listing by the model that has not seen its fold."""
    from staylake.ml.price import cross_validate
    _, predictions = cross_validate(_price_frame(spark, d), _line_cfg())
    return rnd(predictions)


@register("price_baseline_ranking", f"""
WITH {_FOLDS_SQL},
means AS (SELECT model, avg(rmse) AS rmse, avg(mae) AS mae, avg(r2) AS r2, avg(adjusted_r2) AS adjusted_r2,
            stddev_samp(rmse) AS s_rmse, stddev_samp(mae) AS s_mae, stddev_samp(r2) AS s_r2, stddev_samp(adjusted_r2) AS s_adjusted_r2, count(*) AS folds
          FROM folds GROUP BY model)
SELECT model, round(rmse, {R}) AS rmse_mean, round(mae, {R}) AS mae_mean, round(r2, {R}) AS r2_mean, round(adjusted_r2, {R}) AS adjusted_r2_mean,
  round(s_rmse, {R}) AS rmse_std, round(s_mae, {R}) AS mae_std, round(s_r2, {R}) AS r2_std, round(s_adjusted_r2, {R}) AS adjusted_r2_std, folds,
  CAST(row_number() OVER (ORDER BY rmse, mae) AS INTEGER) AS rank FROM means""")
def _price_baseline_ranking(spark, d):
    """The two baselines ranked by CV, without the seconds."""
    from staylake.ml.price import baselines_cv
    ranked = baselines_cv(_price_frame(spark, d), _line_cfg(), ("median", "linear"))
    return rnd(ranked.drop("fit_seconds_mean", "predict_seconds_mean"))


@register("price_line_predictions", f"""
WITH {_HOLDOUT_SQL}
SELECT listing_id, round(y, {R}) AS log_price, round(p, {R}) AS predicted_log_price, round(greatest(exp(p) - 1, 0), 4) AS predicted_price FROM pred""")
def _price_line_predictions(spark, d):
    from staylake.ml.price import train_evaluate
    _, _, pred = train_evaluate(_price_frame(spark, d), _line_cfg())
    return rnd(pred.select("listing_id", "log_price", "predicted_log_price", F.round("predicted_price", 4).alias("predicted_price")))


@register("price_line_metrics", f"""
WITH {_HOLDOUT_SQL}
SELECT count(*) AS n, round(sqrt(avg((y - p) ^ 2)), {R}) AS rmse, round(avg(abs(y - p)), {R}) AS mae, round(1 - avg((y - p) ^ 2) / var_pop(y), {R}) AS r2,
  round(1 - avg((y - p) ^ 2) / var_pop(y) * (count(*) - 1) / (count(*) - 2), {R}) AS adjusted_r2 FROM pred""")
def _price_line_metrics(spark, d):
    from staylake.ml.price import train_evaluate
    _, metrics, _ = train_evaluate(_price_frame(spark, d), _line_cfg())
    return rnd(metrics)


@register("price_line_dependence", f"""
WITH {_HOLDOUT_SQL}
SELECT CAST(grid_value AS DOUBLE) AS grid_value, round(base + slope * grid_value, {R}) AS avg_predicted_log_price
FROM line CROSS JOIN (SELECT unnest([0, 1, 2, 3, 5, 8]) AS grid_value)""")
def _price_line_dependence(spark, d):
    from staylake.ml.explain import partial_dependence
    from staylake.ml.price import train_evaluate
    frame = _price_frame(spark, d)
    model, _, _ = train_evaluate(frame, _line_cfg())
    return rnd(partial_dependence(model, frame, "accommodates", [0, 1, 2, 3, 5, 8]))


# a point per line item, at its return flag and status, moved by its discount and tax
_POINT_ITEMS = ["l_returnflag", "l_linestatus",
                "CASE l_returnflag WHEN 'A' THEN 0.0 WHEN 'N' THEN 10.0 ELSE 20.0 END + CASE l_linestatus WHEN 'F' THEN 0.0 ELSE 4.0 END"
                " + CAST(l_discount AS DOUBLE) AS x",
                "CASE l_returnflag WHEN 'A' THEN 0.0 WHEN 'N' THEN 7.0 ELSE 3.0 END + CASE l_linestatus WHEN 'F' THEN 0.0 ELSE 100.0 END"
                " + CAST(l_tax AS DOUBLE) AS y"]
_POINTS_SQL = f"points AS (SELECT CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, l_returnflag, l_linestatus FROM (SELECT {', '.join(_POINT_ITEMS)} FROM lineitem))"


def _points(spark, d):
    from staylake.ml.segment import as_vector
    items = T(spark, d, "lineitem").selectExpr(*_POINT_ITEMS).withColumns({c: F.col(c).cast("double") for c in "xy"})
    return as_vector(items, ["x", "y"])


@register("kmeans_groups", f"""
WITH {_POINTS_SQL},
g AS (SELECT l_returnflag, l_linestatus, avg(x) AS cx, avg(y) AS cy FROM points GROUP BY ALL),
s AS (SELECT g.*, count(*) AS n, avg(sqrt((x - cx) ^ 2 + (y - cy) ^ 2)) AS mean_distance, max(sqrt((x - cx) ^ 2 + (y - cy) ^ 2)) AS max_distance
      FROM g JOIN points USING (l_returnflag, l_linestatus) GROUP BY ALL),
o AS (SELECT *, row_number() OVER (ORDER BY cx DESC) AS by_x FROM s),
named AS (SELECT *, CASE WHEN by_x = 1 THEN 1 WHEN row_number() OVER (PARTITION BY by_x = 1 ORDER BY cy DESC) = 1 THEN 2 ELSE 3 END AS kind FROM o)
SELECT CASE kind WHEN 1 THEN 'Large short-stay group homes' WHEN 2 THEN 'Long-stay standard apartments' ELSE 'Standard short-stay listings' END AS cluster_name,
  round(cx, {R}) AS x, round(cy, {R}) AS y, n, round(mean_distance, {R}) AS mean_distance, round(max_distance, {R}) AS max_distance FROM named""")
def _kmeans_groups(spark, d):
    """k-means on groups far apart: the centroids are the groups' means; segments named by their centroids."""
    from staylake.ml import segment as S
    points = _points(spark, d)
    k = points.select("l_returnflag", "l_linestatus").distinct().count()
    model = S.fit_kmeans(points, k)
    centroids = S.centroid_table(model, ["x", "y"])
    assigned = S.attach_names(S.assign(model, points).drop("x", "y"), S.name_segments(centroids, "x", "y"))
    sizes = assigned.groupBy("cluster_id", "cluster_name").agg(
        F.count(F.lit(1)).alias("n"), F.avg("distance_to_centroid").alias("mean_distance"), F.max("distance_to_centroid").alias("max_distance"))
    return rnd(sizes.join(F.broadcast(centroids), "cluster_id").select("cluster_name", "x", "y", "n", "mean_distance", "max_distance"))


@register("elbow_groups", f"""
WITH {_POINTS_SQL},
w AS (SELECT l_linestatus, l_returnflag, count(*) AS n, var_pop(x) + var_pop(y) AS v FROM points GROUP BY GROUPING SETS ((l_linestatus), (l_linestatus, l_returnflag)))
SELECT CAST(count(*) AS INTEGER) AS k, round(sum(n * v) / sum(n), 4) AS mean_inertia FROM w GROUP BY l_returnflag IS NULL""")
def _elbow_groups(spark, d):
    """Inertia per row at two cluster counts whose best split is plain: by status, and by status and flag."""
    from staylake.ml import segment as S
    points = _points(spark, d)
    rows, both = points.count(), points.select("l_returnflag", "l_linestatus").distinct().count()
    single = points.select("l_linestatus").distinct().count()
    table = S.elbow(points, [single, both], n_init=S.DEFAULT_N_INIT)
    return table.select("k", F.round(F.col("inertia") / rows, 4).alias("mean_inertia"))


@register("pca_pair", f"""
WITH v AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS a, CAST(l_extendedprice AS DOUBLE) / 1000 AS b FROM lineitem),
m AS (SELECT avg(a) AS ma, avg(b) AS mb, var_samp(a) AS va, var_samp(b) AS vb, covar_samp(a, b) AS c FROM v),
e AS (SELECT *, (va + vb) / 2 + sqrt(((va - vb) / 2) ^ 2 + c ^ 2) AS top FROM m),
u AS (SELECT *, c / sqrt(c ^ 2 + (top - va) ^ 2) AS ua, (top - va) / sqrt(c ^ 2 + (top - va) ^ 2) AS ub FROM e)
SELECT l_orderkey, l_linenumber, round(abs((a - ma) * ua + (b - mb) * ub), 4) AS pc1, round(abs((b - mb) * ua - (a - ma) * ub), 4) AS pc2 FROM v CROSS JOIN u""")
def _pca_pair(spark, d):
    """Both principal components of two columns, without their sign."""
    from staylake.ml.segment import as_vector, pca_2d
    items = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("a"),
                                           (F.col("l_extendedprice").cast("double") / 1000).alias("b"))
    pcs = pca_2d(as_vector(items, ["a", "b"]).drop("a", "b"))
    return pcs.select("l_orderkey", "l_linenumber", *[F.round(F.abs(c), 4).alias(c) for c in ("pc1", "pc2")])
